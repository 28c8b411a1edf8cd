"""Byte-level BPE encoding and decoding with a pair occurrence index.

The distinct words of a batch lie side by side in one symbol array. An index maps each mergeable
pair to all its positions. Ranks that occur are applied in ascending order, each to all its
positions at once, and the pairs to the left and right of a merge join the lists of their ranks.
Words already encoded by the task are kept in a bounded cache; the bound changes speed only.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame

from tidestar.llm.batches import map_rows

#: How byte-level BPE splits a text into words before merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words a task remembers before it starts anew.
CACHE_WORDS = 150_000
SCHEMA = "doc_id bigint, n_tokens bigint, ids binary, ids_sha256 string, decoded_sha256 string"


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairIndexBPE:
    """Encoder and decoder for one byte-level vocabulary file of the tokenizers library."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, to_byte = spec["model"], byte_characters()
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max(chain(vocab.values(), self.special.values())) + 1
        self.pieces: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.pieces[i] = bytes(to_byte[c] for c in token)
        for token, i in self.special.items():
            self.pieces[i] = token.encode()
        self.first = np.zeros(256, np.int64)
        for character, b in to_byte.items():
            self.first[b] = vocab[character]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in merges], np.int64)
        self.right = np.array([vocab[b] for _, b in merges], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        made = {int(m): r for r, m in reversed(list(enumerate(self.merged)))}
        if any(made.get(int(p), -1) >= r for side in (self.left, self.right) for r, p in enumerate(side)):
            raise ValueError("a merge comes before the merge that makes its part; ranks can't be applied in order")
        keys = self.left << 32 | self.right
        self.by_key = np.argsort(keys, kind="stable")
        self.keys = keys[self.by_key]
        self.split = regex.compile(WORDS)
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.cache: dict[str, bytes] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or -1."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.by_key[at], -1)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = np.append(self.first[np.frombuffer(b"".join(words), np.uint8)], -1)
        end = len(symbols) - 1  # stands for "no neighbour"
        after, before = np.arange(1, end + 2), np.arange(-1, end)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        some = sizes > 0
        after[ends[some] - 1] = end
        before[starts[some]] = end
        lists: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enlist(positions: np.ndarray, ranks: np.ndarray) -> None:
            found = ranks >= 0
            positions, ranks = positions[found], ranks[found]
            if len(ranks) == 0:
                return
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            firsts = ranks[np.append(0, cuts)].tolist()
            for rank, part in zip(firsts, np.split(positions, cuts) if len(cuts) else [positions], strict=True):
                if rank not in lists:
                    lists[rank] = []
                    heapq.heappush(active, rank)
                lists[rank].append(part)

        lefts = np.flatnonzero(after[:end] != end)
        enlist(lefts, self.ranks(symbols[lefts], symbols[after[lefts]]))
        while active:
            rank = heapq.heappop(active)
            parts = lists.pop(rank)
            at = np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]
            a, b = self.left[rank], self.right[rank]
            at = at[(symbols[at] == a) & (symbols[after[at]] == b)]
            if a == b and len(at) > 1:  # in a run of one symbol, merges are taken from the left
                used, free = -1, []
                for p, q in zip(at.tolist(), after[at].tolist(), strict=True):
                    if p != used:
                        free.append(p)
                        used = q
                at = np.array(free, np.int64)
            if len(at) == 0:
                continue
            gone = after[at]
            following = after[gone]
            symbols[at], symbols[gone] = self.merged[rank], -1
            after[at], before[following] = following, at
            left = before[at]
            left, right = left[left != end], at[following != end]
            around = np.concatenate([left, right])
            enlist(around, self.ranks(symbols[around], symbols[after[around]]))
        alive = symbols[:end] >= 0
        counted = np.append(0, np.cumsum(alive))
        ids = symbols[:end][alive].astype("<u4").tobytes()
        return [ids[4 * s : 4 * e] for s, e in zip(counted[starts].tolist(), counted[ends].tolist(), strict=True)]

    def parts(self, text: str) -> list[str]:
        """Words and special tokens of a text, in order."""
        if not any(s in text for s in self.special):
            return self.split.findall(text)
        pieces = self.split_special.split(text)
        return list(chain.from_iterable([p] if i % 2 else self.split.findall(p) for i, p in enumerate(pieces)))

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, special tokens included; a null text counts as empty."""
        parts = [self.parts(t) if t else [] for t in texts]
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        cache = self.cache
        for token, i in self.special.items():
            cache[token] = i.to_bytes(4, "little")
        new = list(set(chain.from_iterable(parts)).difference(cache))
        cache.update(zip(new, self.encode_words([w.encode("utf-8", "surrogatepass") for w in new]), strict=True))
        return [b"".join(map(cache.__getitem__, p)) for p in parts]

    def decode(self, ids: bytes) -> str:
        """The text of some ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> PairIndexBPE:
    """The encoder of a vocabulary file, read once in each Python worker."""
    return PairIndexBPE(path)


def encode(docs: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """Encode and decode every whole text of ``docs`` (``doc_id``, ``text``).

    Returns ``doc_id``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit; null without
    ``with_ids``), ``ids_sha256`` and ``decoded_sha256``. One row per input row: repeated rows are
    encoded each, null and empty texts have no tokens, a null ``doc_id`` stays null, an empty
    table gives no rows, other columns are ignored. Nothing is shuffled; a lost task is run again.
    """

    def make() -> Callable[[dict[str, list]], dict[str, list]]:
        bpe = load(path)

        def encoded(rows: dict[str, list]) -> dict[str, list]:
            ids = bpe.encode_batch(rows["text"])
            return {
                "doc_id": rows["doc_id"],
                "n_tokens": [len(i) // 4 for i in ids],
                "ids": ids if with_ids else [None] * len(ids),
                "ids_sha256": [hashlib.sha256(i).hexdigest() for i in ids],
                "decoded_sha256": [hashlib.sha256(bpe.decode(i).encode()).hexdigest() for i in ids],
            }

        return encoded

    return map_rows(docs.select("doc_id", "text"), SCHEMA, make)
