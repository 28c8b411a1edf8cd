"""Token ids in packed rows of one length: best-fit decreasing, with a segment tree over free capacities.

Each task encodes the texts of its partition and packs them in blocks of bounded size, so nothing is
shuffled and memory doesn't depend on the partition. Texts longer than a row are split into parts of
whole rows and a rest; together the parts are the text. A row holds its ids, padded, the cumulative
lengths of its segments and where positions start anew.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from typing import Any

import numpy as np
import tiktoken
from pyspark.sql import DataFrame

from tidestar.llm.batches import map_slices
from tidestar.llm.bpe import WORDS

CAPACITY = 2048
#: Tokens packed together at most, and what a task holds at a time (4 bytes each).
BLOCK_TOKENS = 8_000_000
SCHEMA = "n_tokens int, doc_ids array<bigint>, parts array<int>, cu_seqlens array<int>, resets array<int>, input_ids binary"


class FreeSpace:
    """How many rows have each free capacity; a segment tree finds the least capacity that suffices."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.leaves)

    def add(self, free: int, change: int) -> None:
        node = self.leaves + free
        while node:
            self.counts[node] += change
            node >>= 1

    def best(self, size: int) -> int:
        """The least capacity of ``size`` or more that some row has free, or -1."""
        node = self.leaves + size
        if self.counts[node]:
            return size
        while node > 1 and (node & 1 or not self.counts[node + 1]):
            node >>= 1
        if node <= 1:
            return -1
        node += 1
        while node < self.leaves:
            node = 2 * node if self.counts[2 * node] else 2 * node + 1
        return node - self.leaves


def pack_sizes(sizes: list[int], capacity: int) -> list[list[int]]:
    """The items of each row, by best fit in order of decreasing size; equal sizes keep their order."""
    free, open_rows, rows = FreeSpace(capacity), [[] for _ in range(capacity + 1)], []
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[item]
        if not 0 < size <= capacity:
            raise ValueError("a segment must have from one token to a row's capacity")
        room = free.best(size)
        if room < 0:
            row = len(rows)
            rows.append([])
            room = capacity
        else:
            row = open_rows[room].pop()
            free.add(room, -1)
        rows[row].append(item)
        if room > size:
            open_rows[room - size].append(row)
            free.add(room - size, 1)
    return rows


def position_ids(cu_seqlens: list[int], capacity: int) -> np.ndarray:
    """The position of every token of a row within its segment; zero in the padding."""
    ends = np.asarray(cu_seqlens)
    out = np.zeros(capacity, np.int64)
    used = ends[-1]
    out[:used] = np.arange(used) - np.repeat(ends[:-1], np.diff(ends))
    return out


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    """The encoder of a rank file, read once in each Python worker."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("packing", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


def packed(docs: DataFrame, path: str, end: int, capacity: int = CAPACITY) -> DataFrame:
    """All texts of ``docs`` (``doc_id``, ``text``) as rows of ``capacity`` token ids.

    ``path`` is a rank file; ``end`` closes each text and fills the padding. Each row has ``n_tokens``,
    the ``doc_ids`` and ``parts`` of its segments (a text's parts count from 0 and, put together, are
    its ids and the end), ``cu_seqlens`` (0, then the end of each segment), ``resets`` (where
    positions start from 0) and ``input_ids`` (little-endian, 16 bits where all ids fit, else 32).
    Null and empty texts are the end alone. Repeated rows are packed each; null ids stay null. An
    empty table gives no rows; other columns are ignored. Which texts share a row depends on how the
    table is split into tasks; the segments themselves don't.
    """

    def run(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, Any]]:
        encoder = encoding(path)
        width = "<u2" if max(encoder.n_vocab - 1, end) < 1 << 16 else "<u4"
        ids: list[np.ndarray] = []
        names: list[tuple[int | None, int]] = []
        held = 0

        def block() -> dict[str, Any]:
            rows = pack_sizes([len(i) for i in ids], capacity)
            matrix = np.full((len(rows), capacity), end, width)
            ends = []
            for row, items in zip(matrix, rows, strict=True):
                line = np.concatenate([ids[i] for i in items])
                row[: len(line)] = line
                ends.append([0, *np.cumsum([len(ids[i]) for i in items]).tolist()])
            return {
                "n_tokens": [e[-1] for e in ends],
                "doc_ids": [[names[i][0] for i in items] for items in rows],
                "parts": [[names[i][1] for i in items] for items in rows],
                "cu_seqlens": ends,
                "resets": [e[:-1] for e in ends],
                "input_ids": [row.tobytes() for row in matrix],
            }

        for columns in slices:
            for doc_id, text in zip(columns["doc_id"], columns["text"], strict=True):
                tokens = np.array([*(encoder.encode_ordinary(text) if text else ()), end], width)
                for part, at in enumerate(range(0, len(tokens), capacity)):
                    ids.append(tokens[at : at + capacity])
                    names.append((doc_id, part))
                held += len(tokens)
                if held >= BLOCK_TOKENS:
                    yield block()
                    ids, names, held = [], [], 0
        if ids:
            yield block()

    return map_slices(docs.select("doc_id", "text"), SCHEMA, run)


def write_packed(rows: DataFrame, path: str) -> None:
    """Write packed rows as Parquet; the binary column, joined, is the matrix of a file."""
    rows.write.mode("overwrite").parquet(path)
