"""Causal self-attention over subword ids, trained and applied in numpy inside Spark tasks.

A text is its lower-cased words as subword ids of a public vocabulary, then one end. The most frequent
``CLASSES - 1`` ids are classes of their own; the rest, the rare ids, share one class. At every place the model
attends to itself, to the places before it in its window and to nothing. The scores are products of learned queries
and keys plus learned offsets, and the values are distributions over the next class: after this class or this pair of
classes directly, some places later, or anywhere. So the attention's mean is itself a distribution, and no softmax
over the vocabulary is needed.

Rare ids are told apart on both sides. A rare id attended to has values of its own: those of its class, lifted by its own
counts of the groups of classes that follow it. Where the answer is a rare id, the same weights take the mean of
distributions over all rare ids, one for each kind of place attended to (a group of alike classes, or a band of rare
ids); nothing gives an id its smoothed frequency. Both are distributions, so the probabilities of all ids sum to one.

Texts are cut into blocks of ``BLOCK`` places. A window is a block and the one before it: windows overlap by
half, and each token is scored once, in the window whose later half holds it.

All training texts count. Value tables are sums over all training tokens, added up in Spark. Queries, keys and
offsets are fitted by gradient steps over all training windows: each task starts from the same
parameters and goes once through its own, and the results are averaged by tokens. Parameters and
tables have a fixed size, whatever the corpus.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestar.llm.batches import map_slices
from tidestar.llm.packing import encoding
from tidestar.session import stored

CLASSES, WIDTH, BLOCK = 1024, 4, 8
OTHER, PAD = CLASSES - 1, CLASSES
#: Pairs of classes, the most frequent ones, that have a value of their own.
PAIRS = 8192
#: Distances, beyond the next place, at which the table of later places is counted.
LATER = (1, 2, 4, 7)
#: Words whose counts are given to all tasks; all others find their counts by a join.
FREQUENT = 150_000
#: Different words a task counts before it hands its counts on.
COUNTED = 300_000
#: Bytes of texts, and of ids, that a task works on at a time.
TEXT_BYTES, IDS_BYTES = 1_500_000, 1_500_000
#: Rows of a matrix of counts that are summed together.
ROWS = 64
BATCH = 512  #: windows computed at a time, and of one gradient step
RATE = 0.1
SMOOTH = 20.0  #: unigram counts added to the values of a class
PAIR_SMOOTH = 100.0  #: counts of the class's values added to those of a pair

#: Groups of alike classes, the last of which is the class of the rare ids, and bands that these are dealt to by rank.
GROUPS, BANDS = 48, 16
KINDS = GROUPS + BANDS
#: Rare ids that have their counts by kind in a row of a matrix of counts, which has a column for each class.
IN_ROW = CLASSES // KINDS
RARE_SMOOTH = 1000.0  #: counts by frequency alone added to the rare ids after a kind

SHAPES = {"query": (CLASSES + 1, WIDTH), "key": (CLASSES + 1, WIDTH), "near": (CLASSES + 1,), "none": (CLASSES + 1,), "offset": (2 * BLOCK,)}


def held_out() -> Any:
    """Whether a document is held out: the remainder of its id's checksum is 1; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes: lowers A-Z only


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``c`` of every word of ``docs``, summed by task before the shuffle."""

    def run(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, Any]]:
        counts: Counter[bytes] = Counter()
        for rows in slices:
            counts.update(Counter(chain.from_iterable(map(words, rows["text"]))))  # few enough to stay in the processor's cache
            if len(counts) > COUNTED:
                yield {"word": list(counts), "c": list(counts.values())}
                counts.clear()
        yield {"word": list(counts), "c": list(counts.values())}

    return map_slices(docs.select("text"), "word binary, c bigint", run, TEXT_BYTES).groupBy("word").agg(F.sum("c").alias("c"))


class Common:
    """The words of the highest counts, ``FREQUENT`` at most, in a compact form that tasks unfold once in each worker."""

    def __init__(self, words: pa.ChunkedArray | None = None, counts: pa.ChunkedArray | None = None) -> None:
        self.words = b" ".join(words.to_pylist()) if words is not None else b""
        self.counts = counts.to_numpy() if counts is not None else np.empty(0)
        self.unfolded: tuple[dict[bytes, int], list[bytes], np.ndarray] | None = None

    def tables(self, encode: Callable[[list[bytes]], list[bytes]]) -> tuple[dict[bytes, int], list[bytes], np.ndarray]:
        """Number of each word, and by number its ids and the logarithm of its count; last, that of an unseen word."""
        if self.unfolded is None:
            names = self.words.split()
            logs = np.append(np.log10(self.counts + 0.5), np.log10(0.5))
            self.unfolded = dict(zip(names, range(len(names)), strict=True)), encode(names) if names else [], logs
        return self.unfolded


def frequent(counts: DataFrame) -> Common:
    """The words of the highest counts; a count is taken with all its like or not at all."""
    level = F.floor(F.log2("c") * 16).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each order of magnitude
    total, least = 0, None
    for row in sorted(levels, key=lambda r: -r["level"]):
        total += row["n"]
        if total > FREQUENT:
            break
        least = row["level"]
    if least is None:
        return Common()
    found = counts.where(level >= least).toArrow()
    return Common(found.column("word"), found.column("c"))


class WordEncoder:
    """The subword ids of words, each after a space, 16 bits each."""

    def __init__(self, path: str) -> None:
        self.encoder = encoding(path)
        pieces = (self.encoder.decode_single_token_bytes(i) for i in range(self.encoder.n_vocab))
        self.starts = np.fromiter((p[:1] == b" " for p in pieces), bool)

    def __call__(self, words: list[bytes]) -> list[bytes]:
        """Encodes all in one text, where each word begins with the token that holds its space."""
        text = b" ".join(words).decode("utf-8", "surrogatepass")
        if len(text.split()) != len(words):  # other spaces inside words could join their neighbours
            return [np.array(self.encoder.encode_ordinary(" " + w.decode("utf-8", "surrogatepass")), "<u2").tobytes() for w in words]
        ids = np.array(self.encoder.encode_ordinary(" " + text), "<u2")
        at = (2 * np.flatnonzero(self.starts[ids])).tolist()
        flat_ids = ids.tobytes()
        return [flat_ids[a:b] for a, b in zip(at, [*at[1:], len(flat_ids)], strict=True)]


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


READ = (
    "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, "
    "rest array<binary>, times array<int>, ids binary"
)


def read_texts(docs: DataFrame, path: str, shared: Broadcast[Common]) -> DataFrame:
    """Each text's subword ids, the base score's part of its frequent words, and its other words.

    ``base`` sums the logarithm of ``c + 0.5`` over the frequent words, and takes all others as unseen.
    """

    def run(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, Any]]:
        encode = word_encoder(path)
        number_of, ids_of, logs = shared.value.tables(encode)
        row, other = TaskContext.get().partitionId() << 33, len(ids_of)
        for rows in slices:
            # Each different word of the slice is looked up once; the rest is arithmetic on its places.
            texts = [words(t) for t in rows["text"]]
            n = len(texts)
            sizes = np.fromiter(map(len, texts), np.int64, n)
            names = list(dict.fromkeys(chain.from_iterable(texts)))
            place = dict(zip(names, range(len(names)), strict=True))
            at = np.fromiter(map(place.__getitem__, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
            doc = np.repeat(np.arange(n), sizes)
            numbers = [number_of.get(w, other) for w in names]
            rare = [w for w, k in zip(names, numbers, strict=True) if k == other]
            new = iter(encode(rare) if rare else [])
            ids = [ids_of[k] if k != other else next(new) for k in numbers]
            number = np.array(numbers, np.int64)
            unseen = number[at] == other
            pairs, times = np.unique(doc[unseen] * max(1, len(names)) + at[unseen], return_counts=True)
            rest = [names[k] for k in (pairs % max(1, len(names))).tolist()]
            cuts = np.searchsorted(pairs, np.arange(n + 1) * max(1, len(names))).tolist()
            times = times.tolist()
            # The ids of all words in a row, from those of the different words.
            length = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
            long = length[at]
            ends = np.cumsum(long)
            first = (np.cumsum(length) - length)[at]
            flat_ids = np.frombuffer(b"".join(ids), "<u2")[np.repeat(first - ends + long, long) + np.arange(int(long.sum()))].tobytes()
            bounds = (2 * np.append(0, np.append(0, ends)[np.cumsum(sizes)])).tolist()
            yield {
                "row": range(row, row + n),
                "doc_id": rows["doc_id"],
                "held_out": rows["held_out"],
                "n_tokens": sizes + 1,
                "known": np.bincount(doc, ~unseen, n).astype(np.int64),
                "base": np.bincount(doc, logs[number[at]], n),
                "rest": [rest[a:b] for a, b in zip(cuts, cuts[1:], strict=False)],
                "times": [times[a:b] for a, b in zip(cuts, cuts[1:], strict=False)],
                "ids": [flat_ids[a:b] for a, b in zip(bounds, bounds[1:], strict=False)],
            }
            row += n

    return map_slices(docs.select("doc_id", held_out().alias("held_out"), "text"), READ, run, TEXT_BYTES)


def id_counts(table: DataFrame, end: int) -> np.ndarray:
    """How often each subword id occurs in the texts, each of which has one end."""

    def run(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, Any]]:
        total = np.zeros(end + 1, np.int64)
        for rows in slices:
            total += np.bincount(np.frombuffer(b"".join(rows["ids"]), "<u2"), minlength=end + 1)
            total[end] += len(rows["ids"])
        some = np.flatnonzero(total)
        yield {"id": some, "c": total[some]}

    sums = map_slices(table.select("ids"), "id int, c bigint", run).groupBy("id").agg(F.sum("c").alias("c"))
    found = sums.toArrow()  # the vocabulary at most
    counts = np.zeros(end + 1)
    counts[found.column("id").to_numpy()] = found.column("c").to_numpy()
    return counts


class Vocabulary:
    """Classes of subword ids, the share of its class that an id has, and the rank of a rare id, -1 for others."""

    def __init__(self, counts: np.ndarray) -> None:
        self.end = len(counts) - 1
        order = [i for i in np.argsort(-counts, kind="stable") if i != self.end][: CLASSES - 2]
        self.of = np.full(len(counts), OTHER, np.int32)
        self.of[[self.end, *order]] = np.arange(len(order) + 1)
        self.within = np.zeros(len(counts))
        other = self.of == OTHER
        self.within[other] = np.log10((counts[other] + 0.5) / (counts[other] + 0.5).sum())
        self.unigram = np.bincount(self.of, counts + 0.5, CLASSES)
        self.unigram /= self.unigram.sum()
        rare = np.flatnonzero(other)
        self.rare = np.full(len(counts), -1, np.int32)
        self.rare[rare[np.argsort(-counts[rare], kind="stable")]] = np.arange(len(rare))

    def shares(self) -> np.ndarray:
        """The rare ids' shares of their class, by rank."""
        out = np.empty(int(self.rare.max(initial=-1)) + 1, np.float32)
        out[self.rare[self.rare >= 0]] = 10 ** self.within[self.rare >= 0]
        return out


class Rare(NamedTuple):
    """The rare ids of some windows: window, place among the keys and rank of those attended to, and window, place among
    the queries and rank of those that are answers, with the kinds of their windows' keys."""

    keys: tuple[np.ndarray, np.ndarray, np.ndarray]
    answers: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def kinds_of(inputs: np.ndarray, at: np.ndarray, places: np.ndarray, rank: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The kinds of the inputs ``at`` some places; ``places`` are those of all rare ids, with their ranks."""
    kinds = group[inputs[at]].astype(np.int32)
    rare = inputs[at] == OTHER
    kinds[rare] = GROUPS + rank[np.searchsorted(places, at[rare])] % BANDS
    return kinds


class RareWindows:
    """The rare ids of all windows of some blocks, in the order of these."""

    def __init__(self, blocks: Blocks, group: np.ndarray) -> None:
        places, rank = blocks.rare_inputs()
        block, at = places // BLOCK, places % BLOCK
        block, at, twice = np.concatenate([block, block + 1]), np.concatenate([at + BLOCK, at]), np.concatenate([rank, rank])
        there = block < len(blocks.rows)
        there[there] = blocks.rows[block[there], 0] != PAD  # a text's last block is the first half of no window
        order = np.flatnonzero(there)
        order = order[np.argsort(block[order], kind="stable")]
        self.keys = block[order], at[order], twice[order]
        answers = places - 1
        keys = (answers // BLOCK * BLOCK - BLOCK)[:, None] + np.arange(2 * BLOCK)
        self.answers = answers // BLOCK, answers % BLOCK, rank, kinds_of(blocks.inputs, keys, places, rank, group)

    def within(self, here: np.ndarray) -> Rare | None:
        def some(block: np.ndarray, *rest: np.ndarray) -> tuple[np.ndarray, ...]:
            a, b = np.searchsorted(block, (here[0], here[-1] + 1)).tolist()
            return np.searchsorted(here, block[a:b]), *(r[a:b] for r in rest)

        found = Rare(some(*self.keys), some(*self.answers))
        return found if len(found.keys[0]) + len(found.answers[0]) else None


class Blocks:
    """Texts laid out in blocks: a block of padding before each, then its ids, the end standing first as the start."""

    def __init__(self, vocabulary: Vocabulary, texts: list[bytes]) -> None:
        arrays = [np.frombuffer(t, "<u2") for t in texts]
        sizes = np.array([len(a) + 1 for a in arrays], np.int64)
        self.blocks = -(-sizes // BLOCK) + 1
        self.first = (np.cumsum(self.blocks) - self.blocks + 1) * BLOCK
        self.arrays, self.vocabulary = arrays, vocabulary
        # 32 bits: a task holds several arrays of this length, and its worker keeps what they took.
        self.inputs = np.full(int(self.blocks.sum()) * BLOCK, PAD, np.int32)
        self.targets = np.full(len(self.inputs), PAD, np.int32)
        start = vocabulary.of[vocabulary.end]
        for a, at in zip(arrays, self.first.tolist(), strict=True):
            own = vocabulary.of[a]
            self.inputs[at] = start
            self.inputs[at + 1 : at + 1 + len(a)] = own
            self.targets[at : at + len(a)] = own
            self.targets[at + len(a)] = start
        self.rows, self.answers = self.inputs.reshape(-1, BLOCK), self.targets.reshape(-1, BLOCK)
        self.windowed: RareWindows | None = None

    def rare_inputs(self) -> tuple[np.ndarray, np.ndarray]:
        """The places whose input is a rare id, which is the answer one place before, and its rank."""
        rank = self.vocabulary.rare[np.concatenate([*self.arrays, np.empty(0, "<u2")])]
        return np.flatnonzero(self.inputs == OTHER), rank[rank >= 0]

    def rare(self, here: np.ndarray, group: np.ndarray) -> Rare | None:
        """The rare ids in the windows of blocks ``here``."""
        if self.windowed is None:
            self.windowed = RareWindows(self, group)
        return self.windowed.within(here)

    def sums(self, logs: np.ndarray) -> np.ndarray:
        """For each text the sum of ``logs``, which has a value for each place, and of its ids' shares of their classes."""
        for a, at in zip(self.arrays, self.first.tolist(), strict=True):
            logs[at : at + len(a)] += self.vocabulary.within[a]
        return np.bincount(np.repeat(np.arange(len(self.arrays)), self.blocks * BLOCK), logs, len(self.arrays))

    def windows(self, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Block numbers, queries, keys and answers of ``size`` windows at a time."""
        places = np.flatnonzero(self.rows[:, 0] != PAD)  # blocks that begin with a place of a text
        for at in range(0, len(places), size):
            here = places[at : at + size]
            x = self.rows[here].astype(np.intp)
            yield here, x, np.concatenate([self.rows[here - 1], x], axis=1, dtype=np.intp), self.answers[here].astype(np.intp)


def start_parameters() -> dict[str, np.ndarray]:
    random = np.random.default_rng(7)
    p = {k: (random.normal(0, 0.1, s) if len(s) > 1 else np.zeros(s)).astype(np.float32) for k, s in SHAPES.items()}
    p["near"] += 3
    p["offset"] -= 3 + 0.05 * np.arange(2 * BLOCK, dtype=np.float32)
    return p


DELTA = np.arange(BLOCK)[:, None] + BLOCK - np.arange(2 * BLOCK)[None, :]  # how far a key lies before its query
SEEN = DELTA >= 0


def diagonal(windows: np.ndarray) -> np.ndarray:
    """A view of each query's own place in arrays of windows, queries and keys."""
    return windows.reshape(len(windows), -1)[:, BLOCK :: 2 * BLOCK + 1]


def frequent_pairs(following: np.ndarray) -> np.ndarray:
    """The pairs of classes that have a value of their own, the most frequent first: the first class of each, and the second."""
    best = np.argsort(-following.ravel(), kind="stable")[:PAIRS].astype(np.int32)
    return np.stack([best // CLASSES, best % CLASSES])


def value_rows(pairs: np.ndarray) -> np.ndarray:
    """The row of ``Values.own`` for each two classes in a row: that of the pair, or of the second class alone."""
    row = np.tile(np.arange(CLASSES + 1, dtype=np.int32), (CLASSES + 1, 1))
    row[pairs[0], pairs[1]] = CLASSES + 1 + np.arange(pairs.shape[1])
    return row.ravel()


def class_groups(following: np.ndarray) -> np.ndarray:
    """A group for each class, and for padding, of classes that have like classes after them; the rare ids' class is one alone."""
    roots = np.sqrt(following[:OTHER].astype(np.float32))
    roots /= np.maximum(np.linalg.norm(roots, axis=1, keepdims=True), 1)
    centres = roots[: GROUPS - 1].copy()  # those of the most frequent classes
    for _ in range(8):
        own = np.argmax(roots @ centres.T, axis=1)
        for k in range(len(centres)):
            if (own == k).any():
                centres[k] = roots[own == k].sum(axis=0)
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    return np.concatenate([own, [GROUPS - 1, 0]]).astype(np.uint8)


#: Rows of a matrix of counts that each of the four tables of ``rare_cells`` takes, for some number of rare ids.
def rare_rows(ids: int) -> int:
    return -(-ids // (IN_ROW * ROWS)) * ROWS


def rare_cells(blocks: Blocks, group: np.ndarray, ids: int) -> Iterator[np.ndarray]:
    """Cells of four tables of rare ids by kind, one below the other.

    The groups of the answers directly after a rare id and later, and the kinds of the places that a rare
    id follows directly and later.
    """
    places, rank = blocks.rare_inputs()
    row, column = rank // IN_ROW, rank % IN_ROW * KINDS
    cell = lambda table, at, kinds: (table * rare_rows(ids) + row[at]) * np.int32(CLASSES + 1) + column[at] + kinds
    for d in (0, *LATER):
        at = np.flatnonzero(places + d < len(blocks.targets))
        answer = blocks.targets[places[at] + d]
        real = answer != PAD
        yield cell(min(d, 1), at[real], group[answer[real]])
        before = places - 1 - d
        at = np.flatnonzero(blocks.inputs[before] != PAD)
        yield cell(2 + min(d, 1), at, kinds_of(blocks.inputs, before[at], places, rank, group))


class Lifts:
    """How much likelier than by their class alone answers are after each rare id, and rare ids after each kind of place."""

    def __init__(self, values: Values, group: np.ndarray, shares: np.ndarray, parts: Iterable[tuple[int, np.ndarray]]) -> None:
        ids, size = len(shares), rare_rows(len(shares))
        tables = np.zeros((4, size * IN_ROW, KINDS), np.float32)
        for at, part in parts:
            table, row = divmod(at, size)
            tables[table, row * IN_ROW : (row + len(part)) * IN_ROW] = part[:, : IN_ROW * KINDS].reshape(-1, KINDS)
        self.group = group
        for table, rows in enumerate((values.own, values.later)):
            base = np.bincount(group[:CLASSES], rows.reshape(-1, CLASSES)[OTHER], KINDS).astype(np.float32)
            counts = tables[table]
            total = counts.sum(axis=1, keepdims=True) + SMOOTH
            counts += SMOOTH * base
            counts /= total
            counts /= np.where(base > 0, base, 1)
        for counts in tables[2:, :ids]:
            total = counts.sum(axis=0) + RARE_SMOOTH
            counts += RARE_SMOOTH * shares[:, None]
            counts /= total
            counts /= shares[:, None]
        self.next_own, self.next_later, self.after_own, self.after_later = tables


class Values:
    """Distributions over the next class, from counts: after a class, after a pair, and some places later."""

    def __init__(self, unigram: np.ndarray, following: np.ndarray, later: np.ndarray, pairs: np.ndarray | None = None) -> None:
        smooth = lambda t: (t + SMOOTH * unigram) / (t.sum(axis=1, keepdims=True) + SMOOTH)
        padding = np.zeros((1, CLASSES))
        self.unigram = unigram.astype(np.float32)
        self.later = np.concatenate([smooth(later), padding]).astype(np.float32).ravel()
        self.own = np.concatenate([smooth(following), padding]).astype(np.float32)
        pairs = frequent_pairs(following) if pairs is None else pairs
        self.seconds, self.row = pairs[1], value_rows(pairs)
        self.lifts: Lifts | None = None

    def add_pairs(self, parts: Iterable[tuple[int, np.ndarray]]) -> None:
        """The values of the pairs, from parts of their counts: the first pair of a part, and rows."""
        single = len(self.own)
        own = np.empty((single + len(self.seconds), self.own.shape[1]), np.float32)
        own[:single] = self.own
        np.take(self.own, self.seconds, axis=0, out=own[single:])  # without counts, those of the second class
        for at, part in parts:
            rows = own[single + at : single + at + len(part)]
            rows *= PAIR_SMOOTH
            rows += part
            rows /= part.sum(axis=1, keepdims=True) + PAIR_SMOOTH
        self.own = own.ravel()


class Model:
    """The attention over some values."""

    def __init__(self, parameters: dict[str, np.ndarray], values: Values) -> None:
        self.parameters, self.values = parameters, values
        self.kept: dict[str, np.ndarray] = {}
        self.prepare()

    def room(self, name: str, *shape: int, kind: type = np.float32) -> np.ndarray:
        """An array that each batch uses again: to get new ones of this size takes longer than what is computed in them."""
        size = int(np.prod(shape))
        if name not in self.kept or self.kept[name].size < size:
            self.kept[name] = np.empty(size, kind)
        return self.kept[name][:size].reshape(shape)

    def prepare(self) -> None:
        """After a change of parameters: bounds them, so that no weight overflows, and lays out the offsets."""
        for name, most in (("query", 2), ("key", 2), ("near", 15), ("none", 15), ("offset", 15)):
            np.clip(self.parameters[name], -most, most, out=self.parameters[name])
        offset = np.where(SEEN, self.parameters["offset"][np.where(SEEN, DELTA, 0)], -1e9)
        self.bias = offset.astype(np.float32)
        self.padding = np.where(np.arange(CLASSES + 1) == PAD, -1e9, 0).astype(np.float32)

    def attend(self, x: np.ndarray, keys: np.ndarray, y: np.ndarray, rare: Rare | None = None) -> dict[str, np.ndarray]:
        """Weights, values and the probability of each answer ``y`` (padding counts as class 0); good until the next call."""
        p, shape = self.parameters, (*x.shape, keys.shape[1])
        q = p["query"].take(x, axis=0, out=self.room("q", *x.shape, WIDTH), mode="clip")
        k = p["key"].take(keys, axis=0, out=self.room("k", *keys.shape, WIDTH), mode="clip")
        scores = np.matmul(q, k.transpose(0, 2, 1), out=self.room("scores", *shape))
        scores += self.bias
        own = diagonal(scores)
        own += p["near"][x]
        scores += self.padding[keys][:, None, :]
        weights = np.exp(scores, out=scores)
        nothing = np.exp(p["none"][x])
        total = weights.sum(axis=2) + nothing
        at = np.add((keys * CLASSES)[:, None, :], y[:, :, None], out=self.room("at", *shape, kind=np.intp))
        values = self.values.later.take(at, out=self.room("values", *shape), mode="clip")
        if rare:
            window, place, rank = rare.keys
            values[window, :, place] *= self.values.lifts.next_later[rank[:, None], self.values.lifts.group[y[window]]]
        row = self.values.row[keys[:, BLOCK - 1 : -1] * (CLASSES + 1) + x]
        diagonal(values)[:] = self.values.own[row * CLASSES + y]
        if rare:
            own = place >= BLOCK
            window, place, rank = window[own], place[own], rank[own]
            answer = y[window, place - BLOCK]
            values[window, place - BLOCK, place] = self.values.own[OTHER * CLASSES + answer] * self.values.lifts.next_own[rank, self.values.lifts.group[answer]]
        plain = self.values.unigram[y]
        chance = (np.einsum("ijk,ijk->ij", weights, values) + nothing * plain) / total
        return {"q": q, "k": k, "weights": weights, "nothing": nothing, "total": total, "values": values, "plain": plain, "chance": chance}

    def choose(self, f: dict[str, np.ndarray], rare: Rare) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each answer that is a rare id: weights, lifts, and how much likelier the id is than by its share of the class."""
        window, place, rank, kinds = rare.answers
        lifts = self.values.lifts.after_later[rank[:, None], kinds]
        row = np.arange(len(rank))
        lifts[row, place + BLOCK] = self.values.lifts.after_own[rank, kinds[row, place + BLOCK]]
        weights = f["weights"][window, place]
        chance = (np.einsum("ij,ij->i", weights, lifts) + f["nothing"][window, place]) / f["total"][window, place]
        return weights, lifts, chance

    def rare(self, blocks: Blocks, here: np.ndarray) -> Rare | None:
        return blocks.rare(here, self.values.lifts.group) if self.values.lifts else None

    def score(self, vocabulary: Vocabulary, texts: list[bytes]) -> np.ndarray:
        """The logarithm to base 10 of the probability of each text, its end included."""
        blocks = Blocks(vocabulary, texts)
        logs = np.zeros(blocks.rows.shape)
        for here, x, keys, y in blocks.windows(BATCH):
            real = y != PAD
            rare = self.rare(blocks, here)
            f = self.attend(x, keys, np.where(real, y, 0), rare)
            logs[here] = np.where(real, np.log10(np.maximum(f["chance"], np.float32(1e-30))), 0)
            if rare:
                window, place = rare.answers[:2]
                logs[here[window], place] += np.log10(self.choose(f, rare)[2])
        return blocks.sums(logs.ravel())

    def gradients(self, x: np.ndarray, keys: np.ndarray, y: np.ndarray, rare: Rare | None = None) -> dict[str, np.ndarray]:
        """Of the answers' log probability, summed."""
        real = y != PAD
        f = self.attend(x, keys, np.where(real, y, 0), rare)
        share = (real / (f["total"] * np.maximum(f["chance"], 1e-30))).astype(np.float32)
        values = f["values"]
        values -= f["chance"][:, :, None]
        values *= f["weights"]
        values *= share[:, :, None]
        none = f["nothing"] * (f["plain"] - f["chance"]) * share
        if rare:
            window, place = rare.answers[:2]
            weights, lifts, chance = self.choose(f, rare)
            part = 1 / (f["total"][window, place] * chance)
            values[window, place] += (lifts - chance[:, None]) * weights * part[:, None]
            none[window, place] += f["nothing"][window, place] * (1 - chance) * part
        by_query = np.matmul(values, f["k"], out=self.room("by_query", *f["q"].shape))
        by_key = np.matmul(values.transpose(0, 2, 1), f["q"], out=self.room("by_key", *f["k"].shape))
        add = lambda at, what: np.bincount(at.ravel(), what.ravel(), CLASSES + 1)
        return {
            "query": np.stack([add(x, by_query[:, :, i]) for i in range(WIDTH)], axis=1),
            "key": np.stack([add(keys, by_key[:, :, i]) for i in range(WIDTH)], axis=1),
            "near": add(x, diagonal(values)),
            "none": add(x, none),
            "offset": np.bincount(np.where(SEEN, DELTA, 0).ravel(), np.where(SEEN, values.sum(axis=0), 0).ravel(), 2 * BLOCK),
        }


def packed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype(np.float32), 1)  # few bytes for the many zeros and small counts


def unpacked(parts: list[tuple[int, bytes]], rows: int) -> Iterator[tuple[int, np.ndarray]]:
    """The first row of each part of a matrix of ``rows`` rows, and its rows."""
    for at, part in parts:
        yield at, np.frombuffer(zlib.decompress(part), np.float32).reshape(-1, CLASSES + 1)[: rows - at]


def summed(
    table: DataFrame, vocabulary: Broadcast[Vocabulary], rows: int, cells: Callable[[Blocks], Iterator[np.ndarray]]
) -> list[tuple[int, bytes]]:
    """Counts of cells of a matrix of ``rows`` rows and a column for each class and for padding, over all texts.

    Gives the matrix in parts, those without counts left out: the first row of a part, and its rows as ``packed``.
    Each task sends its sums in parts of ``ROWS`` rows. They are added up in three steps, 64 tasks,
    64 times as many and all, so that a step never holds more than 64 parts for any likely number of tasks.
    """
    size = ROWS * (CLASSES + 1)

    def run(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, Any]]:
        total = np.zeros(-(-rows // ROWS) * size, np.int32)
        for part in slices:
            for at in cells(Blocks(vocabulary.value, part["ids"])):
                np.add.at(total, at, np.int32(1))  # in place: a count of its own would be as long as the matrix, in 64 bits
        parts = total.reshape(-1, size)
        for at in np.flatnonzero(parts.any(axis=1)).tolist():
            yield {"part": [TaskContext.get().partitionId()], "at": [at], "sums": [parts[at].astype("<i8").tobytes()]}

    def adding(give: Callable[[np.ndarray], bytes]) -> Callable[[pa.Table], pa.Table]:
        def add(group: pa.Table) -> pa.Table:
            total = np.zeros(size, np.int64)
            for value in group.column("sums"):
                total += np.frombuffer(value.as_buffer(), "<i8")
            return pa.table({c: group.column(c).slice(0, 1) for c in ("part", "at")} | {"sums": pa.array([give(total)], pa.binary())})

        return add

    schema = "part int, at int, sums binary"
    sums = map_slices(table.select("ids"), schema, run, IDS_BYTES)
    for tasks, give in ((64, np.ndarray.tobytes), (64, np.ndarray.tobytes), (1 << 30, packed)):
        sums = sums.withColumn("part", F.floor(F.col("part") / tasks).cast("int")).groupBy("part", "at").applyInArrow(adding(give), schema)
    return [(row["at"] * ROWS, row["sums"]) for row in sums.select("at", "sums").toLocalIterator()]  # as many parts as the matrix has


def following_cells(blocks: Blocks) -> Iterator[np.ndarray]:
    """The cell of each place's answer in the row of its class and, below these rows, of each later answer, by distance."""
    x, y = blocks.inputs * np.int32(CLASSES + 1), blocks.targets  # the padding between texts is longer than any distance
    yield x + y
    x += np.int32((CLASSES + 1) * (CLASSES + 1))
    for d in LATER:
        yield x[:-d] + y[d:]


class Tables:
    """The counts that values are made of, in a compact form that tasks unfold once in each worker.

    The driver holds and sends no more than this; the values themselves take some 95 MB.
    """

    def __init__(self, unigram: np.ndarray, shares: np.ndarray, singles: list[tuple[int, bytes]]) -> None:
        self.unigram, self.shares, self.singles = unigram, shares, singles
        following = self.matrix()[:CLASSES, :CLASSES]
        self.pairs, self.group = frequent_pairs(following), class_groups(following)
        self.paired: list[tuple[int, bytes]] = []  # and below these rows, those of the rare ids
        self.unfolded: Values | None = None

    def matrix(self) -> np.ndarray:
        """The rows of each class's answers and, below these rows, of its later answers."""
        counts = np.zeros((2 * (CLASSES + 1), CLASSES + 1), np.float32)
        for at, part in unpacked(self.singles, len(counts)):
            counts[at : at + len(part)] = part
        return counts

    def values(self) -> Values:
        if self.unfolded is None:
            counts = self.matrix()
            values = Values(self.unigram, counts[:CLASSES, :CLASSES], counts[CLASSES + 1 : -1, :CLASSES], self.pairs)
            pairs = self.pairs.shape[1]
            values.add_pairs((at, part[:, :CLASSES]) for at, part in unpacked([p for p in self.paired if p[0] < pairs], pairs))
            rare = [(at - pairs, part) for at, part in self.paired if at >= pairs]
            values.lifts = Lifts(values, self.group, self.shares, unpacked(rare, 4 * rare_rows(len(self.shares))))
            self.unfolded, self.singles, self.paired = values, [], []
        return self.unfolded


def learn_values(table: DataFrame, vocabulary: Broadcast[Vocabulary]) -> Tables:
    """The counts of the value distributions, from all texts of ``table``."""
    shares = vocabulary.value.shares()
    tables = Tables(vocabulary.value.unigram, shares, summed(table, vocabulary, 2 * (CLASSES + 1), following_cells))
    pairs, group, ids = tables.pairs, tables.group, len(shares)

    def paired(blocks: Blocks) -> Iterator[np.ndarray]:
        x, y = blocks.inputs, blocks.targets
        pair = value_rows(pairs)[x[:-1] * np.int32(CLASSES + 1) + x[1:]] - np.int32(CLASSES + 1)
        own = pair >= 0  # places without a pair of their own get the row of their class alone
        yield pair[own] * np.int32(CLASSES + 1) + y[1:][own]
        for cells in rare_cells(blocks, group, ids):
            yield pairs.shape[1] * (CLASSES + 1) + cells

    tables.paired = summed(table, vocabulary, pairs.shape[1] + 4 * rare_rows(ids), paired)
    return tables


def flat(parameters: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([parameters[k].ravel() for k in SHAPES])


def shaped(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = values[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return out


def train(table: DataFrame, vocabulary: Broadcast[Vocabulary], shared: Broadcast[Tables]) -> dict[str, np.ndarray]:
    """Parameters fitted to all windows of all texts of ``table``, averaged over tasks by tokens."""

    def run(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, Any]]:
        model = Model(start_parameters(), shared.value.values())
        squares = {k: np.zeros(s) for k, s in SHAPES.items()}
        tokens = 0
        for rows in slices:
            blocks = Blocks(vocabulary.value, rows["ids"])
            for here, x, keys, y in blocks.windows(BATCH):
                sums = model.gradients(x, keys, y, model.rare(blocks, here))
                n = int((y != PAD).sum())
                tokens += n
                for name in SHAPES:
                    g = sums[name] / n
                    squares[name] += g * g
                    model.parameters[name] += (RATE * g / np.sqrt(squares[name] + 1e-12)).astype(np.float32)
                model.prepare()
        if tokens:
            fitted = flat(model.parameters).astype(float) * tokens
            yield {"at": range(len(fitted)), "weighted": fitted, "tokens": [tokens] * len(fitted)}

    sums = map_slices(table.select("ids"), "at int, weighted double, tokens bigint", run, IDS_BYTES)
    sums = sums.groupBy("at").agg((F.sum("weighted") / F.sum("tokens")).alias("value")).toArrow()  # of fixed size
    found = flat(start_parameters()).astype(float)
    found[sums.column("at").to_numpy()] = sums.column("value").to_numpy()
    return shaped(found)


SCORED = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, score double"


def score_documents(docs: DataFrame, path: str, end: int) -> DataFrame:
    """Base and model scores of every whole text of ``docs`` (``doc_id``, ``text``).

    ``path`` is a rank file of a public vocabulary, ``end`` an id after its last. Learns from the documents that are not held
    out (``held_out``). Returns ``doc_id``, ``held_out``, ``n_tokens`` (words and one end), ``n_known``
    (tokens seen in training), ``train_tokens``, ``base_score`` and ``score`` (log10 probability of the
    text under the model). One row per input row; repeated rows are scored, and learned from, each. Null
    and empty texts are an end alone. Null ids are learned from. Without training documents the base score
    takes all tokens as unseen and the model's values are uniform. An empty table gives no rows; other
    columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    learned = docs.where(~held_out())
    counts = stored(word_counts(learned), "words")
    totals = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    ends = learned.count()
    n, v = (totals[0] or 0) + ends, totals[1] + (ends > 0)
    broadcast = docs.sparkSession.sparkContext.broadcast
    common = broadcast(frequent(counts))  # FREQUENT words at most
    table = stored(read_texts(docs, path, common), "texts")
    common.destroy()  # the driver's copy too
    lift = F.sum(F.col("n") * (F.log10(F.col("c") + 0.5) - F.lit(float(np.log10(0.5)))))
    rest = table.select("row", F.explode(F.arrays_zip(F.col("rest").alias("word"), F.col("times").alias("n"))).alias("r"))
    rest = rest.select("row", "r.word", "r.n").join(counts, "word")
    rest = rest.groupBy("row").agg(lift.alias("lift"), F.sum("n").cast("bigint").alias("more"))
    training = table.where("not held_out")
    vocabulary = broadcast(Vocabulary(id_counts(training, end)))  # once, not in the code of each step
    shared = broadcast(learn_values(training, vocabulary))  # once, of fixed size
    parameters = train(training, vocabulary, shared)

    def run(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, Any]]:
        model = Model(parameters, shared.value.values())
        for rows in slices:
            ids = rows.pop("ids")
            yield rows | {"score": model.score(vocabulary.value, ids)}

    kept = table.select("row", "doc_id", "held_out", "n_tokens", "known", "base", "ids")
    scored = map_slices(kept, SCORED, run, IDS_BYTES).join(rest, "row", "left")
    last = float(np.log10(ends + 0.5))
    scale = float(np.log10(n + 0.5 * (v + 1)))
    base = F.col("base") + F.coalesce("lift", F.lit(0.0)) + F.lit(last) - F.col("n_tokens") * F.lit(scale)
    known = F.col("known") + F.coalesce("more", F.lit(0)) + F.lit(int(ends > 0))
    return scored.select(
        "doc_id", "held_out", "n_tokens", known.cast("bigint").alias("n_known"), F.lit(n).cast("bigint").alias("train_tokens"), base.alias("base_score"), "score"
    )
