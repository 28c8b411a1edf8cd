"""Approximate nearest neighbours with an inverted multi-index.

1. Equal vectors form a class, of which one is indexed; its rows of smallest ids go along.
2. The two halves of the unit vectors are quantised separately, by centroids fitted on a bounded sample. A pair
   of centroids is a cell; every class has one.
3. A query goes through the pairs of centroids by their summed squared distance, with a heap, until the cells seen
   hold a share of all classes. How large a share is found on the sample: what it takes to see ``REACH`` of the true
   neighbours there. Vectors without structure need a large share, clustered ones a small one.
4. The entries with one first centroid lie in pages of some ``PAGE`` entries, the queries that go there in blocks. Each
   page meets each block in one matrix product, entries of cells not seen are masked, and the best are reranked by
   the measure itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidestar.llm.batches import bounded_batches
from tidestar.llm.vectors import finite, matrix
from tidestar.session import stored

CENTROIDS = 64  #: of each half; the square of it is the number of cells
STEPS = 12  #: of the centroids' fit
#: Rows of the sample at most, and its bytes as doubles at most.
SAMPLE_ROWS, SAMPLE_BYTES = 8192, 32_000_000
TRIALS = 512  #: sampled rows whose true neighbours set the share to see
REACH = 0.97
PAGE, BLOCK = 1024, 256  #: entries and queries that meet at a time, on average
SPARE = 4  #: entries reranked beyond those wanted, against rounding in the matrix product


def scaled(rows: np.ndarray) -> np.ndarray:
    """Vectors times a power of two, so that squares neither overflow nor vanish. Exact, and cosines stay."""
    top = np.frexp(np.abs(rows).max(axis=1, initial=0))[1]
    return np.ldexp(rows, -top[:, None])


def units(rows: np.ndarray) -> np.ndarray:
    rows = scaled(rows)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


@dataclass(frozen=True)
class Codebook:
    """Centroids of the two halves, and the share of all entries that a query sees."""

    halves: tuple[np.ndarray, np.ndarray]
    share: float

    @property
    def width(self) -> int:
        return sum(h.shape[1] for h in self.halves)

    def distances(self, unit: np.ndarray) -> list[np.ndarray]:
        """Squared distances of the halves of unit vectors from the centroids, less the halves' own squares."""
        cut = self.halves[0].shape[1]
        return [(c * c).sum(axis=1) - 2 * part @ c.T for c, part in zip(self.halves, (unit[:, :cut], unit[:, cut:]), strict=True)]

    def cells(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, second = (d.argmin(axis=1).astype(np.int32) for d in self.distances(unit))
        return first, second


def centroids(rows: np.ndarray, count: int) -> np.ndarray:
    """Centroids of the rows by alternating means, from rows far from one another (each the farthest from those before)."""
    rows = rows if len(rows) else np.zeros((1, rows.shape[1]))
    at, far = [0], np.full(len(rows), np.inf)
    while len(at) < min(count, len(rows)):
        far = np.minimum(far, ((rows - rows[at[-1]]) ** 2).sum(axis=1))
        if far.max() <= 0:
            break
        at.append(int(far.argmax()))
    centre = rows[at].copy()
    for _ in range(STEPS):
        near = ((centre * centre).sum(axis=1) - 2 * rows @ centre.T).argmin(axis=1)
        size = np.bincount(near, minlength=len(centre))
        for k in range(rows.shape[1]):
            total = np.bincount(near, rows[:, k], len(centre))
            centre[:, k] = np.where(size > 0, total / np.maximum(size, 1), centre[:, k])
    return centre


def fitted(sample: np.ndarray, count: int, wanted: int, reach: float) -> Codebook:
    """Centroids of a sample of unit vectors, and the share of entries that ``reach`` of the neighbours in it lie in.

    A neighbour's place is the share of the sample whose cells a query sees no later than the neighbour's. In a table
    larger than the sample neighbours are closer, so a share is rather too large than too small.
    """
    cut = (sample.shape[1] + 1) // 2
    book = Codebook((centroids(sample[:, :cut], count), centroids(sample[:, cut:], count)), 1.0)
    trials = min(TRIALS, len(sample))
    if len(sample) <= wanted + 1:
        return book
    near = sample[:trials] @ sample.T
    near[np.arange(trials), np.arange(trials)] = -np.inf
    best = np.argpartition(-near, wanted, axis=1)[:, :wanted]
    first, second = book.cells(sample)
    one, two = book.distances(sample[:trials])
    far = one[:, first] + two[:, second]
    order = np.sort(far, axis=1)
    places = [np.searchsorted(order[i], far[i, best[i]], "right") for i in range(trials)]
    return Codebook(book.halves, float(np.quantile(np.concatenate(places), reach, method="higher")) / len(sample))


def seen(one: np.ndarray, two: np.ndarray, counts: np.ndarray, goal: float) -> np.ndarray:
    """Which cells a query sees: pairs of centroids by summed distance, from the nearest, until they hold ``goal`` entries."""
    first, second = one.argsort(kind="stable"), two.argsort(kind="stable")
    one, two, counts_ = one[first].tolist(), two[second].tolist(), counts[first][:, second].tolist()
    marked = np.zeros(counts.shape, bool)
    heap, held, at = [(one[0] + two[0], 0, 0)], 0, []
    while heap and held < goal:
        _, i, j = heappop(heap)
        at.append((i, j))
        held += counts_[i][j]
        if j + 1 < len(two):
            heappush(heap, (one[i] + two[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(one):
            heappush(heap, (one[i + 1] + two[0], i + 1, 0))
    i, j = np.array(at, np.int64).reshape(-1, 2).T
    marked[first[i], second[j]] = True
    return marked


def mapped(df: DataFrame, schema: str, run) -> DataFrame:  # noqa: ANN001
    """Batches of rows through a function that gives columns."""
    wanted = to_arrow_schema(T._parse_datatype_string(schema))

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            if batch.num_rows:
                out = run(batch)
                columns = [out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type) for f in wanted]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, wanted, strict=True)], schema=wanted)

    return bounded_batches(df).mapInArrow(batches, schema)


def indexed(classes: DataFrame, book: Codebook) -> DataFrame:
    """The classes with their cells, ``first`` and ``second``, and the least id of their rows."""
    kind = classes.schema["embedding"].dataType.simpleString()

    def place(batch: pa.RecordBatch) -> dict[str, Any]:
        first, second = book.cells(units(matrix(batch.column("embedding"), book.width)))
        return {c: batch.column(c) for c in ("id", "least", "embedding")} | {"first": first, "second": second}

    least = F.coalesce(F.col("members")[0]["vec_id"], F.lit(2**63 - 1)).alias("least")
    return mapped(classes.select("id", least, "embedding"), f"least bigint, id bigint, embedding {kind}, first int, second int", place)


def routes(queries: DataFrame, book: Codebook, counts: np.ndarray) -> DataFrame:
    """For each query and first centroid it goes to: ``second``, a byte for each second centroid, 1 where the cell is seen."""
    kind = queries.schema["embedding"].dataType.simpleString()
    goal = book.share * counts.sum()

    def route(batch: pa.RecordBatch) -> dict[str, Any]:
        one, two = book.distances(units(matrix(batch.column("embedding"), book.width)))
        at, first, second = [], [], []
        for q in range(batch.num_rows):
            marked = seen(one[q], two[q], counts, goal) & (counts > 0)
            for i in np.flatnonzero(marked.any(axis=1)):
                at.append(q)
                first.append(i)
                second.append(marked[i].tobytes())
        take = pa.array(at, pa.int64())
        return {"id": batch.column("id").take(take), "embedding": batch.column("embedding").take(take), "first": first, "second": second}

    return mapped(queries.select("id", "embedding"), f"id bigint, embedding {kind}, first int, second binary", route)


def packed(rows: DataFrame, sizes: np.ndarray, size: int, name: str) -> DataFrame:
    """Rows of one first centroid in groups of some ``size``: ``first`` and an array of their other columns, in order.

    ``sizes`` has how many rows each first centroid may have; a crowded one has more groups, dealt by hash.
    """
    groups = F.array(*(F.lit(max(1, -(-int(n) // size))) for n in sizes))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("id", F.lit(17)), F.element_at(groups, F.col("first") + 1)))
    return dealt.groupBy("first", "part").agg(F.sort_array(F.collect_list(F.struct(*(c for c in rows.columns if c != "first")))).alias(name)).drop("part")


def compared(pairs: DataFrame, width: int, wanted: int) -> DataFrame:
    """The ``wanted`` best entries of each query in each pair of a block of queries and a page: ``query``, ``id``, ``least``, ``score``.

    Entries lie by least id, so of equal scores the first are those of the smallest ids.
    """

    def best(queries: pa.StructArray, entries: pa.StructArray) -> tuple[np.ndarray, ...]:
        q, x = (scaled(matrix(side.field("embedding"), width)) for side in (queries, entries))
        marks = np.frombuffer(b"".join(queries.field("second").to_pylist()), bool).reshape(len(q), -1)
        may = marks[:, entries.field("second").to_numpy()]
        qq, xx = (q * q).sum(axis=1), (x * x).sum(axis=1)
        near = np.where(may, q @ x.T / np.sqrt(qq[:, None] * xx[None, :]), -2.0)
        count = min(wanted + SPARE, len(x))
        key = np.rint(near * -(2.0**40)).astype(np.int64) * len(x) + np.arange(len(x))
        at = np.sort(np.argpartition(key, count - 1, axis=1)[:, :count], axis=1)
        score = (q[:, None, :] * x[at]).sum(axis=2) / np.sqrt(qq[:, None] * xx[at])  # each by itself, so that equal vectors score alike
        score[~np.take_along_axis(may, at, axis=1)] = -np.inf
        order = np.argsort(-score, axis=1, kind="stable")[:, :wanted]
        score, at = (np.take_along_axis(a, order, axis=1) for a in (score, at))
        row, place = np.nonzero(score > -np.inf)
        entry = pa.array(at[row, place])
        return queries.field("id").to_numpy()[row], *(entries.field(c).take(entry).to_numpy() for c in ("id", "least")), score[row, place]

    def rerank(batch: pa.RecordBatch) -> dict[str, Any]:
        sides = batch.column("queries"), batch.column("entries")
        found = [best(*(flat(side, at) for side in sides)) for at in range(batch.num_rows)]
        return dict(zip(("query", "id", "least", "score"), map(np.concatenate, zip(*found, strict=True)), strict=True))

    return mapped(pairs.select("queries", "entries"), "query bigint, id bigint, least bigint, score double", rerank)


def flat(side: pa.ListArray, at: int) -> pa.StructArray:
    """The structs of one row of a column of arrays."""
    return side.slice(at, 1).flatten()


def first_rows(rows: DataFrame, by: list[str], order: list[Column], count: int) -> DataFrame:
    ranked = rows.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col("place") <= count).drop("place")


def sampled(classes: DataFrame, width: int) -> np.ndarray:
    """Unit vectors of the classes with the smallest hashes, at most ``SAMPLE_ROWS`` and ``SAMPLE_BYTES``."""
    rows = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * max(width, 1))))
    table = classes.select("id", "embedding").orderBy("id").limit(rows).toArrow().combine_chunks()
    return units(matrix(table.column("embedding").combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.float64())), width))


def neighbours(vectors: DataFrame, every: int = 50, count: int = 5, centroids: int = CENTROIDS, reach: float = REACH) -> DataFrame:
    """The ``count`` nearest rows found for each row of ``vectors`` (``vec_id``, ``embedding``) whose id ``every`` divides.

    Nearness is the cosine, in double precision. Returns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``, nearest
    first, ties to the smaller id. Every row is indexed and may be found but the query's own; with fewer candidates
    all are given. ``reach`` is the share of true neighbours that the search is set to find on the sample.

    Null and zero vectors and those with null or non-finite entries neither ask nor are found. Rows that repeat an id or
    a vector are rows of their own: a query whose id repeats is answered for each, and finds the others. A row
    without an id doesn't ask; it is found, after rows with ids that tie with it. Shorter vectors are padded with
    zeros. An empty table gives no rows; other columns are ignored. Equal vectors are told by 64-bit hashes.
    """
    odd = F.col("vec_id").isNull()
    usable = finite() & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").where(usable).withColumn("id", F.xxhash64("embedding"))
    least = first_rows(rows.withColumn("odd", odd), ["id"], [F.col("odd"), F.col("vec_id")], count + 1)
    member = F.struct("odd", "vec_id")
    classes = stored(least.groupBy("id").agg(F.first("embedding").alias("embedding"), F.sort_array(F.collect_list(member)).alias("members")), "classes")
    width = classes.agg(F.max(F.size("embedding"))).first()[0] or 1
    book = fitted(sampled(classes, width), centroids, count, reach)

    index = stored(indexed(classes, book), "index")
    counts = np.zeros([len(h) for h in book.halves], np.int64)
    for first, second, n in index.groupBy("first", "second").count().collect():  # as many as cells
        counts[first, second] = n
    asking = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id", "id").agg(F.count(F.lit(1)).alias("times"))
    asking = stored(asking, "queries")
    ways = stored(routes(index.join(asking.select("id").distinct(), "id", "left_semi"), book, counts), "routes")
    going = np.zeros(len(counts), np.int64)
    for first, n in ways.groupBy("first").count().collect():
        going[first] = n
    pages = stored(packed(index, counts.sum(axis=1), PAGE, "entries"), "pages")
    blocks = stored(packed(ways, going, BLOCK, "queries"), "blocks")

    hits = compared(blocks.join(pages, "first"), width, count + 1)
    hits = first_rows(hits, ["query"], [F.col("score").desc(), F.col("least"), F.col("id")], count + 1)
    hits = hits.join(classes.select("id", "members"), "id").select("query", "id", (-F.col("score")).alias("far"), F.explode("members").alias("member"))
    nearest = F.slice(F.sort_array(F.collect_list(F.struct("far", "member", "id"))), 1, count + 1)
    found = stored(hits.groupBy("query").agg(nearest.alias("hits")), "found")
    own = F.array_position(F.transform("hits", lambda h: (h["id"] == F.col("id")) & h["member"]["vec_id"].eqNullSafe(F.col("vec_id"))), True)
    answers = asking.join(found, F.col("id") == F.col("query")).withColumn("own", own)
    others = F.slice(F.filter("hits", lambda h, i: i + 1 != F.col("own")), 1, count)
    answers = answers.select("vec_id", others.alias("hits"), F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    answers = answers.select(F.col("vec_id").alias("query_id"), F.posexplode("hits").alias("at", "hit"))
    return answers.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "hit.member.vec_id", (-F.col("hit.far")).alias("score"))
