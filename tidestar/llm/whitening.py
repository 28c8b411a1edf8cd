"""Embedding whitening with a covariance by polarisation.

Every entry becomes an integer, so all sums are exact. One pass adds up the dimensions; a second adds up, for
every dimension and every sum of two dimensions, the squares of the centred values. The covariance of two
dimensions is half of what the variance of their sum exceeds their own variances by, so no product of two
dimensions is ever formed. The matrix is assembled from these integers, rounded once, and taken apart by ``eigh``.

Values are centred by the integer next to their mean; what remains to the mean itself is taken off the sums,
which is exact too: the squares of ``n * x - S`` add up to ``n * n * Q - n * R * R`` where ``Q`` adds the squares
of the values so centred and ``R`` the values.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Context, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidestar.llm.batches import bounded_batches
from tidestar.llm.vectors import finite, matrix
from tidestar.session import stored

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Dimensions at most: the driver holds a square matrix of them.
MAX_WIDTH = 4096
#: Larger scaled entries (of a size no embedding has) are set to this, so that they stay long integers.
LARGEST = 2.0**53
#: Centred values below this have 64-bit squares that can be added; others are added as Python integers.
SMALL = 1 << 22
ROWS = 4096  #: of a slice: their squares add up within 64 bits
WORD = 10**18  #: sums travel in two decimals, of which this is the unit of the higher
#: Directions whose variance is below this share of the largest hold rounding only and are not whitened.
RANK = 1e-11
EXACT = Context(prec=60)


@dataclass(frozen=True)
class Centre:
    """Number of vectors, and by dimension the integers next to the means and the sums beyond them."""

    n: int
    near: list[int]
    beyond: list[int]


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def scaled(entries: np.ndarray) -> np.ndarray:
    """``floor(1024 * c)`` as 64-bit integers."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * entries), -LARGEST, LARGEST).astype(np.int64)


def centred(column: pa.ListArray, centre: Centre) -> np.ndarray:
    """Values less the integers next to their means; Python integers where 64 bits may not do."""
    y = scaled(matrix(column, len(centre.near))) - np.array([m - SHIFT for m in centre.near], np.int64)
    return y if np.abs(y).max(initial=0) < SMALL else y.astype(object)


def decimals(values: list[int]) -> tuple[list[Decimal], list[Decimal]]:
    parts = [divmod(int(v), WORD) for v in values]
    return [EXACT.create_decimal(h) for h, _ in parts], [EXACT.create_decimal(low) for _, low in parts]


PARTS = "at int, high array<decimal(38,0)>, low array<decimal(38,0)>"


def exact_sums(fit: DataFrame, add: Callable[[dict[int, list[int]], pa.ListArray], None]) -> dict[int, list[int]]:
    """Integer sums over all vectors by row and position, added up in the tasks and then in a shuffle.

    ``add`` adds a slice of vectors to the rows of a task. The driver gets the sums alone.
    """
    schema = to_arrow_schema(T._parse_datatype_string(PARTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list[int]] = {}
        for batch in slices(batches):
            add(total, batch.column(0))
        for at, values in total.items():
            columns = [[at], *([part] for part in decimals(values))]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    parts = bounded_batches(fit.select("embedding")).mapInArrow(run, PARTS)
    entries = parts.select("at", F.posexplode(F.arrays_zip("high", "low")).alias("to", "part"))
    sums = entries.groupBy("at", "to").agg(F.sum("part.high").alias("high"), F.sum("part.low").alias("low"))
    rows = sums.groupBy("at").agg(F.sort_array(F.collect_list(F.struct("to", "high", "low"))).alias("sums"))
    return {r["at"]: [int(s["high"]) * WORD + int(s["low"]) for s in r["sums"]] for r in rows.toLocalIterator()}


def added(row: list[int], more: np.ndarray) -> list[int]:
    row = row + [0] * (len(more) - len(row))
    return [a + int(b) for a, b in zip(row, more, strict=False)] + row[len(more) :]


def centre_of(fit: DataFrame) -> Centre:
    """Number and means of all vectors, as exact integers. Fails beyond ``MAX_WIDTH`` dimensions."""
    n, width = fit.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    width = width or 0
    if width > MAX_WIDTH:
        raise ValueError(f"{width} dimensions; at most {MAX_WIDTH} have their covariances assembled")

    def add(total: dict[int, list[int]], column: pa.ListArray) -> None:
        x = scaled(matrix(column, width))  # at most 2**53 each, in slices of 2**12 at most: halves of 27 bits add up
        low = x & (2**27 - 1)
        sums = (x >> 27).sum(axis=0).astype(object) * 2**27 + low.sum(axis=0).astype(object)
        total[0] = added(total.get(0, []), sums)

    sums = [s + n * SHIFT for s in exact_sums(fit, add).get(0, [])]
    near = [(2 * s + n) // (2 * n) for s in sums]
    return Centre(n, near, [s - n * m for s, m in zip(sums, near, strict=True)])


def squares(fit: DataFrame, centre: Centre) -> list[list[int]]:
    """For each dimension ``i``: the sums of the squares of ``n * x - S`` of it, and of its sums with each later dimension."""

    def add(total: dict[int, list[int]], column: pa.ListArray) -> None:
        y = centred(column, centre)
        for i in range(y.shape[1]):
            both = y[:, i:] + y[:, i : i + 1]
            both[:, 0] = y[:, i]
            total[i] = added(total.get(i, []), (both * both).sum(axis=0))

    n, r = centre.n, centre.beyond
    found = exact_sums(fit, add)
    over = lambda i, k: r[i] + (r[i + k] if k else 0)
    return [[n * n * q - n * over(i, k) ** 2 for k, q in enumerate(found[i])] for i in range(len(r))]


def covariance(sums: list[list[int]], n: int) -> np.ndarray:
    """The matrix of covariances (divisor ``n``) from the squares of dimensions and of their sums, each entry rounded once."""
    out = np.empty((len(sums), len(sums)))
    for i, row in enumerate(sums):
        out[i, i] = row[0] / n**3
        for k in range(1, len(row)):
            out[i, i + k] = out[i + k, i] = (row[k] - row[0] - sums[i + k][0]) // 2 / n**3
    return out


ROW = "vec_id bigint, deviation bigint, whitened array<double>"


def projected(fit: DataFrame, centre: Centre, ways: np.ndarray) -> DataFrame:
    """``vec_id``, ``deviation`` and ``whitened`` of every vector; ``ways`` has the scaled directions as columns."""
    schema = to_arrow_schema(T._parse_datatype_string(ROW))
    n, beyond = centre.n, np.array(centre.beyond, object)
    rest = beyond.astype(float) / n
    constant = int((beyond * beyond).sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            y = centred(batch.column(1), centre)
            fits = y.dtype == np.int64 and n * SMALL * max(len(beyond), 1) < 2**62  # beyond is at most n
            own, crossed = (y * y).sum(axis=1), (y * (beyond.astype(np.int64) if fits else beyond)).sum(axis=1)
            deviation = [n * n * int(a) - 2 * n * int(b) + constant for a, b in zip(own, crossed, strict=True)]
            deviation = [d if d < 2**63 else None for d in deviation]
            columns = [batch.column(0), pa.array(deviation, pa.int64()), pa.array(list((y.astype(float) - rest) @ ways), schema[2].type)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return bounded_batches(fit.select(F.col("vec_id").cast("bigint"), "embedding")).mapInArrow(run, ROW)


def identity_error(rows: DataFrame, count: int) -> float | None:
    """The largest absolute entry of the covariance of ``whitened`` minus the identity, over all rows."""
    if not count:
        return None
    part = [F.col("whitened")[k] for k in range(count)]
    means = rows.agg(*(F.avg(p).alias(f"m{k}") for k, p in enumerate(part))).first()
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    moments = rows.agg(*(F.avg((part[i] - means[i]) * (part[j] - means[j])).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(moments[at] - (i == j)) for at, (i, j) in enumerate(pairs))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Whitened components of all rows of ``vectors`` (``vec_id``, ``embedding``) whose vector has only finite entries.

    Entries become ``floor(1024 * c) + 100000``. Returns one row for each such row and each of the ``components``
    directions of largest variance (fewer where vectors are shorter): ``vec_id``, ``component`` (from 1), ``n``
    (vectors), ``deviation`` (squared distance of ``n`` times the vector from the sums, exact; null beyond 63 bits),
    ``whitened``, ``explained`` (share of the variance) and ``identity_error``, the same in all rows.

    Null vectors and those with null, NaN or infinite entries have no rows and no say. Zero vectors are vectors like
    others. Shorter vectors are padded with zeros; where all are empty there are no components and no rows. Rows
    that repeat an id or a vector are rows of their own, and so is a row without an id. A direction
    without variance (one vector, equal vectors, as many vectors as directions) has ``whitened`` null and ``explained``
    of zero, null where there is no variance at all; of equal variances any directions may come. An empty table
    gives no rows; other columns are ignored. Entries beyond 2**43 count as that; more than ``MAX_WIDTH`` dimensions fail.
    """
    fit = vectors.select("vec_id", "embedding").where(finite())
    centre = centre_of(fit)
    sums = squares(fit, centre)
    matrix_ = covariance(sums, centre.n) if sums else np.empty((0, 0))
    largest = np.abs(matrix_).max(initial=0) or 1.0
    values, ways = np.linalg.eigh(matrix_ / largest)
    values, ways = values[::-1][:components] * largest, ways[:, ::-1][:, :components]
    sound = int((values > RANK * values.max(initial=0)).sum()) if largest and values.max(initial=0) > 0 else 0
    trace = float(np.trace(matrix_))
    table = stored(projected(fit, centre, ways[:, :sound] / np.sqrt(values[:sound])), "whitened")
    error = identity_error(table, sound)
    shares = [float(v) / trace if k < sound else 0.0 if trace else None for k, v in enumerate(values)]
    entries = [entry(k, share, k < sound) for k, share in enumerate(shares)]
    rows = table.select("vec_id", "deviation", F.inline(F.array(*entries))) if entries else table.limit(0).select("vec_id", "deviation", F.inline(F.array(entry(0, 0.0, False))))
    n, wrong = F.lit(centre.n).cast("bigint").alias("n"), F.lit(error).cast("double").alias("identity_error")
    return rows.select("vec_id", "component", n, "deviation", "whitened", "explained", wrong)


def entry(k: int, share: float | None, sound: bool) -> Column:
    value = F.col("whitened")[k] if sound else F.lit(None).cast("double")
    return F.struct(F.lit(k + 1).alias("component"), value.alias("whitened"), F.lit(share).cast("double").alias("explained"))
