"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with a cosine of ``c`` or more lie within ``sqrt(2 - 2c)`` of each other. Vectors are projected
on the leading principal directions, which never lengthens a distance, and sorted by the cells of a
grid of that width. The order is cut into blocks of consecutive vectors. Two blocks whose boxes lie further
apart than a cell are skipped; other pairs of blocks are joined by halving the longer interval again and
again, skipping distant halves, until small intervals are compared by one matrix product.

Equal vectors form a class of which one is compared. A pair of blocks gives for each vector the number of
its links, and a local component, never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestar.llm.batches import map_rows, map_slices
from tidestar.llm.components import least_members
from tidestar.session import stored

DIRECTIONS = 8  #: principal directions that make the grid
BLOCK_BYTES = 512 * 1024  #: of the vectors of a block, so that a pair of blocks stays small
LEAF_ROWS = 128
SLACK = 1e-9  #: added to distances that prune, against rounding


def usable() -> Column:
    """Whether ``embedding`` has a direction: no null or non-finite component, and not only zeros."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists("embedding", lambda x: x != 0), F.lit(False))


def padded(rows: list, width: int) -> np.ndarray:
    """Vectors as rows of a matrix; shorter ones are padded with zeros."""
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def units(rows: list | np.ndarray, width: int) -> np.ndarray:
    """Vectors in double precision, of length one."""
    out = rows.astype(float) if isinstance(rows, np.ndarray) else padded(rows, width)
    out /= np.abs(out).max(axis=1, keepdims=True, initial=1e-300)
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def directions(classes: DataFrame, width: int) -> np.ndarray:
    """The leading principal directions of all vectors, as columns."""

    def run(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, Any]]:
        total = np.zeros((width, width))
        for rows in slices:
            unit = units(rows["embedding"], width)
            total += unit.T @ unit
        yield {"at": range(width), "sums": list(total)}

    sums = map_slices(classes.select("embedding"), "at int, sums array<double>", run)
    entries = sums.select("at", F.posexplode("sums").alias("to", "part")).groupBy("at", "to").agg(F.sum("part").alias("part"))
    matrix = np.zeros((width, width))
    for r in entries.collect():  # as many numbers as the square of the dimension
        matrix[r["at"], r["to"]] = r["part"]
    return np.ascontiguousarray(np.linalg.eigh(matrix)[1][:, ::-1][:, :DIRECTIONS])


def projected(classes: DataFrame, basis: np.ndarray, cell: float) -> DataFrame:
    """The classes with their grid ``cells``."""
    width = len(basis)

    def make():  # noqa: ANN202
        def project(rows: dict[str, list]) -> dict[str, Any]:
            at = units(rows["embedding"], width) @ basis
            return {k: rows[k] for k in ("id", "n", "embedding")} | {"cells": list(np.floor(at / cell).astype(np.int32))}

        return project

    kind = classes.schema["embedding"].dataType.simpleString()
    return map_rows(classes.select("id", "n", "embedding"), f"id bigint, n bigint, embedding {kind}, cells array<int>", make)


def block_rows(width: int, kind: str) -> int:
    return max(1, BLOCK_BYTES // (width * np.dtype(kind).itemsize))


BLOCKS = "block bigint, low array<double>, high array<double>, ids array<bigint>, counts array<bigint>, vectors binary"


def blocks(ordered: DataFrame, basis: np.ndarray, kind: str) -> DataFrame:
    """Consecutive vectors of each sorted partition, with the box around their projections."""
    width = len(basis)
    size = block_rows(width, kind)
    schema = pa.schema([("block", pa.int64()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())), ("ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("vectors", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def block(rows: pa.Table) -> pa.RecordBatch:
            nonlocal number
            raw = padded(rows.column("embedding").to_pylist(), width).astype(kind)
            at = units(raw, width) @ basis
            row = [[part * 2**32 + number], [at.min(axis=0)], [at.max(axis=0)], [rows.column("id").to_pylist()], [rows.column("n").to_pylist()], [raw.tobytes()]]
            number += 1
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, schema.types, strict=True)], schema=schema)

        for batch in batches:
            held.append(batch)
            rows = pa.Table.from_batches(held)
            while rows.num_rows >= size:
                yield block(rows.slice(0, size))
                rows = rows.slice(size)
            held = rows.to_batches()
        rows = pa.Table.from_batches(held) if held else None
        if rows is not None and rows.num_rows:
            yield block(rows)

    return ordered.mapInArrow(run, BLOCKS)


def block_pairs(boxes: DataFrame, reach: float) -> DataFrame:
    """Pairs of blocks (``a <= b``) whose boxes are no further apart than ``reach``.

    Blocks meet by the cells of the first direction that they cover, or are next to.
    """
    first = lambda c: F.floor(F.col(c)[0] / reach).cast("int")
    covered = boxes.select("block", "low", "high", F.explode(F.sequence(first("low"), first("high"))).alias("cell"))
    near = boxes.select("block", "low", "high", F.explode(F.sequence(first("low") - 1, first("high") + 1)).alias("cell"))
    left = covered.select(F.col("block").alias("a"), F.col("low").alias("al"), F.col("high").alias("ah"), "cell")
    right = near.select(F.col("block").alias("b"), F.col("low").alias("bl"), F.col("high").alias("bh"), "cell")
    gaps = F.zip_with(F.arrays_zip("al", "ah"), F.arrays_zip("bl", "bh"), lambda x, y: F.greatest(x["al"] - y["bh"], y["bl"] - x["ah"], F.lit(0.0)))
    far = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    return left.join(right, "cell").where("a <= b").where(far <= reach * reach).select("a", "b").distinct()


def join_intervals(one: np.ndarray, two: np.ndarray, basis: np.ndarray, threshold: float, reach: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of two sorted intervals with a cosine of ``threshold`` or more; each pair once if they are the same."""
    at, bt = one @ basis, two @ basis
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    todo = [(0, len(one), 0, len(two))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if same and a0 >= b1:
            continue
        gap = np.maximum(0, np.maximum(at[a0:a1].min(axis=0) - bt[b0:b1].max(axis=0), bt[b0:b1].min(axis=0) - at[a0:a1].max(axis=0)))
        if gap @ gap > reach * reach:
            continue
        if max(a1 - a0, b1 - b0) <= LEAF_ROWS:
            i, j = np.nonzero(one[a0:a1] @ two[b0:b1].T >= threshold)
            i, j = i + a0, j + b0
            keep = i < j if same else slice(None)
            left.append(i[keep])
            right.append(j[keep])
        elif a1 - a0 >= b1 - b0:
            middle = (a0 + a1) // 2
            todo += [(a0, middle, b0, b1), (middle, a1, b0, b1)]
        else:
            middle = (b0 + b1) // 2
            todo += [(a0, a1, b0, middle), (a0, a1, middle, b1)]
    return np.concatenate(left), np.concatenate(right)


def local_components(left: np.ndarray, right: np.ndarray, count: int) -> np.ndarray:
    """The least node that each node reaches by some links."""
    label = np.arange(count)
    ends, other = np.concatenate([left, right]), np.concatenate([right, left])
    order = np.argsort(ends, kind="stable")
    ends, other = ends[order], other[order]
    starts = np.flatnonzero(np.append(True, ends[1:] != ends[:-1])) if len(ends) else ends
    while len(ends):
        new = label.copy()
        new[ends[starts]] = np.minimum(label[ends[starts]], np.minimum.reduceat(label[other], starts))
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def similar(classes: DataFrame, threshold: float) -> DataFrame:
    """For each class with links to others, in parts: ``id``, ``n`` (vectors it links with), ``near`` (a class it reaches)."""
    reach = float(np.sqrt(2 - 2 * threshold)) + SLACK
    width = classes.agg(F.max(F.size("embedding"))).first()[0] or 1
    basis = directions(classes, width)
    placed = stored(projected(classes, basis, reach), "projected")
    keys = [F.col("cells")[i] for i in range(basis.shape[1])]
    ordered = placed.withColumns({f"c{i}": k for i, k in enumerate(keys)})
    by = [f"c{i}" for i in range(basis.shape[1])] + ["id"]
    ordered = ordered.repartitionByRange(*by).sortWithinPartitions(*by).select("id", "n", "embedding")
    kind = "<f4" if "float" in classes.schema["embedding"].dataType.simpleString() else "<f8"
    # Fewer vectors than the partitions could hold would make small blocks, and many pairs of them.
    ordered = ordered.coalesce(-(-placed.count() // block_rows(width, kind)) or 1)
    table = stored(blocks(ordered, basis, kind), "blocks")
    pairs = block_pairs(table.select("block", "low", "high"), reach)
    side = lambda c: table.select(F.col("block").alias(c), *(F.col(x).alias(f"{c}_{x}") for x in ("ids", "counts", "vectors")))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def make():  # noqa: ANN202
        def joined(rows: dict[str, list]) -> dict[str, Any]:
            out: dict[str, list] = {"id": [], "n": [], "near": []}
            for at in range(len(rows["a"])):
                same = rows["a"][at] == rows["b"][at]
                one, two = (units(np.frombuffer(rows[f"{c}_vectors"][at], kind).reshape(-1, width), width) for c in "ab")
                left, right = join_intervals(one, two, basis, threshold, reach, same)
                ids = np.array(rows["a_ids"][at] + ([] if same else rows["b_ids"][at]), np.int64)
                counts = np.array(rows["a_counts"][at] + ([] if same else rows["b_counts"][at]), np.int64)
                right = right if same else right + len(one)
                n = np.bincount(left, counts[right], len(ids)) + np.bincount(right, counts[left], len(ids))
                linked = np.flatnonzero(n)
                out["id"] += ids[linked].tolist()
                out["n"] += n[linked].astype(np.int64).tolist()
                out["near"] += ids[local_components(left, right, len(ids))[linked]].tolist()
            return out

        return joined

    return map_rows(both, "id bigint, n bigint, near bigint", make)


def near_duplicates(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Links and components of all rows of ``vectors`` (``vec_id``, ``embedding``) by cosine in double precision.

    Returns ``vec_id``, ``n_links`` (other rows with a cosine of ``threshold`` or more),
    ``component_id`` (smallest id reachable by links) and ``kept`` (the row has that id). One row per
    input row; rows that repeat an id or a vector are rows of their own and link with each other. Null and zero
    vectors, and those with null or non-finite components, link with nothing. Vectors of
    different lengths compare as if padded with zeros. A row without an id takes part, but never
    names a component. An empty table gives no rows; other columns are ignored.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    rows = vectors.select("vec_id", "embedding").withColumn("id", F.when(usable(), F.xxhash64("embedding")))
    classes = rows.where("id is not null").groupBy("id").agg(F.min("vec_id").alias("doc_id"), F.count(F.lit(1)).alias("n"), F.first("embedding").alias("embedding"))
    classes = stored(classes, "classes")
    parts = stored(similar(classes, threshold), "similar")
    named = least_members(classes.select("id", "doc_id"), parts.select("id", "near"))
    links = parts.groupBy("id").agg(F.sum("n").alias("others"))
    found = classes.select("id", "n").join(named, "id").join(links, "id", "left")
    found = found.select("id", "component_id", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    out = rows.drop("embedding").join(found, "id", "left")
    component = F.when(F.col("id").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
