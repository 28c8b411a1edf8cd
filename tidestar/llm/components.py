"""Connected components of a link table, in rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestar.session import stored


def _state(edges: DataFrame) -> tuple:
    """Number and checksum of the links: one row, whatever the size."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("bigint"))).first())


def components(links: DataFrame) -> DataFrame:
    """The smallest id that each linked id reaches: ``node``, ``component``.

    ``links`` has two id columns, in any order; repeated links and links of an id to itself change
    nothing. Ids without a link to another id have no row. Alternates large-star and small-star
    rounds until the links form stars. Each round's table is written to the shared folder, and
    nothing but its size and checksum comes to the driver. A hot id is reduced by partial
    aggregates, and these are stored too: a join of stored tables is one whose hot partitions the
    adaptive skew join can split, which it can't beside an aggregate.
    """
    a, b = links.columns[:2]
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    edges = stored(edges, "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "links")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "links")
        before, state = state, _state(edges)
        if before == state:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def least_members(members: DataFrame, links: DataFrame) -> DataFrame:
    """``id`` and ``component_id``: the smallest ``doc_id`` in the component of every row of ``members`` (``id``, ``doc_id``)."""
    known = components(links)
    named = members.select("id", "doc_id").join(known, F.col("id") == F.col("node"), "left")
    named = stored(named.select("id", "doc_id", F.coalesce("component", "id").alias("component")), "members")
    least = stored(named.groupBy("component").agg(F.min("doc_id").alias("component_id")), "least")
    return named.join(least, "component").select("id", "component_id")
