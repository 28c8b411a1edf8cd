"""Sharding by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a prime-sized table. The shards take turns, and each
claims the first slot of its permutation that is still free. So slots divide evenly, and when a
shard comes or goes few others change. The table is small and fixed in size; it is broadcast, and
a key finds its shard by one hash and one lookup.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 5003
#: Slots that a table may have; it bounds what is broadcast.
MAX_SLOTS = 1_000_003


def number(text: str) -> int:
    """52 bits of a text's MD5, the same in Spark, Python and SQL."""
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16)


def number_of(column: Column) -> Column:
    return F.conv(F.substring(F.md5(column.cast("string").cast("binary")), 1, 13), 16, 10).cast("bigint")


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard (by position) of each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be there and have different names")
    if not len(shards) <= slots <= MAX_SLOTS or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"the number of slots must be a prime from the number of shards to {MAX_SLOTS}")
    place = [number(f"offset:{s}") % slots for s in shards]
    skip = [number(f"skip:{s}") % (slots - 1) + 1 for s in shards]
    owner = [-1] * slots
    for turn in range(slots):
        shard = turn % len(shards)
        while owner[place[shard]] >= 0:
            place[shard] = (place[shard] + skip[shard]) % slots
        owner[place[shard]] = shard
    return owner


def table_frame(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """The lookup table as ``slot``, ``shard``."""
    owners = F.split(F.lit(",".join(map(str, lookup_table(shards, slots)))), ",").cast("array<int>")
    rows = spark.range(1).select(F.posexplode(owners).alias("slot", "shard_number"))
    name = F.get(F.array(*map(F.lit, shards)), F.col("shard_number"))
    return rows.select(F.col("slot").cast("bigint").alias("slot"), name.alias("shard"))


def place(rows: DataFrame, key: str, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """The rows with ``slot`` and ``shard``, in place of columns of these names.

    Equal keys go to one shard, however often they repeat; only the key decides. Null keys hash as the
    empty text. Nothing is shuffled. An empty table gives no rows.
    """
    table = table_frame(rows.sparkSession, shards, slots)
    slot = F.pmod(number_of(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(slots))
    return rows.drop("shard").withColumn("slot", slot).join(F.broadcast(table), "slot")


ORACLE = """
WITH RECURSIVE shards AS (
    SELECT s, 'shard-' || lpad(s::VARCHAR, 2, '0') AS shard,
        ('0x' || substr(md5('offset:shard-' || lpad(s::VARCHAR, 2, '0')), 1, 13))::BIGINT % {slots} AS place,
        ('0x' || substr(md5('skip:shard-' || lpad(s::VARCHAR, 2, '0')), 1, 13))::BIGINT % ({slots} - 1) + 1 AS skip
    FROM range({shards}) r(s)
), turns AS (
    SELECT 0 AS turn, list_transform(range({slots}), lambda x: -1) AS owner
    UNION ALL
    SELECT turn + 1, list_concat(owner[:slot], list_concat([s::INTEGER], owner[slot + 2:]))
    FROM (
        SELECT turn, owner, s,
            (place + skip * list_filter(range({slots}), lambda j: owner[(place + j * skip) % {slots} + 1] < 0)[1]) % {slots} AS slot
        FROM turns JOIN shards ON s = turn % {shards}
        WHERE turn < {slots}
    )
), slots AS (
    SELECT unnest(range({slots})) AS slot, unnest(owner) AS s FROM turns WHERE turn = {slots}
)
SELECT doc_id, slot, shard
FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT % {slots} AS slot FROM documents)
JOIN slots USING (slot) JOIN shards USING (s)
"""
