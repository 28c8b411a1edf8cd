"""Random row and key picks of an exact size, of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestar.session import stored

#: Order values have 60 bits each; a round of counting tells rows apart by this many of them.
BITS, DIGIT = 60, 15


def _smallest(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The n rows that come first by some order columns of ``BITS`` bits, which together tell all rows apart.

    The cut is found from counts: a round counts the rows at the cut by their next ``DIGIT`` bits, which is
    a bounded number of counts whatever the table's size, and ends when they divide at exactly n
    rows. No task sorts or holds the n rows, so one way serves every n.
    """
    if n <= 0:
        return df.limit(0)
    below, at = F.lit(False), F.lit(True)
    left = n
    for column in order:
        for shift in range(BITS - DIGIT, -1, -DIGIT):
            digit = F.shiftright(column, shift).bitwiseAND((1 << DIGIT) - 1)
            counts = df.where(at).groupBy(digit.alias("digit")).agg(F.count(F.lit(1)).alias("n")).collect()
            taken, cut = 0, None
            for row in sorted(counts):
                if taken + row["n"] > left:
                    cut = row["digit"]
                    break
                taken += row["n"]
            if cut is None:  # all the rows at the cut are wanted
                return df.where(below | at)
            below, at, left = below | (at & (digit < cut)), at & (digit == cut), left - taken
            if left == 0:
                return df.where(below)
    return df.where(below)


def _numbered(df: DataFrame) -> DataFrame:
    """The rows, stored, each with a number of its own."""
    return stored(df.withColumn("__row", F.monotonically_increasing_id()), "sample")


def pick_keys(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n keys in random order of ``sha2(key|seed)``: the same seed gives the same keys on any cluster.

    The order is by range over all tasks, as that of any sorted table.
    """
    digest = F.sha2(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))), 256)
    part = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint")
    rows = _numbered(df.select(key, part(1).alias("__o1"), part(16).alias("__o2")))
    order = ["__o1", "__o2", "__row"]
    return _smallest(rows, n, order).orderBy(*order).select(key)


#: A cut is set so that it holds the rows wanted, but for one time in a billion: this many deviations above their number.
DEVIATIONS, SPARE = 6, 20


def sample_n(df: DataFrame, n: int, seed: int) -> DataFrame:
    """Exactly n rows without replacement, or all when there are fewer.

    Every row draws a number. From the count of the rows a cut is set below which n of them lie almost surely; only
    the rows below it are stored, some n in all, and divided at exactly n. Where they are too few the cut is doubled, and the
    rows draw the same numbers again. Each copy of a row draws by itself.
    """
    if n <= 0:
        return df.limit(0)
    total = df.count()
    if n >= total:
        return df
    draw = F.floor(F.rand(seed) * (1 << 52)).cast("bigint")
    cut = (n + DEVIATIONS * n**0.5 + SPARE) / total
    while True:
        drawn = df.withColumn("__o", F.shiftleft(draw, BITS - 52))
        rows = _numbered(drawn if cut >= 1 else drawn.where(F.col("__o") < int(cut * (1 << BITS))))
        if cut >= 1 or rows.count() >= n:
            return _smallest(rows, n, ["__o", "__row"]).drop("__o", "__row")
        cut *= 2
