"""Quality rules: robust multivariate outliers by minimum-covariance-determinant estimates.

Each document becomes a vector of six transformed statistics. For every language and source, centre
and covariance come from the half to three quarters of its documents whose covariance has the least
determinant. The search starts from three deterministic estimates (median and deviation, spatial
signs, hyperbolic tangents) and improves each by concentration steps; the best start is reweighted
once. A document is rejected when its squared Mahalanobis distance exceeds a chi-square quantile.

A concentration step is one aggregation over all documents. Distances fall into narrow logarithmic
bins, and each task sums the moments of each bin before the shuffle; the bin in which the wanted
share ends counts with the fraction that is missing. So a group of any size costs its bins only,
the order of rows doesn't matter, and ties are treated alike.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestar.llm.batches import SPACES, map_rows, without_ids
from tidestar.session import stored

#: Symbols that count as such, as the contract of the base rules names them.
SYMBOLS = "#*$%&|<>"
PUNCTUATION = "!\"'(),-./:;=?@[\\]^_`{}~+"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_punctuation")
STATISTICS = "doc_id bigint, lang string, source string, " + ", ".join(f"{c} bigint" for c in COUNTS)

X = [f"x{i}" for i in range(6)]
LOWER = [(i, j) for i in range(6) for j in range(i + 1)]
#: Spread added to every dimension's variance: what is always taken as normal variation of the transformed statistics.
FLOORS = (0.10, 0.35, 0.35, 0.35, 0.68, 0.79)
SHARE = 0.75  #: of a group's documents from which the least determinant is sought
QUANTILE = 0.99999  #: of the chi-square distribution beyond which a document is rejected
MIN_GROUP = 50  #: a source with fewer documents of a language joins that language's other small sources
STEPS = 10  #: concentration steps at most; they end earlier when no determinant falls any more
BINS_PER_OCTAVE = 32
SALTS = 32  #: parts that a group's documents are dealt into when they meet its estimate
GRAIN = 256  #: medians are taken over values rounded to 1/GRAIN, so their counts stay few


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of one whole text, in the order of ``COUNTS``."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    histogram = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    spaces = sum(int(histogram[ord(c)]) for c in SPACES)
    seen: set[str] = set()
    dup, lines = 0, 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            dup += line in seen
            seen.add(line)
    return (
        n,
        len(raw) - int(histogram[0x80:0xC0].sum()) - spaces,
        sum(int(histogram[ord(c)]) for c in SYMBOLS),
        dup,
        repeated_words(words),
        lines,
        int(histogram[65:91].sum()),
        sum(int(histogram[ord(c)]) for c in PUNCTUATION),
    )


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in a window of three words that occurs twice or more."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
    _, window, count = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    twice = count[window] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : shift + n - 2] |= twice
    return int(covered.sum())


def text_statistics(docs: DataFrame) -> DataFrame:
    """Ids, groups and counts of every document; one row for each input row, other columns ignored."""

    def make() -> Callable[[dict[str, list]], dict[str, list]]:
        def counted(rows: dict[str, list]) -> dict[str, list]:
            columns = zip(*map(text_counts, rows["text"]), strict=True)
            return {k: rows[k] for k in ("doc_id", "lang", "source")} | dict(zip(COUNTS, columns, strict=True))

        return counted

    return map_rows(docs.select("doc_id", "text", "lang", "source"), STATISTICS, make)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def vectors() -> dict[str, Column]:
    """The transformed statistics: logarithms of ratios, so that each is near to symmetric in clean text."""
    ratio = lambda a, b: F.log1p(100.0 * F.col(a) / F.greatest(F.col(b), F.lit(1)))
    columns = [
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
        ratio("n_symbols", "n_words"),
        ratio("n_upper", "word_chars"),
        ratio("n_punctuation", "n_words"),
        ratio("n_repeat_words", "n_words"),
        ratio("n_dup_lines", "n_lines"),
    ]
    return dict(zip(X, columns, strict=True))


def chi2_cdf(x: float, dims: int) -> float:
    """Distribution function for an even number of dimensions."""
    term, total = 1.0, 0.0
    for i in range(dims // 2):
        total += term
        term *= x / 2 / (i + 1)
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(p: float, dims: int) -> float:
    low, high = 0.0, 10.0 * dims - 40 * NormalDist().inv_cdf(min(0.5, 1 - p))
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, dims) < p else (low, middle)
    return high


def consistency(share: float) -> float:
    """What makes the covariance of the nearest ``share`` of normal data that of all of it."""
    return share / chi2_cdf(chi2_quantile(share, len(X)), len(X) + 2)


def described(center: np.ndarray, covariance: np.ndarray) -> dict[str, object]:
    """An estimate as stored: centre, rows of the inverse Cholesky factor, logarithm of the determinant."""
    covariance = covariance + np.diag(np.square(FLOORS))
    factor = np.linalg.cholesky(covariance)
    inverse = np.linalg.inv(factor)
    return {"center": center.tolist(), "whiten": [inverse[i, j] for i, j in LOWER], "logdet": 2 * float(np.log(np.diag(factor)).sum())}


def squared_distance() -> Column:
    """Of columns ``X`` under the estimate in columns ``center`` and ``whiten``."""
    away = [F.col(x) - F.col("center")[i] for i, x in enumerate(X)]
    at = {ij: k for k, ij in enumerate(LOWER)}
    rows = [sum((F.col("whiten")[at[i, j]] * away[j] for j in range(1, i + 1)), F.col("whiten")[at[i, 0]] * away[0]) for i in range(6)]
    return sum((r * r for r in rows[1:]), rows[0] * rows[0])


def moments() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        *(F.sum(x).alias(f"s{i}") for i, x in enumerate(X)),
        *(F.sum(F.col(X[i]) * F.col(X[j])).alias(f"s{i}_{j}") for i, j in LOWER),
    ]


def from_moments(bins: pd.DataFrame, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centre and covariance of binned moments, each bin with its weight."""
    total = (bins["n"].to_numpy() * weights).sum()
    weigh = lambda name: (bins[name].to_numpy() * weights).sum() / total
    center = np.array([weigh(f"s{i}") for i in range(6)])
    covariance = np.zeros((6, 6))
    for i, j in LOWER:
        covariance[i, j] = covariance[j, i] = weigh(f"s{i}_{j}") - center[i] * center[j]
    return center, covariance


def psd(matrix: np.ndarray) -> np.ndarray:
    """The nearest covariance without negative eigenvalues (rounding can leave small ones)."""
    values, vectors_ = np.linalg.eigh(matrix)
    return (vectors_ * np.maximum(values, 0)) @ vectors_.T


ESTIMATE = "grp string, start int, center array<double>, whiten array<double>, logdet double"


def concentrate(bins: pd.DataFrame) -> pd.DataFrame:
    """One concentration step of one group and start, from the moments of its distance bins."""
    bins = bins.sort_values("bin")
    count = bins["n"].to_numpy().astype(float)
    before = np.cumsum(count) - count
    weights = np.clip((SHARE * count.sum() - before) / count, 0, 1)
    center, covariance = from_moments(bins, weights)
    new = described(center, psd(covariance) * consistency(SHARE))
    return pd.DataFrame([{"grp": bins["grp"].iloc[0], "start": bins["start"].iloc[0]} | new])


def reweight(bins: pd.DataFrame) -> pd.DataFrame:
    """The final estimate of one group: all documents within the 97.5 % ellipsoid count."""
    limit = math.floor(math.log2(chi2_quantile(0.975, 6)) * BINS_PER_OCTAVE)
    weights = (bins["bin"].to_numpy() <= limit).astype(float)
    if not weights.any():
        weights[:] = 1
    center, covariance = from_moments(bins, weights)
    new = described(center, psd(covariance) * consistency(0.975))
    return pd.DataFrame([{"grp": bins["grp"].iloc[0], "start": bins["start"].iloc[0]} | new])


def first_estimates(sums: pd.DataFrame) -> pd.DataFrame:
    """Three starting estimates of one group from its medians, deviations and sums of signs and tangents."""
    row = sums.iloc[0]
    center, spread = np.array(row["med"], float), np.array(row["mad"], float)
    found = []
    for start, name in enumerate(("", "sign", "tanh")):
        shape = np.eye(6)
        if name:
            for i, j in LOWER:
                shape[i, j] = shape[j, i] = row[f"{name}{i}_{j}"] / row["n"]
            shape = psd(shape)
            diagonal = np.sqrt(np.maximum(np.diag(shape), 1e-6))
            shape = shape / np.outer(diagonal, diagonal)
        covariance = psd(shape * np.outer(spread, spread))
        found.append({"grp": row["grp"], "start": start} | described(center, covariance))
    return pd.DataFrame(found)


def distance_bin() -> Column:
    return F.floor(F.log2(F.greatest(squared_distance(), F.lit(2.0**-20))) * BINS_PER_OCTAVE).cast("int").alias("bin")


def given(points: DataFrame, table: DataFrame) -> DataFrame:
    """The points with the row of ``table`` for their group; a hot group meets it in ``SALTS`` parts."""
    salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return points.join(salted, ["grp", "salt"])


def estimates(points: DataFrame) -> DataFrame:
    """The estimate of every group of ``points`` (``grp``, ``x0`` .. ``x5``): ``grp``, ``center``, ``whiten``, ``logdet``."""
    points = points.withColumn("salt", F.pmod(F.hash(*X), F.lit(SALTS)))
    rounded = [F.median(F.round(F.col(x) * GRAIN)) / GRAIN for x in X]
    med = points.groupBy("grp").agg(F.array(*rounded).alias("med"))
    away = [F.median(F.round(F.abs(F.col(x) - F.col("med")[i]) * GRAIN)) / GRAIN for i, x in enumerate(X)]
    floored = [F.greatest(1.4826 * d, F.lit(f)) for d, f in zip(away, FLOORS, strict=True)]
    spread = stored(given(points, med).groupBy("grp").agg(F.first("med").alias("med"), F.array(*floored).alias("mad")), "spread")
    z = {f"z{i}": (F.col(x) - F.col("med")[i]) / F.col("mad")[i] for i, x in enumerate(X)}
    norm = F.greatest(sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, 6)), F.col("z0") * F.col("z0")), F.lit(1e-12))
    sums = (
        given(points, spread)
        .select("grp", "med", "mad", *(c.alias(k) for k, c in z.items()))
        .groupBy("grp", "med", "mad")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *(F.sum(F.col(f"z{i}") * F.col(f"z{j}") / norm).alias(f"sign{i}_{j}") for i, j in LOWER),
            *(F.sum(F.tanh(f"z{i}") * F.tanh(f"z{j}")).alias(f"tanh{i}_{j}") for i, j in LOWER),
        )
    )
    now = stored(sums.groupBy("grp").applyInPandas(first_estimates, ESTIMATE), "estimates")
    binned = lambda e: given(points, e).groupBy("grp", "start", distance_bin()).agg(*moments())
    falling = None
    for _ in range(STEPS):
        now = stored(binned(now).groupBy("grp", "start").applyInPandas(concentrate, ESTIMATE), "estimates")
        was, falling = falling, now.agg(F.round(F.sum("logdet"), 4)).first()[0]  # one number
        if was == falling:
            break
    best = now.groupBy("grp").agg(F.min_by(F.struct("start", "center", "whiten"), F.struct("logdet", "start")).alias("best")).select("grp", "best.*")
    return stored(binned(best).groupBy("grp", "start").applyInPandas(reweight, ESTIMATE), "estimates").drop("start")


def verdicts(docs: DataFrame) -> DataFrame:
    """Counts, distance and verdict of every document of ``docs`` (``doc_id``, ``text``, ``lang``, ``source``).

    Returns the columns of ``STATISTICS``, ``base_failed``, ``distance`` (squared Mahalanobis; null
    where the base rules fail or no estimate exists) and ``kept``. One row per input row, repeated
    rows included. Null and empty texts have no words and fail the base rules. Null languages and
    sources are groups of their own. Sources with fewer than ``MIN_GROUP`` documents of a language
    are estimated together; where even those are fewer than seven, nothing can be said against a document
    and it is kept. An empty table gives no rows. Other columns are ignored.
    """
    counted = stored(text_statistics(docs).withColumn("base_failed", base_failed()).withColumns(vectors()), "statistics")
    fine = counted.where(~F.col("base_failed"))
    named = lambda *c: F.to_json(F.struct(*c))  # noqa: E731  leaves out nulls, so a null differs from any name
    sizes = fine.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    groups = sizes.select(
        F.col("lang").alias("g_lang"),
        F.col("source").alias("g_source"),
        F.when(F.col("n") < MIN_GROUP, named("lang", F.lit(True).alias("small"))).otherwise(named("lang", "source")).alias("grp"),
    )
    same = F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
    points = stored(fine.join(groups, same).select("grp", "doc_id", "lang", "source", *X), "points")
    found = estimates(points)
    enough = points.groupBy("grp").count().where(F.col("count") > len(X)).join(found, "grp").drop("count")
    by_group = groups.join(enough, "grp", "left").drop("grp")
    distance = F.when(~F.col("base_failed") & F.col("center").isNotNull(), squared_distance())
    limit = chi2_quantile(QUANTILE, len(X))
    return (
        counted.join(by_group, same, "left")
        .withColumn("distance", distance)
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True)))
        .drop("g_lang", "g_source", "center", "whiten", "logdet", *X)
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    Rows of one ``doc_id`` stay together, those without an id too: they go if any of them is rejected. So
    repeated rows go or stay alike. Null, empty and wordless texts fail the base rules and go; long ones are judged
    whole. An empty table gives no rows, and other columns may have any names.
    """
    return without_ids(docs, verdicts(docs).where(~F.col("kept")))
