"""Mixing to target weights: soft domain membership and nonnegative document rates, in SQL functions only.

A naive Bayes classifier learns the domains of the labelled table from hashed words. It gives each
document a posterior over the domains: soft membership. Rates then solve a least-squares problem,

    minimise  (A r - T)' G^-1 (A r - T)   over rates r >= 0,

where ``A r`` are the expected tokens of each domain, ``T`` the target and ``G`` the Gram matrix of the
memberships weighted by tokens. Every projected gradient step is ``r <- max(0, r - p . g)`` with one
vector ``g`` for all documents. A step is one aggregation over the
documents; the driver sees as many numbers as there are domains, and the steps taken so far are
folded over each document again, so nothing is rewritten between them.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestar.llm.batches import free_name
from tidestar.session import stored

BUCKETS = 8192  #: hashed words told apart by the classifier
#: Labelled documents that the classifier learns from at most, taken by hash.
LABELLED = 200_000
STEPS = 60
TOLERANCE = 1e-5  #: of all tokens: the misfit of a domain at which steps end
#: A document's evidence counts as that of so many words at most, since words are not independent.
EVIDENCE = 60.0


def words(text: str = "text") -> Column:
    """The words of a text, lower-cased; none for a null or empty text."""
    found = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "[\\x20\\x09-\\x0D]+")
    return F.filter(found, lambda w: w != "")


def bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled texts: ``domain`` is ``quality * 2 + toxic``; rows without a full label or id don't count."""
    known = labels.select("doc_id", (F.col("quality") * 2 + F.col("toxic")).cast("int").alias("domain"))
    known = known.where("domain between 0 and 3 and doc_id is not null").groupBy("doc_id").agg(F.min("domain").alias("domain"))
    total = known.count()
    if total > LABELLED:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit((1 << 30) * LABELLED // total))
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # about LABELLED ids at most


def classifier(docs: DataFrame, labels: DataFrame) -> tuple[list[int], list[float], list[np.ndarray]]:
    """Domains, log priors and log probabilities of the buckets: ``BUCKETS`` numbers for each domain."""
    counted = labelled(docs, labels).select("domain", F.explode(F.array_distinct(F.transform(words(), bucket))).alias("bucket"))
    sums = counted.groupBy("domain", "bucket").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 4 * BUCKETS rows
    if not sums:
        return [-1], [0.0], [np.zeros(BUCKETS)]
    domains = sorted({r["domain"] for r in sums})
    table = np.zeros((4, BUCKETS))
    for r in sums:
        table[r["domain"], r["bucket"]] = r["n"]
    table = table[domains] + 0.5
    share = table.sum(axis=1) / max(table.sum(), 1)
    return domains, np.log(share).tolist(), list(np.log(table / table.sum(axis=1, keepdims=True)))


def array_of(numbers: np.ndarray | list[float]) -> Column:
    """A constant array, folded once when the plan is made."""
    return F.split(F.lit(",".join(f"{x:.7g}" for x in numbers)), ",").cast("array<double>")


def posteriors(docs: DataFrame, model: tuple[list[int], list[float], list[np.ndarray]]) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``p``, the posterior of each of the model's domains, for every row."""
    domains, priors, logs = model
    k = len(domains)
    base = docs.select("doc_id", words().alias("w"))
    base = base.select("doc_id", F.size("w").cast("bigint").alias("n_tokens"), F.array_distinct(F.transform("w", bucket)).alias("b"))
    # Each document's evidence relative to the first domain, one fold for each other domain.
    fold = lambda table: F.aggregate("b", F.lit(0.0), lambda s, b: s + F.get(array_of(table), b))
    weight = F.least(F.lit(1.0), F.lit(EVIDENCE) / F.greatest(F.size("b"), F.lit(1)))
    odds = [F.lit(0.0), *(priors[i] - priors[0] + weight * fold(logs[i] - logs[0]) for i in range(1, k))]
    base = base.select("doc_id", "n_tokens", F.array(*odds).alias("odds"))
    base = base.select("doc_id", "n_tokens", F.transform("odds", lambda o: F.exp(o - F.array_max("odds"))).alias("e"))
    total = F.aggregate("e", F.lit(0.0), lambda s, e: s + e)
    return base.select("doc_id", "n_tokens", F.transform("e", lambda e: e / total).alias("p"))


def rate(steps: list[list[float]], k: int) -> Column:
    """The rate of a document after some projected steps, folded over the constant array of the steps."""
    if not steps:
        return F.lit(1.0)
    flat = array_of([g for step in steps for g in step])
    dot = lambda i: reduce(lambda a, b: a + b, (F.col("p")[j] * F.get(flat, i * k + j) for j in range(k)))
    return F.aggregate(F.sequence(F.lit(0), F.lit(len(steps) - 1)), F.lit(1.0), lambda r, i: F.greatest(F.lit(0.0), r - dot(i)))


def fit(members: DataFrame, domains: list[int], targets: dict[int, float]) -> list[list[float]]:
    """The projected gradient steps that bring the expected tokens of each domain to its target share.

    Steps are scaled by the Gram matrix of the documents whose rates are above zero, which the same
    pass sums up. A step that doesn't lessen the misfit is taken back and tried a quarter as long;
    when it has become short, a step scaled by the matrix of all documents, which always
    lessens it, takes its place.
    """
    k = len(domains)
    entries = [(i, j) for i in range(k) for j in range(i + 1)]
    tokens = [F.col("n_tokens") * F.col("p")[i] for i in range(k)]
    inverse = lambda m: np.linalg.pinv(m, rcond=1e-9, hermitian=True)
    steps: list[list[float]] = []
    misfit, length = None, 1.0
    for _ in range(STEPS):
        rated = members.withColumn("r", rate(steps, k))
        active = [F.sum(F.when(F.col("r") > 0, tokens[i] * F.col("p")[j])) for i, j in entries]
        row = [float(x or 0) for x in rated.agg(F.sum("n_tokens"), *(F.sum(t * F.col("r")) for t in tokens), *active).first()]
        total, sums, gram = row[0], np.array(row[1 : k + 1]), np.zeros((k, k))
        for (i, j), x in zip(entries, row[k + 1 :], strict=True):
            gram[i, j] = gram[j, i] = x
        if misfit is None:  # all rates are 1
            weights = np.array([max(0.0, targets.get(d, 0.0)) for d in domains])
            if not total or not weights.any():
                return []
            whole, wanted = inverse(gram), total * weights / weights.sum()
        now = float((sums - wanted) @ whole @ (sums - wanted))
        if misfit is None or now < misfit:
            length = min(1.0, 2 * length)
            residual, scale, misfit = sums - wanted, inverse(gram), now
            if np.abs(residual).max() <= TOLERANCE * total:
                return steps
        else:
            steps.pop()
            length /= 4
        if length < 1 / 64:
            step, length = whole @ residual, 0.5
        else:
            step = length * scale @ residual
        steps.append(step.tolist())
    return steps[:-1]


#: Target shares of the expected tokens by domain (``quality * 2 + toxic``).
TARGETS = {2: 0.85, 0: 0.10, 3: 0.04, 1: 0.01}


def mix(docs: DataFrame, labels: DataFrame, targets: dict[int, float] = TARGETS) -> DataFrame:
    """Soft memberships and rates of every document of ``docs`` (``doc_id``, ``text``).

    Returns ``doc_id``, ``n_tokens`` (words), ``membership`` (posterior of each labelled domain, in
    ascending order), ``rate`` (expected copies) and ``copies`` (whole copies, which the id's hash
    rounds up or down so that their mean is the rate). One row per input row; rows that repeat are
    rated alike. Null and empty texts have no tokens and the prior as membership. Null ids share
    one rounding. Without usable labels, or when no labelled domain has a target, every rate is 1. A
    domain that no document belongs to can't meet its target, and the nearest rates are returned.
    An empty table gives no rows; other columns are ignored.
    """
    domains, priors, logs = classifier(docs, labels)
    members = stored(posteriors(docs, (domains, priors, logs)), "members")
    steps = fit(members, domains, targets)
    rated = members.withColumn("rate", rate(steps, len(domains)))
    unit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = F.floor(F.col("rate") + unit).cast("bigint")
    return rated.select("doc_id", "n_tokens", F.col("p").alias("membership"), "rate", copies.alias("copies"))


def mixed_documents(docs: DataFrame, labels: DataFrame, targets: dict[int, float] = TARGETS) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say, with all their columns.

    Rows of one ``doc_id``, those without an id too, come as often as the one of them with most copies. Null and empty texts are
    rated by the prior, repeated rows alike, long texts by all their words. An empty table gives no rows, and other
    columns may have any names.
    """
    known, copies, copy = (free_name(docs, c) for c in ("mixed_id", "mixed_copies", "mixed_copy"))
    times = mix(docs, labels, targets).groupBy(F.col("doc_id").alias(known)).agg(F.max("copies").alias(copies))
    rows = docs.join(times, F.col("doc_id").eqNullSafe(F.col(known))).where(F.col(copies) > 0)
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*(f"`{c}`" for c in docs.columns))
