"""The operators of this subpackage as registered queries over the given tables."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidestar.llm import attention, bpe, collocations, forest, grid, licenses, lookup, mixing, multi_index, packing, quotes, robust, whitening
from tidestar.session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package's code, once for each application."""
    app = spark.sparkContext.applicationId
    if app not in SHIPPED:
        SHIPPED.add(app)
        root = Path(__file__).resolve().parent.parent
        to = f"{tempfile.mkdtemp(prefix='run-')}/{root.name}"
        spark.sparkContext.addPyFile(shutil.make_archive(to, "zip", root.parent, root.name))
    return spark


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: function(pin_utc(ship(spark)), sf_dir)
        if sql is not None:
            ORACLE[name] = sql.strip()
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op7_bpe")
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded with the public byte-level vocabulary."""
    encoded = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op1_robust_outliers")
def op1_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the robust verdict of every document."""
    found = robust.verdicts(table(spark, sf_dir, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *counts, "base_failed", "kept", "distance")


#: The smallest id that each node reaches over ``links`` (a, b), for the queries below.
REACH_SQL = """ways AS (SELECT a AS x, b AS y FROM links UNION ALL SELECT b, a FROM links), reach AS (
    SELECT x, y FROM ways UNION SELECT r.x, w.y FROM reach r JOIN ways w ON w.x = r.y),
  least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)"""

SHINGLES_SQL = f"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
  sets AS (
    SELECT doc_id, CASE WHEN len(w) < 2 THEN w
      ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM texts),
  items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
  links AS (
    SELECT p.doc_id AS a, q.doc_id AS b FROM items p JOIN items q ON p.item = q.item AND p.doc_id < q.doc_id
    GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
  {REACH_SQL}
SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id,
    doc_id <= coalesce(y, doc_id) AS kept
FROM sets LEFT JOIN least ON x = doc_id
"""

COSINE_SQL = f"""
WITH RECURSIVE vectors AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  links AS (
    SELECT p.vec_id AS a, q.vec_id AS b FROM vectors p JOIN vectors q ON p.vec_id < q.vec_id
    WHERE list_dot_product(p.v, q.v) / sqrt(list_dot_product(p.v, p.v) * list_dot_product(q.v, q.v)) >= 0.95),
  {REACH_SQL}, counts AS (SELECT x, count(*) AS n FROM ways GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(y, vec_id)) AS component_id,
    vec_id <= coalesce(y, vec_id) AS kept
FROM embeddings LEFT JOIN least ON least.x = vec_id LEFT JOIN counts ON counts.x = vec_id
"""


@query("op8_lsh_forest", SHINGLES_SQL)
def op8_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents over two-word shingles."""
    return forest.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


@query("op3_soft_mixing")
def op3_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Soft memberships, rates and copies of all documents for the default targets."""
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SHARDS = [f"shard-{i:02d}" for i in range(32)]


@query("op9_lookup_table", lookup.ORACLE.format(slots=lookup.SLOTS, shards=len(SHARDS)))
def op9_lookup_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slot and shard of every document."""
    placed = lookup.place(table(spark, sf_dir, "documents"), "doc_id", SHARDS)
    return placed.select("doc_id", "slot", "shard")


@query("op10_quotation_linking")
def op10_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations turned into threads of quoting messages, and back from their quotes alone."""
    threads = quotes.with_quotes(table(spark, sf_dir, "conversations"))
    return quotes.conversations(threads)


@query("op4_patience_licenses")
def op4_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices of all documents."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op5_packed_ids")
def op5_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed rows of token ids."""
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), end=50256)


@query("op6_grid_order_join", COSINE_SQL)
def op6_grid_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return grid.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op11_phrase_collocations", collocations.ORACLE)
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents")).drop("doc_id")


@query("op12_multi_index")
def op12_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows found for every fiftieth embedding."""
    return multi_index.neighbours(table(spark, sf_dir, "embeddings"))


@query("op13_polarised_whitening")
def op13_polarised_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight whitened components of all embeddings."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op2_attention_scores")
def op2_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of all documents."""
    return attention.score_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), end=50256)


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, sf_dir)
