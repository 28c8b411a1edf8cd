"""Latest rows, merges, change application, row-set DML, picks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestar.functions import unwrap_cdc
from tidestar.operators import (
    affected,
    apply_changes,
    build_dim,
    build_dim_datetime,
    delete_where_in,
    diff_changes,
    latest_per_key,
    live_rows,
    merge_insert,
    pick_keys,
    sample_n,
    update_where_in,
    where_in,
)
from tidestar.plans import BucketedState, DigestedVersions, FeedTable, clean_trips, read_versioned, write_version
from tidestar.registry.base import ORACLE, query, table
from tidestar.registry.fixtures import (
    CLEAN_SQL,
    ORDERS_AFTER_SQL,
    RATES_SQL,
    USER_ROW,
    order_feed,
    orders_after,
    trips,
    user_feed,
)
from tidestar.registry.star import DIM_DATETIME_SQL
from tidestar.session import stored, work_dir
from tidestar.sources import rate_codes

ITEM_KEY = ["l_orderkey", "l_linenumber"]
ITEM_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


@query(
    "latest_per_key",
    """SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem)
    WHERE rn = 1""",
)
def latest_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(table(spark, sf_dir, "lineitem"), ITEM_KEY, ITEM_ORDER)


@query(
    "pick_keys",
    "SELECT o_orderkey FROM orders ORDER BY sha256(concat_ws('|', CAST(o_orderkey AS VARCHAR), '42')) LIMIT 1000",
)
def pick_order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pick_keys(table(spark, sf_dir, "orders"), "o_orderkey", 1000, seed=42)


@query("sample_n")
def sample_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_n(table(spark, sf_dir, "lineitem"), 1000, seed=42)


@query(
    "sample_n_facts",
    """SELECT CASE n WHEN 0 THEN 1000 ELSE total - 5 END AS wanted, CASE n WHEN 0 THEN 1000 ELSE total - 5 END AS n_rows,
              CASE n WHEN 0 THEN 1000 ELSE total - 5 END AS n_distinct, CAST(0 AS BIGINT) AS n_foreign
    FROM (SELECT count(*) AS total FROM (SELECT DISTINCT event_id FROM events)) CROSS JOIN (VALUES (0), (1)) v(n)""",
)
def sample_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of every random sample, for a small one and one near the whole table: size, no repeats, no foreign rows."""
    events = table(spark, sf_dir, "events").select("event_id")
    found = []
    for n in (1000, events.count() - 5):
        drawn = sample_n(events, n, seed=42)
        foreign = drawn.join(events.withColumnRenamed("event_id", "known"), F.col("event_id") == F.col("known"), "left_anti")
        facts = drawn.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_id").alias("n_distinct"))
        facts = facts.withColumn("n_foreign", F.lit(foreign.count()).cast("bigint"))
        found.append(facts.select(F.lit(n).cast("bigint").alias("wanted"), "n_rows", "n_distinct", "n_foreign"))
    return found[0].unionByName(found[1])


def _waves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = clean_trips(trips(spark, sf_dir))
    return rows.filter("load_wave = 1"), rows.filter("load_wave = 2")


@query("merge_insert", f"WITH {CLEAN_SQL} {DIM_DATETIME_SQL}")
def merge_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of a second load merged into those of the first."""
    first, second = _waves(spark, sf_dir)
    return merge_insert(build_dim_datetime(first), build_dim_datetime(second), ["datetime_hash"])


@query(
    "merge_insert_null_unsafe",
    f"""WITH {CLEAN_SQL}, {RATES_SQL}, dim AS (
      SELECT DISTINCT c.load_wave, c.ratecode_id, r.ratecode_description
      FROM clean c LEFT JOIN rate_codes r ON r.ratecode_id = c.ratecode_id)
    SELECT ratecode_id, ratecode_description FROM dim WHERE load_wave = 1
    UNION ALL
    SELECT ratecode_id, ratecode_description FROM dim s WHERE load_wave = 2
      AND NOT EXISTS (SELECT 1 FROM dim t WHERE t.load_wave = 1 AND t.ratecode_id = s.ratecode_id)""",
)
def merge_codes_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain equality: the null code of the second load is inserted beside that of the first."""
    first, second = [build_dim(w, "ratecode_id", rate_codes(spark)) for w in _waves(spark, sf_dir)]
    return merge_insert(first, second, ["ratecode_id"], null_safe=False)


LAST_EVENT_SQL = """last_event AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
  WHERE rn = 1)"""


def _user_state(spark: SparkSession, sf_dir: str, deletes: str) -> DataFrame:
    changes = unwrap_cdc(user_feed(spark, sf_dir), USER_ROW, keep=["offset"]).drop("source")
    changes = changes.withColumnRenamed("offset", "__offset")
    return apply_changes(None, changes, ["user_id"], ["__offset"], deletes)


@query(
    "cdc_current_state",
    f"""WITH {LAST_EVENT_SQL}
    SELECT user_id, event_id, epoch_us(ts) AS ts, event_type, value, props FROM last_event
    WHERE event_type <> 'error'""",
)
def cdc_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _user_state(spark, sf_dir, "apply")


@query(
    "cdc_late_changes",
    f"""WITH {LAST_EVENT_SQL}
    SELECT user_id, event_id, epoch_us(ts) AS ts, event_type, value, props FROM last_event
    WHERE event_type <> 'error'""",
)
def cdc_late_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed in four batches, the latest first: marks keep deleted keys deleted when older changes come after."""
    changes = unwrap_cdc(user_feed(spark, sf_dir), USER_ROW, keep=["offset"]).drop("source")
    changes = stored(changes.withColumnRenamed("offset", "__offset"), "late_changes")
    state = None
    for part in (3, 1, 2, 0):
        batch = changes.filter(F.pmod(F.floor(F.col("__offset") / 3), F.lit(4)) == part)
        state = stored(apply_changes(state, batch, ["user_id"], ["__offset"], "mark"), "late_state")
    return live_rows(state)


CURRENT_SQL = ORACLE["cdc_late_changes"]


@query("cdc_bucketed_state", CURRENT_SQL)
def cdc_bucketed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batches folded into buckets of the key, each fold rewriting the buckets it touches."""
    changes = unwrap_cdc(user_feed(spark, sf_dir), USER_ROW, keep=["offset"]).drop("source")
    changes = stored(changes.withColumnRenamed("offset", "__offset"), "late_changes")
    state = BucketedState(work_dir(spark, "buckets"), USER_ROW, ["user_id"], ["__offset"], buckets=16)
    for part in (3, 1, 2, 0):
        state.fold(changes.filter(F.pmod(F.floor(F.col("__offset") / 3), F.lit(4)) == part))
    return state.read(spark)


REPLICA_SQL = f"""WITH {LAST_EVENT_SQL}
    SELECT user_id,
      CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
      CASE WHEN event_type <> 'error' THEN epoch_us(ts) END AS ts,
      CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
      CASE WHEN event_type <> 'error' THEN value END AS value,
      CASE WHEN event_type <> 'error' THEN props END AS props
    FROM last_event"""


@query("cdc_replica_state", REPLICA_SQL)
def cdc_replica_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _user_state(spark, sf_dir, "keep")


@query(
    "diff_changes",
    f"""WITH {ORDERS_AFTER_SQL}
    SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(a.o_custkey, b.o_custkey) AS o_custkey,
           coalesce(a.o_orderstatus, b.o_orderstatus) AS o_orderstatus,
           coalesce(a.o_totalprice, b.o_totalprice) AS o_totalprice,
           coalesce(a.o_orderdate, b.o_orderdate) AS o_orderdate,
           coalesce(a.o_orderpriority, b.o_orderpriority) AS o_orderpriority,
           CASE WHEN b.o_orderkey IS NULL THEN 'c' WHEN a.o_orderkey IS NULL THEN 'd' ELSE 'u' END AS op
    FROM orders b FULL JOIN orders_after a ON a.o_orderkey = b.o_orderkey
    WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_orderstatus <> b.o_orderstatus""",
)
def diff_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = diff_changes(table(spark, sf_dir, "orders"), orders_after(spark, sf_dir), ["o_orderkey"])
    return changes.withColumnRenamed("__op", "op").drop("__deleted")


@query("diff_by_digest", ORACLE["diff_changes"])
def diff_orders_by_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from two stored versions, of which only the buckets with other digests are read."""
    before, after = table(spark, sf_dir, "orders"), orders_after(spark, sf_dir)
    store = DigestedVersions(work_dir(spark, "digested"), before.schema, ["o_orderkey"], buckets=64)
    changes = store.diff(spark, store.write(before), store.write(after))
    return changes.withColumnRenamed("__op", "op").drop("__deleted")


@query(
    "feed_schema",
    """SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS o_orderpriority,
         CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice END AS o_totalprice
    FROM orders WHERE o_orderkey % 2 = 1 OR o_orderstatus <> 'F'""",
)
def feed_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that tells its own types, and whose second batch widens a column, adds one, and leaves one out."""
    replica = FeedTable(work_dir(spark, "feed"), ["o_orderkey"])
    for batch_id, later in enumerate((False, True)):
        replica.load(order_feed(spark, sf_dir, later), "feed", batch_id)
    return replica.read(spark)


@query("apply_diff", f"WITH {ORDERS_AFTER_SQL} SELECT * FROM orders_after")
def apply_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes between two versions, applied to the first, give the second."""
    before = table(spark, sf_dir, "orders")
    changes = stored(diff_changes(before, orders_after(spark, sf_dir), ["o_orderkey"]), "order_changes")
    return apply_changes(before, changes, ["o_orderkey"])


@query("versioned_table", f"WITH {ORDERS_AFTER_SQL} SELECT * FROM orders_after")
def versioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a stored table: read one version, write the next, read that."""
    before, root = table(spark, sf_dir, "orders"), work_dir(spark, "orders")
    write_version(before, root)
    current = read_versioned(spark, root, before.schema)
    changes = stored(diff_changes(current, orders_after(spark, sf_dir), ["o_orderkey"]), "order_changes")
    write_version(apply_changes(current, changes, ["o_orderkey"]), root)
    return read_versioned(spark, root, before.schema)


def _debtors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))


DEBTORS_SQL = "(SELECT c_custkey FROM customer WHERE c_acctbal < 0)"


@query("where_in", f"SELECT * FROM orders WHERE o_custkey IN {DEBTORS_SQL}")
def orders_where_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return where_in(table(spark, sf_dir, "orders"), _debtors(spark, sf_dir), "o_custkey")


@query(
    "update_where_in",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN o_custkey IN {DEBTORS_SQL} THEN 'N' ELSE o_orderstatus END
      AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""",
)
def orders_update_where_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _debtors(spark, sf_dir)
    return update_where_in(table(spark, sf_dir, "orders"), keys, "o_custkey", {"o_orderstatus": "N"})


@query("delete_where_in", f"SELECT * FROM orders WHERE o_custkey NOT IN {DEBTORS_SQL}")
def orders_delete_where_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delete_where_in(table(spark, sf_dir, "orders"), _debtors(spark, sf_dir), "o_custkey")


@query("affected_rows", f"SELECT count(*) AS n_rows FROM orders WHERE o_custkey IN {DEBTORS_SQL}")
def affected_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return affected(table(spark, sf_dir, "orders"), _debtors(spark, sf_dir), "o_custkey")
