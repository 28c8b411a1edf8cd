"""Session defaults and scratch folders."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Hash keys render timestamps as text, so every run must agree on the zone.
# Broadcasts are left to Catalyst and AQE, which check sizes against the threshold.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "tidestar", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Z", "+00:00", "UTC+0"}


def require_utc(spark: SparkSession, what: str) -> None:
    """Fail where the session zone would change the meaning of stored times."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"{what} needs spark.sql.session.timeZone=UTC, not {zone}")


def pin_utc(spark: SparkSession) -> SparkSession:
    """Set the session zone to UTC, which timestamps on the wire and hash keys assume."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder path on the storage all executors share.

    The cluster names that storage in ``spark.checkpoint.dir``. Where it is unset, a machine-local
    folder serves a local session; on a cluster every executor would write to a disk of its own,
    so that is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to storage that all executors of {master} share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written to a scratch table and read back: computed once, and of a size that Catalyst knows."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
