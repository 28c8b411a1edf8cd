"""The star in a catalog whose tables take row-level changes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tidestar import schemas
from tidestar.functions.decode import conform
from tidestar.functions.derive import with_datetime_hash
from tidestar.operators.changes import merge_into
from tidestar.operators.star import build_dim_datetime, create_star
from tidestar.plans.star import code_dimensions
from tidestar.plans.store import CODE_KEYS
from tidestar.session import require_utc


@dataclass(frozen=True)
class CatalogStar:
    """The star as tables of a database, loaded by MERGE for dimensions and append for the fact.

    The declared fact has no batch columns, so a batch that is replayed is
    appended again (at least once); ``StarStore`` loads it exactly once.
    """

    database: str
    source: str = "iceberg"
    null_safe: bool = True

    def create(self, spark: SparkSession) -> None:
        create_star(spark, self.database, source=self.source)

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {name: spark.table(f"{self.database}.{name}") for name in schemas.STAR_TABLES}

    def load(
        self, trips: DataFrame, run: str, batch_id: int, gated: tuple[DataFrame, Callable[[], object]] | None = None
    ) -> None:
        """Merge the dimensions of clean trips, then append their fact rows. ``gated`` is as in ``StarStore.load``."""
        require_utc(trips.sparkSession, "loading a star")
        first, check = gated or (trips, None)
        codes = first.select(*CODE_KEYS).distinct().persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if check:
                codes.count()
                check()
            dims = {"dim_datetime": build_dim_datetime(trips)} | code_dimensions(codes)
            for name, rows in dims.items():
                rows = conform(rows, schemas.STAR_TABLES[name])
                merge_into(rows, f"{self.database}.{name}", [schemas.DIM_KEYS[name]], self.null_safe, unique=True)
        finally:
            codes.unpersist()
        fact = conform(with_datetime_hash(trips), schemas.FACT_TRIPS)
        fact.writeTo(f"{self.database}.fact_trips").append()
