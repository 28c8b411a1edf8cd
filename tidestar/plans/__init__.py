from tidestar.plans.batch import run_batch
from tidestar.plans.bucketed import BucketedStar
from tidestar.plans.buckets import BucketedState
from tidestar.plans.catalog import CatalogStar
from tidestar.plans.digested import DigestedVersions
from tidestar.plans.feed import FeedTable
from tidestar.plans.replica import current_version, read_versioned, replica_changes, write_version
from tidestar.plans.star import clean_trips, gated_trips, payment_summary, star_tables
from tidestar.plans.store import StarStore

__all__ = [
    "BucketedStar",
    "BucketedState",
    "CatalogStar",
    "DigestedVersions",
    "FeedTable",
    "StarStore",
    "clean_trips",
    "current_version",
    "gated_trips",
    "payment_summary",
    "read_versioned",
    "replica_changes",
    "run_batch",
    "star_tables",
    "write_version",
]
