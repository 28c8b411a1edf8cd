from tidestar.operators.changes import (
    affected,
    apply_changes,
    delete_where_in,
    diff_changes,
    latest_per_key,
    live_rows,
    merge_insert,
    merge_into,
    rows_to_insert,
    update_where_in,
    where_in,
)
from tidestar.operators.digests import bucket_digests, diff_by_digest, differing_buckets
from tidestar.operators.enrich import enrich, orphans, star_join, unknown_codes
from tidestar.operators.gates import Gate, RulesViolated
from tidestar.operators.quality import (
    check_rules,
    dedup,
    duplicate_keys,
    fill,
    require_non_negative,
    require_not_null,
)
from tidestar.operators.sampling import pick_keys, sample_n
from tidestar.operators.star import build_dim, build_dim_datetime, build_fact, create_star, distinct_dim

__all__ = [
    "Gate",
    "RulesViolated",
    "affected",
    "apply_changes",
    "bucket_digests",
    "build_dim",
    "build_dim_datetime",
    "build_fact",
    "check_rules",
    "create_star",
    "dedup",
    "delete_where_in",
    "diff_by_digest",
    "diff_changes",
    "differing_buckets",
    "distinct_dim",
    "duplicate_keys",
    "enrich",
    "fill",
    "latest_per_key",
    "live_rows",
    "merge_insert",
    "merge_into",
    "orphans",
    "pick_keys",
    "require_non_negative",
    "require_not_null",
    "rows_to_insert",
    "sample_n",
    "star_join",
    "unknown_codes",
    "update_where_in",
    "where_in",
]
