from tidestar.functions.checked import conform_checked, good_rows, parse_checked, rejects, unwrap_checked
from tidestar.functions.decode import (
    conform,
    decimals_as_double,
    decode_value,
    micros_to_ts,
    parse_json,
    record_key,
    rename,
    split_bad,
    unwrap_cdc,
)
from tidestar.functions.derive import (
    component_total,
    datetime_hash,
    datetime_parts,
    flag_when,
    insert_select,
    pg_element,
    interval_text,
    pg_char_cast,
    pg_numeric_cast,
    pg_int_cast,
    series,
    shift_time,
    total_mismatch,
    trip_dates,
    with_datetime_hash,
)

__all__ = [
    "component_total",
    "conform",
    "conform_checked",
    "datetime_hash",
    "datetime_parts",
    "decimals_as_double",
    "decode_value",
    "flag_when",
    "good_rows",
    "insert_select",
    "micros_to_ts",
    "parse_json",
    "parse_checked",
    "pg_element",
    "interval_text",
    "pg_char_cast",
    "pg_numeric_cast",
    "pg_int_cast",
    "record_key",
    "rejects",
    "rename",
    "series",
    "shift_time",
    "split_bad",
    "total_mismatch",
    "trip_dates",
    "unwrap_cdc",
    "unwrap_checked",
    "with_datetime_hash",
]
