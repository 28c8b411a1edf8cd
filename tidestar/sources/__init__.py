from tidestar.sources.codes import code_list, payment_types, rate_codes
from tidestar.sources.files import append_load, jdbc_append, read_parquet, row_count
from tidestar.sources.ledger import LedgerTable
from tidestar.sources.topics import bootstrap, file_topic, include_tables, read_topic, route

__all__ = [
    "LedgerTable",
    "append_load",
    "bootstrap",
    "code_list",
    "file_topic",
    "include_tables",
    "jdbc_append",
    "payment_types",
    "rate_codes",
    "read_parquet",
    "read_topic",
    "route",
    "row_count",
]
