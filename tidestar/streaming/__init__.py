from tidestar.streaming.appends import append, append_star, read_routed, routed_sink, stream_append
from tidestar.streaming.handover import read_handover, start_handover, take_snapshot
from tidestar.streaming.latest import latest_rows, start_latest, state_rows
from tidestar.streaming.rejects import read_rejects, rejects_sink, stream_rejects
from tidestar.streaming.replica import merge_replica, read_replica, replica_sink
from tidestar.streaming.run import query_id, run
from tidestar.streaming.star import captured_state, decode_captured_trips, decode_trips, star_sink, start_star

__all__ = [
    "append",
    "append_star",
    "decode_captured_trips",
    "decode_trips",
    "latest_rows",
    "merge_replica",
    "query_id",
    "read_handover",
    "read_rejects",
    "read_replica",
    "read_routed",
    "rejects_sink",
    "replica_sink",
    "routed_sink",
    "run",
    "star_sink",
    "start_handover",
    "start_latest",
    "start_star",
    "state_rows",
    "stream_append",
    "stream_rejects",
    "take_snapshot",
]
