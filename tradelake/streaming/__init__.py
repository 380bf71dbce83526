"""Streaming lane."""

from tradelake.functions.parse import assign_event_time
from tradelake.streaming.events import (
    LateRows,
    drop_redelivered,
    start_all,
    upsert_to_table,
    windowed_notional,
    with_watermark,
    write_dead_letters,
    write_metrics,
    write_parsed,
    write_raw,
)

__all__ = [
    "LateRows", "assign_event_time", "drop_redelivered", "start_all",
    "upsert_to_table", "windowed_notional", "with_watermark", "write_dead_letters",
    "write_metrics", "write_parsed", "write_raw",
]
