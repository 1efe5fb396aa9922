"""Structured Streaming runners (T1-T5), running values per row, state taken on."""

from keyfold.streaming.running import read_running, running_sink, start_running_stream  # noqa: F401
from keyfold.streaming.state import carrying, state_partitions, state_totals  # noqa: F401
from keyfold.streaming.upsert import (  # noqa: F401
    start_upsert_stream, run_report_stream, use_rocksdb_state,
)
