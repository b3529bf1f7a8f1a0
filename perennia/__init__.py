"""Event-based customer value analytics as Spark DataFrame jobs."""

from perennia.operators.dispositions import event_dispositions, rejects
from perennia.operators.fold import Entities, entities, fold
from perennia.operators.rank import dense_rank_x, top_x
from perennia.plans.ingest import ingest, ingest_files, stored_entities
from perennia.plans.ltv import ltv, ltv_timeframe, result_columns
from perennia.plans.ltv_sql import ltv_sql
from perennia.plans.ltv_touch import touch_ltv
from perennia.session import configure, local_session
from perennia.sources.array_scan import read_event_arrays
from perennia.sources.event_log import read_event_log, union_logs, write_event_log
from perennia.sources.json_events import read_event_lines, read_events, stream_events

__all__ = [
    "Entities",
    "configure",
    "dense_rank_x",
    "entities",
    "event_dispositions",
    "fold",
    "ingest",
    "ingest_files",
    "local_session",
    "ltv",
    "ltv_sql",
    "ltv_timeframe",
    "read_event_arrays",
    "read_event_lines",
    "read_event_log",
    "read_events",
    "rejects",
    "result_columns",
    "stored_entities",
    "stream_events",
    "top_x",
    "touch_ltv",
    "union_logs",
    "write_event_log",
]
