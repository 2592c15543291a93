from eventloom.sources.facts import create_fact_table, read_fact, read_jdbc, stored_fact
from eventloom.sources.fixture import activity_from_events, read_events_activity
from eventloom.sources.landed import hours_landed, index_files, read_index
from eventloom.sources.raw import (
    landed_files,
    missing_files,
    read_activity,
    read_latest_hours,
    read_listed,
    rejected_lines,
    stream_activity,
)

__all__ = [
    "activity_from_events",
    "read_events_activity",
    "create_fact_table",
    "hours_landed",
    "index_files",
    "landed_files",
    "missing_files",
    "read_activity",
    "read_fact",
    "read_index",
    "read_jdbc",
    "read_latest_hours",
    "read_listed",
    "rejected_lines",
    "stored_fact",
    "stream_activity",
]
