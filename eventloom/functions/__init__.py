from eventloom.functions.calendar import day_names, hour_file_name
from eventloom.functions.columns import with_event_time, with_repo_columns

__all__ = ["day_names", "hour_file_name", "with_event_time", "with_repo_columns"]
