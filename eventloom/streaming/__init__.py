from eventloom.streaming.live import read_live, run_live, stream_facts, stream_hourly_counts, stream_repos

__all__ = ["read_live", "run_live", "stream_facts", "stream_hourly_counts", "stream_repos"]
