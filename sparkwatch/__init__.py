"""sparkwatch: security-event detection on Spark DataFrames, batch and streaming."""

from sparkwatch.session import scratch_path, session, written_table

__all__ = ["scratch_path", "session", "written_table"]
