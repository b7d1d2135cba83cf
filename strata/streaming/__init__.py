from . import speed
from .runner import run_streaming_job, run_to_end, start, start_speed_views
from .sinks import ChangelogSink, compact, read_latest

__all__ = ["speed", "run_streaming_job", "run_to_end", "start", "start_speed_views", "ChangelogSink",
           "compact", "read_latest"]
