from .manifest import ManifestTable, commit_by_window, commit_tagged
from .sinks import fan_out, publish_lines, upsert_by_window, write_stream

__all__ = ["ManifestTable", "commit_by_window", "commit_tagged", "fan_out", "publish_lines",
           "upsert_by_window", "write_stream"]
