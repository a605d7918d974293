from .time import (duration_us, event_time, epoch_ms, epoch_s, floor_div,
                   java_timestamp_string, utc_string, from_epoch_us)
from .hashing import poly_hash
from .text import render_ranking

__all__ = ["duration_us", "event_time", "epoch_ms", "epoch_s", "floor_div",
           "java_timestamp_string", "utc_string", "from_epoch_us", "poly_hash",
           "render_ranking"]
