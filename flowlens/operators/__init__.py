from .distinct import (approx_unique_visitors, bitmap_unique_visitors,
                       running_unique_visitors, unique_visitors)
from .filters import behavior_is, behavior_is_not, is_fail, not_static
from .frequency import frequency_cap
from .lateness import (final_count_runs, final_counts, late_corrections, split_late,
                       with_watermark)
from .scan import running_agg
from .sequences import failure_bursts, sequence_match
from .skew import salted_count, salted_partials, spread_key
from .topn import format_ranking, top_n, top_n_of_runs, top_n_per_window
from .windows import window_ends, windowed_count

__all__ = [n for n in dir() if not n.startswith("_")]
