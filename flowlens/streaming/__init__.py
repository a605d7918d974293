from .bounded import BoundedInput, before_end, run_for, run_to_end
from .jobs import (hot_url_reports_writer, late_rows_writer, running_visitors_writer,
                   stream_ad_clicks,
                   stream_ad_clicks_by_province, stream_hot_items, stream_hot_url_reports, stream_hot_urls,
                   stream_login_bursts, stream_login_pattern, stream_marketing_by_channel,
                   stream_marketing_total, stream_page_view_partials, stream_page_views,
                   stream_page_views_salted, stream_running_bitmap,
                   stream_running_unique_visitors, stream_running_visitors,
                   stream_unique_visitors, stream_unique_visitors_bitmap,
                   stream_url_counts_updates, stream_windowed_count, top_n_writer)
from .processors import (FailureBurstProcessor, FrequencyCapProcessor, RunningVisitorsProcessor,
                         SequenceMatchProcessor, TopNReportProcessor)
from .ring import PaneRingProcessor, above_watermark, ring_counts

__all__ = [n for n in dir() if not n.startswith("_")]
