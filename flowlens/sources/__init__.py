from .files import (parse_access_log, parse_ad_click_lines, parse_behavior_lines,
                    parse_login_lines, parse_marketing_lines, read_ad_clicks, read_behavior,
                    read_lines, read_logins, read_marketing)
from .kafka import read_kafka_lines
from .tables import load_table

__all__ = ["parse_access_log", "parse_ad_click_lines", "parse_behavior_lines",
           "parse_login_lines", "parse_marketing_lines", "read_ad_clicks",
           "read_behavior", "read_lines", "read_logins", "read_marketing",
           "read_kafka_lines", "load_table"]
