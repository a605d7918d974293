"""The row filters of the reference jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The regex of the hot-URL job keeps URLs that do not end in
# "/css" or "/js" (a path segment, not an extension).  The extension form is
# what the job's comment describes; it is offered as an option.
STATIC_SEGMENT = r"/(css|js)$"
STATIC_EXTENSION = r"\.(css|js)$"


def behavior_is(col: str, value: str = "pv") -> Column:
    return F.col(col) == F.lit(value)


def behavior_is_not(col: str, value: str = "UNINSTALL") -> Column:
    return F.col(col) != F.lit(value)


def not_static(url_col: str, mode: str = "segment") -> Column:
    pattern = STATIC_SEGMENT if mode == "segment" else STATIC_EXTENSION
    return ~F.col(url_col).rlike(pattern)


def is_fail(col: str, value: str = "fail") -> Column:
    return F.col(col) == F.lit(value)
