"""text/CSV/JSON sources of the reference jobs, batch or stream.

Parsing is positional ``split`` + ANSI ``cast`` (a bad number fails the job,
as ``.toLong`` does); event time is attached as an instant column ``ts``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.time import event_time, ntz_to_instant

# Fixed value: the access-log time layout (field 3 of a space-split line).
ACCESS_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"


def _reader(spark: SparkSession, streaming: bool):
    return spark.readStream if streaming else spark.read


def read_lines(spark: SparkSession, path: str, streaming: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    r = _reader(spark, streaming).format("text")
    if streaming and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def _csv(spark, path, schema, streaming, max_files_per_trigger=None) -> DataFrame:
    r = _reader(spark, streaming).schema(schema).option("mode", "FAILFAST")
    if streaming and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(path)


def _with_ts(df: DataFrame, col: str, unit: str) -> DataFrame:
    return df.withColumn("ts", event_time(df, col, unit))


def parse_behavior_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """P1 for UserBehavior lines 'user,item,category,behavior,epoch_s'."""
    parts = F.split(F.col(value_col), ",")
    df = lines.select(
        parts[0].cast("long").alias("user_id"),
        parts[1].cast("long").alias("item_id"),
        parts[2].cast("int").alias("category_id"),
        parts[3].alias("behavior"),
        parts[4].cast("long").alias("ts_s"),
    )
    return _with_ts(df, "ts_s", "s")


def read_behavior(spark: SparkSession, path: str, streaming: bool = False,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """UserBehavior CSV files."""
    return _with_ts(_csv(spark, path, schemas.BEHAVIOR, streaming, max_files_per_trigger),
                    "ts_s", "s")


def parse_access_log(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """S3: space-split access log; fields 0 ip, 2 user, 3 time, 5 method, 6 url."""
    parts = F.split(F.col(value_col), " ")
    return lines.select(
        parts[0].alias("ip"),
        parts[2].alias("user_id"),
        ntz_to_instant(F.to_timestamp_ntz(parts[3], F.lit(ACCESS_TIME_FORMAT))).alias("ts"),
        parts[5].alias("method"),
        parts[6].alias("url"),
    )


def read_ad_clicks(spark: SparkSession, path: str, streaming: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """AdClickEvent CSV."""
    return _with_ts(_csv(spark, path, schemas.AD_CLICK, streaming, max_files_per_trigger),
                    "ts_s", "s")


def read_logins(spark: SparkSession, path: str, streaming: bool = False,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """LoginEvent CSV."""
    return _with_ts(_csv(spark, path, schemas.LOGIN, streaming, max_files_per_trigger),
                    "ts_s", "s")


def _parsed(lines: DataFrame, value_col: str, parse, schema, unit: str) -> DataFrame:
    row = parse(F.col(value_col), schema.simpleString(), {"mode": "FAILFAST"}).alias("row")
    return _with_ts(lines.select(row).select("row.*"), f"ts_{unit}", unit)


def parse_ad_click_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """S4 from lines 'user,ad,province,city,epoch_s' (fields may be quoted)."""
    return _parsed(lines, value_col, F.from_csv, schemas.AD_CLICK, "s")


def parse_login_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """S5 from lines 'user,ip,event_type,epoch_s' (fields may be quoted)."""
    return _parsed(lines, value_col, F.from_csv, schemas.LOGIN, "s")


def parse_marketing_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """S6 from one JSON object a line."""
    return _parsed(lines, value_col, F.from_json, schemas.MARKETING, "ms")


def read_marketing(spark: SparkSession, path: str, streaming: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """MarketUserBehavior records as JSON lines (epoch ms)."""
    r = _reader(spark, streaming).schema(schemas.MARKETING).option("mode", "FAILFAST")
    if streaming and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return _with_ts(r.json(path), "ts_ms", "ms")
