"""CSV lines from a Kafka topic (needs the spark-sql-kafka package on the
class path; the plan is only built when a source is requested)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import parse_behavior_lines


def read_kafka_lines(spark: SparkSession, bootstrap: str, topic: str,
                     starting_offsets: str = "latest", group_id: str | None = None,
                     streaming: bool = True) -> DataFrame:
    r = (spark.readStream if streaming else spark.read).format("kafka")
    r = (r.option("kafka.bootstrap.servers", bootstrap)
          .option("subscribe", topic)
          .option("startingOffsets", starting_offsets))
    if group_id:
        r = r.option("kafka.group.id", group_id)
    return r.load().select(F.col("value").cast("string").alias("value"))


def read_kafka_behavior(spark: SparkSession, bootstrap: str, topic: str,
                        starting_offsets: str = "latest") -> DataFrame:
    """The hot-items source: Kafka topic of UserBehavior CSV lines."""
    return parse_behavior_lines(read_kafka_lines(spark, bootstrap, topic, starting_offsets))
