"""K1–K5: stream outputs.

* ``write_stream``      K1/K2 — console (the reference's print), memory (tests)
                        or parquet, one query per labelled output;
* ``fan_out``           K2/K5 — several labelled outputs of one tagged stream
                        written from one ``foreachBatch``;
* ``upsert_by_window``  K4 — keyed upsert of per-window results: each batch
                        overwrites only the window partitions it touches
                        (dynamic partition overwrite), so replays are idempotent;
* ``publish_lines``     K3 — a text column to a Kafka topic, written in
                        parallel by the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stream_checkpoint


def write_stream(df: DataFrame, name: str, output_mode: str = "append", fmt: str = "console",
                 path: str | None = None, trigger: dict | None = None,
                 checkpoint: str | None = None):
    w = df.writeStream.queryName(name).outputMode(output_mode).format(fmt)
    if fmt not in ("console", "memory"):
        w = w.option("checkpointLocation", checkpoint or stream_checkpoint(df.sparkSession, name))
        if path:
            w = w.option("path", path)
    elif fmt == "console":
        w = w.option("truncate", "false")
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def fan_out(df: DataFrame, tag_col: str, writers: dict[str, Callable[[DataFrame, int], None]],
            name: str, trigger: dict | None = None, checkpoint: str | None = None):
    """One streaming query; each micro-batch is split by ``tag_col`` and every
    part handed to its writer(batch_df, batch_id)."""
    def route(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read once for all tags
        try:
            for tag, write in writers.items():
                write(batch.filter(F.col(tag_col) == tag).drop(tag_col), batch_id)
        finally:
            batch.unpersist()
    w = (df.writeStream.queryName(name).foreachBatch(route)
           .option("checkpointLocation", checkpoint or stream_checkpoint(df.sparkSession, name)))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def upsert_by_window(path: str, window_col: str = "window_end"
                     ) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: replace the rows of every window present in the
    batch, keep all other windows."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.write.mode("overwrite").partitionBy(window_col)
              .option("partitionOverwriteMode", "dynamic").parquet(path))
    return write


def publish_lines(df: DataFrame, bootstrap: str, topic: str, value_col: str = "value") -> None:
    (df.select(F.col(value_col).cast("string").alias("value"))
       .write.format("kafka")
       .option("kafka.bootstrap.servers", bootstrap)
       .option("topic", topic)
       .save())
