"""Running a stream to its end, and for a bounded wait.

A bounded input closes all windows and event timers after its last file.
Spark's watermark stops at the last rows, so ``BoundedInput`` appends an end
marker of its own once the input is read: one row whose event time lies after
every timer and whose other columns are null.  Jobs count no null rows, so the
marker only moves the watermark; results of the marker itself are cut off by
``before_end``.

``run_for`` runs a query with a processing-time trigger until a condition holds
or the time is up: queries with processing-time timers are never idle, so
waiting for them to finish would not end.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from ..session import checkpoint_dir

#: Event time of the end marker: later than any real one, within the range of
#: nanosecond timestamps.
END = dt.datetime(2261, 1, 1, tzinfo=dt.timezone.utc)


class BoundedInput:
    """A folder of Parquet files read as a stream that ends."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, ts: str = "ts",
                 files_per_batch: int | None = None):
        self.spark, self.path, self.schema, self.ts = spark, path, schema, ts
        self.files_per_batch = files_per_batch
        self.home = f"{checkpoint_dir(spark)}/bounded-{uuid.uuid4().hex}"
        self.markers = f"{self.home}/end"
        spark.createDataFrame([], schema).write.parquet(f"{self.markers}/none")

    def _read(self, path: str) -> DataFrame:
        reader = self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true")
        if self.files_per_batch:
            reader = reader.option("maxFilesPerTrigger", self.files_per_batch)
        return reader.parquet(path)

    def stream(self) -> DataFrame:
        """The input, followed by the marker once ``finish`` was called.  Both
        come before the watermark, so there is one watermark for both."""
        return self._read(self.path).unionByName(self._read(self.markers))

    def finish(self) -> None:
        row = [F.lit(END).cast(f.dataType).alias(f.name) if f.name == self.ts
               else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        self.spark.range(1).select(*row).write.mode("overwrite").parquet(f"{self.markers}/marker")


def before_end(df: DataFrame, window_end: str = "window_end") -> DataFrame:
    """Results without those of the marker's own windows."""
    return df.filter(F.col(window_end) < F.lit(END))


def run_to_end(source: BoundedInput, start: Callable[[DataFrame], object]) -> None:
    """Reads all input, then closes every window and timer.  ``start(stream)``
    gives a configured ``DataStreamWriter`` with its own checkpoint location;
    it is started twice on that checkpoint, before and after the marker."""
    for last in (False, True):
        if last:
            source.finish()
        query = start(source.stream()).trigger(availableNow=True).start()
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()


def run_for(query: StreamingQuery, seconds: float, done: Callable[[], bool],
            step: float = 0.2) -> bool:
    """Waits until ``done()`` or for ``seconds``; whether it was done.  The
    query goes on; stop it when it is no longer needed."""
    until = time.monotonic() + seconds
    while time.monotonic() < until:
        if query.exception() is not None:
            raise query.exception()
        if done():
            return True
        time.sleep(step)
    return done()
