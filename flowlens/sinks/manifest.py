"""K4/K5 with an atomic commit: tables whose readers follow a manifest.

A micro-batch writes its rows into folders of its own and then puts one small
manifest file in place by a rename.  Readers see the folders that manifests
name and nothing else, so a batch is visible whole (all its labelled outputs
together) or not at all; a replayed batch writes new folders and replaces its
manifest.

``ManifestTable(path).commit(batch_id, {label: rows}, windows={label: column})``
writes a batch; a label with a window column is upserted (K4): a window's rows
are those of the last batch that wrote it.  Labels without one are appended.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MANIFEST = "batch long, label string, folder string, windowed string"


class ManifestTable:
    """Labelled outputs under ``path``: data folders and manifests."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._jvm = spark.sparkContext._jvm
        root = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def commit(self, batch_id: int, outputs: dict[str, DataFrame],
               windows: dict[str, str] | None = None) -> None:
        """Writes every output of the batch, then its manifest.  A failure
        before the rename leaves folders that no reader looks at."""
        entries = []
        for label, rows in outputs.items():
            folder = f"data/{label}/{batch_id}-{uuid.uuid4().hex}"
            rows.write.parquet(f"{self.path}/{folder}")
            entries.append({"batch": batch_id, "label": label, "folder": folder,
                            "windowed": (windows or {}).get(label)})
        self._swap(f"{batch_id}.json", "\n".join(json.dumps(e) for e in entries))

    def _swap(self, name: str, text: str) -> None:
        """Puts a manifest in place: written beside, then renamed over."""
        fs, jvm = self._fs, self._jvm
        fs.mkdirs(self._path("manifests"))
        draft = self._path("drafts", f"{name}-{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        option = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = self.spark.sparkContext._gateway.new_array(
            jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = option
        context.rename(draft, self._path("manifests", name), options)

    def manifests(self) -> DataFrame:
        """(batch, label, folder, windowed) of all committed batches."""
        if not self._fs.exists(self._path("manifests")):
            return self.spark.createDataFrame([], _MANIFEST)
        return self.spark.read.schema(_MANIFEST).json(f"{self.path}/manifests")

    def read(self, label: str, schema: T.StructType | str) -> DataFrame:
        """Committed rows of a label.  One folder name per committed batch
        reaches the driver, as a file listing would."""
        known = self.manifests().where(F.col("label") == label).collect()
        if not known:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*[f"{self.path}/{r['folder']}" for r in known])
        window = known[0]["windowed"]
        if window is None:
            return rows
        # the last batch that wrote a window holds it
        batch = F.regexp_extract(F.col("_metadata.file_path"), f"/{label}/(\\d+)-[0-9a-f]+/", 1)
        rows = rows.withColumn("_batch", batch.cast("long"))
        last = rows.groupBy(window).agg(F.max("_batch").alias("_batch"))
        cond = rows[window].eqNullSafe(last[window]) & (rows["_batch"] == last["_batch"])
        return rows.join(last, cond, "left_semi").drop("_batch")


def commit_tagged(table: ManifestTable, tag_col: str, tags: list[str],
                  windows: dict[str, str] | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: the parts of a tagged stream, committed together."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            table.commit(batch_id, {t: batch.filter(F.col(tag_col) == t).drop(tag_col) for t in tags},
                         windows)
        finally:
            batch.unpersist()
    return write


def commit_by_window(table: ManifestTable, label: str, window_col: str = "window_end"
                     ) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: K4, the rows of every window in the batch replace
    earlier ones."""
    def write(batch: DataFrame, batch_id: int) -> None:
        table.commit(batch_id, {label: batch}, {label: window_col})
    return write
