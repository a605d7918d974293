"""Shared pieces of the training-data operators: words, Arrow batches, link
components and checkpoints."""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.session import checkpoint_dir

#: Documents handed to Python at once; long texts make larger batches heavy.
BATCH_ROWS = 256

#: Settings of the C library and of Arrow for Python workers.
_WORKER_MEMORY = {"MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "1048576",
                  "MALLOC_ARENA_MAX": "2", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the session's Arrow batch size, so that a batch of whole texts
    stays small next to an executor's memory, and let Python workers of a
    local session import this package from any working directory (on a
    cluster it is installed or shipped with ``--py-files``)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    # workers live on between stages: large arrays go back to the system when freed
    for name, value in _WORKER_MEMORY.items():
        env.setdefault(name, value)


def portions(texts: pa.Array, limit: int = 1 << 21):
    """(first row, texts) of rows that follow each other, about ``limit`` bytes
    together, so that what a task holds is bounded by bytes and not by rows; a
    longer text comes alone."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    lo, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > limit:
            yield lo, texts.slice(lo, i - lo).to_pylist()
            lo, held = i, 0
        held += n
    if lo < len(sizes):
        yield lo, texts.slice(lo).to_pylist()


def words(text: str | None) -> list[bytes]:
    """Maximal runs of bytes outside ASCII white space (``bytes.split`` splits
    at exactly \\x20 and \\x09-\\x0D)."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder (``spark.checkpoint.dir``)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
         for c, f in zip(columns, schema, strict=True)], schema=schema)


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """Connected components of ``edges`` (a long, b long): (node, component),
    component being the smallest node of the group; nodes without an edge to
    another node do not appear.

    Alternating large-star and small-star steps: every step joins each edge
    with the smallest neighbour of its node, taken by a partially aggregated
    minimum, so a hub is an ordinary skewed join key and no group is
    collected.  The edge set is checkpointed after each round.  The rounds end
    when every node's only link is to a node that is the larger end of none: a
    star per group.  They grow with the logarithm of the longest chain; a set
    that is not finished after ``max_rounds`` raises."""
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"),
                                     F.least("a", "b").alias("v")).distinct()
    e = cut(e)
    for _ in range(max_rounds):
        degrees = e.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        if degrees.where("n > 1").isEmpty() and e.select("v").join(
                degrees.select("u"), F.col("v") == F.col("u"), "left_semi").isEmpty():
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                e.select("v", "v")).distinct()
        both = e.union(e.select(F.col("v"), F.col("u"))).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u").alias("u"), F.col("m").alias("v")))))
                 .select("col.*").where("u <> v").distinct())
        e = cut(small)
    raise RuntimeError(f"components are not finished after {max_rounds} rounds")


class Forest:
    """Union-find over the few nodes of one block; ``join`` tells whether the
    link was new, so a block hands on a spanning forest, never all pairs."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = up.get(p, p)
            x = p
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.  The
    write's shuffle files go when it ends, so phases do not add up on disk."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    top = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    path = f"{top}/{name}-{uuid.uuid4().hex}"
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    if before is not None:
        spark.conf.set(key, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        if before is not None:
            spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)
