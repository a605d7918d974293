"""Running (prefix) aggregates that stay parallel under skew.

A plain ``sum() over (partition by p order by o)`` puts a whole partition in
one task.  Here the ordered sequence of each partition is cut into blocks by a
column that grows with the order (an arrival-id bucket or a time bucket):

1. per (p, block) totals  — hash aggregate with map-side combine;
2. exclusive prefix of block totals per p — a window over the small block table;
3. in-block running aggregate — a window partitioned by (p, block);
4. offset joined back on (p, block) and combined.

Steps 3 and 4 share the (p, block) hash partitioning, so the big side is
shuffled once.  A hot partition is spread over its blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_COMBINE = {
    "sum": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + b),
    "max": (F.max, lambda a, b: F.greatest(a, b)),
}


def running_agg(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[Column],
                value: Column, out_col: str, block: Column, fn: str = "sum",
                inclusive: bool = True, outer_blocks: Sequence[Column] = ()) -> DataFrame:
    """Add ``out_col`` = fn(value) over rows up to the current one (or strictly
    before it when ``inclusive`` is False), in ``order_cols`` order within
    ``partition_cols``.  ``block`` must be non-decreasing in that order.

    ``outer_blocks`` (coarser, also non-decreasing) make the scan
    hierarchical: the block-offset table is itself prefix-scanned with the
    next coarser block, so neither level sorts a large partition in one task
    (fine blocks bound the row-level windows, coarse blocks bound the
    block-level ones)."""
    agg, _ = _COMBINE[fn]
    p = list(partition_cols)
    x = df.withColumn("_blk", block).withColumn("_val", value)
    for i, ob in enumerate(outer_blocks):
        x = x.withColumn(f"_ob{i}", ob)
    outer_names = [f"_ob{i}" for i in range(len(outer_blocks))]
    totals = x.groupBy(*p, "_blk", *outer_names).agg(agg("_val").alias("_tot"))
    if outer_names:
        level = totals.withColumnRenamed("_blk", "_fine").withColumnRenamed("_tot", "_ftot")
        offsets = running_agg(level, p, [F.col("_fine")], F.col("_ftot"), "_lvl_off",
                              block=F.col(outer_names[0]), fn=fn, inclusive=False,
                              outer_blocks=[F.col(n) for n in outer_names[1:]])
        offsets = offsets.select(*p, F.col("_fine").alias("_blk"), F.col("_lvl_off").alias("_off"))
    else:
        bw = Window.partitionBy(*p).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select(*p, "_blk", agg("_tot").over(bw).alias("_off"))
    frame_end = Window.currentRow if inclusive else -1
    iw = (Window.partitionBy(*p, "_blk").orderBy(*order_cols)
          .rowsBetween(Window.unboundedPreceding, frame_end))
    local = x.drop(*outer_names).withColumn("_loc", agg("_val").over(iw))
    joined = local.join(offsets, on=[*p, "_blk"], how="left")
    if fn == "sum":
        res = F.coalesce(F.col("_off"), F.lit(0)) + F.coalesce(F.col("_loc"), F.lit(0))
    else:
        res = F.greatest(F.col("_off"), F.col("_loc"))
    return joined.withColumn(out_col, res).drop("_blk", "_val", "_off", "_loc")
