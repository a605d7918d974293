"""Exact, parallel form of the C3 burst rule for segments longer than ``w``.

Inside a segment every event but possibly the last (a success) is a fail and
consecutive events are at most ``w`` apart.  Anchors form a chain: the first
event, then again and again the first event later than anchor + w.  An
anchor's burst holds the events up to anchor + w; with the success among them
it is cancelled.

Time is cut into nested blocks of ``w * fan``, ``w * fan**2``, … .  A chain
enters a block within its first 2w, so a block is summed up by a few hops
(entry -> entry of the next block), whichever entry the chain will take:

* upwards, hops of small blocks are joined into hops of larger ones;
* at the top one walk per segment is left (about 2 / fan**levels of its events);
* downwards, the entries taken in a large block give those of its small
  blocks, and at last the anchors and their bursts.

Every step is a grouped map over (segment, block), so a segment that holds a
third of all rows is spread over its blocks.  The plan is lazy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.time import floor_div

#: "The chain ends": no event has this time.
END = np.iinfo(np.int64).min


def _walk(hops: dict[int, int], at: int) -> Iterator[int]:
    while at in hops:
        yield at
        at = hops[at]


def chain_bursts(rows: DataFrame, seg: list[str], start: str, within_us: int, min_fails: int,
                 fan: int = 64, levels: int = 2) -> DataFrame:
    """rows: the columns of ``seg`` (``start`` among them, the time of the
    segment's first event), _us, _fail.  Returns seg + _head, _last, n_fails."""
    w = within_us
    spans = [w * fan ** (j + 1) for j in range(levels)]
    at_start = seg.index(start)
    fields = [rows.schema[c] for c in seg]

    def schema(*names: str) -> StructType:
        return StructType(fields + [StructField(n, LongType()) for n in names])

    def frame(key, **cols) -> pd.DataFrame:
        n = len(next(iter(cols.values())))
        named = {c: [key[i]] * n for i, c in enumerate(seg)}
        return pd.DataFrame({**named, **{c: np.asarray(v, np.int64) for c, v in cols.items()}})

    def blocks(df: DataFrame, span: int) -> DataFrame:
        return df.withColumn("_k", floor_div(F.col("_us"), span))

    def entry(us: np.ndarray, key, span: int) -> np.ndarray:
        return (us - key[len(seg)] * span < 2 * w) | (us == key[at_start])

    def first_hops(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        us = np.sort(p["_us"].to_numpy())
        own = int(np.searchsorted(us, (key[len(seg)] + 1) * spans[0]))
        to = np.append(np.searchsorted(us, us + w, "right"), len(us))
        while (inside := to < own).any():
            to[inside] = to[to[inside]]
        take = np.nonzero(entry(us[:own], key, spans[0]))[0]
        return frame(key, _us=us[take], _to=np.append(us, END)[to[take]])

    def joined_hops(span: int):
        def join(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
            far: dict[int, int] = {}
            p = p.sort_values("_us", ascending=False)
            for a, b in zip(p["_us"].tolist(), p["_to"].tolist(), strict=True):
                far[a] = far.get(b, b)
            us = np.array(list(far), np.int64)
            take = us[entry(us, key, span)]
            return frame(key, _us=take, _to=[far[a] for a in take.tolist()])
        return join

    def whole_walk(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        hops = dict(zip(p["_us"].tolist(), p["_to"].tolist(), strict=True))
        return frame(key, _us=list(_walk(hops, key[at_start])))

    def block_walk(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        seen = p.loc[p["_to"].isna(), "_us"]
        if not len(seen):
            return frame(key, _us=[])
        rest = p[p["_to"].notna()]
        hops = dict(zip(rest["_us"].tolist(), rest["_to"].astype("int64").tolist(), strict=True))
        return frame(key, _us=list(_walk(hops, int(seen.min()))))

    def anchor_bursts(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        seen = p.loc[p["_n"] == 0, "_us"]
        if not len(seen):
            return frame(key, _head=[], _last=[], n_fails=[])
        p = p[p["_n"] > 0].sort_values("_us")
        us = p["_us"].to_numpy()
        total = np.append(0, np.cumsum(p["_n"].to_numpy()))
        bad = np.append(0, np.cumsum(p["_bad"].to_numpy()))
        own = int(np.searchsorted(us, (key[len(seg)] + 1) * spans[0]))
        then = np.searchsorted(us, us + w, "right")
        i, out = int(np.searchsorted(us, int(seen.min()))), []
        while i < own:
            j = int(then[i])
            if bad[j] == bad[i] and total[j] - total[i] >= min_fails:
                out.append((us[i], us[j - 1], total[j] - total[i]))
            i = j
        head, last, n = zip(*out, strict=True) if out else ((), (), ())
        return frame(key, _head=head, _last=last, n_fails=n)

    times = blocks(rows.groupBy(*seg, "_us").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(~F.col("_fail")).alias("_bad")), spans[0])
    # the chain leaves a block to one of the next 2w
    halo = times.filter(F.col("_us") - F.col("_k") * spans[0] < 2 * w).withColumn(
        "_k", F.col("_k") - 1)
    pieces = times.unionByName(halo)
    # a halo alone, before the segment's first block, has no events of its own
    pieces = pieces.filter(F.col("_k") >= floor_div(F.col(start), spans[0]))
    hops = [pieces.groupBy(*seg, "_k").applyInPandas(first_hops, schema("_us", "_to"))]
    for span in spans[1:]:
        hops.append(blocks(hops[-1], span).groupBy(*seg, "_k").applyInPandas(
            joined_hops(span), schema("_us", "_to")))
    taken = hops[-1].groupBy(*seg).applyInPandas(whole_walk, schema("_us"))
    for span, below in zip(reversed(spans[1:]), reversed(hops[:-1]), strict=True):
        both = below.unionByName(taken.withColumn("_to", F.lit(None).cast("long")))
        taken = blocks(both, span).groupBy(*seg, "_k").applyInPandas(block_walk, schema("_us"))
    marks = blocks(taken, spans[0]).withColumn("_n", F.lit(0).cast("long")).withColumn(
        "_bad", F.lit(0).cast("long"))
    return pieces.unionByName(marks).groupBy(*seg, "_k").applyInPandas(
        anchor_bursts, schema("_head", "_last", "n_fails"))
