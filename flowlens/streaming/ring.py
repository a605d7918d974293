"""Sliding-window counts from pane counts held per key (W2, W3, L1 in streams).

``F.window`` copies every row into size / slide windows.  Here a key's state is
its panes, one slide long each, with their counts; a window's count is the sum
over the panes it spans.  Windows leave when an event-time timer passes their
end, so no row is copied and the state of a key is bounded by the panes that
open windows span.

With ``lateness`` a window stays open for that long after it fired: a later row
fires it again with the accumulated count.  Results of the first firing have
``phase`` 0, of later ones 1.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.time import duration_us


def fired_windows(panes: np.ndarray, counts: np.ndarray, n: int, lo: int, hi: int
                  ) -> tuple[np.ndarray, np.ndarray]:
    """(window-end numbers k, counts) of the non-empty windows with
    lo < k <= hi; window k spans panes k - n .. k - 1."""
    at = np.concatenate((panes + 1, panes + n + 1))
    edge, place = np.unique(at, return_inverse=True)
    step = np.zeros(len(edge), np.int64)
    np.add.at(step, place, np.concatenate((counts, -counts)))
    level = np.cumsum(step)
    begin = np.maximum(edge[:-1], lo + 1)
    size = np.maximum(np.minimum(edge[1:], hi + 1) - begin, 0) * (level[:-1] > 0)
    first = np.cumsum(size) - size
    k = np.repeat(begin - first, size) + np.arange(int(size.sum()))
    return k, np.repeat(level[:-1], size)


class PaneRingProcessor(StatefulProcessor):
    """State of a key: its panes with counts, the last window-end number that
    fired, and the armed timer.  Input rows: ``us`` (epoch microseconds) and
    ``n`` (how many rows it stands for; 0: none).

    ``final``: rows are pane counts that an aggregate releases once the
    watermark passed them, so they belong to windows due in the same batch."""

    STATE = "panes array<long>, counts array<long>, fired long, timer long"

    def __init__(self, keys: Sequence[str], size_us: int, slide_us: int, lateness_ms: int = 0,
                 us: str = "pane_us", n: str = "pane_n", clock: str | None = None, final: bool = False):
        self.keys, self.us, self.n, self.clock = list(keys), us, n, clock
        self.slide_us, self.panes = slide_us, size_us // slide_us
        self.lateness_ms, self.final = lateness_ms, final

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getValueState("ring", self.STATE)

    def _due(self, watermark_ms: int) -> int:
        """Last window-end number whose final instant the watermark passed."""
        return (watermark_ms + 1) * 1000 // self.slide_us

    def _load(self, due: int):
        if not self.ring.exists():
            return np.zeros(0, np.int64), np.zeros(0, np.int64), due, None
        panes, counts, fired, timer = self.ring.get()
        return np.array(panes, np.int64), np.array(counts, np.int64), fired, timer

    def _store(self, panes, counts, fired: int, timer: int | None, closed: int) -> None:
        alive = panes + self.panes > closed  # some window of it is open
        panes, counts = panes[alive], counts[alive]
        if not len(panes):
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.ring.clear()
            return
        open_ends = np.maximum(panes + 1, fired + 1)[panes + self.panes > fired]
        if len(open_ends):  # the next window to fire
            at = -(-int(open_ends.min()) * self.slide_us // 1000) - 1
        else:  # all have fired: the first pane to forget
            at = -(-int(panes.min() + self.panes) * self.slide_us // 1000) - 1 + self.lateness_ms
        if at != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(at)
        self.ring.update((panes.tolist(), counts.tolist(), int(fired), at))

    def _rows(self, key, k: np.ndarray, counts: np.ndarray, phase: int, watermark: int) -> pd.DataFrame:
        end = k * self.slide_us
        out = {name: [value] * len(k) for name, value in zip(self.keys, key, strict=True)}
        out["window_start"] = pd.to_datetime(end - self.panes * self.slide_us, unit="us", utc=True)
        out["window_end"] = pd.to_datetime(end, unit="us", utc=True)
        out["cnt"] = counts
        out["phase"] = np.full(len(k), phase, np.int32)
        if self.clock:  # never behind the watermark, as rows that a chain passes on must be
            out[self.clock] = pd.to_datetime(
                np.maximum(end // 1000 + self.lateness_ms, watermark + 1), unit="ms", utc=True)
        return pd.DataFrame(out)

    def _fire(self, key, state, watermark: int):
        panes, counts, fired, timer = state
        due = self._due(watermark)
        if due > fired and len(panes):
            k, c = fired_windows(panes, counts, self.panes, fired, due)
            if len(k):
                yield self._rows(key, k, c, 0, watermark)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        due, closed = self._due(watermark), self._due(watermark - self.lateness_ms)
        panes, counts, fired, timer = state = self._load(due)
        if not self.final:  # what was due before these rows
            yield from self._fire(key, state, watermark)
            fired = max(fired, due)
        fresh, fresh_n = self._panes_of(rows, -1 if self.final else closed)
        if self.final and not len(panes):
            fired = int(fresh.min(initial=due))
        all_panes, place = np.unique(np.concatenate((panes, fresh)), return_inverse=True)
        all_counts = np.zeros(len(all_panes), np.int64)
        np.add.at(all_counts, place, np.concatenate((counts, fresh_n)))
        if self.final:
            yield from self._fire(key, (all_panes, all_counts, fired, timer), watermark)
            fired = closed = max(fired, due)
        elif len(fresh):  # windows that fired already and are still open fire again
            own = np.unique(fresh)
            touched, _ = fired_windows(own, np.ones(len(own), np.int64), self.panes, closed, fired)
            if len(touched):
                k, c = fired_windows(all_panes, all_counts, self.panes, closed, fired)
                again = np.isin(k, touched)
                yield self._rows(key, k[again], c[again], 1, watermark)
        self._store(all_panes, all_counts, fired, timer, closed)

    def _panes_of(self, rows, closed: int) -> tuple[np.ndarray, np.ndarray]:
        """Pane and count of every row that some open window spans."""
        panes, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for pdf in rows:
            pdf = pdf[pdf[self.n] > 0]
            p = pdf[self.us].to_numpy(np.int64) // self.slide_us
            keep = p + self.panes > closed
            panes.append(p[keep])
            counts.append(pdf[self.n].to_numpy(np.int64)[keep])
        return np.concatenate(panes), np.concatenate(counts)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        if not self.ring.exists():
            return
        state = self._load(0)
        yield from self._fire(key, state, watermark)
        panes, counts, fired, _ = state
        self._store(panes, counts, max(fired, self._due(watermark)), None,
                    self._due(watermark - self.lateness_ms))

    def close(self) -> None:
        pass


def above_watermark(keep: Column, ts: str) -> Column:
    """``keep`` as a filter that stays above the watermark: it also names the
    event time, so the rows it drops still advance the watermark."""
    return F.coalesce(keep, F.lit(False)) | (F.col(ts) < F.lit("0001-01-01").cast("timestamp"))


def ring_counts(rows: DataFrame, keys: Sequence[str], size, slide, ts: str,
                weight: str | None = None, lateness="0 seconds", clock: str | None = None,
                event: str | None = None, final: bool = False) -> DataFrame:
    """Counts per (keys, sliding window) of a stream that has a watermark:
    keys, window_start, window_end, cnt, phase (and ``clock``, an event time
    for a further stateful operator).

    ``ts`` is the time counted by, ``event`` the event-time column if that is
    another one, ``weight`` a column of counts (default 1 per row); ``final``
    see the processor."""
    size_us, slide_us = duration_us(size), duration_us(slide)
    if size_us % slide_us:
        raise ValueError("the size must be a multiple of the slide")
    if final and duration_us(lateness):
        raise ValueError("final pane counts have no late rows")
    group = list(keys) or ["every_row"]  # pandas columns may not start with _
    x = rows if keys else rows.withColumn("every_row", F.lit(0))
    one = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    x = x.select(*group, event or ts, F.unix_micros(ts).alias("pane_us"), one.alias("pane_n"))
    stamp = [T.StructField(c, T.TimestampType()) for c in
             ("window_start", "window_end", *([clock] if clock else []))]
    schema = T.StructType([x.schema[k] for k in group] + stamp[:2] + [
        T.StructField("cnt", T.LongType()), T.StructField("phase", T.IntegerType())] + stamp[2:])
    out = x.groupBy(*group).transformWithStateInPandas(
        PaneRingProcessor(group, size_us, slide_us, duration_us(lateness) // 1000, clock=clock,
                          final=final),
        schema, "append", "EventTime", eventTimeColumnName=clock or "")
    return out if keys else out.drop("every_row")
