"""Per-key ordered state for the streaming forms of B1, C3, C4, N2 and A10, as
``transformWithState`` processors.

The cap (B1, row API) counts rows as they arrive, those of one micro-batch in
(event time, arrival) order.  The others take Arrow batches.  The login
processors (C3, C4) hold rows back until the watermark passes them and then
take them in (event time, arrival) order, so their results do not depend on the
micro-batch boundaries.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.frequency import WARNING_TEMPLATE
from ..operators.sequences import BURST_MESSAGE, MATCH_MESSAGE, _duration_text

DAY_MS = 86_400_000
EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def _us(ts: dt.datetime) -> int:
    """datetime (aware or naive-UTC) -> epoch microseconds."""
    if ts.tzinfo is None:
        ts = ts.replace(tzinfo=dt.timezone.utc)
    return (ts - EPOCH) // dt.timedelta(microseconds=1)


def _sorted(rows: Iterator[Row], ts: str, arrival: str) -> list[Row]:
    return sorted(rows, key=lambda r: (r[ts], r[arrival]))


class FrequencyCapProcessor(StatefulProcessor):
    """B1 keyed by (user, ad): rows 1..N of a day pass, row N+1 emits the one
    warning, later rows are dropped.  ``day='event'`` counts per UTC event day,
    so rows of two days may interleave; a day is forgotten when the watermark
    passes its midnight (later rows of it are dropped as late).  ``'none'``
    counts over all days, ``'processing'`` until the next midnight of the wall
    clock plus ``clock_offset_ms`` (Z6; an offset is for tests).

    Output rows are tagged: kind='pass' (the input row) or kind='warn'.
    """

    OUTPUT = ("kind string, user_id long, ad_id string, province string, ts timestamp, "
              "event_id long, msg string")

    def __init__(self, max_count: int = 100, day: str = "event", clock_offset_ms: int = 0):
        if day not in ("event", "none", "processing"):
            raise ValueError("day must be 'event', 'none' or 'processing'")
        self.max_count = max_count
        self.day = day
        self.clock_offset_ms = clock_offset_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", "day long", "count long, sent boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        msg = f"{WARNING_TEMPLATE[0]}{self.max_count}{WARNING_TEMPLATE[1]}"
        if self.day == "processing" and not self.days.exists():
            now = timerValues.getCurrentProcessingTimeInMs() + self.clock_offset_ms
            self.handle.registerTimer((now // DAY_MS + 1) * DAY_MS - self.clock_offset_ms)
        seen: dict[int, tuple[int, bool]] = {}
        for r in _sorted(rows, "ts", "event_id"):
            d = _us(r["ts"]) // (DAY_MS * 1000) if self.day == "event" else 0
            if d not in seen:
                known = self.days.containsKey((d,))
                seen[d] = tuple(self.days.getValue((d,))) if known else (0, False)
                if self.day == "event" and not known:
                    self.handle.registerTimer((d + 1) * DAY_MS)
            count, sent = seen[d]
            out = dict(user_id=r["user_id"], ad_id=str(r["ad_id"]), province=r["province"],
                       ts=r["ts"], event_id=r["event_id"])
            if count < self.max_count:
                seen[d] = (count + 1, sent)
                yield Row(kind="pass", **out, msg=None)
            elif not sent:
                seen[d] = (count, True)
                yield Row(kind="warn", **out, msg=msg)
        for d, state in seen.items():
            self.days.updateValue((d,), state)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.day == "event":
            over = expiredTimerInfo.getExpiryTimeInMs() // DAY_MS - 1
            if self.days.containsKey((over,)):
                self.days.removeKey((over,))
        else:
            self.days.clear()
        return iter([])

    def close(self) -> None:
        pass


def _instants(us) -> pd.DatetimeIndex:
    return pd.to_datetime(np.asarray(us, np.int64), unit="us", utc=True)


class _InOrderProcessor(StatefulProcessor):
    """Rows wait until the watermark passes them; ``release`` gets them as
    arrays in (event time, arrival) order.

    Waiting rows lie in a map from (time slot, entry number, first time) to
    arrays; every micro-batch adds entries and rewrites none, and a timer reads
    only entries whose first row the watermark has passed.  One timer per key,
    at the earliest time at which there is something to do.  Input columns:
    us (epoch microseconds), event_id, is_fail."""

    ROWS = "us array<long>, id array<long>, fail array<boolean>"

    def __init__(self, within_ms: int = 2000):
        self.within_us = within_ms * 1000
        self.slot_us = max(8 * self.within_us, 60_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "slot long, entry long, first long", self.ROWS)
        self.mark = handle.getValueState("mark", "timer long, entries long")

    def _hold(self, us, ids, fail, entries: int) -> int:
        slots = us // self.slot_us
        for slot in np.unique(slots).tolist():
            own = slots == slot
            self.held.updateValue((slot, entries, int(us[own].min())),
                                  (us[own].tolist(), ids[own].tolist(), fail[own].tolist()))
            entries += 1
        return entries

    def _marks(self) -> tuple[int, int]:
        return self.mark.get() if self.mark.exists() else (-1, 0)

    def _wake(self, at_us: int, armed: int) -> int:
        """Arms the timer unless it is armed earlier; -1: none is."""
        at = -(-at_us // 1000)
        if 0 <= armed <= at:
            return armed
        if armed >= 0:
            self.handle.deleteTimer(armed)
        self.handle.registerTimer(at)
        return at

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        armed, entries = self._marks()
        for pdf in rows:
            us = pdf["us"].to_numpy(np.int64)
            entries = self._hold(us, pdf["event_id"].to_numpy(np.int64),
                                 pdf["is_fail"].to_numpy(bool), entries)
            armed = self._wake(int(us.min()), armed)
        self.mark.update((armed, entries))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        _, entries = self._marks()
        waiting = list(self.held.keys())
        due = sorted(k for k in waiting if k[2] <= passed)
        parts = []
        for k in due:
            parts.append([np.array(c) for c in self.held.getValue(k)])
            self.held.removeKey(k)
        us, ids, fail = (np.concatenate(c) for c in zip(*parts)) if parts else (
            np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
        ready = us <= passed
        later = [k[2] for k in waiting if k[2] > passed]
        if not ready.all():
            entries = self._hold(us[~ready], ids[~ready], fail[~ready], entries)
            later.append(int(us[~ready].min()))
        us, ids, fail = us[ready], ids[ready], fail[ready]
        order = np.lexsort((ids, us))
        out, wake = self.release(key, us[order], ids[order], fail[order], passed)
        later += [wake] if wake is not None else []
        if later:
            self.mark.update((self._wake(min(later), -1), entries))
        else:
            self.mark.clear()
        if len(out):
            yield out

    def close(self) -> None:
        pass


class FailureBurstProcessor(_InOrderProcessor):
    """The first fail opens a burst; fails within the closed interval join
    it; a success in it cancels it; it is reported, if it holds min_fails
    fails, when a later row or the watermark passes its end."""

    OUTPUT = "user_id long, first_fail timestamp, last_fail timestamp, n_fails long, msg string"

    def __init__(self, within_ms: int = 2000, min_fails: int = 2):
        super().__init__(within_ms)
        self.min_fails = min_fails

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.burst = handle.getValueState("burst", "head long, last long, n long")

    def release(self, key, us, ids, fail, passed) -> tuple[pd.DataFrame, int | None]:
        head, last, n = self.burst.get() if self.burst.exists() else (0, 0, 0)
        over = []
        for t, f in zip(us.tolist(), fail.tolist(), strict=True):
            if n and t > head + self.within_us:
                over.append((head, last, n))
                n = 0
            if not f:
                n = 0
            else:
                head, last, n = (head, t, n + 1) if n else (t, t, 1)
        # rows up to the watermark can no longer arrive
        if n and head + self.within_us <= passed:
            over.append((head, last, n))
            n = 0
        if n:
            self.burst.update((head, last, n))
        else:
            self.burst.clear()
        return self._reports(key, over), head + self.within_us if n else None

    def _reports(self, key, bursts) -> pd.DataFrame:
        bursts = [b for b in bursts if b[2] >= self.min_fails]
        a, b, c = BURST_MESSAGE
        return pd.DataFrame({
            "user_id": [key[0]] * len(bursts), "first_fail": _instants([x[0] for x in bursts]),
            "last_fail": _instants([x[1] for x in bursts]), "n_fails": [x[2] for x in bursts],
            "msg": [f"{a}{_duration_text(self.within_us)}{b}{x[2]}{c}" for x in bursts]})


class SequenceMatchProcessor(_InOrderProcessor):
    """C4: ``steps`` consecutive fails, the last less than w after the first.
    The last steps - 1 rows of the key are kept while a match can still begin
    with them."""

    OUTPUT = ("user_id long, first_fail timestamp, last_fail timestamp, "
              "first_arrival long, last_arrival long, msg string")

    def __init__(self, within_ms: int = 2000, steps: int = 2):
        super().__init__(within_ms)
        self.steps = steps

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.tail = handle.getValueState("tail", self.ROWS)

    def release(self, key, us, ids, fail, passed) -> tuple[pd.DataFrame, int | None]:
        if self.tail.exists():
            us, ids, fail = (np.concatenate((np.array(old, new.dtype), new)) for old, new in
                             zip(self.tail.get(), (us, ids, fail), strict=True))
        k = self.steps
        fails = np.concatenate(([0], np.cumsum(fail)))
        first = np.arange(max(0, len(us) - k + 1))  # the tail alone is shorter than a match
        last = first + k - 1
        hit = (fails[last + 1] - fails[first] == k) & (us[last] - us[first] < self.within_us)
        first, last = first[hit], last[hit]
        keep = np.arange(len(us)) > len(us) - k
        alive = keep & (us > passed - self.within_us)  # a later row is after the watermark
        if alive.any():
            self.tail.update((us[alive].tolist(), ids[alive].tolist(), fail[alive].tolist()))
        else:
            self.tail.clear()
        out = pd.DataFrame({
            "user_id": [key[0]] * len(first), "first_fail": _instants(us[first]),
            "last_fail": _instants(us[last]), "first_arrival": ids[first],
            "last_arrival": ids[last], "msg": [MATCH_MESSAGE] * len(first)})
        wake = int(us[alive].min()) + self.within_us if alive.any() else None  # forget it then
        return out, wake


class TopNReportProcessor(StatefulProcessor):
    """N2 keyed by window end: the n largest counts of a window, reported by a
    timer that every update arms again, and forgotten by a second timer once
    the lateness has passed.

    Counts of a window only grow, so the n largest are kept in order and no
    other key of the window is held.  Input columns: key, cnt, phase (0: fired
    on time, 1: after a late row).  First reports carry report = 1."""

    OUTPUT = "window_end timestamp, report long, rank int, {key} string, cnt long"

    def __init__(self, n: int, key: str, lateness_ms: int):
        self.n, self.key, self.lateness_ms = n, key, lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.top = handle.getValueState("top", "keys array<string>, counts array<long>, report long")

    def _merge(self, top: dict[str, int], pdf: pd.DataFrame) -> dict[str, int]:
        for k, c in zip(pdf["name"], pdf["cnt"], strict=True):
            top[k] = max(int(c), top.get(k, 0))
        return dict(sorted(top.items(), key=lambda e: (-e[1], e[0]))[:self.n])

    def _report(self, end_us: int, top: dict[str, int], report: int) -> pd.DataFrame:
        return pd.DataFrame({"window_end": _instants([end_us] * len(top)), "report": report,
                             "rank": np.arange(1, len(top) + 1, dtype=np.int32),
                             self.key: list(top), "cnt": list(top.values())})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))
        known = self.top.exists()
        keys, counts, report = self.top.get() if known else ([], [], 0)
        top = dict(zip(keys, counts, strict=True))
        end_ms = -(-key[0] // 1000)
        if not known:
            self.handle.registerTimer(end_ms + self.lateness_ms)
        late = new[new["phase"] > 0]
        top = self._merge(top, new[new["phase"] == 0])
        if len(late):
            if len(late) < len(new):  # the report that was due before the late rows
                report += 1
                yield self._report(key[0], top, report)
            top = self._merge(top, late)
        self.handle.registerTimer(end_ms + 1)
        self.top.update((list(top), list(top.values()), report))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        if not self.top.exists():
            return
        if at >= -(-key[0] // 1000) + self.lateness_ms:
            self.top.clear()
            return
        keys, counts, report = self.top.get()
        self.top.update((keys, counts, report + 1))
        yield self._report(key[0], dict(zip(keys, counts, strict=True)), report + 1)

    def close(self) -> None:
        pass


class RunningVisitorsProcessor(StatefulProcessor):
    """A10 keyed by window end: a row for every arrival with the number of
    different visitors so far.  Visitors are bits of a map of pages; a batch
    loads the pages it touches once.  A timer at the window end clears it; rows
    of a closed window are dropped.  Input columns: bit, arrival, user_id."""

    PAGE_BITS = 32_768
    OUTPUT = "window_end timestamp, arrival long, user_id long, uv_so_far long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pages = handle.getMapState("pages", "page long", "bits binary")
        self.seen = handle.getValueState("seen", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        end_ms = -(-key[0] // 1000)
        if end_ms - 1 <= timerValues.getCurrentWatermarkInMs():
            return
        if not self.seen.exists():
            self.handle.registerTimer(end_ms - 1)
        n = self.seen.get()[0] if self.seen.exists() else 0
        pdf = pd.concat(list(rows)).sort_values("arrival", kind="stable")
        bit = pdf["bit"].to_numpy(np.int64)
        different, first = np.unique(bit, return_index=True)
        page = different // self.PAGE_BITS
        fresh = np.zeros(len(bit), np.int64)
        for p in np.unique(page).tolist():
            own = page == p
            at = different[own] % self.PAGE_BITS
            known = self.pages.containsKey((p,))
            bits = np.frombuffer(self.pages.getValue((p,))[0], np.uint8).copy() if known else \
                np.zeros(self.PAGE_BITS // 8, np.uint8)
            unset = bits[at // 8] >> (at % 8).astype(np.uint8) & 1 == 0
            fresh[first[own][unset]] = 1
            np.bitwise_or.at(bits, at // 8, (1 << at % 8).astype(np.uint8))
            self.pages.updateValue((p,), (bits.tobytes(),))
        uv = n + np.cumsum(fresh)
        self.seen.update((int(uv[-1]),))
        yield pd.DataFrame({"window_end": _instants([key[0]] * len(bit)),
                            "arrival": pdf["arrival"].to_numpy(), "user_id": pdf["user_id"].to_numpy(),
                            "uv_so_far": uv})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.pages.clear()
        self.seen.clear()
        return iter([])

    def close(self) -> None:
        pass
