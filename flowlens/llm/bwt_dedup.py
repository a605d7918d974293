"""Byte-substring duplicates by merging shard Burrows-Wheeler orders (operator 6).

Window runs are routed to shards by minimizers (``window_runs``), so equal
windows always meet in one shard and no merge across shards is left to do.  In
a shard the distinct runs (but for those of hot grams, see there) are cut into
blocks, and each block gets its Burrows-Wheeler transform.  The transforms are
merged by iterative interleave refinement (``merge_transforms``): it reads the
transforms alone, sorts no suffix again, and derives the common prefix of
neighbouring suffixes from the round in which they part.  Neighbours with
``length`` bytes in common are the repeated intervals.
A symbol stands for ``STEP`` bytes or fewer (a 64-bit hash of them; any fixed
order of the alphabet will do), and a run gives one string of symbols for each
phase, so 200 bytes need five rounds.

Defined cases: a null text counts as empty (no bytes, digest of nothing);
texts shorter than ``length`` lose nothing; matches never cross documents;
repeated rows repeat each other, so they lose their windows like any copies;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import batch, prepare
from flowlens.llm.window_runs import (
    hit_arrays, hits_of, mix, prefix_hash, run_contents, runs_of, shared_runs, span_hash, with_hits)

GRAM = 64
STEP = 40
#: Bytes of a block, and distinct runs of a shard: their arrays stay in the cache
#: and under the size from which workers give memory back after every use.
BLOCK_BYTES = 1 << 15
GROUP_RUNS = 400


def symbols_of(data: np.ndarray, step: int) -> np.ndarray:
    """The ``step`` bytes from every position on, as one number; the order of
    the alphabet is that of the numbers.  Zero where fewer bytes are left."""
    out = np.zeros(len(data), np.uint64)
    at = np.arange(max(0, len(data) - step + 1))
    out[at] = mix(span_hash(prefix_hash(data.astype(np.uint64) + np.uint64(1)), at, at + step))
    return out


def step_of(length: int) -> int:
    """Bytes of a symbol: the largest divisor of ``length`` up to STEP."""
    return max(d for d in range(1, STEP + 1) if length % d == 0)


def _starts(change: np.ndarray) -> np.ndarray:
    """For every row the index of the first row of its group."""
    return np.maximum.accumulate(np.where(change, np.arange(len(change)), 0))


def _changes(*keys: np.ndarray) -> np.ndarray:
    out = np.zeros(len(keys[0]), bool)
    out[:1] = True
    for k in keys:
        out[1:] |= k[1:] != k[:-1]
    return out


def _tied(change: np.ndarray) -> np.ndarray:
    """The rows that are not alone in their group."""
    head = np.concatenate((change, [True]))
    return ~(head[:-1] & head[1:])


class Transform(NamedTuple):
    """Burrows-Wheeler transform of one block: its sorted distinct symbols,
    and in suffix order the symbol before each suffix (1 + its place among
    the symbols, 0 where a string begins) and the suffix's position."""

    alphabet: np.ndarray
    before: np.ndarray
    order: np.ndarray


def block_transform(symbols: np.ndarray, room: np.ndarray, lead: np.ndarray,
                    step: int) -> Transform:
    """Transform of one block.  ``room`` and ``lead`` are the bytes of the run
    after and before each position.  Every run gives ``step`` strings of
    symbols, one for each phase; equal suffixes stand by position."""
    n = len(symbols)
    ended, whole = np.flatnonzero(room < step), np.flatnonzero(room >= step)
    order = np.concatenate((ended, whole[np.argsort(symbols[whole])]))
    rest = order[len(ended):]
    change = _changes(symbols[rest])
    code, rank = np.zeros(n, np.int32), np.zeros(n, np.int64)
    code[rest] = np.cumsum(change)
    rank[rest] = len(ended) + _starts(change)
    tied = np.flatnonzero(_tied(change)) + len(ended)
    active, depth = order[tied], 1
    while len(active := active[room[active] >= step * depth]):
        k1, k2 = rank[active], rank[active + step * depth]
        at = np.argsort(k1 * n + k2)
        active, k1, k2 = active[at], k1[at], k2[at]
        outer, inner = _changes(k1), _changes(k1, k2)
        rank[active] = k1 + _starts(inner) - _starts(outer)
        active, depth = active[_tied(inner)], depth * 2
    order[tied] = (rows := order[tied])[np.argsort(rank[rows] * n + rows)]
    before = np.where(lead[order] >= step, code[np.maximum(order - step, 0)], 0)
    return Transform(symbols[rest[change]], before, order)


def _union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge of two sorted alphabets."""
    at = np.searchsorted(a, b)
    new = np.ones(len(b), bool)
    inside = at < len(a)
    new[inside] = a[at[inside]] != b[inside]
    return np.insert(a, at[new], b[new])


def _dealt(codes: np.ndarray) -> np.ndarray:
    """Rows dealt to one bucket per code, in their order: counting passes
    over 16 bits at a time, no comparisons."""
    at = np.argsort((codes & 0xFFFF).astype(np.uint16), kind="stable")
    shift = 16
    while int(codes.max(initial=0)) >> shift:
        high = ((codes[at] >> shift) & 0xFFFF).astype(np.uint16)
        at, shift = at[np.argsort(high, kind="stable")], shift + 16
    return at


def merge_transforms(blocks: list[Transform], rounds: int):
    """Merge the transforms of blocks that follow each other, from the
    transforms alone.  Returns (merged transform, common prefix of every
    suffix with the one before it, in symbols and up to ``rounds``).

    Dealing a transform's symbols to one bucket per symbol leads from every
    place of its order to the place of the suffix one symbol on.  The buckets
    of all blocks are joined by their counts alone; each is an interval, its
    places block after block.  Every round splits the intervals by the
    interval that the suffix one symbol on stands in, which orders them by one
    symbol more; ties stay block after block, in block order.  An interval
    that holds one suffix is settled.  A border first seen in round h parts
    suffixes with h symbols in common."""
    alphabet = reduce(_union, (b.alphabet for b in blocks))
    codes = [np.concatenate(([0], np.searchsorted(alphabet, b.alphabet) + 1)).astype(np.int32)
             for b in blocks]
    counts = [np.bincount(b.before, minlength=len(c)) for b, c in zip(blocks, codes, strict=True)]
    total = np.zeros(len(alphabet) + 1, np.int32)
    for c, n_of in zip(codes, counts, strict=True):
        total[c] += n_of.astype(np.int32)
    first = np.cumsum(total, dtype=np.int32) - total
    free = first.copy()  # next place of every bucket
    follow, interval, place, base = [], [], [], 0
    for b, c, n_of in zip(blocks, codes, counts, strict=True):
        follow.append(_dealt(b.before) + base)
        interval.append(np.repeat(first[c], n_of))
        own = np.cumsum(n_of) - n_of  # the bucket's first place in the block's own order
        place.append(np.arange(len(b.order)) + np.repeat(free[c] - own, n_of))
        free[c] += n_of.astype(np.int32)
        base += len(b.order)
    follow, interval, place = (np.concatenate(x) for x in (follow, interval, place))
    common = np.full(base, rounds, np.int32)
    common[first[total > 0]] = 0
    active = np.empty(base, np.int64)
    active[place] = np.arange(base)
    active = active[np.repeat((total > 1) & (np.arange(len(total)) > 0), total)]
    for depth in range(1, rounds):
        k1, k2 = interval[active], interval[follow[active]]
        at = np.argsort(k1 * np.int64(base) + k2, kind="stable")
        active, k1, k2 = active[at], k1[at], k2[at]
        outer, inner = _changes(k1), _changes(k1, k2)
        now = k1 + np.arange(len(k1)) - _starts(outer)
        place[active] = now
        interval[active] = now[_starts(inner)]
        parted = inner & ~outer
        if not parted.any():
            break
        common[now[parted]] = depth
        active = active[_tied(inner)]
    order, symbol = np.empty(base, np.int64), np.empty(base, np.int32)
    starts = np.cumsum([0, *(len(b.order) for b in blocks[:-1])])
    order[place] = np.concatenate([b.order + at for b, at in zip(blocks, starts, strict=True)])
    symbol[place] = np.concatenate([c[b.before] for b, c in zip(blocks, codes, strict=True)])
    return Transform(alphabet, symbol, order), common


def repeated_windows(contents: list[bytes], weights: np.ndarray, length: int,
                     block_bytes: int = BLOCK_BYTES) -> np.ndarray:
    """For every byte of the joined contents: a window of ``length`` bytes
    that starts there occurs again in the contents, or its content has
    occurred more than once."""
    sizes = np.array([len(c) + 1 for c in contents], dtype=np.int64)  # one place for its end
    data = np.frombuffer(b"".join(c + b"\0" for c in contents), np.uint8)
    ends = np.cumsum(sizes)
    at = np.arange(len(data))
    room = np.repeat(ends - 1, sizes) - at
    lead = at - np.repeat(ends - sizes, sizes)
    step = step_of(length)
    symbols = symbols_of(data, step)
    found = np.repeat(weights > 1, sizes) & (room >= length)
    bounds = np.unique(np.concatenate((
        [0], np.searchsorted(ends, np.arange(block_bytes, len(data), block_bytes)) + 1,
        [len(sizes)])))
    edges = np.concatenate(([0], ends))[bounds].tolist()
    rounds = length // step
    merged, common = merge_transforms(
        [block_transform(symbols[a:b], room[a:b], lead[a:b], step)
         for a, b in zip(edges[:-1], edges[1:], strict=True)], rounds)
    # a repeated interval: neighbours that share ``length`` bytes
    same = common >= rounds
    hit = merged.order[same | np.concatenate((same[1:], [False]))]
    found[hit[room[hit] >= length]] = True
    return found[room > 0]


def byte_runs(length: int):
    """Runs of a text for ``window_runs``: minimizers over GRAM bytes."""

    def runs(text: str | None, with_content: bool):
        raw = (text or "").encode("utf-8", "surrogatepass")
        if len(raw) < length:
            return None
        h = np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)
        base, width = 0x9E3779B97F4A7C15, 1
        while width < GRAM:
            h = h[:-width] * np.uint64(base) + h[width:]
            base, width = base * base % (1 << 64), width * 2
        first, count, key = runs_of(mix(h), length - GRAM + 1)
        if not with_content:
            return first, count, key, None
        digest = xxhash.xxh3_64_intdigest
        chash = np.array([digest(raw[a:a + n + length - 1]) for a, n in
                          zip(first.tolist(), count.tolist(), strict=True)], dtype=np.uint64)
        return first, count, key, chash

    return runs


def byte_content(length: int):
    def of(text: str | None):
        raw = (text or "").encode("utf-8", "surrogatepass")
        return lambda start, windows: raw[start:start + windows + length - 1]

    return of


def byte_windows(length: int):
    def of(content: bytes, windows: int):
        return (content[i:i + length] for i in range(windows))

    return of


_HITS = pa.schema([("key", pa.int64()), ("chash", pa.int64()), ("windows", pa.int64()),
                   ("hits", pa.list_(pa.int64()))])


def repeated_spans(docs: DataFrame, length: int = 200, shard_runs: int = 5000) -> DataFrame:
    """doc_id, text, runs: list of (loc, hits); hits holds begin and end of the
    byte spans, relative to the run's start, that repeated windows cover.  A
    gram with more than ``shard_runs`` runs is hot; shards hold about
    GROUP_RUNS runs, more where one gram has more."""
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")
    rows = shared_runs(
        docs, byte_runs(length),
        lambda k: k.groupBy("key").agg(F.count(F.lit(1)).alias("n_runs")).where("n_runs > 1"),
        shard_runs, "byte-runs")
    contents = run_contents(docs, rows, byte_content(length), min(shard_runs, GROUP_RUNS))

    def search(t: pa.Table) -> pa.Table:
        data = t.column("content").to_pylist()
        weights = t.column("n").to_numpy()
        found = repeated_windows(data, weights, length).astype(np.int8)
        hits, at = [], 0
        for c in data:
            own = np.diff(np.concatenate(([0], found[at:at + len(c)], [0])))
            span = np.stack((np.flatnonzero(own == 1), np.flatnonzero(own == -1) + length - 1), 1)
            hits.append(span.ravel())
            at += len(c)
        return pa.Table.from_arrays(
            [t.column("key"), t.column("chash"), t.column("windows"),
             pa.array(hits, pa.list_(pa.int64()))], schema=_HITS)

    def hot_hits(windows: DataFrame) -> DataFrame:
        at = (windows.where("coalesce(shared_n, n) > 1").groupBy("key", "chash", "windows")
              .agg(F.array_sort(F.collect_set("i")).alias("at")))
        begin = F.filter("at", lambda i: ~F.array_contains("at", i - 1))
        end = F.filter("at", lambda i: ~F.array_contains("at", i + 1))
        return at.withColumn("hits", F.flatten(F.zip_with(
            begin, end, lambda a, b: F.array(a, b + length))))

    hits = hits_of(rows, contents, search, byte_windows(length), hot_hits, "byte")
    return with_hits(docs, rows, hits.where("size(hits) > 0"))


def covered_bytes(n_bytes: np.ndarray, runs: pa.ListArray) -> np.ndarray:
    """For all bytes of a batch of texts: covered by a repeated window."""
    base = np.concatenate(([0], np.cumsum(n_bytes)))
    row, start, n_hits, edges = hit_arrays(runs)
    at = np.repeat(base[row] + start, n_hits) + edges
    size = int(base[-1]) + 1
    cover = np.bincount(at[::2], minlength=size) - np.bincount(at[1::2], minlength=size)
    return np.cumsum(cover[:-1]) > 0


_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                  ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def byte_dedup(docs: DataFrame, length: int = 200) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in b.column(1).to_pylist()]
            n_bytes = np.array([len(t) for t in texts], dtype=np.int64)
            gone = covered_bytes(n_bytes, b.column(2))
            removed, spans, kept, at = [], [], [], 0
            for raw in texts:
                own = gone[at:at + len(raw)]
                at += len(raw)
                removed.append(int(own.sum()))
                spans.append(int(own[:1].sum() + (own[1:] & ~own[:-1]).sum()))
                left = np.frombuffer(raw, np.uint8)[~own].tobytes() if removed[-1] else raw
                kept.append(hashlib.sha256(left).hexdigest())
            yield batch(_OUT, b.column(0), n_bytes, removed, spans, kept)

    return repeated_spans(docs, length).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
