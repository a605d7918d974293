"""Routing of fixed-length windows to shards by minimizers.

Every window of ``length`` symbols has one smallest gram (by hash, leftmost on
ties).  Consecutive windows with the same gram occurrence form a run.  Equal
windows have equal grams, so sending runs to shards by the gram's hash brings
all occurrences of every window together, and a run whose gram occurs only
once cannot hold a repeated window: it is dropped before any text moves.

A gram with more than ``shard_runs`` runs is hot: its different runs would all
meet in one shard.  They are cut into their windows instead, and those meet by
gram and 128-bit hash of the window in ordinary aggregates.

A run row is (key, chash, rk, doc_id, loc, hot): gram hash, hash of the run's
content, hash of the document row, start << 12 | number of windows, and whether
the gram is hot.  Runs are told apart by key, content hash and length, 128 hash
bits together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import batch, prepare, written

_PLACE = np.uint64((1 << 20) - 1)
RUN_DDL = "key long, chash long, rk long, doc_id long, loc long"
_RUN = pa.schema([(c, pa.int64()) for c in ("key", "chash", "rk", "doc_id", "loc")])


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads polynomial hashes over all bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def runs_of(grams: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs over windows of ``span`` grams each: first window, number of
    windows, gram hash."""
    n = len(grams) - span + 1
    firsts, counts, keys = [], [], []
    step = (1 << 20) - span
    for w0 in range(0, n, step):
        part = grams[w0:min(n, w0 + step) + span - 1]
        key = (part & ~_PLACE) | np.arange(len(part), dtype=np.uint64)
        low, width = key, 1
        while width * 2 <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < span:
            low = np.minimum(low[:len(key) - span + 1], low[span - width:])
        at = low & _PLACE
        first = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
        firsts.append(first + w0)
        counts.append(np.diff(np.concatenate((first, [len(at)]))))
        keys.append(part[at[first]])
    return np.concatenate(firsts), np.concatenate(counts), np.concatenate(keys)


def _offsets(lists: pa.ListArray) -> pa.Array:
    """Offsets of a list column counted from its own first entry."""
    sizes = lists.value_lengths().fill_null(0).to_numpy()
    return pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())


def hit_arrays(runs: pa.ListArray):
    """A batch's run lists as arrays: row and start of each run, its number
    of hits, and all hits in order."""
    sizes = runs.value_lengths().fill_null(0).to_numpy()
    flat = runs.flatten()
    hits = flat.field("hits")
    return (np.repeat(np.arange(len(sizes)), sizes), flat.field("loc").to_numpy() >> 12,
            hits.value_lengths().fill_null(0).to_numpy().astype(np.int64),
            hits.flatten().to_numpy())


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Polynomial prefix hashes: prefix[i] covers values before i."""
    return np.concatenate((np.zeros(1, np.uint64),
                           np.cumsum(values * _powers(len(values))[0][:len(values)], dtype=np.uint64)))


def span_hash(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of values[start:stop], the same wherever the values stand."""
    return (prefix[stop] - prefix[start]) * _powers(len(prefix))[1][start]


_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, grown on need."""
    have = len(_POWERS[0])
    if have < n:
        size = max(n, 2 * have, 1 << 12)
        for i, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, np.uint64(b))
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


def row_key():
    """Identity of a document row: equal rows have equal keys."""
    return F.xxhash64("doc_id", "text").alias("rk")


def keyed(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return docs.select(row_key(), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"), *keep)


def shared_runs(docs: DataFrame, runs, shared, shard_runs: int, name: str) -> DataFrame:
    """Run rows whose gram is shared.  ``runs(text)`` gives (start, windows,
    key, content hash) arrays of one text; ``shared(keys)`` turns the table of
    (key) occurrences into the keys to keep with their number of runs."""
    prepare(docs.sparkSession)

    def emit_keys(batches):
        schema = pa.schema([("key", pa.int64()), ("rk", pa.int64())])
        for b in batches:
            found = [runs(t, False) for t in b.column(2).to_pylist()]
            keys = [f[2] for f in found if f is not None]
            sizes = [0 if f is None else len(f[2]) for f in found]
            yield batch(schema, np.concatenate([np.zeros(0, np.uint64), *keys]).view(np.int64),
                        np.repeat(b.column(0).to_numpy(), sizes))

    def emit_runs(batches):
        for b in batches:
            found = [runs(t, True) for t in b.column(2).to_pylist()]
            sizes = [0 if f is None else len(f[2]) for f in found]
            found = [f for f in found if f is not None]
            start, count, key, chash = (np.concatenate([np.zeros(0, t), *(f[i] for f in found)])
                                        for i, t in enumerate(("i8", "i8", "u8", "u8")))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            yield batch(_RUN, key.view(np.int64), chash.view(np.int64),
                        b.column(0).take(pa.array(owner)), b.column(1).take(pa.array(owner)),
                        start << 12 | count)

    base = keyed(docs)
    # written first: the join then sees two plain shuffles and can split a hot key
    keep = written(shared(base.mapInArrow(emit_keys, "key long, rk long")), f"{name}-keys")
    keep = keep.select("key", (F.col("n_runs") > shard_runs).alias("hot"))
    return written(base.mapInArrow(emit_runs, RUN_DDL).join(keep, "key"), name)


def run_contents(docs: DataFrame, rows: DataFrame, content, shard_runs: int) -> DataFrame:
    """(shard, key, chash, windows, low, n, content): every distinct run once
    (or as often as the row it is taken from is repeated),
    with the smallest doc_id it stands in and its number of occurrences.
    ``content(text)`` returns a function (start, windows) -> bytes.  A shard
    holds about ``shard_runs`` runs; runs of hot grams have shard -1."""
    distinct = rows.where("not hot").agg(F.approx_count_distinct("chash")).first()[0]
    n_shards = max(1, -(-distinct // shard_runs))
    reps = (rows.groupBy("key", "chash", (F.col("loc") % 4096).alias("windows"))
            .agg(F.min(F.struct("rk", "doc_id", "loc")).alias("at"), F.min("doc_id").alias("low"),
                 F.count(F.lit(1)).alias("n"), F.bool_or("hot").alias("hot"))
            .groupBy(F.col("at.rk").alias("rk"), F.col("at.doc_id").alias("of"))
            .agg(F.collect_list(F.struct("key", "chash", "low", "n", "at.loc", "hot")).alias("runs")))
    # repeated rows: any of them has the text
    texts = keyed(docs).join(reps, "rk").where("doc_id <=> of").select("text", "runs", "rk", "of")
    schema = pa.schema([(c, pa.int64()) for c in ("shard", "key", "chash", "windows", "low", "n")]
                       + [("content", pa.binary())])

    def emit(batches):
        last = np.zeros(0, np.int64)
        for b in batches:
            # equal rows mostly follow each other here: one of them will do
            rk = np.concatenate((last, b.column(2).to_numpy()))
            new = np.concatenate((np.ones(1 - len(last), bool), rk[1:] != rk[:-1]))[:b.num_rows]
            last = rk[-1:]
            b = b.filter(pa.array(new))
            out: list[bytes] = []
            runs_field = b.column(1).flatten().field("loc")
            locs = pa.ListArray.from_arrays(_offsets(b.column(1)), runs_field)
            for text, runs in zip(b.column(0).to_pylist(), locs.to_pylist(), strict=True):
                part = content(text)
                out += [part(r >> 12, r & 4095) for r in runs]
            flat = b.column(1).flatten()
            key, loc = (flat.field(c).to_numpy() for c in ("key", "loc"))
            hot = flat.field("hot").to_numpy(zero_copy_only=False)
            yield batch(schema, np.where(hot, -1, key % n_shards), key, flat.field("chash"), loc & 4095,
                        flat.field("low"), flat.field("n"), out)

    return texts.select("text", "runs", "rk").mapInArrow(
        emit, "shard long, key long, chash long, windows long, low long, n long, content binary")


def hits_of(rows: DataFrame, contents: DataFrame, search, windows_of, hot_hits,
            name: str) -> DataFrame:
    """(key, chash, windows, hits) of all distinct runs: ``search`` turns the
    table of a shard into them, ``hot_hits`` the table of ``shared_windows``."""
    ddl = "key long, chash long, windows long, hits array<long>"
    if rows.where("hot").isEmpty():
        return written(contents.groupBy("shard").applyInArrow(search, ddl), f"{name}-hits")
    contents = written(contents, f"{name}-contents")
    cold = contents.where("shard >= 0").groupBy("shard").applyInArrow(search, ddl)
    hot = hot_hits(shared_windows(contents.where("shard < 0"), windows_of, name))
    return written(cold.union(hot.select("key", "chash", "windows", "hits")), f"{name}-hits")


def shared_windows(contents: DataFrame, windows_of, name: str) -> DataFrame:
    """(key, chash, windows, i, low, n, shared_low, shared_n) of every window
    of the runs: the smallest doc_id and the number of occurrences of its run,
    and those of all runs of the gram that hold the window (null if there is no
    other).  ``windows_of(content, windows)`` gives the bytes of each window."""
    schema = pa.schema([(c, pa.int64()) for c in (
        "key", "chash", "windows", "i", "low", "n", "a", "b")])

    def emit(batches):
        for b in batches:
            sizes = b.column(2).to_numpy()
            digests = b"".join(
                xxhash.xxh3_128_digest(w)
                for c, n in zip(b.column(5).to_pylist(), sizes.tolist(), strict=True)
                for w in windows_of(c, n))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            i = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            own = [b.column(k).take(pa.array(owner)) for k in (0, 1, 2, 3, 4)]
            halves = np.frombuffer(digests, "<i8").reshape(-1, 2)
            yield batch(schema, *own[:3], i, *own[3:], halves[:, 0], halves[:, 1])

    every = written(contents.select("key", "chash", "windows", "low", "n", "content").mapInArrow(
        emit, ", ".join(f"{c} long" for c in schema.names)), f"{name}-hot")
    # written first: the join then sees two plain shuffles and can split a hot window
    shared = written(every.groupBy("key", "a", "b").agg(
        F.min("low").alias("shared_low"), F.sum("n").alias("shared_n"),
        F.count(F.lit(1)).alias("holders")).where("holders > 1").drop("holders"), f"{name}-shared")
    return every.join(shared, ["key", "a", "b"], "left").drop("a", "b")


def with_hits(docs: DataFrame, rows: DataFrame, hits: DataFrame,
              keep: tuple[str, ...] = (), useful: Column | None = None) -> DataFrame:
    """doc_id, text, the list of (loc, hits) that are ``useful`` and ``keep`` columns of every row
    of ``docs``; ``hits`` is (key, chash, windows, hits array<long>)."""
    spans = (rows.withColumn("windows", F.col("loc") % 4096)
             .join(hits, ["key", "chash", "windows"])
             .where(F.lit(True) if useful is None else useful)
             .groupBy("rk", F.col("doc_id").alias("of"))
             .agg(F.collect_set(F.struct("loc", "hits")).alias("runs")))
    base = keyed(docs, keep)
    cond = (base.rk == spans.rk) & base.doc_id.eqNullSafe(spans.of)
    return base.join(spans, cond, "left").select("doc_id", "text", "runs", *keep)
