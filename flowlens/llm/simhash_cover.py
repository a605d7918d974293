"""SimHash near-duplicates by covering locality-sensitive hashing (operator 10).

Bit position i of a fingerprint gets a non-zero vector m(i) of radius + 1 bits.
Table v (every non-zero vector of that length) compares only positions with
<m(i), v> = 1.  Up to ``radius`` differing positions always leave some v with
<m(i), v> = 0 for all of them, so every pair within the radius collides in at
least one of the 2^(radius+1) - 1 tables: recall is 1 by construction.

Equal fingerprints are folded before the tables.  Buckets are streamed in
sorted order; a bucket of more than ``bucket_rows`` fingerprints is not
compared but dealt out again by covering masks over its free bits, so any
bucket ends as one of bounded size (two levels leave about seven free bits).

Defined cases: a null or word-less text has fingerprint 0 and links like any
other; repeated rows are returned once each; an empty table gives no rows;
other columns of the input are ignored; links are those of fingerprints, so a
row without doc_id takes part in them like any other; component_id is null only
where no row of the group has an id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowlens.llm.common import Forest, batch, components, cut, prepare

BITS = 64
_FP = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
#: kind 0: link a-b; kind 1: fingerprint b of row a, dealt to (level table t, key k)
_OUT = pa.schema([("kind", pa.int32()), ("t", pa.int64()), ("k", pa.int64()),
                  ("a", pa.int64()), ("b", pa.int64())])
_BUCKET_DDL = "kind int, t long, k long, a long, b long"


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Majority bit vector over the XXH64 of the word shingles."""
    w = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not w:
        return 0
    n = max(1, len(w) - shingle + 1)
    flat = b" ".join(w)
    ends = np.cumsum([len(x) + 1 for x in w]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(shingle, len(w)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(flat[a:b], seed) for a, b in zip(starts, stops, strict=True)],
                 dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 65536):
        part = h[at:at + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def covering_masks(free: int, radius: int) -> list[int]:
    """One mask per table over the bits set in ``free``."""
    dims = radius + 1
    at = [i for i in range(BITS) if free >> i & 1]
    vector = {i: j % ((1 << dims) - 1) + 1 for j, i in enumerate(at)}
    return [sum(1 << i for i in at if (vector[i] & v).bit_count() & 1)
            for v in range(1, 1 << dims)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp) and ``keep`` columns of every row of ``docs``."""
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            fps = np.array([simhash(t, shingle, seed) for t in b.column(1).to_pylist()],
                           dtype=np.uint64).view(np.int64)
            done = batch(_FP, b.column(0), fps)
            yield pa.RecordBatch.from_arrays([*done.columns, *b.columns[2:]],
                                             names=[*_FP.names, *keep])

    out_type = StructType([*StructType.fromDDL("doc_id long, fp long").fields,
                           *docs.select(*keep).schema.fields])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"), *keep).mapInArrow(run, out_type)


def _links(fp: np.ndarray, run_id: np.ndarray, ids: np.ndarray, radius: int):
    """Spanning links of rows (sorted by bucket) whose buckets are all small."""
    forest, found = Forest(), []
    step = 1
    while step < len(fp):
        same = np.flatnonzero(run_id[step:] == run_id[:-step])
        if not len(same):
            break
        near = same[np.bitwise_count(fp[same + step] ^ fp[same]) <= radius]
        for x, y in zip(ids[near].tolist(), ids[near + step].tolist(), strict=True):
            if forest.join(x, y):
                found.append((x, y))
        step += 1
    return found


def _deal_again(code: int, level: int, n_tables: int, radius: int, last: int):
    """Masks below table ``code``; code holds the table of each level, base 256."""
    free = (1 << BITS) - 1
    path = []
    for i in range(level + 1):
        t = code >> (8 * i) & 255
        mask = covering_masks(free, radius)[t]
        free &= ~mask
        path.append(t)
    kept = (1 << BITS) - 1 & ~free
    below = covering_masks(free, radius) if level < last else []
    return [(code | t << (8 * (level + 1)), kept | m) for t, m in enumerate(below)]


def _bucket_pass(level: int, radius: int, bucket_rows: int, last: int):
    def emit(t, k, fp, ids):
        edge_from, edge_to = [], []
        change = np.concatenate(([True], (t[1:] != t[:-1]) | (k[1:] != k[:-1])))
        run_id = np.cumsum(change)
        pairs = _links(fp.view(np.uint64), run_id, ids, radius)
        if pairs:
            edge_from, edge_to = map(list, zip(*pairs, strict=True))
        n = len(edge_from)
        z = np.zeros(n, np.int64)
        return batch(_OUT, np.zeros(n, np.int32), z, z, edge_from, edge_to)

    def deal(t, k, fp, ids):
        for code, mask in _deal_again(int(t), level, 0, radius, last):
            keys = (fp.view(np.uint64) & np.uint64(mask)).view(np.int64)
            yield batch(_OUT, np.ones(len(fp), np.int32), np.full(len(fp), code, np.int64),
                        keys, ids, fp)

    def run(batches):
        held, over = [], None  # rows of the last, maybe unfinished bucket; its key if too large

        def big(n):
            return level < last and n > bucket_rows

        for b in batches:
            t, k, fp, ids = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            if held:
                t, k, fp, ids = (np.concatenate(x) for x in zip(held.pop(), (t, k, fp, ids),
                                                                strict=True))
            if not len(t):
                continue
            cuts = np.flatnonzero((t[1:] != t[:-1]) | (k[1:] != k[:-1])) + 1
            starts = np.concatenate(([0], cuts))
            sizes = np.diff(np.concatenate((starts, [len(t)])))
            tail = int(starts[-1])
            # rows of a bucket already known to be too large go straight on
            first = 0
            if over is not None and (t[0], k[0]) == over:
                first = int(starts[1]) if len(starts) > 1 else len(t)
                yield from deal(t[0], k[0], fp[:first], ids[:first])
                if first == len(t):
                    continue
                over = None
            for s, n in zip(starts.tolist(), sizes.tolist(), strict=True):
                if s >= max(first, 0) and big(n):
                    yield from deal(t[s], k[s], fp[s:s + n], ids[s:s + n])
            closed = np.repeat(np.arange(len(starts)), sizes)
            small = ~np.isin(closed, np.flatnonzero([big(n) for n in sizes.tolist()]))
            keep = small & (np.arange(len(t)) >= first) & (np.arange(len(t)) < tail)
            if keep.any():
                yield emit(t[keep], k[keep], fp[keep], ids[keep])
            if big(int(sizes[-1])):
                over = (t[tail], k[tail])
            elif tail >= first:
                held = [(t[tail:], k[tail:], fp[tail:], ids[tail:])]
        if held:
            yield emit(*held.pop())

    return run


def near_links(rows: DataFrame, radius: int = 3, bucket_rows: int = 2048,
               levels: int = 3) -> DataFrame:
    """Links (a, b) that connect the same rows as all pairs of ``rows``
    (rep long, fp long, distinct fp) within ``radius`` bits do."""
    masks = covering_masks((1 << BITS) - 1, radius)
    dealt = rows.select(F.inline(F.array(*[
        F.struct(F.lit(t).cast("long").alias("t"),
                 F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k"),
                 F.col("fp").alias("fp"), F.col("rep").alias("rep"))
        for t, m in enumerate(masks)])))
    links = None
    for level in range(levels):
        out = (dealt.repartition("t", "k").sortWithinPartitions("t", "k", "fp")
               .mapInArrow(_bucket_pass(level, radius, bucket_rows, levels - 1), _BUCKET_DDL))
        if level < levels - 1:
            out = cut(out)
        found = out.where("kind = 0").select("a", "b")
        links = found if links is None else links.union(found)
        dealt = out.where("kind = 1").select("t", "k", F.col("b").alias("fp"),
                                             F.col("a").alias("rep"))
    return links


def fingerprint_groups(fps: DataFrame, radius: int = 3, bucket_rows: int = 2048) -> DataFrame:
    """(fp, node, low) of every fingerprint: ``node`` is the smallest
    fingerprint reachable by links."""
    rows = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    label = components(near_links(rows.select(F.col("fp").alias("rep"), "fp"), radius, bucket_rows))
    return rows.join(label.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("node"), "low")


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 3, seed: int = 42,
                   bucket_rows: int = 2048) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits),
    component_id (smallest doc_id reachable by links)."""
    fps = cut(fingerprints(docs, shingle, seed))
    groups = cut(fingerprint_groups(fps, radius, bucket_rows))
    low = cut(groups.groupBy("node").agg(F.min("low").alias("component_id")))
    named = groups.join(low, "node").select("fp", "component_id")
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, shingle: int = 3, radius: int = 3, seed: int = 42,
                      bucket_rows: int = 2048) -> DataFrame:
    """The first row of each group by doc_id (nulls last), SHA-256 of the text
    and a hash of the row."""
    flags = [F.col(c).isNull() for c in docs.columns]
    marked = docs.withColumns({
        "row_a": F.xxhash64(*docs.columns, *flags),
        "row_b": F.xxhash64(F.lit(1), *docs.columns, *flags),
        "digest": F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)})
    fps = cut(fingerprints(marked, shingle, seed, ("digest", "row_a", "row_b")))
    groups = fingerprint_groups(fps, radius, bucket_rows).select("fp", "node")
    first = fps.join(groups, "fp").groupBy("node").agg(F.min(F.struct(
        F.col("doc_id").isNull(), "doc_id", "digest", "row_a", "row_b")).alias("first"))
    keep = first.select("first.row_a", "first.row_b")
    return marked.join(keep, ["row_a", "row_b"], "left_semi").dropDuplicates(
        ["row_a", "row_b"]).select(*docs.columns)
