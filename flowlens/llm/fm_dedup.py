"""Substring duplicates over word windows with FM-index shards (operator 3).

Window runs are routed to shards by minimizers (``window_runs``).  Each shard
indexes its distinct runs (but for those of hot grams, see there): suffixes sorted to the window length, the
Burrows-Wheeler transform in a wavelet matrix with bit-packed ranks.  The runs
are then streamed against the index from right to left: backward search keeps
the interval of the longest match up to ``length`` words (a failing or full
match shrinks to its parent interval), so each position gets its matching
statistic; intervals at the threshold report the smallest document that holds
the window.  A window is removed where that document is smaller than its own.

Defined cases: a null text has no words and keeps the digest of nothing; a
text shorter than the window loses nothing; repeated rows (equal doc_id)
never remove each other, as no smaller doc_id holds the window; a null doc_id
is never the smaller document, and its own windows go if any document with an
id holds them; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowlens.llm.common import batch, portions, prepare, words
from flowlens.llm.window_runs import (
    hit_arrays, hits_of, mix, prefix_hash, run_contents, runs_of, shared_runs, span_hash, with_hits)

NO_DOC = (1 << 63) - 1


class WaveletMatrix:
    """Rank of any symbol at any position of an integer sequence."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.n = len(symbols)
        cur = symbols.astype(np.int64)
        self.bits, self.ones, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (cur >> level & 1).astype(np.uint8)
            packed = np.packbits(np.concatenate((bit, np.zeros(-self.n % 64 + 64, np.uint8))),
                                 bitorder="little").view("<u8")
            counts = np.bitwise_count(packed).astype(np.int64)
            self.bits.append(packed)
            self.ones.append(np.concatenate(([0], np.cumsum(counts)[:-1])))
            self.zeros.append(self.n - int(bit.sum()))
            cur = np.concatenate((cur[bit == 0], cur[bit == 1]))
        self.start = self._descend(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def _descend(self, symbol: np.ndarray, pos: np.ndarray) -> np.ndarray:
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            word = pos >> 6
            mask = (np.uint64(1) << (pos & 63).astype(np.uint64)) - np.uint64(1)
            one = self.ones[i][word] + np.bitwise_count(self.bits[i][word] & mask)
            pos = np.where(symbol >> level & 1, self.zeros[i] + one, pos - one)
        return pos

    def rank(self, symbol: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before ``pos``."""
        return self._descend(symbol, pos) - self.start[symbol]


class FMIndex:
    """Index of word sequences, exact for patterns of up to ``depth`` words."""

    def __init__(self, sequences: list[list[bytes]], depth: int):
        self.depth = depth
        self.ids: dict[bytes, int] = {}
        ids = self.ids
        flat = []
        for s in sequences:  # 0 ends a sequence and never matches
            flat += [ids.setdefault(w, len(ids) + 1) for w in s]
            flat.append(0)
        text = np.array(flat, dtype=np.int64)
        n = self.n = len(text)
        lengths = np.array([len(s) + 1 for s in sequences], dtype=np.int64)
        self.text, self.lengths = text, lengths
        rank, width = text, 1
        while width < depth:  # order of the first `width` words, doubled each time
            nxt = np.concatenate((rank[width:], np.zeros(min(width, n), np.int64)))[:n]
            rank = np.unique(rank * (n + len(ids) + 2) + nxt, return_inverse=True)[1]
            width *= 2
        sa = np.argsort(rank, kind="stable")
        self.owner = np.repeat(np.arange(len(sequences)), lengths)[sa]
        common = np.zeros(n, np.int64)  # words shared with the row before
        same = np.ones(n, bool)
        padded = np.concatenate((text, np.zeros(depth, np.int64)))
        for k in range(depth):
            here = padded[sa + k]
            same[0] = False
            same[1:] &= (here[1:] == here[:-1]) & (here[1:] != 0)
            common += same
        self.common = common
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=len(ids) + 1))))
        self.bwt = WaveletMatrix(text[sa - 1], len(ids) + 1)
        self._parents: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def parents(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """For every row, first and last-plus-one row that share ``length`` words."""
        if length not in self._parents:
            start = self.common < length
            start[0] = True
            lo = np.maximum.accumulate(np.where(start, np.arange(self.n), 0))
            cuts = np.concatenate((np.flatnonzero(start), [self.n]))
            self._parents[length] = lo, cuts[np.cumsum(start)]
        return self._parents[length]

    def grid(self, queries: list[list[bytes]]) -> np.ndarray:
        """Queries as right-aligned rows of symbols; -1: word not indexed."""
        longest = max(map(len, queries), default=0)
        out = np.zeros((len(queries), longest), dtype=np.int64)
        for i, q in enumerate(queries):
            out[i, longest - len(q):] = [self.ids.get(w, -1) for w in q]
        return out

    def own_grid(self) -> np.ndarray:
        """The indexed sequences themselves as queries."""
        longest = int(self.lengths.max(initial=1)) - 1
        out = np.zeros((len(self.lengths), longest), dtype=np.int64)
        out[np.arange(longest) >= (longest + 1 - self.lengths)[:, None]] = self.text[self.text > 0]
        return out

    def matching_statistics(self, grid: np.ndarray):
        """Per step from the right end of the queries: (query numbers,
        positions, match lengths up to ``depth``, interval starts)."""
        longest = grid.shape[1]
        length = (grid != 0).sum(1)
        lo = np.zeros(len(grid), np.int64)
        hi = np.full(len(grid), self.n, np.int64)
        size = np.zeros(len(grid), np.int64)
        for col in range(longest - 1, -1, -1):
            live = np.flatnonzero(longest - length <= col)
            c = grid[live, col]
            lost = live[c < 0]
            lo[lost], hi[lost], size[lost] = 0, self.n, 0
            todo = live[c >= 0]
            self._shrink(todo[size[todo] == self.depth], lo, hi, size, self.depth - 1)
            while len(todo):
                sym = grid[todo, col]
                a = self.first[sym] + self.bwt.rank(sym, lo[todo])
                b = self.first[sym] + self.bwt.rank(sym, hi[todo])
                ok = a < b
                done = todo[ok]
                lo[done], hi[done] = a[ok], b[ok]
                size[done] += 1
                todo = todo[~ok]
                todo = todo[size[todo] > 0]  # an indexed word always matches alone
                for s in np.unique(size[todo]):
                    self._shrink(todo[size[todo] == s], lo, hi, size, int(s) - 1)
            yield live, col - (longest - length[live]), size[live], lo[live]

    def _shrink(self, which, lo, hi, size, length):
        if len(which):
            start, end = self.parents(length)
            row = lo[which]
            lo[which], hi[which], size[which] = start[row], end[row], length


def smallest_holders(sequences: list[list[bytes]], values: np.ndarray,
                     length: int) -> list[np.ndarray]:
    """For each sequence, for each of its windows of ``length`` words, the
    smallest value among the sequences that hold the window."""
    index = FMIndex(sequences, length)
    starts = index.common < length  # row 0 shares nothing
    low = np.minimum.reduceat(values[index.owner], np.flatnonzero(starts))
    interval = np.cumsum(starts) - 1
    sizes = np.array([max(0, len(s) - length + 1) for s in sequences], dtype=np.int64)
    at = np.cumsum(sizes) - sizes
    out = np.full(int(sizes.sum()), NO_DOC, np.int64)
    for which, pos, size, row in index.matching_statistics(index.own_grid()):
        full = size == length
        out[at[which[full]] + pos[full]] = low[interval[row[full]]]
    return np.split(out, at[1:])


def split_words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word of a byte array."""
    solid = np.concatenate(([False], ~_WHITE[raw], [False]))
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    return edge[::2], edge[1::2]


#: ASCII white space, bytes 9 to 13 and 32 (fixed values)
_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def word_runs(length: int, gram: int):
    """Runs of a text for ``window_runs``: minimizers over ``gram`` words."""

    def runs(text: str | None, with_content: bool):
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        begin, end = split_words(raw)
        n = len(begin)
        if n < length:
            return None
        hashes = mix(span_hash(prefix_hash(raw.astype(np.uint64) + np.uint64(1)), begin, end))
        prefix = prefix_hash(hashes)
        at = np.arange(n - gram + 1)
        first, count, key = runs_of(mix(span_hash(prefix, at, at + gram)), length - gram + 1)
        chash = span_hash(prefix, first, first + count + length - 1) if with_content else None
        return first, count, key, chash

    return runs


def word_content(length: int):
    """Words of a run, joined by one space."""

    def of(text: str | None):
        w = words(text)
        return lambda start, windows: b" ".join(w[start:start + windows + length - 1])

    return of


def word_windows(length: int):
    def of(content: bytes, windows: int):
        w = content.split()
        return (b" ".join(w[i:i + length]) for i in range(windows))

    return of


_HITS = pa.schema([("key", pa.int64()), ("chash", pa.int64()), ("windows", pa.int64()),
                   ("hits", pa.list_(pa.int64()))])


def window_holders(docs: DataFrame, length: int = 13, gram: int = 5, shard_runs: int = 8_000,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, runs and ``keep`` columns; runs: for the windows shared by documents, the smallest
    doc_id that holds each, as list of (loc, hits)."""
    rows = shared_runs(
        docs, word_runs(length, gram),
        lambda k: k.groupBy("key").agg(F.min("rk").alias("a"), F.max("rk").alias("b"),
                                   F.count(F.lit(1)).alias("n_runs"))
        .where("a <> b").select("key", "n_runs"), shard_runs, "word-runs")
    contents = run_contents(docs, rows, word_content(length), shard_runs)

    def search(t: pa.Table) -> pa.Table:
        seqs = [c.split() for c in t.column("content").to_pylist()]
        low = np.array([NO_DOC if v is None else v for v in t.column("low").to_pylist()],
                       dtype=np.int64)
        hits = smallest_holders(seqs, low, length)
        return pa.Table.from_arrays(
            [t.column("key"), t.column("chash"), t.column("windows"),
             pa.array(hits, pa.list_(pa.int64()))], schema=_HITS)

    def hot_hits(windows: DataFrame) -> DataFrame:
        holder = F.coalesce("shared_low", "low", F.lit(NO_DOC)).alias("holder")
        return windows.groupBy("key", "chash", "windows").agg(F.transform(
            F.array_sort(F.collect_set(F.struct("i", holder))),
            lambda w: w.holder).alias("hits"))

    hits = hits_of(rows, contents, search, word_windows(length), hot_hits, "word")
    own = F.coalesce("doc_id", F.lit(NO_DOC))
    return with_hits(docs, rows, hits, keep,
                     F.exists("hits", lambda h: h < own))


def covered_words(doc_ids: list, n_words: np.ndarray, runs: pa.ListArray,
                  length: int) -> np.ndarray:
    """For all words of a batch of documents: covered by a window that a
    document with a smaller id holds."""
    base = np.concatenate(([0], np.cumsum(n_words)))
    row, start, n_hits, holder = hit_arrays(runs)
    own = np.array([NO_DOC if d is None else d for d in doc_ids], dtype=np.int64)
    first = np.cumsum(n_hits) - n_hits
    at = np.repeat(base[row] + start - first, n_hits) + np.arange(len(holder))
    at = at[holder < np.repeat(own[row], n_hits)]
    size = int(base[-1]) + 1
    cover = np.bincount(at, minlength=size) - np.bincount(at + length, minlength=size)[:size]
    return np.cumsum(cover[:-1]) > 0


def substring_dedup(docs: DataFrame, length: int = 13, text: bool = False,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256; with ``text`` also kept, the
    kept words joined by one space (the unchanged text if all are kept), and
    the ``keep`` columns."""
    prepare(docs.sparkSession)
    base = window_holders(docs, length, keep=keep)
    out_type = StructType([*StructType.fromDDL(
        "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * text
    ).fields, *base.select(*keep).schema.fields])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("kept_sha256", pa.string())] + [("kept", pa.string())] * text)

    def run(batches):
        for whole in batches:
            for lo, texts in portions(whole.column(1)):
                b = whole.slice(lo, len(texts))
                doc_ids = b.column(0).to_pylist()
                all_words = [words(t) for t in texts]
                n_words = np.array([len(w) for w in all_words], dtype=np.int64)
                stay = ~covered_words(doc_ids, n_words, b.column(2), length)
                kept, gone, digests, at = [], [], [], 0
                for i, w in enumerate(all_words):
                    all_words[i] = None  # one text's words at a time from here
                    own = stay[at:at + len(w)]
                    at += len(w)
                    left = int(own.sum())
                    k = b" ".join(w if left == len(w) else compress(w, own.tolist()))
                    gone.append(len(w) - left)
                    digests.append(hashlib.sha256(k).hexdigest())
                    if text:
                        kept.append(k.decode() if gone[-1] else texts[i])
                done = batch(schema, doc_ids, n_words, gone, digests, *([kept] if text else []))
                yield pa.RecordBatch.from_arrays(
                    [*done.columns, *b.columns[3:]], names=[*schema.names, *keep])

    return base.mapInArrow(run, out_type)
