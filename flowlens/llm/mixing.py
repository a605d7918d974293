"""Mixing sources to target weights by min-cost flow (operator 4).

Documents are aggregated by membership pattern (the set of sources they stand
in).  A flow network routes words from patterns to sources: a pattern offers
its size once per copy, every further copy at a higher (convex) cost; a source
takes up to its target.  The cheapest full flow says how many words each
pattern gives to each of its sources.  A pattern's documents, in a seeded
order, are laid out once per copy; the line is cut where one source's words
end and the next one's begin, and a copy goes to the source that holds its
middle.  Each cut is found by histograms over ever longer prefixes of the
order key, so no pattern, bucket or group of equal rows is ranked in one task;
then every document compares its own key with the cuts, without a shuffle.

Defined cases: a null text has size 0; documents of size 0 are never taken; a
null source is a source of its own, last; a document in no source (null or
empty array) is never taken; null ids share one place in the order and are
ordered by size, text and place in the table; repeated rows are documents of
their own (which of several equal rows is taken is open); an empty table gives
no rows; other columns are ignored unless named.  Patterns and sources (not
documents) reach the driver: they must be few.
"""

from __future__ import annotations

import pickle
from collections import deque
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import written

WEIGHTS = (3, 1, 2)
SEED = "mix-1"
BROADCAST_BYTES = 32 << 20  # larger tables of patterns are joined by a shuffle
EDGE_ROWS = 10_000  # a bucket with a cut in it is split until it holds no more

#: The order key of a document; the last column tells equal rows apart.
KEY = ("order", "doc_id", "size", "digest", "place")
_KEY_DDL = "struct<order:string,doc_id:long,size:long,digest:string,place:long,past:int>"
#: Ever longer prefixes of the order key: each level has at most some thousand
#: values within one of the level before, or is decided by few rows.
_LEVELS = ("substring(order, 1, 3)", "substring(order, 4, 3)", "substring(order, 7, 3)", "order",
           "doc_id", "size", "substring(digest, 1, 3)", "digest", "place div 16777216",
           "place div 4096")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: dict[str | None, int], weights: Sequence[int] = WEIGHTS,
                   share: Fraction = Fraction(3, 2), cap: int = 2) -> dict[str | None, Fraction]:
    """Share ``share`` times all sizes by weight; a target stops at ``cap``
    times its source's size and the excess is shared again by weight."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out: dict[str | None, Fraction] = {}
    left, rest = share * sum(sizes.values()), set(order)
    while rest:
        level = left / sum(weight[s] for s in rest)
        full = {s for s in rest if weight[s] * level > cap * sizes[s]}
        if not full:
            out.update({s: weight[s] * level for s in rest})
            break
        for s in full:
            out[s] = Fraction(cap * sizes[s])
            left -= out[s]
        rest -= full
    return out


def cheapest_flow(supply: dict[tuple, int], quota: dict, copies: int = 2) -> dict[tuple, dict]:
    """Words each pattern gives to each source: min-cost max-flow from patterns
    to quotas, the r-th copy of a pattern costing r^2 a word.

    Only the arcs that open a copy cost anything, so every augmenting path
    costs what the copy it starts with costs.  Shortest paths first therefore
    means: a maximum flow with first copies, then one on its residual network
    with second copies, and so on; each is found by level graphs."""
    patterns, sources = list(supply), list(quota)
    first_q = 1 + len(patterns)
    end = first_q + len(sources)
    place = {s: first_q + i for i, s in enumerate(sources)}
    to: list[int] = []  # edge i goes to to[i]; edge i ^ 1 goes back
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(end + 1)]

    def add(a, b, capacity):
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((capacity, 0))

    for i, p in enumerate(patterns):
        add(0, 1 + i, 0)
    for i, p in enumerate(patterns):
        for s in p:
            add(1 + i, place[s], copies * supply[p])
    for s, q in quota.items():
        add(place[s], end, q)
    for _ in range(copies):
        for i, p in enumerate(patterns):
            room[2 * i] += supply[p]
        while True:
            level = [-1] * (end + 1)
            level[0], queue = 0, deque([0])
            while queue:
                x = queue.popleft()
                for e in out[x]:
                    if room[e] and level[to[e]] < 0:
                        level[to[e]] = level[x] + 1
                        queue.append(to[e])
            if level[end] < 0:
                break
            at, path = [0] * (end + 1), []
            while True:  # blocking flow
                x = to[path[-1]] if path else 0
                if x == end:
                    push = min(room[e] for e in path)
                    for e in path:
                        room[e] -= push
                        room[e ^ 1] += push
                    path = path[:next(i for i, e in enumerate(path) if not room[e])]
                    continue
                while at[x] < len(out[x]):
                    e = out[x][at[x]]
                    if room[e] and level[to[e]] == level[x] + 1:
                        break
                    at[x] += 1
                if at[x] < len(out[x]):
                    path.append(out[x][at[x]])
                elif path:
                    at[to[path.pop() ^ 1]] += 1
                else:
                    break
    flow: dict[tuple, dict] = {p: {} for p in patterns}
    for i, p in enumerate(patterns):
        for e in out[1 + i]:
            if e % 2 == 0 and room[e ^ 1]:
                flow[p][sources[to[e] - first_q]] = room[e ^ 1]
    return flow


def _small(spark, rows: list[tuple], ddl: str) -> DataFrame:
    """A table of patterns or cuts, broadcast if its bytes are few."""
    df = spark.createDataFrame(rows, ddl)
    return F.broadcast(df) if len(pickle.dumps(rows)) <= BROADCAST_BYTES else df


def find_cuts(small: DataFrame, cuts: list[tuple[list, int]], edge_rows: int = EDGE_ROWS
              ) -> dict[tuple, tuple]:
    """For each (sources, words), words below the size of these sources' pattern:
    the order key up to which a document's middle lies at ``words`` or before,
    as the values of ``KEY`` and 1 (the key itself lies behind) or 2 (before).

    ``small`` holds sources and ``KEY``.  A cut's bucket is the one whose words
    include it; buckets are split by the next level of the key as long as one
    of them has more than ``edge_rows`` documents of some size."""
    spark = small.sparkSession
    rows = small.where("size > 0")
    names: list[str] = []
    # sources, prefix of the key, words before the bucket, words of the cut
    open_cuts = sorted({(tuple(p), (), 0, c) for p, c in cuts}, key=repr)
    types = ""
    for level, expr in enumerate(_LEVELS):
        if not open_cuts:
            return {}
        name = f"l{level}"
        rows = rows.withColumn(name, F.expr(expr))
        sizes = _in_buckets(rows, open_cuts, names, types).groupBy("sources", *names, name).agg(
            F.sum("size").alias("n"), F.count(F.lit(1)).alias("n_rows"))
        before = Window.partitionBy("sources", *names).orderBy(name).rowsBetween(
            Window.unboundedPreceding, -1)
        sizes = sizes.withColumn("below", F.coalesce(F.sum("n").over(before), F.lit(0)))
        names.append(name)
        types += f", {name} {rows.schema[name].dataType.simpleString()}"
        found = _with_cuts(sizes, open_cuts, names[:-1], types).where(
            "base + below <= cut and cut < base + below + n").select(
            "sources", *names, "base", "below", "cut", "n_rows").collect()
        open_cuts = [(tuple(r["sources"]), tuple(r[c] for c in names), r["base"] + r["below"],
                      r["cut"]) for r in found]
        if max(r["n_rows"] for r in found) <= edge_rows:
            break
    so_far = Window.partitionBy("sources", *names).orderBy(*KEY).rowsBetween(
        Window.unboundedPreceding, -1)
    ranked = _in_buckets(rows, open_cuts, names, types).withColumn(
        "below", F.coalesce(F.sum("size").over(so_far), F.lit(0)))
    found = _with_cuts(ranked, open_cuts, names, types).where(
        "base + below <= cut and cut < base + below + size").select(
        "sources", "cut", *KEY, F.expr("2 * (base + below) + size <= 2 * cut").alias("in")).collect()
    return {(tuple(r["sources"]), r["cut"]): (*(r[c] for c in KEY), 2 if r["in"] else 1)
            for r in found}


def _matching(rows: DataFrame, other: DataFrame, names: list[str], how: str) -> DataFrame:
    on = F.lit(True)
    for c in ("sources", *names):
        on = on & F.col(c).eqNullSafe(F.col("b_" + c))
    joined = rows.join(other, on, how)
    return joined if how == "left_semi" else joined.drop(*["b_" + c for c in ("sources", *names)])


def _ddl(names: list[str], types: str) -> str:
    own = "".join(f", b_{t.strip()}" for t in types.split(",") if t.strip().split(" ")[0] in names)
    return "b_sources array<string>" + own


def _in_buckets(rows: DataFrame, cuts: list[tuple], names: list[str], types: str) -> DataFrame:
    """The rows of the buckets that hold a cut."""
    buckets = sorted({(p, prefix) for p, prefix, _, _ in cuts}, key=repr)
    table = _small(rows.sparkSession, [(list(p), *prefix) for p, prefix in buckets],
                   _ddl(names, types))
    return _matching(rows, table, names, "left_semi")


def _with_cuts(rows: DataFrame, cuts: list[tuple], names: list[str], types: str) -> DataFrame:
    """Each row beside the cuts of its bucket: base (words before it) and cut."""
    table = _small(rows.sparkSession, [(list(p), *prefix, base, c) for p, prefix, base, c in cuts],
                   _ddl(names, types) + ", base long, cut long")
    return _matching(rows, table, names, "inner")


def _slices(flow: dict[tuple, dict], totals: dict[tuple, int]) -> dict[tuple, list[tuple]]:
    """Per pattern (place of the source, from, to) in words of one copy: the
    copies of the pattern lie behind one another, cut by source in order."""
    out: dict[tuple, list[tuple]] = {}
    for p, size in totals.items():
        out[p], at = [], 0
        for i, s in enumerate(p):
            end = at + flow.get(p, {}).get(s, 0)
            while at < end:
                lo = at % size
                hi = min(size, lo + end - at)
                out[p].append((i, lo, hi))
                at += hi - lo
    return out


def mix_documents(docs: DataFrame, sources: Column, keep: tuple[str, ...] = (),
                  weights: Sequence[int] = WEIGHTS, seed: str = SEED, copies: int = 2,
                  edge_rows: int = EDGE_ROWS) -> DataFrame:
    """``keep`` columns, doc_id, size, sources, taken (words the mix takes,
    whole copies) and, by the order of the sources, source_sizes, targets and
    taken_for (words taken on behalf of that source, which add up to taken).
    ``sources`` is the array of sources of a document (null elements count as
    a source)."""
    spark = docs.sparkSession
    no_source = F.array().cast("array<string>")
    small = written(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *keep, n_words(F.col("text")).alias("size"),
        F.array_sort(F.array_distinct(F.coalesce(sources.cast("array<string>"), no_source)))
        .alias("sources"),
        F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"))).alias("order"),
        F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("digest"),
        F.monotonically_increasing_id().alias("place")), "mix-sizes")
    totals = {tuple(r[0]): r[1] for r in small.groupBy("sources").agg(F.sum("size")).collect()}
    sizes: dict[str | None, int] = {}
    for p, size in totals.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + size
    target = source_targets(sizes, weights, cap=copies)
    flow = cheapest_flow({p: n for p, n in totals.items() if n},
                         {s: int(t) for s, t in target.items()}, copies)
    slices = _slices(flow, totals)
    cuts = find_cuts(small.select("sources", *KEY), [
        (list(p), c) for p, parts in slices.items() for c in {x for _, *ab in parts for x in ab}
        if 0 < c < totals[p]], edge_rows)
    # one row for each pattern, like the totals: broadcast, it moves no document
    plans = _small(spark, [
        (list(p), [(i, cuts.get((p, a)), cuts.get((p, b))) for i, a, b in parts],
         [sizes[s] for s in p], [float(target[s]) for s in p]) for p, parts in slices.items()],
        f"sources array<string>, slices array<struct<source:int,start:{_KEY_DDL},stop:{_KEY_DDL}>>, "
        "source_sizes array<long>, targets array<double>")
    own = F.struct(*[F.col(c) for c in KEY], F.lit(1).alias("past"))
    rows = small.select("doc_id", *keep, "size", "sources", own.alias("own")).join(plans, "sources")

    def copies_for(i: Column) -> Column:
        return F.size(F.filter("slices", lambda x: (x["source"] == i)
                               & (x["start"].isNull() | (F.col("own") >= x["start"]))
                               & (x["stop"].isNull() | (F.col("own") < x["stop"]))))

    taken_for = F.transform("sources", lambda s, i: F.col("size") * copies_for(i))
    return rows.withColumn("taken_for", taken_for).select(
        "doc_id", *keep, "size", "sources", "source_sizes", "targets", "taken_for",
        F.aggregate("taken_for", F.lit(0).cast("long"), lambda a, x: a + x).alias("taken"))


def mix_single(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The mix where each document stands in the one source of its column."""
    mixed = mix_documents(docs, F.array(F.col("source").cast("string")), keep)
    return mixed.select("doc_id", *keep, "size", F.col("source_sizes")[0].alias("source_size"),
                        F.col("targets")[0].alias("target"), "taken")
