"""Embedding near-duplicates with product quantisation (operator 7).

Equal vectors of a label are folded into classes first.  A coarse codebook
(spherical k-means) gives every class an inverted list; the residual is coded
in ``SUBSPACES`` parts of 256 codewords.  Each class probes every list of its
label that can hold a linked entry (at least the ``probes`` nearest): a list is
left out only if its angular radius, or the plane that parts it from the
class's own list, puts all its entries below the threshold.  An asymmetric
table lookup estimates the cosine to every entry, and since the coding error
of an entry is known, an entry whose estimate plus error stays below the
threshold cannot link; the others are reranked by the exact cosine in double
precision.  So every pair is found.  Codebooks are fitted on at most
``SAMPLE`` classes; every class is indexed and probes.

Neighbouring small lists of a label share a part, so that a class goes to a
part once, not to each list.  Parts are dealt out in blocks of at most about
``BLOCK`` entries and queries, so a large list is many tasks.  A block hands on link counts and a spanning forest,
never all pairs.  Lists are probed from the lower list's side only; a pair
found there counts for both sides.

The codebook is that of the most frequent length.  Vectors of another length
link within their label and length; they are compared block by block without
codes (list number: minus the length).

Defined cases: null labels, and vectors that are null, empty, zero, or hold
null or non-finite components, link with nothing; a repeated row is a vector of its own; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from flowlens.llm.common import Forest, components, prepare, written

SAMPLE = 16_384
SUBSPACES = 8
CODES = 256
BLOCK = 4096
#: Nearest lists that are probed even if their bounds rule out a link.
PROBES = 24


def _kmeans(x: np.ndarray, k: int, spherical: bool, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(11)
    centers = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, centers)
        for j in range(len(centers)):
            own = x[near == j]
            if len(own):
                centers[j] = own.mean(0)
        if spherical:
            centers /= np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)
    return centers


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    half = (centers ** 2).sum(1) / 2
    return np.concatenate([(x[i:i + 4096] @ centers.T - half).argmax(1)
                           for i in range(0, len(x), 4096)] or [np.zeros(0, np.int64)])


class Codebook:
    """Coarse centers and residual codewords over unit vectors."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.dim = sample.shape[1]
        self.width = -(-self.dim // SUBSPACES)
        self.coarse = _kmeans(sample, lists, True)
        rest = self._parts(sample - self.coarse[_nearest(sample, self.coarse)])
        self.words = [_kmeans(rest[:, m], CODES, False) for m in range(SUBSPACES)]

    def _parts(self, x: np.ndarray) -> np.ndarray:
        pad = self.width * SUBSPACES - self.dim
        return np.pad(x, ((0, 0), (0, pad))).reshape(len(x), SUBSPACES, self.width)

    def encode(self, x: np.ndarray):
        """List, codes and coding error of unit vectors."""
        own = _nearest(x, self.coarse)
        rest = self._parts(x - self.coarse[own])
        codes = np.stack([_nearest(rest[:, m], w) for m, w in enumerate(self.words)], 1)
        err = rest - np.stack([w[codes[:, m]] for m, w in enumerate(self.words)], 1)
        return own, codes.astype(np.uint8), np.sqrt((err ** 2).sum((1, 2)))

    def angles(self, x: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(x @ self.coarse.T, -1, 1))

    def probes(self, x: np.ndarray, own: np.ndarray, n: int, threshold: float,
               radii: np.ndarray) -> np.ndarray:
        """Whether each of the unit vectors probes each list: the ``n`` nearest
        and all that can hold an entry with a cosine of ``threshold`` or more.
        ``radii`` has the smallest and largest angle of each list's entries
        to its center."""
        reach = np.arccos(np.clip(threshold, -1, 1)) + 1e-6
        angle = self.angles(x)
        can = (angle - radii[:, 1] <= reach) & (radii[:, 0] - angle <= reach)
        if threshold >= 0:
            # an entry is nearer to its own center than to this vector's
            cos = x @ self.coarse.T
            gap = np.sqrt(np.maximum(2 - 2 * self.coarse @ self.coarse.T, 0))
            plane = cos[np.arange(len(x)), own][:, None] - cos <= np.sin(reach) * gap[own] + 1e-6
            odd = np.abs(np.linalg.norm(self.coarse, axis=1) - 1) > 1e-6
            can &= plane | odd | odd[own][:, None]
        near = np.argsort(angle, axis=1, kind="stable")[:, :n]
        can[np.arange(len(x))[:, None], near] = True
        return can

    def estimate(self, q: np.ndarray, own: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Estimated cosines of queries to coded entries of the lists ``own``."""
        parts = self._parts(q)
        out = (q @ self.coarse.T)[:, own]
        for m, w in enumerate(self.words):
            out += (parts[:, m] @ w.T)[:, codes[:, m]]
        return out


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=0)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def can_link() -> Column:
    """False (never null) for rows that link with nothing."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull()
                      & finite & F.exists(v, lambda x: x != 0), F.lit(False))


_ROW_TYPES = pa.schema([
    ("label", pa.int64()), ("part", pa.int64()), ("query", pa.bool_()), ("rep", pa.int64()),
    ("n", pa.int64()), ("list", pa.int64()), ("err", pa.float64()), ("codes", pa.binary()),
    ("vec", pa.binary())])
_ROW = ("label long, part long, query boolean, rep long, n long, list long, err double, "
        "codes binary, vec binary")
_LINK_TYPES = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])


def _index_rows(classes: DataFrame, book: Codebook, dtype: str, width: int) -> DataFrame:
    """An entry row of each class, with its angle to the center of its list;
    ``width`` lists are a part."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            vectors = [np.array(v, dtype=np.float64) for v in b.column(2).to_pylist()]
            sizes = np.array([len(v) for v in vectors])
            usual = sizes == book.dim
            own, err, angle = -sizes, np.zeros(len(sizes)), np.zeros(len(sizes))
            codes = [b""] * len(sizes)
            if usual.any():
                x = unit(np.stack([v for v, u in zip(vectors, usual, strict=True) if u]))
                own[usual], found, err[usual] = book.encode(x)
                angle[usual] = book.angles(x)[np.arange(len(x)), own[usual]]
                for i, c in zip(np.flatnonzero(usual).tolist(), found, strict=True):
                    codes[i] = c.tobytes()
            cols = [b.column(1), pa.array(np.where(usual, own // width, own)),
                    pa.array(np.zeros(len(own), bool)), b.column(0), b.column(3), pa.array(own),
                    pa.array(err), pa.array(codes, pa.binary()),
                    pa.array([v.astype(dtype).tobytes() for v in vectors], pa.binary()),
                    pa.array(angle)]
            yield pa.RecordBatch.from_arrays(
                cols, schema=_ROW_TYPES.append(pa.field("angle", pa.float64())))

    return classes.select("rep", F.col("label").cast("long"), "embedding", "n").mapInArrow(
        run, f"{_ROW}, angle double")


def _query_rows(index: DataFrame, book: Codebook, dtype: str, width: int, probes: int,
                threshold: float, radii: np.ndarray) -> DataFrame:
    """A query row of each class in each part with lists that it probes, from
    its own list on; ``codes`` has one bit for each list of the part."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            usual = pc.greater_equal(b.column(5), 0)
            other = b.filter(pc.invert(usual))
            if other.num_rows:  # they meet all of their length and label
                yield pa.RecordBatch.from_arrays(
                    [*other.columns[:2], pa.array(np.ones(other.num_rows, bool)),
                     *other.columns[3:]], schema=_ROW_TYPES)
            b = b.filter(usual)
            if not b.num_rows:
                continue
            own = b.column(5).to_numpy()
            x = unit(np.stack([np.frombuffer(v, dtype) for v in b.column(8).to_pylist()])
                     .astype(np.float64))
            near = book.probes(x, own, probes, threshold, radii)
            near &= np.arange(near.shape[1]) >= own[:, None]
            near = np.pad(near, ((0, 0), (0, -near.shape[1] % width)))
            near = near.reshape(len(x), -1, width)
            pick, part = np.nonzero(near.any(2))
            for at in range(0, len(pick), 8192):
                i, j = pick[at:at + 8192], part[at:at + 8192]
                cols = [c.take(pa.array(i)) for c in b.columns]
                cols[1] = pa.array(j)
                cols[2] = pa.array(np.ones(len(i), bool))
                cols[7] = pa.array([c.tobytes() for c in np.packbits(near[i, j], axis=1)],
                                   pa.binary())
                yield pa.RecordBatch.from_arrays(cols, schema=_ROW_TYPES)

    return index.select(*_ROW_TYPES.names).mapInArrow(run, _ROW)


def _search(book: Codebook, threshold: float, dtype: str, width: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("list")  # queries of a list probe much the same lists
        is_query = t.column("query").to_numpy()
        q, e = t.filter(pa.array(is_query)), t.filter(pa.array(~is_query))
        if not q.num_rows or not e.num_rows:
            return _LINK_TYPES.empty_table()

        def col(x, c):
            return x.column(c).to_numpy()

        def matrix(x, c, dtype):
            return np.stack([np.frombuffer(v, dtype) for v in x.column(c).to_pylist()])

        e_vec = unit(matrix(e, "vec", dtype).astype(np.float64))
        q_vec = unit(matrix(q, "vec", dtype).astype(np.float64))
        q_rep, e_rep, q_n, e_n = col(q, "rep"), col(e, "rep"), col(q, "n"), col(e, "n")
        q_list, e_list, e_err = col(q, "list"), col(e, "list"), col(e, "err")
        coded = e_list[0] >= 0
        if coded:
            codes = matrix(e, "codes", np.uint8)
            asked = np.unpackbits(matrix(q, "codes", np.uint8), axis=1)[:, e_list % width] > 0
        counts: dict[int, int] = {}
        forest, edges = Forest(), []
        for at in range(0, len(q_rep), 256):
            part = slice(at, at + 256)
            if coded:
                some = np.flatnonzero(asked[part].any(0))
                est = book.estimate(q_vec[part], e_list[some], codes[some])
                i, j = np.nonzero(asked[part][:, some] & (est + e_err[some] >= threshold - 1e-6))
                j = some[j]
            else:
                i, j = np.nonzero(q_vec[part] @ e_vec.T >= threshold - 1e-6)
            i += at
            exact = np.concatenate([np.zeros(0, bool)] + [
                (q_vec[i[k:k + 65536]] * e_vec[j[k:k + 65536]]).sum(1) >= threshold
                for k in range(0, len(i), 65536)])
            i, j = i[exact], j[exact]
            other = q_rep[i] != e_rep[j]
            i, j = i[other], j[other]
            # within a list the entry finds this query itself
            alone = q_list[i] != e_list[j]
            for rep, n in ((q_rep[i], e_n[j]), (e_rep[j[alone]], q_n[i[alone]])):
                ids, place = np.unique(rep, return_inverse=True)
                for r, c in zip(ids.tolist(), np.bincount(place, n).astype(int).tolist(),
                                strict=True):
                    counts[r] = counts.get(r, 0) + c
            for a, b in zip(q_rep[i].tolist(), e_rep[j].tolist(), strict=True):
                if forest.join(a, b):
                    edges.append((a, b))
        rows = [(r, None, c) for r, c in counts.items()] + [(a, b, 0) for a, b in edges]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                                    if rows else [pa.array([], pa.int64())] * 3,
                                    schema=_LINK_TYPES)

    return run


def embedding_groups(rows: DataFrame, threshold: float = 0.93, probes: int = PROBES,
                     lists: int | None = None, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    spark = rows.sparkSession
    prepare(spark, 1024)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    plain = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"),
                        F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    valid = rows.where(can_link())
    classes = written(valid.groupBy("label", "embedding").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")), "vector-classes")
    size = classes.groupBy(F.size("embedding").alias("d")).count().orderBy(
        F.desc("count"), "d").first()
    if size is None:
        return plain
    n = size["count"]
    drawn = classes.where(F.size("embedding") == size["d"]).orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("embedding").collect()
    sample = unit(np.array([r[0] for r in drawn], dtype=np.float64))
    book = Codebook(sample, lists or int(min(1024, max(16, 2 ** round(np.log2(n ** 0.5))))))
    dtype = "<f4" if rows.schema["embedding"].dataType.elementType == FloatType() else "<f8"
    n_labels = classes.agg(F.count_distinct("label")).first()[0]
    width = min(len(book.coarse), max(1, len(book.coarse) * block * n_labels // n))
    index = written(_index_rows(classes, book, dtype, width), "vector-index")
    radii = np.array([[np.inf, -np.inf]] * len(book.coarse))  # an empty list is out of reach
    for r in index.where("list >= 0").groupBy("list").agg(F.min("angle"), F.max("angle")).collect():
        radii[r[0]] = r[1:]
    index = index.drop("angle").union(
        _query_rows(index, book, dtype, width, probes, threshold, radii))
    parts = index.groupBy("label", "part").agg(
        F.ceil(F.count_if(~F.col("query")) / block).alias("blocks"),
        F.ceil(F.count_if(F.col("query")) / block).alias("turns")).where("blocks > 0")
    spread = F.when(F.col("query"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)) \
        .otherwise(F.array(F.pmod(F.xxhash64("rep"), "blocks")))
    turns = F.when(F.col("query"), F.array(F.pmod(F.xxhash64("rep"), "turns"))) \
        .otherwise(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("turns"), F.lit(1)) - 1))
    dealt = (index.join(parts, ["label", "part"])
             .withColumn("block", F.explode(spread)).withColumn("turn", F.explode(turns)))
    found = written(dealt.select(*_ROW_TYPES.names, "block", "turn").groupBy(
        "label", "part", "block", "turn").applyInArrow(
            _search(book, threshold, dtype, width), "a long, b long, links long"), "vector-links")
    links = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    label = components(found.where("b is not null").select("a", "b"))
    named = (classes.join(links, classes.rep == links.a, "left")
             .join(label, classes.rep == label.node, "left")
             .select(classes.label, classes.embedding,
                     (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
                     F.coalesce("component", "rep").alias("component")))
    keyed = valid.select("vec_id", "label", "embedding")
    linked = keyed.join(named, ["label", "embedding"]).select(
        "vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    rest = rows.where(~can_link())
    return linked.select("vec_id", "n_links", "component_id",
                         (F.col("vec_id") == F.col("component_id")).alias("kept")).union(
        rest.select("vec_id", F.lit(0).cast("long"), F.col("vec_id"), F.lit(True)))
