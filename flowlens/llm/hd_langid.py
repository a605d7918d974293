"""Language ID with hyperdimensional profiles (operator 8).

Every letter has a seeded random vector of +1/-1.  A trigram vector binds
(multiplies) its letters' vectors, rotated by their place; a text vector
bundles (adds) the vectors of all its trigrams; a language prototype bundles
the unit text vectors of its learning documents.  A text goes to the language
with the largest cosine.

Prototypes are learned from at most about ``sample_per_lang`` documents per
language, drawn by a hash of doc_id; everything else covers every row.

Defined cases: null or letter-less text gives ``und`` with score 0; without
any learning row every text is ``und``; equal cosines go to the language first
by code point; a null doc_id is not learned from and is not held out; repeated
rows are returned once each; columns beyond doc_id, text, lang are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from flowlens.llm.common import batch, prepare

DIM = 1024
SAMPLE_PER_LANG = 4000
_DENSE = 1 << 22  # up to here trigram numbers are looked up in a flat table


@functools.lru_cache(maxsize=8192)
def _letter(code: int, dim: int) -> np.ndarray:
    rng = np.random.Generator(np.random.Philox(key=code + 1))
    return (rng.integers(0, 2, dim, dtype=np.int8) * 2 - 1).astype(np.int8)


@functools.cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter; digits, fractions, Roman numerals
    and the like are not."""
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def _codes(text: str | None) -> np.ndarray:
    """Code points of the lower-cased letters, runs of others as one space,
    with a space at both ends; empty if there is no letter."""
    lower = f" {text.lower()} " if text else ""
    codes = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, "<u4")
    keep = letter.copy()
    keep[:-1] |= letter[1:]  # of a run of others its last one stays, as a space
    keep[-1] = True
    return np.where(letter, codes, np.uint32(ord(" ")))[keep]


def text_vectors(texts: list[str | None], dim: int = DIM) -> np.ndarray:
    """Unit text vectors, float32, zero where a text has no letters."""
    out = np.zeros((len(texts), dim), np.float32)
    codes = [_codes(t) for t in texts]
    full = [i for i, c in enumerate(codes) if len(c)]
    if not full:
        return out
    letters, flat = np.unique(np.concatenate([codes[i] for i in full]), return_inverse=True)
    base = np.array([_letter(int(c), dim) for c in letters], dtype=np.int8)
    a = len(letters)
    at = np.cumsum([0] + [len(codes[i]) for i in full])
    flat = flat.astype(np.int64)
    grams = flat[:-2] * a * a + flat[1:-1] * a + flat[2:]
    keep = np.ones(len(grams), bool)  # trigrams that reach into the next text
    for end in at[1:-1]:
        keep[end - 2:end] = False
    owner = np.repeat(np.arange(len(full)), np.diff(at))[:len(grams)][keep]
    grams = grams[keep]
    if a ** 3 <= _DENSE:
        there = np.flatnonzero(np.bincount(grams, minlength=a ** 3))
        place = np.zeros(a ** 3, np.int64)
        place[there] = np.arange(len(there))
        idx = place[grams]
    else:
        there, idx = np.unique(grams, return_inverse=True)
    two, one = np.roll(base, 2, axis=1), np.roll(base, 1, axis=1)
    vec = np.zeros((len(full), dim), np.float32)
    bounds = np.searchsorted(owner, np.arange(len(full) + 1))
    for lo in range(0, len(there), 4096):  # trigram vectors in blocks: bounded memory
        part = there[lo:lo + 4096]
        bound = (two[part // (a * a)] * one[part // a % a] * base[part % a]).astype(np.float32)
        counts = np.zeros((len(full), len(part)), np.float32)
        for j in range(len(full)):
            own = idx[bounds[j]:bounds[j + 1]]
            own = own[(own >= lo) & (own < lo + len(part))] - lo if len(there) > 4096 else own
            counts[j] = np.bincount(own, minlength=len(part))
        vec += counts @ bound
    norm = np.linalg.norm(vec, axis=1, keepdims=True)
    out[full] = np.divide(vec, norm, out=np.zeros_like(vec), where=norm > 0)
    return out


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the decimal id mod 3 is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def learn_prototypes(docs: DataFrame, dim: int = DIM,
                     sample_per_lang: int = SAMPLE_PER_LANG) -> dict[str, np.ndarray]:
    """Unit prototype per learned language; ``dim`` numbers for each language
    are all that reaches the driver."""
    spark = docs.sparkSession
    prepare(spark)
    known = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
        & ~held_out(F.col("doc_id")))
    counts = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items())
                           for x in (lang, min(1.0, sample_per_lang / n))])
    draw = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 20)) / float(1 << 20)
    sample = known.where(draw < F.element_at(share, F.col("lang")))
    schema = pa.schema([("lang", pa.string()), ("v", pa.list_(pa.float64()))])

    def bundle(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            vec = text_vectors(b.column(0).to_pylist(), dim).astype(np.float64)
            langs = np.array(b.column(1).to_pylist(), dtype=object)
            for lang in set(langs.tolist()):
                sums[lang] = sums.get(lang, 0) + vec[langs == lang].sum(0)
        yield batch(schema, list(sums), [v.tolist() for v in sums.values()])

    part = sample.select("text", "lang").mapInArrow(bundle, "lang string, v array<double>")
    total = part.select("lang", F.posexplode("v")).groupBy("lang", "pos").agg(
        F.sum(F.round("col", 6).cast("decimal(28,6)")).alias("x"))  # order of tasks has no effect
    proto: dict[str, np.ndarray] = {}
    for r in total.collect():
        proto.setdefault(r["lang"], np.zeros(dim))[r["pos"]] = float(r["x"])
    return {k: v / n for k, v in sorted(proto.items()) if (n := np.linalg.norm(v)) > 0}


def predict_language(docs: DataFrame, prototypes: dict[str, np.ndarray],
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) from the text alone; ``keep`` names
    columns passed on."""
    prepare(docs.sparkSession)
    names = list(prototypes)
    dim = len(next(iter(prototypes.values()))) if names else DIM
    matrix = np.array([prototypes[n] for n in names]).reshape(len(names), dim).astype(np.float32)
    base = docs.select("text", *[c for c in ("doc_id", *keep) if c != "text"])
    out_schema = StructType([*base.schema.fields, StructField("lang_pred", StringType()),
                             StructField("score", DoubleType())])

    def run(batches):
        for b in batches:
            vec = text_vectors(b.column(0).to_pylist(), dim)
            n = len(vec)
            lang, score = np.full(n, "und", dtype=object), np.zeros(n)
            if names:
                cos = (vec @ matrix.T).astype(np.float64)
                best, some = cos.argmax(1), vec.any(axis=1)
                lang[some] = np.array(names, dtype=object)[best[some]]
                score[some] = np.clip(cos[some, best[some]], 0.0, 1.0)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(lang.tolist(), pa.string()), pa.array(score, pa.float64())],
                names=[*b.schema.names, "lang_pred", "score"])

    return base.mapInArrow(run, out_schema)


def language_id(docs: DataFrame, dim: int = DIM, sample_per_lang: int = SAMPLE_PER_LANG,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Learn on the documents that are not held out, predict every document."""
    proto = learn_prototypes(docs, dim, sample_per_lang)
    return predict_language(docs, proto, keep).withColumn("held_out", held_out(F.col("doc_id")))
