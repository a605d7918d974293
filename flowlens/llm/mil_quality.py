"""Quality classifier by attention-based multiple-instance learning (operator 11).

A document is a bag of passages of ``PASSAGE`` words.  Every passage is
encoded: the mean of its words' feature vectors (shape of the word, signed
hashes of its letter trigrams), repetition within the passage, and a learned
tanh layer.  Gated attention, w . (tanh(V h) * sigmoid(U h)), softmax over the
bag, weighs the passages; the weighted sum is scored by a logistic unit.  All
of it is learned from document labels alone.

The fit uses at most ``SAMPLE`` labelled documents drawn by hash and, of
those, documents with at most ``LONGEST`` passages, ``PASSAGES`` together; the
sample is trained in one task.  Every whole text is scored, passage by passage
with a running softmax, so a long text is never held as features.

Defined cases: a null, empty or word-less text is one passage without words;
without any learning row every score is 0.5 and predicted 1; with one class
the scores stay near it; a document labelled several times is learned with the
mean of its labels; labels that are null or of a null id are not learned; a
null doc_id is scored and is not held out; repeated rows are scored once each
(learned once); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import batch, prepare, words, written
from flowlens.llm.window_runs import mix

SAMPLE = 6_144
PASSAGES = 32_768
LONGEST = 512
PASSAGE = 100
HASHED = 32
THRESHOLD = 0.3

_SHAPES = 16
_PARTS = 4
WIDTH = _SHAPES + HASHED + _PARTS
_SEGMENT = 1 << 20  # characters split into words at once


# --- passages --------------------------------------------------------------------

class WordTable:
    """Feature vectors of words, remembered up to ``limit`` words."""

    def __init__(self, limit: int = 150_000):
        self.limit = limit
        self.start()

    def start(self) -> None:
        self.place: dict[bytes, int] = {}
        self.rows = np.zeros((1 << 12, _SHAPES + HASHED), np.float32)

    def places(self, found: list[bytes]) -> np.ndarray:
        if len(self.place) > self.limit:
            self.start()
        place = self.place
        new = sorted(set(found).difference(place))
        if new:
            n = len(place)
            place.update(zip(new, range(n, n + len(new)), strict=True))
            if len(place) > len(self.rows):
                grown = np.zeros((max(len(place), 2 * len(self.rows)), _SHAPES + HASHED), np.float32)
                grown[:n] = self.rows[:n]
                self.rows = grown
            self.rows[n:len(place)] = word_features(new)
        return np.fromiter(map(place.__getitem__, found), np.int64, len(found))


_LETTER, _UPPER, _DIGIT, _KNOWN = 1, 2, 4, 8
_FLAGS = np.zeros(0x110000, np.uint8)  # filled for the characters met
_LOWER = np.arange(0x110000, dtype=np.uint32)


def _look_at(codes: np.ndarray) -> np.ndarray:
    for c in np.unique(codes[_FLAGS[codes] == 0]).tolist():
        x = chr(c)
        _FLAGS[c] = _KNOWN + _LETTER * x.isalpha() + _UPPER * x.isupper() + _DIGIT * x.isdigit()
        _LOWER[c] = ord(x.lower()[0])
    return _FLAGS[codes]


def word_features(found: list[bytes]) -> np.ndarray:
    """One row per word: its shape, then signed hashes of its letter trigrams."""
    texts = [w.decode("utf-8", "replace") for w in found]
    n = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer(f" {' '.join(texts)} ".encode("utf-32-le", "surrogatepass"), "<u4")
    start = np.cumsum(n + 1) - n
    flags = _look_at(codes)

    def total(x):  # the space behind a word adds nothing
        return np.add.reduceat(x.astype(np.int64), start)

    letters, upper = total(flags & _LETTER), total(flags & _UPPER) // _UPPER
    digits, wide = total(flags & _DIGIT) // _DIGIT, total(codes > 127)
    twice = np.append(False, codes[1:] == codes[:-1])
    marks = n - letters - digits
    first, last = flags[start], codes[start + n - 1]
    stop, comma = np.isin(last, [ord(c) for c in ".!?"]), last == ord(",")
    plain = (marks == 1) & np.isin(last, [ord(c) for c in ".,;:!?"])
    out = np.zeros((len(texts), _SHAPES + HASHED), np.float32)
    out[:, :_SHAPES] = np.stack([
        np.minimum(n, 30) / 10, upper / n, digits / n, marks / n, letters == 0, n == 1,
        (upper == letters) & (letters > 1), first & _UPPER > 0, marks > 1, marks > 2, stop, comma,
        (marks > 0) & ~plain, n > 20, total(twice) / n, wide / n], axis=1)
    owner = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(owner)) + np.repeat(start - (np.cumsum(n) - n), n)
    low = _LOWER[codes].astype(np.uint64)
    h = mix((low[at - 1] << np.uint64(42)) ^ (low[at] << np.uint64(21)) ^ low[at + 1])
    bucket = (h >> np.uint64(20)).astype(np.int64) % HASHED
    sign = 1.0 - 2.0 * (h >> np.uint64(50) & np.uint64(1)).astype(np.float64)
    out[:, _SHAPES:] = np.bincount(owner * HASHED + bucket, sign, len(n) * HASHED).reshape(-1, HASHED)
    return out


_TABLE = WordTable()


def passage_features(found: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """One row per passage; ``sizes`` words each, taken from ``found`` in turn
    (0: a passage without words)."""
    out = np.zeros((len(sizes), WIDTH), np.float32)
    full = np.flatnonzero(sizes)
    if not len(full):
        out[:, -1] = 1.0
        return out
    at = _TABLE.places(found)
    own = sizes[full]
    starts = np.cumsum(own) - own
    means = np.add.reduceat(_TABLE.rows[at], starts, axis=0) / own[:, None]
    out[full, :_SHAPES + HASHED] = means
    passage = np.repeat(np.arange(len(full)), own)
    key, counts = np.unique(passage * (int(at.max()) + 1) + at, return_counts=True)
    key = key // (int(at.max()) + 1)
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    out[full, -4] = np.diff(np.append(first, len(key))) / own  # different words
    out[full, -3] = np.maximum.reduceat(counts, first) / own  # share of the commonest
    again = np.append(False, at[1:] == at[:-1])
    again[starts] = False
    out[full, -2] = np.add.reduceat(again.astype(np.float32), starts) / own
    out[sizes == 0, -1] = 1.0
    return out


def segments(text: str | None):
    """The words of a text in pieces of about ``_SEGMENT`` characters, cut at
    white space; at least one piece."""
    text = text or ""
    lo = 0
    while True:
        hi = lo + _SEGMENT
        while hi < len(text) and text[hi] not in "\t\n\x0b\x0c\r ":
            hi += 1
        yield words(text[lo:hi])
        lo = hi
        if lo >= len(text):
            return


def passages_of(texts, most: int = 65_536):
    """(owner of each passage, features) of texts in order, about ``most``
    words at a time."""
    held: list[bytes] = []
    owner: list[int] = []
    sizes: list[int] = []
    for i, text in enumerate(texts):
        seen = False
        for found in segments(text):
            for lo in range(0, len(found), PASSAGE):
                part = found[lo:lo + PASSAGE]
                held += part
                owner.append(i)
                sizes.append(len(part))
                seen = True
                if len(held) >= most:
                    yield np.array(owner), passage_features(held, np.array(sizes))
                    held, owner, sizes = [], [], []
        if not seen:
            owner.append(i)
            sizes.append(0)
    if owner:
        yield np.array(owner), passage_features(held, np.array(sizes))


# --- the network -------------------------------------------------------------------

HIDDEN, ATTENTION = 24, 12


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def encode(model: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Encoded passages, both halves of the gate, and attention logits."""
    h = np.tanh(((x - model["mean"]) / model["scale"]) @ model["E"] + model["e"])
    t, g = np.tanh(h @ model["V"]), _sigmoid(h @ model["U"])
    return h, t, g, (t * g) @ model["w"]


def train(x: np.ndarray, bag: np.ndarray, label: np.ndarray, steps: int = 200, rate: float = 0.02,
          decay: float = 1e-4, seed: int = 11) -> dict:
    """Full-batch Adam on the log loss of the bags; ``bag`` (sorted) is the
    bag of each passage, label in [0, 1]."""
    rng = np.random.Generator(np.random.Philox(seed))
    n = len(label)
    model = {"mean": x.mean(0), "scale": np.maximum(x.std(0), 1e-3)}
    rate_of_one = float(np.clip(label.mean(), 1e-3, 1 - 1e-3))
    p = {"E": rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), "e": np.zeros(HIDDEN),
         "V": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, ATTENTION)),
         "U": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, ATTENTION)),
         "w": rng.normal(0, ATTENTION ** -0.5, ATTENTION), "c": np.zeros(HIDDEN),
         "b": np.array([np.log(rate_of_one / (1 - rate_of_one))])}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    z = ((x - model["mean"]) / model["scale"]).astype(np.float32)
    starts = np.searchsorted(bag, np.arange(n))
    m1 = {k: np.zeros_like(v) for k, v in p.items()}
    m2 = {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, steps + 1):
        h, t, g, logit = encode({**p, "mean": 0.0, "scale": 1.0}, z)
        a = np.exp(logit - np.maximum.reduceat(logit, starts)[bag])
        a /= np.add.reduceat(a, starts)[bag]
        rep = np.add.reduceat(a[:, None] * h, starts, axis=0)
        score = _sigmoid(rep @ p["c"] + p["b"][0])
        d_out = ((score - label) / n).astype(np.float32)
        d_rep = d_out[:, None] * p["c"]
        d_a = (d_rep[bag] * h).sum(1)
        d_logit = a * (d_a - np.add.reduceat(a * d_a, starts)[bag])
        d_gate = d_logit[:, None] * p["w"]
        d_t, d_g = d_gate * g * (1 - t * t), d_gate * t * g * (1 - g)
        d_h = (a[:, None] * d_rep[bag] + d_t @ p["V"].T + d_g @ p["U"].T) * (1 - h * h)
        grad = {"E": z.T @ d_h, "e": d_h.sum(0), "V": h.T @ d_t, "U": h.T @ d_g,
                "w": (t * g).T @ d_logit, "c": rep.T @ d_out, "b": np.array([d_out.sum()])}
        for k, v in p.items():
            own = grad[k] + decay * v * (k not in ("b", "e"))
            m1[k] = 0.9 * m1[k] + 0.1 * own
            m2[k] = 0.999 * m2[k] + 0.001 * own * own
            lift = np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            p[k] = (v - rate * lift * m1[k] / (np.sqrt(m2[k]) + 1e-8)).astype(np.float32)
    return {**model, **p}


def score_texts(model: dict, texts: list[str | None]) -> np.ndarray:
    """Score of each text: attention over all its passages, softmax kept as
    running maximum, weight and weighted sum."""
    n = len(texts)
    top = np.full(n, -np.inf)
    weight, rep = np.zeros(n), np.zeros((n, HIDDEN))
    for owner, x in passages_of(texts):
        h, _, _, logit = encode(model, x)
        logit = logit.astype(np.float64)
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        who = owner[starts]
        high = np.maximum(top[who], np.maximum.reduceat(logit, starts))
        old = np.exp(top[who] - high)
        a = np.exp(logit - np.repeat(high, np.diff(np.append(starts, len(owner)))))
        weight[who] = weight[who] * old + np.add.reduceat(a, starts)
        rep[who] = rep[who] * old[:, None] + np.add.reduceat(a[:, None] * h, starts, axis=0)
        top[who] = high
    return _sigmoid((rep / weight[:, None]) @ model["c"].astype(np.float64) + float(model["b"][0]))


# --- Spark -------------------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    """True where crc32 of the decimal id mod 5 is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _draw() -> Column:
    return F.xxhash64(F.lit(11), F.col("doc_id"), F.col("text"))


def learning_bags(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(draw, label, n passages, features flat) of at most ``sample`` labelled
    documents that are not held out."""
    # at most `sample` ids and `sample` rows are broadcast
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("quality").cast("double").alias("label")).where(
        F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    ids = ids.groupBy("doc_id").agg(F.avg("label").alias("label")).orderBy(
        F.xxhash64(F.lit(5), F.col("doc_id")), "doc_id").limit(sample)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    chosen = base.join(F.broadcast(ids), "doc_id").select(
        _draw().alias("draw"), "label").distinct().orderBy("draw").limit(sample)
    picked = base.join(F.broadcast(ids.select("doc_id")), "doc_id").withColumn(
        "draw", _draw()).join(F.broadcast(chosen), "draw").select("draw", "label", "text")
    schema = pa.schema([("draw", pa.int64()), ("label", pa.float64()), ("n", pa.int64()),
                        ("x", pa.binary())])

    def run(batches):
        for b in batches:
            for i, text in enumerate(b.column(2).to_pylist()):
                parts, n = [], 0
                for _, x in passages_of([text]):
                    n += len(x)
                    parts = [*parts, x] if n <= LONGEST else []
                if parts:
                    yield batch(schema, b.column(0).slice(i, 1), b.column(1).slice(i, 1), [n],
                                [np.concatenate(parts).astype(np.float32).tobytes()])

    return picked.mapInArrow(run, "draw long, label double, n long, x binary")


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE,
          passages: int = PASSAGES) -> dict | None:
    """The trained network (a few thousand numbers); None if nothing is labelled."""
    prepare(docs.sparkSession)
    bags = written(learning_bags(docs, labels, sample), "mil-bags")
    order = Window.orderBy("draw").rowsBetween(Window.unboundedPreceding, 0)  # <= sample rows
    within = bags.select("draw", "n").distinct().withColumn("upto", F.sum("n").over(order)).where(
        F.col("upto") <= passages).select("draw")

    def fit(t: pa.Table) -> pa.Table:
        t = t.sort_by("draw")
        draw = t.column("draw").to_numpy()
        rows = np.flatnonzero(np.append(True, draw[1:] != draw[:-1]))  # repeated rows: once
        raw = t.column("x")
        n = t.column("n").to_numpy()[rows]
        x = np.concatenate([np.frombuffer(raw[i].as_py(), np.float32).reshape(-1, WIDTH)
                            for i in rows.tolist()])
        model = train(x, np.repeat(np.arange(len(rows)), n), t.column("label").to_numpy()[rows])
        return pa.table({"model": pa.array([pickle.dumps(model)], pa.binary())})

    row = bags.join(F.broadcast(within), "draw").withColumn("one", F.lit(1)).groupBy(
        "one").applyInArrow(fit, "model binary").first()
    return pickle.loads(row[0]) if row else None


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
            sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    model = learn(docs, labels, sample)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            score = score_texts(model, texts) if model else np.full(len(texts), 0.5)
            yield batch(schema, b.column(0), score)

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
