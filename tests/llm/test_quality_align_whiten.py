"""Operators 11 to 13 against brute force, and their edge cases."""

import bisect
import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from conftest import SF001, SF01
from flowlens.llm import mil_quality, qd_whiten, token_align
from flowlens.llm.queries import QUERIES

A_JSON = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
B_MODEL = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()


# --- operator 11 -------------------------------------------------------------------

def test_quality_on_held_out_documents(spark):
    got = QUERIES["op11_mil_quality"](spark, SF01)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"),
                          ("predicted", "int")]
    rows = {r[0]: r for r in got.collect()}
    n = spark.read.parquet(f"{SF01}/documents.parquet").count()
    assert len(rows) == n
    labels = [(r["doc_id"], r["quality"]) for r in
              spark.read.parquet(f"{SF01}/labels.parquet").collect()]
    held = [(q, rows[d]) for d, q in labels if rows[d]["held_out"]]
    assert len(held) > 40
    right = np.mean([q == r["predicted"] for q, r in held])
    assert right > 0.93
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows.values())


def _by_hand(model, text):
    """The network on all passages of a text at once."""
    words = (text or "").encode().split()
    parts = [words[i:i + mil_quality.PASSAGE] for i in range(0, len(words), mil_quality.PASSAGE)] or [[]]
    x = np.concatenate([mil_quality.passage_features(p, np.array([len(p)])) for p in parts])
    h = np.tanh((x - model["mean"]) / model["scale"] @ model["E"] + model["e"])
    logit = (np.tanh(h @ model["V"]) / (1 + np.exp(-(h @ model["U"])))) @ model["w"]
    a = np.exp(logit - logit.max())
    z = (a / a.sum()) @ h @ model["c"] + model["b"][0]
    return 1 / (1 + np.exp(-z))


def test_scores_follow_the_definition():
    rng = np.random.default_rng(3)
    random.seed(3)
    vocab = [f"w{i}" for i in range(50)] + ["XX!!", "é,", "12", "|"]
    texts = [" ".join(random.choices(vocab, k=random.randrange(0, 700))) for _ in range(40)]
    texts += [None, "", " \n", "a" * 5000, " ".join(vocab * 3000)]
    model = mil_quality.train(np.concatenate([x for _, x in mil_quality.passages_of(texts)]),
                              np.concatenate([o for o, _ in mil_quality.passages_of(texts)]),
                              rng.integers(0, 2, len(texts)).astype(float), steps=30)
    for n in (len(texts), 1):
        got = np.concatenate([mil_quality.score_texts(model, texts[i:i + n])
                              for i in range(0, len(texts), n)])
        assert np.allclose(got, [_by_hand(model, t) for t in texts], atol=1e-5)


def test_attention_finds_the_bad_passage():
    """One bad passage of many marks the document; its weight is the largest."""
    random.seed(4)
    good = [f"word{i}" for i in range(60)]

    def text(bad):
        parts = [" ".join(random.choices(good, k=100)) for _ in range(random.randrange(2, 6))]
        if bad:
            parts[random.randrange(len(parts))] = " ".join(random.choices(["$$$", "%%%", "###"], k=100))
        return " ".join(parts)

    label = np.array([i % 2 for i in range(160)], float)
    texts = [text(y == 0) for y in label]
    owner, x = (np.concatenate(v) for v in zip(*mil_quality.passages_of(texts)))
    model = mil_quality.train(x, owner, label)
    fresh = [text(i % 2 == 0) for i in range(40)]
    score = mil_quality.score_texts(model, fresh)
    assert ((score >= 0.3) == (np.arange(40) % 2 == 1)).mean() > 0.95


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, "a b", "x", 0), (1, "a b", "x", 0), (None, "c", None, 1), (3, None, None, None),
         (4, "", None, 1), (5, "k " * 60_000, None, 1)], "doc_id long, text string, label string, quality int")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (4, None), (77, 0)],
                                   "doc_id long, quality int")
    got = mil_quality.quality(docs, labels).collect()
    assert collections.Counter(r[0] for r in got) == {1: 2, None: 1, 3: 1, 4: 1, 5: 1}
    assert all(0 <= r["score"] <= 1 for r in got)
    none = mil_quality.quality(docs, labels.limit(0)).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.5, 1)}
    assert mil_quality.quality(docs.limit(0), labels).collect() == []


# --- operator 12 -------------------------------------------------------------------

def _whole_text(voc, text):
    """Both encodings of the whole text, groups by common ends, all pairs."""
    if not text:
        return 0, 0, 0, 0, "", {}
    s = " " + text
    ids = [voc.a.encode(s, add_special_tokens=False).ids, voc.b.encode(text)]
    tokens = [[t[i] for i in x] for t, x in zip((voc.a_bytes, voc.b_bytes), ids)]
    if any(b"".join(t) != s.encode() for t in tokens):
        return 0, 0, 0, 0, "", {}
    ends = [np.cumsum([len(x) for x in t]).tolist() for t in tokens]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    groups = [collections.defaultdict(list), collections.defaultdict(list)]
    for g, x, e in zip(groups, ids, ends):
        for i, end in zip(x, e):
            g[bisect.bisect_left(cuts, end)].append(i)
    links = collections.Counter(a << 32 | b for k in range(len(cuts))
                                for a in groups[0][k] for b in groups[1][k])
    spelled = ";".join(",".join(map(str, groups[0][k])) + "|" + ",".join(map(str, groups[1][k]))
                       for k in range(len(cuts)))
    return (len(ids[0]), len(ids[1]), len(cuts), links.total(),
            hashlib.sha256(spelled.encode()).hexdigest(), dict(links))


def test_pieces_align_like_whole_texts():
    voc = token_align.vocabularies(A_JSON, B_MODEL)
    random.seed(1)
    alphabet = " \t\n\r\x0b\x1c\x85\xa0　   ab'stZé1²½́😀!_-中;{}).,▁<>|the ing"
    texts = ["".join(random.choices(alphabet, k=random.randrange(16))) for _ in range(4000)]
    texts += ["<|endoftext|> x", "a<s></s>", "<unk>", "<0x0A>", " ", "  ", "a ", "\n", "x" * 3000,
              "中" * 300, None, "a▁b c d"]
    for t, got in zip(texts, token_align.align_texts(texts, voc)):
        exp = _whole_text(voc, t)
        assert got[:5] == exp[:5], t
        assert dict(zip(got[5].tolist(), got[6].tolist())) == exp[5], t


def test_texts_of_a_batch_are_summed_together():
    """More pieces than are encoded at once, repeats, pieces with pairs that
    occur more than once, and texts without tokens between the others; pairs
    come summed in ascending order."""
    voc = token_align.Vocabularies(A_JSON, B_MODEL)
    random.seed(3)
    words = ["".join(random.choices("etaoinsré", k=random.randrange(1, 12))) for _ in range(1500)]
    long = "na" * 60 + " " + "!?" * 40
    texts = [" ".join(random.choices(words, k=random.randrange(1, 400))) for _ in range(40)]
    texts = ["\u2460 no", *texts[:20], None, "a\u2581b " + texts[0], "", long + " " + texts[1], *texts, long]
    for _ in range(2):  # the second time all pieces are remembered
        empty = 0
        for t, got in zip(texts, token_align.align_texts(texts, voc), strict=True):
            exp = _whole_text(voc, t)
            assert got[:5] == exp[:5], t
            assert list(zip(got[5].tolist(), got[6].tolist())) == sorted(exp[5].items()), t
            empty += not got[0]
        assert empty >= 2
    assert token_align.align_texts([None, ""], voc)[1][:5] == (0, 0, 0, 0, "")
    assert token_align.align_texts([], voc) == []


@pytest.mark.parametrize("hot", [token_align.HOT_PAIRS, 3, 0])
def test_alignment_brute_force(spark, hot):
    """0 and 3: all pairs, or nearly, meet their counts in the join."""
    voc = token_align.vocabularies(A_JSON, B_MODEL)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "n_chars")
    extra = spark.createDataFrame([(None, "x y", 1), (7, None, 2), (8, "", 3), (9, "a▁b", 4),
                                   (10, "rep rep\r\n rep", 0), (10, "rep rep\r\n rep", 0)],
                                  "doc_id long, text string, n_chars long")
    docs = docs.where("doc_id < 4000").union(extra)
    rows = [(r[0], _whole_text(voc, r[1])) for r in docs.collect()]
    held = collections.Counter(p for _, e in rows for p in e[5])
    best = collections.defaultdict(int)
    for p, n in held.items():
        best[p >> 32] = max(best[p >> 32], n)
    exp = collections.Counter(
        (d, *e[:4], sum(n for p, n in e[5].items() if held[p] == best[p >> 32]),
         sum(n * held[p] for p, n in e[5].items()), e[4]) for d, e in rows)
    got = token_align.align_tokenizers(docs.withColumnRenamed("n_chars", "n_a"), A_JSON, B_MODEL,
                                       hot_pairs=hot)
    assert collections.Counter(tuple(r) for r in got.collect()) == exp


def test_alignment_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert token_align.align_tokenizers(df, A_JSON, B_MODEL).collect() == []


# --- operator 13 -------------------------------------------------------------------

def _cases():
    rng = np.random.default_rng(0)
    for d in (1, 2, 3, 7, 64):
        yield np.triu(rng.normal(size=(d, d)))
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    yield np.eye(9)  # all equal
    yield np.zeros((6, 6))
    yield q * 3
    yield np.linalg.qr(np.logspace(0, -14, 40)[:, None] * q, mode="r")  # graded
    yield np.linalg.qr(np.diag(np.arange(40) < 7).astype(float) @ q, mode="r")  # rank 7, equal
    yield np.linalg.qr(np.diag(1 + 1e-9 * rng.normal(size=40)) @ q, mode="r")  # a cluster
    yield np.diag(np.ones(30)) + np.diag(np.ones(29), 1)
    x = rng.normal(size=(300, 12))
    x[:, 3], x[:, 5] = 0, x[:, 6]
    yield np.linalg.qr(x, mode="r")


@pytest.mark.parametrize("r", list(_cases()), ids=str)
def test_solver(r):
    a, b, v = qd_whiten.bidiagonalise(r)
    exp = np.linalg.svd(r, compute_uv=False) ** 2
    top = max(exp[0], 1e-300)
    assert np.abs(qd_whiten.dqds(a, b) - exp).max() <= 1e-13 * top
    assert np.allclose(v.T @ v, np.eye(len(v)), atol=1e-13)
    values, vectors = qd_whiten.leading_directions(r, 4)
    assert np.abs(r.T @ r @ vectors - vectors * values).max() <= 1e-13 * top
    assert np.allclose(vectors.T @ vectors, np.eye(vectors.shape[1]), atol=1e-13)


def test_small_singular_values_are_accurate():
    """dqds keeps relative accuracy on a graded bidiagonal matrix."""
    a, b = np.logspace(0, -12, 13), np.logspace(-1, -13, 12)
    got = np.sqrt(qd_whiten.dqds(a, b))
    # the product of the singular values is that of the diagonal, to relative accuracy
    assert np.isclose(np.log(got).sum(), np.log(a).sum(), rtol=1e-13)


def test_whitening_brute_force(spark):
    df = spark.read.parquet(f"{SF01}/embeddings.parquet")
    df = df.union(df.limit(20))  # repeated rows count once in the fit
    rows = df.collect()
    x = np.floor(256 * np.array([r["embedding"] for r in rows], float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = fit - s / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    exp = ((x - s / n) @ vectors[:, :4]) / np.sqrt(values[:4])
    deviation = ((n * x - s) ** 2).sum(1)
    got = collections.defaultdict(list)
    for r in qd_whiten.whiten(df).collect():
        got[r["vec_id"], r["component"]].append(r)
    sign = np.sign([sum(got[r["vec_id"], k + 1][0]["whitened"] * e[k] for r, e in zip(rows, exp))
                    for k in range(4)])
    times = collections.Counter(r["vec_id"] for r in rows)
    for r, e, dev in zip(rows, exp, deviation.tolist()):
        for k in range(4):
            mine = got[r["vec_id"], k + 1]
            assert len(mine) == times[r["vec_id"]]
            assert all(m["n"] == n and m["deviation"] == dev for m in mine)
            assert abs(mine[0]["whitened"] * sign[k] - e[k]) < 1e-9
            assert abs(mine[0]["explained"] / (values[k] / values.sum()) - 1) < 1e-9
            assert mine[0]["identity_error"] < 1e-9


def test_whitening_edge_cases(spark):
    rows = [(1, [0.5, 1.0]), (2, None), (3, [float("nan"), 1.0]), (4, [0.1, None]), (5, [1e300, 1.0]),
            (6, []), (7, [0.5, 1.0]), (None, [2.0, 3.0]), (8, [2.0, -1.0]), (9, [1.0, 2.0, 3.0]),
            (9, [1.0, 2.0, 3.0]), (11, [float("-inf"), 0.0])]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<double>, n long")
    got = qd_whiten.whiten(df).collect()
    assert collections.Counter(r["vec_id"] for r in got) == {1: 2, 7: 2, None: 2, 8: 2, 9: 6}
    assert {r["n"] for r in got if r["vec_id"] == 9} == {1}
    assert {r["whitened"] for r in got if r["vec_id"] == 9} == {None}  # nothing varies
    assert {r["n"] for r in got if r["vec_id"] != 9} == {3}
    assert all(r["identity_error"] < 1e-9 for r in got if r["vec_id"] != 9)
    wide = spark.createDataFrame([(1, [1e13]), (2, [2.0])], "vec_id long, embedding array<double>")
    assert {r["deviation"] for r in qd_whiten.whiten(wide).collect()} == {None}  # beyond a long
    assert qd_whiten.whiten(df.limit(0)).collect() == []


def test_many_tasks_merge_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(qd_whiten, "FAN", 2)
    df = spark.read.parquet(f"{SF01}/embeddings.parquet")
    one = {(r[0], r[1]): r for r in qd_whiten.whiten(df.coalesce(1)).collect()}
    for r in qd_whiten.whiten(df.repartition(7)).collect():
        assert abs(abs(r["whitened"]) - abs(one[r[0], r[1]]["whitened"])) < 1e-9
