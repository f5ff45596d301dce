import random
import zlib

import numpy as np
import pytest

from tidemark.llm import classifier_op as op

DIR = "/root/testdata/sf0.01"


def auc(score, y):
    order = np.argsort(np.argsort(score))
    pos = y == 1
    return (order[pos].mean() - order[~pos].mean()) / len(y) + 0.5


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{DIR}/documents.parquet"), spark.read.parquet(f"{DIR}/labels.parquet")
    out = {r.doc_id: r for r in op.score(docs, labels).collect()}
    assert len(out) == docs.count()
    quality = {r.doc_id: r.quality for r in labels.collect()}
    rows = [(r.score, quality[d]) for d, r in out.items() if d in quality and r.held_out]
    s, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    assert auc(s, y) > 0.9
    assert ((s >= 0.3) == (y == 1)).mean() > 0.9
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for d, r in out.items())


def test_only_text_and_allowed_labels_count(spark):
    docs, labels = spark.read.parquet(f"{DIR}/documents.parquet").limit(400), spark.read.parquet(f"{DIR}/labels.parquet")
    a = {r.doc_id: r.score for r in op.score(docs, labels).collect()}
    other = docs.selectExpr("doc_id", "text", "'x' lang", "'y' source", "1 quality")
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality) quality", "toxic", "'t' text")
    b = {r.doc_id: r.score for r in op.score(other, flipped).collect()}
    assert a == pytest.approx(b)


def test_nulls_repeats_and_missing_labels(spark):
    schema = "doc_id long, text string, score string"
    docs = spark.createDataFrame([(None, "a b", "s"), (1, None, "s"), (1, "", "s"), (2, "c d e", None), (2, "c d e", None), (3, "x " * 50000, "s")], schema)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert sorted([tuple(r) for r in op.score(docs, labels).collect()], key=str)[0][2] == 0.5
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 0, 1), (None, 1, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    out = op.score(docs, labels).collect()
    assert len(out) == 6 and all(0 <= r.score <= 1 for r in out) and [r.held_out for r in out if r.doc_id is None] == [False]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert op.score(docs, spark.createDataFrame([], "doc_id long, quality int")).collect() == []


def test_pooling_matches_a_plain_loop():
    rnd = random.Random(0)
    vectors = np.random.default_rng(0).normal(size=(op.BUCKETS, op.WIDTH)).astype(np.float32)
    texts = [" ".join(rnd.choices(["ab", "Cd", "$$$", "9x", "é"], k=rnd.randrange(0, 40))).encode() for _ in range(30)] + [None]
    got = op.pooled(texts, vectors)
    for t, f in zip(texts, got):
        w = op.RUN.findall(t or b"")
        if not w:
            assert not f.any()
            continue
        v = np.array([vectors[op.bucket(x)] for x in w], float)
        s = np.array([vectors[op.bucket(op.shape_of(x))] for x in w], float)
        want = np.concatenate([v.mean(0), v.std(0), s.mean(0), [np.log1p(len(w)), np.linalg.norm(v.mean(0)), len(set(w)) / len(w)]])
        assert np.allclose(f, want, atol=1e-3)


def test_temperature_makes_probabilities_honest():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, op.N_FEATURES))
    p = 1 / (1 + np.exp(-2 * x[:, 0]))
    y = (rng.random(4000) < p).astype(int)
    model = op.fit(x, y)
    x = rng.normal(size=(4000, op.N_FEATURES))  # rows that it hasn't learnt
    p = 1 / (1 + np.exp(-2 * x[:, 0]))
    s = model.scores(x)
    for lo in (0.1, 0.3, 0.5, 0.7):
        part = (s >= lo) & (s < lo + 0.2)
        assert abs(s[part].mean() - p[part].mean()) < 0.12


def test_contexts_match_a_plain_loop(spark):
    rnd = random.Random(1)
    texts = [" ".join(rnd.choices(["ab", "Cd", "$$$", "9x", "é", "aAbB1-"], k=rnd.randrange(0, 30))) for _ in range(40)] + [None, "", "one"]
    place, sign = op.index_vectors()
    want = np.zeros((op.BUCKETS, op.WIDTH))
    for t in texts:
        w = op.RUN.findall((t or "").encode())
        for seq in ([op.bucket(x) for x in w], [op.bucket(op.shape_of(x)) for x in w]):
            for i, x in enumerate(seq):
                for j in range(max(0, i - op.REACH), min(len(seq), i + op.REACH + 1)):
                    if j != i:
                        want[x, place[seq[j]]] += sign[seq[j]]
    want /= np.maximum(1e-9, np.linalg.norm(want, axis=1, keepdims=True))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    assert np.allclose(op.word_vectors(docs.mapInArrow(op._split, op._ROWS)), want, atol=1e-6)


def test_a_text_longer_than_a_segment(monkeypatch):
    texts = [b"ab cd " * 50, None, b"x " * 7, b"Cd ef $$ " * 40]
    vectors = np.random.default_rng(0).normal(size=(op.BUCKETS, op.WIDTH)).astype(np.float32)
    whole = op.pooled(texts, vectors)
    monkeypatch.setattr(op, "SEGMENT", 11)
    assert np.allclose(op.pooled(texts, vectors), whole, rtol=1e-4, atol=1e-5)


def test_shapes_of_long_words():
    assert op.shape_of(b"a" * 200 + b"B1") == b"\x00aA9" and op.shape_of(b"aB1-cD") == b"\x00aA9-" and op.shape_of("éa".encode()) == b"\x00a"
