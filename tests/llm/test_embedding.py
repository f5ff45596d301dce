import numpy as np
import pytest

from tidemark.llm import embedding_op as op

SCHEMA = "vec_id long, embedding array<float>, label int, class string"


def brute(rows, least=0.95):
    def ok(v):
        return v and None not in v and np.isfinite(np.array(v, np.float32)).all() and np.linalg.norm(np.array(v, np.float32).astype(float)) > 0

    use = [i for i, (_, v) in enumerate(rows) if ok(v)]
    x = {i: np.array(rows[i][1], np.float32).astype(float) for i in use}
    near = {i: [j for j in use if j != i and len(x[i]) == len(x[j]) and x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= least] for i in use}
    out = []
    for i, (d, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j), todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        c = min(ids) if ids else None
        out.append((d, len(near.get(i, ())), c, d == c))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(d, v, 1, "c") for d, v in rows], SCHEMA).repartition(3)
    return sorted([tuple(r) for r in op.near_duplicates(df).collect()], key=str)


def corpus(seed, dim=64, families=12, copies=15, noise=0.12):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(families):
        base = rng.normal(size=dim)
        base /= np.linalg.norm(base)
        for _ in range(copies):
            v = base + rng.normal(size=dim) * noise / np.sqrt(dim) * rng.choice([0, 1, 1, 2])
            rows.append((v * rng.choice([1, 3])).tolist())
    rows += rng.normal(size=(100, dim)).tolist()
    ids = rng.permutation(5 * len(rows))[:len(rows)].tolist()
    return list(zip(ids, rows))


@pytest.mark.parametrize("seed,dim", [(0, 64), (1, 48), (2, 128)])
def test_matches_brute_force(spark, seed, dim):
    rows = corpus(seed, dim)
    assert run(spark, rows) == brute(rows)


def test_blocks(spark, monkeypatch):
    rows = corpus(3, 64, 3, 60, 0.05)
    monkeypatch.setattr(op, "BLOCK", 16)
    assert run(spark, rows) == brute(rows)


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        a, b = rng.normal(size=(2, 64))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows += [(2 * i, a.tolist()), (2 * i + 1, (0.9505 * a + np.sqrt(1 - 0.9505**2) * b).tolist())]
    got = run(spark, rows)
    assert sum(r[1] for r in got) >= 0.97 * 800 and all(r[1] <= 1 for r in got)


def test_odd_vectors_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = np.random.default_rng(1).normal(size=8).tolist()
    rows = [(1, None), (2, []), (3, [0.0] * 8), (4, [nan] + v[1:]), (5, [inf] + v[1:]), (6, [None] + v[1:]), (7, v), (8, v), (8, v), (None, v), (9, v[:4]), (10, [-x for x in v]),
            (None, v[:4]), (None, [1.0, 0.0, 0.0]), (11, [2.0])]
    assert run(spark, rows) == brute(rows)


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert sorted([tuple(r) for r in op.near_duplicates(df).collect()], key=str) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 32))
    assert np.allclose(np.linalg.norm(op.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
