import random
import re

import numpy as np
import pytest

from tidemark.llm import ngram_join_op as op
from tidemark.llm.components import components


def shingles(text, k):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                up[top(a)] = top(b)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [e for j, (e, _) in enumerate(rows) if top(j) == top(i) and e is not None]
        out.append((d, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def run(spark, rows, k=3, percent=90):
    df = spark.createDataFrame([(d, t, "s", "c") for d, t in rows], "doc_id long, text string, source string, class string").repartition(3)
    return sorted([tuple(r) for r in op.digest(op.jaccard_components(df, k, percent)).collect()], key=str)


def corpus(seed, families=8, copies=12):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["É", "the", "The"]
    rows = []
    for _ in range(families):
        base = rnd.choices(vocab, k=rnd.choice((9, 11, 20, 60, 200)))
        for _ in range(copies):
            w = list(base)
            for _ in range(rnd.randrange(0, max(1, len(w) // 25) + 1)):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            if rnd.random() < 0.3:
                w = w[:-1]
            rows.append((rnd.randrange(10**6), " ".join(w) if rnd.random() < 0.7 else "\n".join(w).upper()))
    return list(dict(rows).items())


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_matches_brute_force(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows, 3, 90)


def test_other_parameters(spark):
    rows = corpus(7, 6, 8)
    assert run(spark, rows, 5, 80) == brute(rows, 5, 80)


def test_blocks_and_hot_shingles(spark, monkeypatch):
    rows = corpus(3, 3, 30)
    want = brute(rows, 3, 90)
    monkeypatch.setattr(op, "BLOCK", 4)
    monkeypatch.setattr(op, "FRAGMENT", 16)
    assert run(spark, rows) == want
    monkeypatch.setattr(op, "hot_slots", lambda *a: np.arange(op.N_SLOTS))
    assert run(spark, rows) == want


def test_partial_overlaps_sum_to_the_intersection(spark, monkeypatch):
    """Of every pair that is counted, whatever the parts; each class has one lead."""
    rows = corpus(11, 5, 20)
    monkeypatch.setattr(op, "PART", 3)
    seen = []
    real = op.partial_sums
    monkeypatch.setattr(op, "partial_sums", lambda *a: seen.append(real(*a)) or seen[-1])
    df = spark.createDataFrame(rows + rows[:5], "doc_id long, text string").repartition(4)
    found = op.jaccard_components(df, 3, 90)
    text = {bytes(r["class"]): shingles(dict(rows)[r.doc_id], 3) for r in found.collect()}
    sums = seen[0].collect()
    assert len(sums) > 30 and len({bytes(r.b) for r in sums}) == len(sums)
    for r in sums:
        a, b = text[bytes(r.a)], text[bytes(r.b)]
        assert (r.shared, r.n_a, r.n_b) == (len(a & b), len(a), len(b))
    assert sorted([tuple(r) for r in op.digest(found).distinct().collect()], key=str) == brute(rows, 3, 90)


def test_leads_that_link_with_nobody(spark):
    """Sets that share a fragment with their lead, yet link only with each other, or by a chain: blocks decide."""
    rnd = random.Random(12)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for f in range(6):  # the same passage, other words about it: related texts, few links
        for c in range(6):
            w = base[:60 + 10 * f] + [f"f{f}x{i}" for i in range(20 - 3 * f)]
            for _ in range(c):
                w[rnd.randrange(len(w))] = f"r{rnd.randrange(9)}"
            rows.append((100 * f + c, " ".join(w)))
    chain = [f"c{i}" for i in range(90)]
    rows += [(1000 + i, " ".join(chain[2 * i:2 * i + 60])) for i in range(15)]
    assert run(spark, rows) == brute(rows, 3, 90)
    assert run(spark, rows, 5, 80) == brute(rows, 5, 80)


def test_near_copies_of_one_text_need_no_blocks(spark, monkeypatch):
    rnd = random.Random(13)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(80):
        w = list(base)
        w[rnd.randrange(300)] = f"z{i}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(op, "PART", 7)

    def verify(*_):
        def met(_t):
            raise AssertionError("no cluster is open")
        return met

    monkeypatch.setattr(op, "_verify", verify)
    assert run(spark, rows) == brute(rows, 3, 90)


def test_exact_threshold_of_small_sets(spark):
    w = [f"v{i}" for i in range(12)]
    rows = [(1, " ".join(w)), (2, " ".join(w[:-1])), (3, " ".join(w[:10])), (4, "x"), (5, "X"), (6, "x y"), (7, "y x"), (8, "x y z")]
    assert run(spark, rows) == brute(rows, 3, 90)


def test_nulls_empty_long_and_repeated_rows(spark):
    long = " ".join(f"q{i % 3001}" for i in range(20000))
    rows = [(None, "a b c d"), (5, "a b c d"), (1, None), (2, ""), (3, " \n"), (4, long), (9, long + " end"), (6, "m n o"), (6, "m n o"), (6, "other text here"), (None, "lonely row here")]
    assert run(spark, rows) == brute(rows, 3, 90)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_every_similar_pair_shares_a_key():
    rnd = np.random.default_rng(0)
    hot = np.zeros(1 << 10, bool)
    hot[rnd.integers(0, 1 << 10, 300)] = True
    for trial in range(300):
        n = int(rnd.integers(9, 160))
        base = rnd.integers(0, 2**63, n * 2).astype(np.uint64)
        a = np.unique(base[:n])
        gone = int(rnd.integers(0, len(a) // 9 + 1))
        b = np.unique(np.concatenate([a[gone:], base[n:n + int(rnd.integers(0, 3))]]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 90 * (len(a) + len(b) - both):
            continue
        row, key = op.fragment_keys(np.concatenate([a, b]), np.array([len(a), len(a) + len(b)]), hot, 90)
        assert len(a) == len(b) == both or set(key[row == 0].tolist()) & set(key[row == 1].tolist())


def test_components(spark):
    rnd = random.Random(0)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, None), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    near = {}
    for a, b in edges:
        if b is not None and a != b:
            near.setdefault(a, set()).add(b), near.setdefault(b, set()).add(a)
    want = {}
    for x in sorted(near):
        if x not in want:
            todo = [x]
            while todo:
                y = todo.pop()
                if y not in want:
                    want[y] = x
                    todo += near[y]
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
