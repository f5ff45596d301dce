import random
import re
from collections import defaultdict

import pytest

from tidemark.llm import mixing_op as op

SCHEMA = "doc_id long, text string, source string, size int, taken string"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, s, 7, "x") for d, t, s in rows], SCHEMA).repartition(3)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def want_targets(rows):
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(words(t))
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    goal, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = goal - sum(2 * sizes[s] for s in full)
        w = sum(weight[s] for s in order if s not in full)
        share = {s: 2 * sizes[s] if s in full else left * weight[s] / w for s in order}
        more = {s for s in order if s not in full and share[s] >= 2 * sizes[s]}
        if not more or not w:
            return sizes, share
        full |= more
        if len(full) == len(order):
            return sizes, {s: 2.0 * sizes[s] for s in order}


def corpus(seed, n=150):
    rnd = random.Random(seed)
    return [(i, " ".join(f"d{i}w{j}" for j in range(rnd.randrange(0, 90))), rnd.choice(["a"] * 20 + ["B", "é", "z", None, "q", "r"])) for i in range(n)]


@pytest.mark.parametrize("seed,block", [(0, 16), (1, 7), (2, 1024)])
def test_targets_and_bounds(spark, seed, block):
    rows = corpus(seed)
    sizes, share = want_targets(rows)
    out = op.mix(frame(spark, rows), block).collect()
    assert len(out) == len(rows)
    by = {d: (t, s) for d, t, s in rows}
    got = defaultdict(int)
    for r in out:
        t, s = by[r.doc_id]
        assert r["size"] == len(words(t)) and r.source_size == sizes[s] and r.target == pytest.approx(share[s])
        assert 0 <= r.taken <= 2 * r["size"]
        got[s] += r.taken
    for s in sizes:
        assert abs(got[s] - share[s]) < 1.01


def test_reruns_agree(spark):
    rows = corpus(4)
    a = sorted(op.mix(frame(spark, rows), 16).collect())
    b = sorted(op.mix(frame(spark, rows[::-1]).repartition(7), 16).collect())
    assert a == b


def test_brute_force_takes_the_same_blocks(spark):
    """The blocks by hand: streams by doc_id, ranks by MD5, passes."""
    import hashlib
    rows, n = corpus(6, 60), 16
    sizes, share = want_targets(rows)
    taken = {d: 0 for d, _, _ in rows}
    for s in sizes:
        stream = [d for d, t, x in sorted(rows, key=lambda r: r[0]) if x == s for _ in words(t)]
        blocks = [stream[i:i + n] for i in range(0, len(stream), n)]
        name = "-" if s is None else "+" + s
        order = sorted(range(len(blocks)), key=lambda b: hashlib.md5(f"{name}:{b}".encode()).hexdigest())
        left = int(share[s] + 1e-6)
        while left > 0:
            for b in order:
                for d in blocks[b][:max(0, left)]:
                    taken[d] += 1
                left -= len(blocks[b])
    assert {r.doc_id: r.taken for r in op.mix(frame(spark, rows), n).collect()} == taken


def test_documents_of_the_mix(spark):
    rows = corpus(8, 60)
    df = frame(spark, rows)
    plan = {r.doc_id: r.taken for r in op.mix(df, 16).collect()}
    out = op.mixed_documents(df, 16)
    assert out.columns == df.columns
    got = defaultdict(int)
    by = {d: t for d, t, _ in rows}
    for r in out.collect():
        w = words(r.text)
        assert set(w) <= set(words(by[r.doc_id])) and len(set(w)) == len(w) > 0
        got[r.doc_id] += len(w)
    assert {d: n for d, n in plan.items() if n} == dict(got)


def test_every_shard_draws_from_all_sources(spark):
    """Source counts of the shards are multinomial: chi-square against equal chances stays near its mean."""
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(40)), s) for i, s in enumerate(["a"] * 300 + ["b"] * 60 + [None] * 60 + ["tiny"])]
    df = frame(spark, rows)
    out = op.shard_counts(df, 4, 100).collect()
    sizes, share = want_targets(rows)
    n_shards = -(-int(sum(share.values())) // 400)
    by = defaultdict(dict)
    for r in out:
        by[r.source][r.shard] = r.slots
    assert n_shards > 40 and set(by) == set(sizes) and {s for d in by.values() for s in d} == set(range(n_shards))
    for source in ("a", "b", None):
        n = sum(by[source].values())
        mean = n / n_shards
        assert n == pytest.approx(share[source] / 4, abs=1) and len(by[source]) == n_shards
        chi = sum((by[source].get(i, 0) - mean) ** 2 / mean for i in range(n_shards))
        free = n_shards - 1
        assert abs(chi - free) < 4 * (2 * free) ** 0.5
    words_of = {s: sum(r.words for r in out if r.source == s) for s in sizes}
    assert all(abs(words_of[s] - share[s]) < 1.01 for s in sizes)


def test_documents_carry_their_shard(spark):
    rows = corpus(9, 80)
    df = frame(spark, rows)
    want = {(r.shard, r.source): r.words for r in op.shard_counts(df, 8, 20).collect()}
    out = op.mixed_documents(df, 8, "out_shard", shard_slots=20)
    assert out.columns == [*df.columns, "out_shard"]
    got = defaultdict(int)
    for r in out.collect():
        got[r.out_shard, r.source] += len(words(r.text))
    assert dict(got) == want and len({s for s, _ in want}) > 5


def test_nulls_and_repeated_rows(spark):
    rows = [(None, "a b c", "x"), (None, "a b c", "x"), (1, None, "x"), (2, "", None), (3, "p q", None), (3, "p q", None), (4, " \n", "only"), (5, "long " * 5000, "y")]
    out = op.mix(frame(spark, rows), 8).collect()
    assert len(out) == len(rows)
    assert sum(r.taken for r in out) == pytest.approx(1.5 * 5010, abs=4)
    assert all(r.taken <= 2 * r["size"] for r in out)
    assert {r.target for r in out if r.doc_id == 4} == {0.0}
    assert op.mixed_documents(frame(spark, rows), 8).filter("text is null or text = ''").count() == 0


def test_empty_tables(spark):
    assert op.mix(frame(spark, [])).collect() == []
    assert op.mixed_documents(frame(spark, [])).collect() == [] and op.shard_counts(frame(spark, [])).collect() == []
    assert [tuple(r) for r in op.mix(frame(spark, [(1, None, "a")])).collect()] == [(1, 0, 0, 0.0, 0)]


def test_plan_has_no_python(spark):
    text = op.mix(frame(spark, corpus(0)))._jdf.queryExecution().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
