import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import conversation_op as op

SCHEMA = "conv_id long, turn long, role string, text string, seq string, n int"


def want(rows):
    """Nodes by going through every prefix of every conversation."""
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        made[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, s in made.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    out = []
    for p, m in members.items():
        inside = [q for q in members if q[:len(p)] == p]
        leaves = sum(not any(len(x) == len(q) + 1 and x[:len(q)] == q for x in members) for q in inside)
        ends = ",".join(map(str, sorted(c for c in m if len(made[c]) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), sum(len(q) == len(p) + 1 for q in inside), leaves,
                    sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in inside if q), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    return sorted([tuple(r) for r in op.digest(op.prefix_trie(op.rebuilt(df))).collect()], key=str)


def some(seed, n, words="ab", longest=7):
    rnd = random.Random(seed)
    return [(c, t, rnd.choice(["user", "assistant", None]) if rnd.random() < .1 else "user", rnd.choice([*words, None, "é日"]) if rnd.random() < .3 else words[0])
            for c in rnd.sample(range(-n, 2 * n), n) for t in range(rnd.randrange(1, longest))]


@pytest.mark.parametrize("least", [4096, 6, 1])
def test_random(spark, monkeypatch, least):
    monkeypatch.setattr(op, "LEAST", least)
    rows = some(least, 60)
    assert got(spark, rows) == want(rows)


def test_long_shared_paths_and_packs(spark, monkeypatch):
    monkeypatch.setattr(op, "LEAST", 8)
    monkeypatch.setattr(op, "PACK", 3)
    rows = [(c, t, "user", "same") for c in range(0, 80, 5) for t in range(30 + c % 2)]
    rows += [(c, t, "user", f"own {c if t > 20 else 0}") for c in range(1, 30, 5) for t in range(25)]
    assert got(spark, rows) == want(rows)


def test_turnless_and_nulls(spark):
    rows = [(1, None, None, None), (1, 0, None, None), (1, 0, "user", "x"), (None, 0, "user", "lost"), (2, 5, "", ""), (2, 5, "", ""),
            (6, 1, "user", "a"), (7, 1, "user", "a"), (11, 1, "user", "a"), (-3, 0, "user", "z"), (-5, 0, "user", "y")]
    made = want(rows)
    assert got(spark, rows) == made
    assert any(r[1] == 0 and r[-1] != op.NO_ENDS for r in made)  # some end at the root


def test_empty(spark):
    assert got(spark, []) == []


def test_as_they_are_with_text(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "bot", None), (2, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    nodes = op.with_text(op.prefix_trie(op.sequences(df)), df)
    assert sorted([(r.depth, r.conv_id, r.n_convs, r.role, r.text) for r in nodes.collect()]) == [(0, 1, 2, None, None), (1, 1, 2, "user", "a"), (2, 1, 1, "bot", "")]


def test_table(spark):
    convs = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in convs.collect()]
    assert sorted([tuple(r) for r in op.digest(op.prefix_trie(op.rebuilt(convs))).collect()], key=str) == want(rows)
