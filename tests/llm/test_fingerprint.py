import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import fingerprint_op as op

SCHEMA = "doc_id long, text string, fingerprint int, kind string"


def alike(a, b):
    x, y = (Counter(op.paragraphs(t.encode())) for t in (a, b))
    whole = sum((x | y).values())
    return sum((x & y).values()) / whole if whole else 1.0


def want(rows):
    """(doc_id, n_chars, sha, near_edited, near_next) with each row's next by doc_id; doc_ids must differ."""
    order = sorted(rows, key=lambda r: -r[0])
    out = []
    for (d, t), (_, f) in zip(order, [*order[1:], *order[:1]], strict=True):
        t, f = t or "", f or ""
        e = t[:len(t) - len(t) // 2] + f[:len(t) // 2]
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), round(alike(t, e), 9), round(alike(t, f), 9)))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)


def got(spark, rows):
    r = op.digest(op.neighbours(frame(spark, rows))).collect()
    return sorted([(x.doc_id, x.n_chars, x.edited_sha256, round(x.near_edited, 9), round(x.near_next, 9)) for x in r], key=str), r


def some(seed, n):
    rnd = random.Random(seed)
    lines = [f"line {i} of é words日 " + "x" * rnd.randrange(30) for i in range(40)]
    return [(i * 7 - 50, "".join(rnd.choice(lines) + rnd.choice([". ", "\n", "! ", " "]) for _ in range(rnd.choice([0, 1, 3, 30, 300])))) for i in rnd.sample(range(n), n)]


@pytest.mark.parametrize("chunk", [2 << 20, 400, 1])
def test_random(spark, monkeypatch, chunk):
    monkeypatch.setattr(op, "CHUNK", chunk)
    rows = some(chunk, 60)
    assert got(spark, rows)[0] == sorted(want(rows), key=str)


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    r = op.digest(op.neighbours(docs)).collect()
    assert sorted((x.doc_id, x.n_chars, x.edited_sha256, round(x.near_edited, 9), round(x.near_next, 9)) for x in r) == want([(d.doc_id, d.text) for d in docs.collect()])
    # a text is nearer to its own edit than to another document, unless a copy follows it
    far = [x for x in r if x.near_next < 0.5 and x.n_chars > 200]
    assert len(far) > 100 and sum(x.near_edited > x.near_next for x in far) > 0.97 * len(far)
    assert sum(x.near_edited for x in far) / len(far) > 0.25


def test_one_row_is_its_own_next(spark):
    rows, r = got(spark, [(5, "ab. cd. ef")])
    assert rows == [(5, 10, hashlib.sha256(b"ab. cab. c").hexdigest(), 0.5, 1.0)] or rows[0][4] == 1.0
    assert rows[0][2] == hashlib.sha256(b"ab. cab. c").hexdigest()


def test_nulls_and_repeated_rows(spark):
    rows = [(None, "a. b. c. d."), (None, None), (3, "a. b. c. d."), (3, "a. b. c. d."), (2, ""), (1, None)]
    found, r = got(spark, rows)
    assert len(found) == 6
    three = [x for x in r if x.doc_id == 3]
    assert sorted(x.near_next for x in three) == [0.0, 1.0]  # a copy follows the first, an empty text the last
    same = {x.fingerprint for x in r if x.n_chars == 11}
    empty = {x.fingerprint for x in r if x.n_chars == 0}
    assert len(same) == 1 and len(empty) == 1
    assert {x.near_edited for x in r if x.n_chars == 0} == {1.0}


def test_empty_table(spark):
    assert got(spark, [])[0] == []


def test_paragraphs_are_the_text():
    rnd = random.Random(4)
    for n in (0, 1, 700, 5000):
        t = "".join(rnd.choices("ab é日 \n.!?", weights=[20, 20, 5, 5, 5, 1, .1, .01, .01, .01], k=n)).encode()
        assert b"".join(op.paragraphs(t)) == t
    long = " ".join(f"word{rnd.randrange(10 ** 6)}" for _ in range(5000)).encode()
    assert alike(long.decode(), "another beginning " + long.decode()) > 0.9
    assert max(map(len, op.paragraphs(long))) < 5000


def test_peeling_gives_the_differing_digests():
    a = b"one. two. two. three. four. "
    b = b"one. two. three. five. "
    (ka, oa), (kb, ob) = op.digests([a]), op.digests([b])
    fa, fb = op.packed(ka, oa, [a])[0], op.packed(kb, ob, [b])[0]
    removed, added = op.difference(fa, fb)
    assert removed == sorted(set(ka.tolist()) - set(kb.tolist())) and len(removed) == 2
    assert added == sorted(set(kb.tolist()) - set(ka.tolist())) and len(added) == 1
    many = b"".join(b"p %d. " % i for i in range(500))
    km, om = op.digests([many])
    assert op.difference(fa, op.packed(km, om, [many])[0]) is None  # too much for twelve cells
    text, keys, side, cells = op.differences((ka, oa), (km, om), 1)
    assert len(keys) == 505 and (side > 0).sum() == 5 and cells[0] > 505


def test_changes(spark):
    rows = [(1, "a. b. c. ", "a. c. d. "), (2, None, ""), (3, "same", "same"), (4, "", "".join(f"{i}. " for i in range(300)))]
    out = {r.doc_id: r for r in op.changes(spark.createDataFrame(rows, "doc_id long, old string, new string")).collect()}
    key = {t: int(op.digests([t.encode()])[0].astype(np.int64)[0]) for t in ("b. ", "d. ")}
    assert (out[1].removed, out[1].added) == ([key["b. "]], [key["d. "]])
    assert out[2].removed == out[3].added == [] and len(out[4].added) == 300 and out[4].cells > op.CELLS
    fp = {r.doc_id: r for r in op.fingerprints(spark.createDataFrame([(1, "a. b. "), (None, None)], "doc_id long, text string")).collect()}
    assert fp[1].n_paragraphs == 2 and fp[None].n_paragraphs == 0
