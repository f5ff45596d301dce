import hashlib
import random
import re

import numpy as np
import pytest

from tidemark.llm import substring_op as op
from tidemark.llm.common import equal_windows, rolling, word_hashes, word_spans

SCHEMA = "doc_id long, text string, source string, spans string, k int"


def brute(rows, window):
    """doc_id -> (n_words, n_removed, sha) by a dictionary of all windows."""
    docs = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in docs:
        for i in range(len(w) - window + 1):
            if d is not None:
                key = tuple(w[i:i + window])
                first[key] = min(first.get(key, (d, i)), (d, i))
    out = []
    for d, w in docs:
        gone = set()
        for i in range(len(w) - window + 1):
            at = first.get(tuple(w[i:i + window]))
            if at is not None and (d is None or at < (d, i)):
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, window):
    df = spark.createDataFrame([(d, t, "s", "x", 1) for d, t in rows], SCHEMA).repartition(3)
    return sorted([tuple(r) for r in op.digest(op.substring_dedup(df, window)).collect()], key=str)


def corpus(seed, n=60, vocab=40):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(vocab)] + ["é", "日本", "a b"]
    passage = " ".join(rnd.choices(words, k=30))
    rows = []
    for i in range(n):
        t = " ".join(rnd.choices(words, k=rnd.randrange(0, 60)))
        if i % 3 == 0:
            t += "\n" + passage + "\t" + " ".join(rnd.choices(words, k=5))
        if i % 7 == 0:
            t = t + " " + t
        rows.append((i * 3 % 61, t))
    return rows


@pytest.mark.parametrize("seed", [0, 1])
@pytest.mark.parametrize("window", [8, 20])
def test_matches_brute_force(spark, seed, window):
    rows = corpus(seed)
    assert run(spark, rows, window) == brute(rows, window)


def test_hot_passage_and_small_vocabulary(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choices("ab", k=40))) for i in range(120)]
    assert run(spark, rows, 8) == brute(rows, 8)


def test_demoted_grams_give_the_same_result(spark, monkeypatch):
    rows = corpus(5)
    monkeypatch.setattr(op, "_hot_slots", lambda docs, window, n: np.arange(op._slots(n)))
    assert run(spark, rows, 8) == brute(rows, 8)


def test_nulls_empty_long_and_repeated_rows(spark):
    long = " ".join(f"x{i}" for i in range(30000))
    rows = [(None, long[:3000]), (1, None), (2, ""), (3, " \n\t "), (4, long), (9, long), (6, "a b"), (6, "a b"), (7, long[:2000]), (7, long[:2000])]
    got = run(spark, rows, 20)
    assert got == brute(rows, 20)


def test_empty_table(spark):
    assert run(spark, [], 20) == []


def test_rolling_is_a_window_hash():
    h = np.random.default_rng(0).integers(0, 2**63, 50).astype(np.uint64)
    for k in range(1, 21):
        got = rolling(h, k)
        assert len(got) == 50 - k + 1
        want = [sum(int(h[i + j]) * pow(0x9E3779B97F4A7C15, j, 2**64) for j in range(k)) % 2**64 for i in range(len(got))]
        assert got.tolist() == want


def test_equal_windows_survive_a_hash_collision():
    ids = np.array([1, 2, 1, 2, 3, 4, 1, 2])
    at, label = equal_windows(ids, np.zeros(8, np.uint64), np.array([0, 2, 4, 6]), 2)
    classes = {}
    for a, b in zip(at, label):
        classes.setdefault(b, set()).add(int(a))
    assert {frozenset(c) for c in classes.values() if len(c) > 1} == {frozenset({0, 1, 3})}


def test_only_strings_with_a_repeated_window_are_interned():
    rnd = random.Random(4)
    words = [bytes(rnd.choices(b"abcdefgh\xc3\xa9", k=rnd.choice((1, 7, 8, 9, 16, 17, 300)))) for _ in range(200)]
    text = b"\n".join(b" ".join(words[i:i + 10]) for i in range(0, 200, 10))
    begin, end = word_spans(text)
    assert [text[a:b] for a, b in zip(begin.tolist(), end.tolist())] == text.split()
    h = word_hashes(text, begin, end)
    assert len(set(h.tolist())) == len(set(words)) and word_hashes(b"", *word_spans(b"")).tolist() == []
    strings = [b" ".join(words[i:i + 10]) for i in (0, 10, 20, 4, 40)]  # windows 4..7 lie in the first and the fourth
    rows, kept = op._repeating([b"\n".join(strings[:3]), b"\n".join(strings[3:])], np.full(5, 7), 4)
    assert rows.tolist() == [0, 1, 3] and kept == b" ".join(strings[i] for i in (0, 1, 3)).split()
