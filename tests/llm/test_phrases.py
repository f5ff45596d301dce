import random
import re
from collections import Counter

import pytest

from tidemark.llm import phrase_op as op

SCHEMA = "doc_id long, text string, lang string, phrase string, words int"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def want(rows, least=10, best=2000):
    """By the contract: every phrase of every piece."""
    f, n = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        c = f.setdefault(lang, Counter())
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                c.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        scored = []
        for g, a in cand.items():
            if any(len(x) > len(g) and 100 * b >= 50 * a and g in (x[:2], x[1:]) for x, b in cand.items()):
                continue
            s, _, l, r = min((10 ** 6 * a * a // (c[g[:k]] * c[g[k:]]), k, c[g[:k]], c[g[k:]]) for k in range(1, len(g)))  # noqa: E741
            scored.append((-s, -a, " ".join(g).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:best])]  # noqa: E741
    return sorted(out)


def got(spark, rows, **k):
    df = spark.createDataFrame([(d, t, lang, "x", 1) for d, t, lang in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in op.top(df, **k).select(*COLUMNS).collect())


def some(seed, n=60, vocabulary="a b c d e é the The of a.b x,y z! \x1c \x00 日本".split(" ")):
    rnd = random.Random(seed)
    return [(i, "".join(rnd.choice(vocabulary) + rnd.choice([" ", " ", "  ", "\t", "\n", ". "]) for _ in range(rnd.randrange(120))), rnd.choice(["en", "fr", None, "und"]))
            for i in range(n)]


def test_lots_hold_every_word_and_what_follows(monkeypatch):
    text = b"one two three,four five six seven\teight nine ten eleven. twelve"
    whole = [x for tokens, n in op.steps(text) for x in zip(tokens[:n], tokens[1:n + 1] + [b"."], tokens[2:n + 2] + [b".", b"."], strict=False)]
    for chunk, step in ((3, 9), (6, 1), (8, 2), (1, 1)):
        monkeypatch.setattr(op, "CHUNK", chunk)
        monkeypatch.setattr(op, "STEP", step)
        lots = [(tokens + [b".", b"."], n) for tokens, n in op.steps(text)]
        assert [(t[i], t[i + 1], t[i + 2]) for t, n in lots for i in range(n)] == whole


@pytest.mark.parametrize("sizes", [{}, {"BURST": 3, "BUDGET": 40, "CHUNK": 200}, {"WORDS": 5, "CHUNK": 300, "SHARE": 100}, {"CHUNK": 20, "STEP": 2, "BUDGET": 30}])
def test_random(spark, monkeypatch, sizes):
    for k, v in sizes.items():
        monkeypatch.setattr(op, k, v)
    rows = some(len(sizes))
    assert got(spark, rows) == want(rows)


def test_ranks_are_cut(spark):
    rows = some(9)
    assert got(spark, rows, best=3, least=5) == want(rows, least=5, best=3)


def test_one_endless_piece_and_nulls(spark, monkeypatch):
    monkeypatch.setattr(op, "CHUNK", 50)
    rows = [(1, "new york city " * 300, "en"), (2, None, "en"), (None, "", None), (3, "new york city " * 5, None), (3, "new york city " * 5, None)]
    assert got(spark, rows) == want(rows)


def test_no_rows_or_words(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, " .\n", "en"), (2, None, None)]) == []


def test_exact_beyond_64_bits(spark):
    r = spark.sql("select cast(123456789012345 as decimal(15,0)) a, cast(123456789012347 as decimal(15,0)) l").selectExpr(
        "(a * a * cast(1000000 as decimal(7,0))) div (l * l) as s").first()
    assert r.s == 10 ** 6 * 123456789012345 ** 2 // 123456789012347 ** 2


def test_trie_counts(monkeypatch):
    monkeypatch.setattr(op, "BURST", 2)
    t = op.Trie()
    [(tokens, n)] = op.steps(b"a b c a b d. a b")
    t.add(tokens, n)
    assert t.burst and t.entries == 8
    key, n = t.take(0)
    words = list(t.ids)
    found = {(words[k >> 42], words[k >> 21 & op._LOW], words[k & op._LOW]): c for k, c in zip(key.tolist(), n.tolist(), strict=True)}
    assert found[b"a", b"b", b"."] == 1 and found[b"a", b"b", b"c"] == 1 and sum(found.values()) == 8 and t.entries == 0
