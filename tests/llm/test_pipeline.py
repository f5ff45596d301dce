import random

import pytest

import corpus_pipeline as cp
from tests.llm.test_ngram_join import brute, shingles
from tidemark.llm import bpe_op, mixing_op, ngram_join_op, pii_op, quality_op

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rnd, n):
    syllables = "the an re on ing tion es ed or ti ha st nd ou ea".split()
    return " ".join("".join(rnd.choices(syllables, k=rnd.randrange(1, 4))) for _ in range(n))


def corpus():
    rnd = random.Random(9)
    rows = []
    for i in range(40):
        t = prose(rnd, rnd.randrange(25, 90))
        rows.append((i, t, "en", f"s{i % 4}", len(t)))
        if i % 4 == 0:
            w = t.split()
            w[3] = "changed"
            rows.append((100 + i, " ".join(w), "en", "s1", 1))
        if i % 5 == 0:
            rows.append((200 + i, t.upper(), "de", None, 2))
    rows += [(300, "spam spam " * 100, "en", "s0", 3), (301, None, "en", "s0", None), (302, "", None, "s1", 0), (303, prose(rnd, 40) + " mail me a@b.c", "en", "s2", 5), (None, prose(rnd, 30), "en", "s3", 1)]
    return rows


def test_stages(spark):
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "ngram_dedup", "mask_pii", "mix_sources", "encode"]
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)

    good = cp.stored(cp.quality_rules(spark, docs, ""), "t")
    kept = {r.doc_id for r in quality_op.rate(docs).collect() if r.kept}
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == kept
    assert 300 not in kept and 301 not in kept and set(range(40)) <= kept

    one = cp.stored(cp.ngram_dedup(spark, good, ""), "t")
    pairs = [(r.doc_id, r.text) for r in good.collect()]
    home = {d: c for d, _, c in brute(pairs, 5, 80)}
    assert one.columns == docs.columns and sorted([r.doc_id for r in one.collect()], key=str) == sorted({c for c in home.values()}, key=str)

    clean = cp.stored(cp.mask_pii(spark, one, ""), "t")
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert clean.columns == docs.columns and texts[303].endswith("mail me [EMAIL]") and texts[1] == {r.doc_id: r.text for r in one.collect()}[1]

    mixed = cp.stored(cp.mix_sources(spark, clean, ""), "t")
    taken = {r.doc_id: r.taken for r in mixing_op.mix(clean).collect()}
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.split())
    assert mixed.columns == docs.columns and got == {d: n for d, n in taken.items() if n}

    coded = cp.encode(spark, mixed, "")
    want = sorted((r.doc_id is None, r.doc_id or 0, len(bpe_op.encode_texts(bpe_op.vocabulary(cp.BYTE_BPE), [r.text])[0])) for r in mixed.collect())
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in coded.collect()) == want


def test_run_is_the_chain(spark):
    out = cp.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and set(out.columns) >= {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}


def test_empty_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in cp.STAGES:
        docs = cp.stored(stage(spark, docs, ""), name)
        assert docs.count() == 0


def test_one_of_each_with_odd_rows(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (3, None), (3, None), (4, ""), (None, "a b c d e f"), (None, "x y z"), (None, "x y z"), (5, "q"), (5, "r")], "doc_id long, text string")
    got = sorted([tuple(r) for r in ngram_join_op.one_of_each(df, 5, 80).collect()], key=str)
    assert got == sorted([(1, "a b c d e f"), (3, None), (3, None), (4, ""), (None, "x y z"), (5, "q"), (5, "r")], key=str)


def test_stage_parameters():
    assert cp.WORDS == 5 and cp.PERCENT == 80 and len(shingles("a b c d e f", 5)) == 2
    assert pii_op.KINDS == ("email", "ip", "card", "phone")
    with pytest.raises(ValueError):
        ngram_join_op.jaccard_components(None, 5, 50)
