import random

import public_tokenizers
import pytest
import sentencepiece

from tidemark.llm import token_count_op as op

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def counts(spark, rows):
    df = spark.createDataFrame([(d, t, "x", 9) for d, t in rows], "doc_id long, text string, source string, n_bytes int").repartition(3)
    return sorted([tuple(r) for r in op.digest(op.token_counts(df, PATH)).collect()], key=str)


def want(p, rows):
    out = []
    for d, t in rows:
        n = len(p.encode(t or ""))
        out.append((d, len((t or "").encode()), n, n > 4096))
    return sorted(out, key=str)


def test_awkward_texts(spark, library):
    texts = ["", "a", " ", "  ", "a  b   c", "\n", "\n\na\n b\n", "▁a ▁▁ b", "\r\n x;\r\n", "日本 語", "é　Ａ\x00\x1c", "<s> </s> <unk> <0x41>", "a" * 9000, " " * 40,
             "\n" * 5000, "word " * 5000, "\tx\t", "x y\x85z"]
    rows = list(enumerate(texts))
    assert counts(spark, rows) == want(library, rows)


def test_random_texts(spark, library):
    rnd = random.Random(2)
    rows = [(i, "".join(rnd.choices("abcdethe  \n▁.,é日\r\t1<0x>", k=rnd.randrange(300)))) for i in range(400)]
    assert counts(spark, rows) == want(library, rows)


def test_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted([tuple(r) for r in op.digest(op.token_counts(docs, PATH)).collect()], key=str) == want(library, rows)


def test_nulls_and_repeated_rows(spark, library):
    rows = [(None, "a b"), (None, None), (1, None), (2, "c"), (2, "c")]
    assert counts(spark, rows) == want(library, rows)


def test_empty_table(spark):
    assert counts(spark, []) == []


def test_blocks_of_one_document(spark, library, monkeypatch):
    rows = [(i, f"the same words {i % 3} again ") for i in range(40)]
    monkeypatch.setattr(op, "CHUNK", 1)
    assert counts(spark, rows) == want(library, rows)
