import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe_op as op

PATH = public_tokenizers.path("byte_bpe_50k.json")
TABLE = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(texts):
    flat, count = op.encode_texts(op.vocabulary(PATH), texts)
    out, at = [], 0
    for n in count:
        out.append(flat[at:at + n].tolist())
        at += n
    return out


def test_awkward_texts(library):
    texts = ["", "a", "aaaaaaaaaaaaaaa", "aaaa aaaa  aaa", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", " \n\n  z\t", "don't we'll I'M",
             "日本語テキスト", "é́̂", "\x00\x1c\x85 a", "ՙ꙰𞤀ࢠ₝𐞻 ב", "😀😀 👩‍👩‍👧", "0123456789 " * 50, "　\xa0x", "A" * 5000, "the " * 3000]
    assert ids_of(texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_random_texts(library):
    rnd = random.Random(1)
    texts = ["".join(rnd.choices("abAB .,'\n\té1日ß$", k=rnd.randrange(200))) for _ in range(500)]
    texts += ["".join(chr(rnd.randrange(0x20, 0x2FFF)) for _ in range(80)) for _ in range(200)]
    assert ids_of(texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_stable_characters_have_the_library_classes(library):
    v = op.vocabulary(PATH)
    for lo, hi in ((0, 0x557), (0x2010, 0x2070), (0x3000, 0x30FF), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3)):
        for cp in range(lo, hi + 1):
            s = f"a{chr(cp)}b {chr(cp)}{chr(cp)} 1"
            assert v.stable.fullmatch(s)
            assert v.pattern.findall(s) == [s[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(s)], hex(cp)


def test_query_on_a_table(spark, library):
    rows = spark.read.parquet(TABLE).select("doc_id", "text").collect()
    got = {r[0]: tuple(r[1:]) for r in op.digest(op.round_trip(spark.read.parquet(TABLE), PATH)).collect()}
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r.text, add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert got[r.doc_id] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_nulls_repeats_and_extra_columns(spark):
    df = spark.createDataFrame([(None, "a b", 1, "q"), (1, None, 2, "q"), (2, "", 3, None), (2, "", 3, None)], "doc_id long, text string, ids int, decoded string")
    coded = op.round_trip(df, PATH)
    assert sorted(coded.collect(), key=str) == sorted([(None, [64, 275], "a b"), (1, [], ""), (2, [], ""), (2, [], "")], key=str)
    assert sorted(op.decode(op.encode(df, PATH), PATH).collect(), key=str) == sorted([(None, "a b"), (1, ""), (2, ""), (2, "")], key=str)
    bad = spark.createDataFrame([(1, None), (2, [64, None, 275])], "doc_id long, ids array<int>")
    assert sorted(op.decode(bad, PATH).collect()) == [(1, ""), (2, "a b")]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert op.digest(op.round_trip(df, PATH)).collect() == []
