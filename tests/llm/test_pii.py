import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import pii_op as op

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def holds(kind, v):
    d = re.sub("[^0-9]", "", v)
    if kind == "ip":
        return all(int(x) <= 255 for x in v.split("."))
    if kind == "card":
        s = sum(sum(map(int, str(int(x) * 2))) if i % 2 else int(x) for i, x in enumerate(reversed(d)))
        return 14 <= len(d) <= 19 and s % 10 == 0
    return kind != "phone" or 10 <= len(d) <= 15


def base(text):
    out = []
    for k, (kind, p) in enumerate(PATTERNS.items()):
        out += [(m.start(), k, m.end()) for m in re.finditer(p, text or "", re.A) if holds(kind, m[0])]
    return sorted(out)


def row(d, text):
    spans = base(text)
    s = ",".join(f"{op.KINDS[k]}:{a}:{b}" for a, k, b in spans)
    return (d, *[sum(k == i for _, k, _ in spans) for i in range(4)], hashlib.sha256(s.encode()).hexdigest())


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "s", 3) for d, t in rows], "doc_id long, text string, source string, base int").repartition(3)


def run(spark, rows):
    return [tuple(r) for r in op.digest(op.find(frame(spark, rows))).collect()]


def check(spark, rows):
    got = run(spark, rows)
    assert sorted([r[:6] for r in got], key=str) == sorted([row(*r) for r in rows], key=str)
    texts = dict(rows)
    for r in got:  # base spans stay among all spans, in order
        spans = [s.split(":") for s in r[6].split(",") if s]
        keys = [(int(a), op.KINDS.index(k), int(b)) for k, a, b in spans]
        assert keys == sorted(set(keys))
        if len(texts) == len(rows):
            assert set(base(texts[r[0]])) <= set(keys)
    return got


AWKWARD = ["", None, "a@b.c", "a@b.c_d@e.f", "x..y@-.-", "a@b a@b. @b.c a@@b.c", "é.a@b.cé 日1.2.3.4日", "1.2.3.4.5.6.7.8.9", "256.1.1.1 0255.0.0.01 1.2.3 999999999999999999999.1.1.1",
           "4111 1111 1111 1111", "4111-1111-1111-1111 5500000000000004", "4111  1111 1111 1111", "4111111111111111 4111111111111111", "+1 (988) 555-2485", "+1 (988) 555-2485 4111111111111111",
           "+12345678901234567 +1 2 3", "+1234567890.", "++1234567890 +(1)", "1" * 40, "0" * 14, "\x01a@b.c\x00 1.1.1.1\n+4412345678901", "a%b+c-d_e.f@g-h.i-j.k", "5 5 5 5 5 5 5 5 5 5 5 5 5 5 5"]


def test_base_on_awkward_texts(spark):
    check(spark, list(enumerate(AWKWARD)))


@pytest.mark.parametrize("seed", [0, 1])
def test_base_on_random_texts(spark, seed):
    rnd = random.Random(seed)
    check(spark, [(i, "".join(rnd.choices("ab@._+-()0123456789  é\n", k=rnd.randrange(120)))) for i in range(300)])


def test_long_texts(spark):
    rows = [(1, "1 " * 20000), (2, "1.2.3.4 " * 2000), (3, "a" * 100000 + "@b.c"), (4, "a@" + "b." * 20000 + "c"), (5, "7" * 100000), (6, "+1" + "(" * 50000), (7, "x@y.z +4412345678901 4111111111111111 " * 200)]
    check(spark, rows)


def test_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    check(spark, rows)


def phone(rnd):
    return f"+1 ({rnd.randrange(200, 999)}) 555-{rnd.randrange(1000, 9999)}"


def test_unseen_identifiers_are_found(spark):
    """What base patterns lose where a phone and a card meet, and a phone in another spelling after known words."""
    rnd = random.Random(3)
    rows = [(i, f"word{i} please call me at {phone(rnd)} or not") for i in range(60)]
    rows += [(100 + i, f"other text{i} with 41111111111111{c} inside") for i, c in enumerate(("11", "29", "37", "45", "52", "60"))]
    both = "so +1 (269) 555-3296 4111111111111111 here"
    rows += [(200, both), (201, "please call me at (269) 555-3297 or not"), (202, "order 269 555 3298 of 10 units"), (203, "nothing 12 here 2024-01-02")]
    got = {r[0]: r[6] for r in check(spark, rows)}
    assert base(both) == []
    a, b = both.index("+1"), both.index("4111")
    assert f"phone:{a}:{a + 17}" in got[200].split(",")
    assert got[201] == "phone:18:32"
    assert got[202] == "" and got[203] == ""
    assert f"card:{b}:{b + 16}" in got[200].split(",")


def card(rnd):
    """Four groups of four digits that pass."""
    d = "4" + "".join(rnd.choices("0123456789", k=14))
    return next(f"{x[:4]} {x[4:8]} {x[8:12]} {x[12:]}" for x in (d + c for c in "0123456789") if holds("card", x))


def test_touching_identifiers_of_many_groups(spark):
    """Cards of four groups and phones of four to six, side by side: the base patterns take the run as a whole and drop it."""
    rnd = random.Random(5)
    make = [card, lambda r: f"+44 20 {r.randrange(1000, 9999)} {r.randrange(1000, 9999)}",
            lambda r: "+33 1 " + " ".join(str(r.randrange(10, 99)) for _ in range(4)), lambda r: f"+49 30 {r.randrange(100, 999)} {r.randrange(10, 99)} {r.randrange(10, 99)}"]
    rows = [(40 * k + i, f"text{i} has {f(rnd)} in it") for k, f in enumerate(make) for i in range(40)]
    want = {}
    for k, (f, g) in enumerate([(make[0], make[0]), (make[1], make[0]), (make[2], make[0]), (make[3], make[0])]):
        a, b = f(rnd), g(rnd)
        text = f"now {a} {b} here"
        assert base(text) == []
        rows.append((1000 + k, text))
        want[1000 + k] = [f"{'phone' if k else 'card'}:4:{4 + len(a)}", f"card:{5 + len(a)}:{5 + len(a) + len(b)}"]
    got = {r[0]: r[6].split(",") for r in check(spark, rows)}
    assert {d: [x for x in want[d] if x not in got[d]] for d in want} == {d: [] for d in want}
    texts = dict(op.masked(frame(spark, rows)).select("doc_id", "text").collect())
    assert all(not re.search("[0-9]", texts[d]) for d in want)


def test_pieces_are_cut_by_digits(spark):
    """Against all pieces from one token to another, by brute force; also with blanks and brackets between them."""
    rnd = random.Random(6)
    texts = ["x " + "".join(rnd.choices(["1", "23", "4567", "+8", "(90)", " ", " ", " ", " - ", "-", "."], k=30)) + " y" for _ in range(60)]
    texts += ["1 " * 3000, "1" + " " * 3000 + "2 3", "1 " + "( " * 2000 + "2", "123 " * 2000]
    df = spark.createDataFrame([(i, 0, t, []) for i, t in enumerate(texts)], f"doc_id long, mark long, text string, base {op._SPANS}")
    got = {(r.doc_id, r.start, r.hit) for r in op.candidates(df).collect()}
    want = set()
    for d, t in enumerate(texts):
        for m in re.finditer(r"(?<![\w.+(-])[+(]?[0-9][0-9().+ -]*(?<=[0-9])(?!\w)", t):
            tok = [x.span() for x in re.finditer("[^ ]+", m[0])]
            for i, (a, _) in enumerate(tok):
                for j, (_, b) in enumerate(tok[i:i + 40]):
                    hit = m[0][a:b]
                    n = len(re.sub("[^0-9]", "", hit))
                    if re.match(r"[+(]?[0-9]", hit) and re.search("[0-9][^ ]*$", hit) and (n >= 7 if j == 0 else 10 <= n <= 19):
                        want.add((d, m.start() + a, hit))
    assert got == want and len({h for _, _, h in want if h.count(" ") > 5}) > 100


def test_clean_text_has_no_spans(spark):
    rows = [(i, f"In 2024 the 12 cats of page {i} ate 1,000 fish; see 10.1000/182 and v1.2.3, room 4-12.") for i in range(50)]
    assert all(r[6] == "" for r in run(spark, rows))


def test_nulls_and_repeated_rows(spark):
    rows = [(None, "a@b.c"), (None, None), (1, "1.2.3.4"), (1, "1.2.3.4"), (1, "x"), (2, "")]
    check(spark, rows)


def test_masking(spark):
    rows = [(1, "mail a@b.c now"), (2, "é 1.2.3.4 日 +1 (988) 555-2485"), (3, None), (4, "plain"), (1, "mail a@b.c now"), (5, "x@1.2.3.4 y"), (6, "4111111111111111")]
    out = op.masked(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "source", "base"]
    assert sorted([(r[0], r[1]) for r in out.collect()], key=str) == sorted([(1, "mail [EMAIL] now"), (2, "é [IP] 日 [PHONE]"), (3, None), (4, "plain"), (1, "mail [EMAIL] now"), (5, "[EMAIL] y"), (6, "[CARD]")], key=str)


def test_empty_table_and_plan(spark):
    assert run(spark, []) == [] and op.masked(frame(spark, [])).collect() == []
    text = op.find(frame(spark, [(1, "a@b.c")]))._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text


def test_contexts_are_whole_words(spark):
    long = "w" * 30_000
    rows = [(f"a {long}b {long}: ", f"{long}b", f"{long}b {long}:"), (f"{long} ", "", f"{long}"), (" x\t\n", "", "x"), ("", "", ""), ("one two three", "", "two three")]
    df = spark.createDataFrame([(r[0],) for r in rows], "left string").select("left", op.last_words(F.col("left")).alias("last"))
    df = df.withColumn("one", op.words_before(F.col("last"), 1)).withColumn("two", op.words_before(F.col("last"), 2))
    for r in df.collect():
        words = r.left.split()
        assert r.last.split() == words[-2:]
        assert r.one == (words[-1] if words else "") and r.two == (" ".join(words[-2:]) if len(words) > 1 else "")
