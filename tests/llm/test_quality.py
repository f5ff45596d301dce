import base64
import random
import re
from collections import Counter

import zstandard

from tidemark.llm import quality_op as op

WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    t = text or ""
    words = re.findall(WORD, t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    wins = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(wins)
    rep = {j for i, w in enumerate(wins) if often[w] > 1 for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(rep) > 30 * len(words)
    b = t.encode()
    ratio = lambda x: len(x) / len(zstandard.ZstdCompressor(level=3).compress(x)) if x else 0.0
    low, high = next((lo, hi) for n, lo, hi in reversed(op.BANDS) if len(b) >= n)
    parts = [ratio(b[i:i + 2000]) for i in range(0, len(b) - 1999, 2000)]
    ok = low <= ratio(b) <= high and sum(not 1.38 <= r <= 2.75 for r in parts) * 4 <= len(parts)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(rep), failed, ok and not failed)


def prose(rnd, n):
    syllables = "the an re on ing tion es ed or ti ha st nd ou ea".split()
    return " ".join("".join(rnd.choices(syllables, k=rnd.randrange(1, 4))) for _ in range(n))


def samples():
    rnd = random.Random(0)
    out = [None, "", " \n\t\v", "one", "é日 $#|<x>", "a b c d e f g h " * 4, prose(rnd, 19), prose(rnd, 20)]
    out += [prose(rnd, n) for n in (30, 100, 400, 2000, 9000)]
    out += ["\n".join([prose(rnd, 12)] * 3 + [prose(rnd, 12), "", " ", " "]), "\n".join(["same line here"] * 300), "x\r\ny\r\nx\r\n"]
    out += [base64.b64encode(rnd.randbytes(3000)).decode(), " ".join(base64.b64encode(rnd.randbytes(9)).decode() for _ in range(400))]
    p = prose(rnd, 15)
    out += [f"{prose(rnd, 40)} {p} {prose(rnd, 30)} {p}", prose(rnd, 3000) + " " + "lorem ipsum " * 1500]
    return out


def test_matches_brute_force(spark):
    rows = list(enumerate(samples()))
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, kept string, n_words int").repartition(3)
    got = {r.doc_id: tuple(r)[1:8] for r in op.rate(df).collect()}
    assert got == {i: brute(t) for i, t in rows}


def test_verdicts():
    rnd = random.Random(4)
    good = [prose(rnd, n) for n in (25, 60, 200, 1000, 5000, 20000)]
    bad = [base64.b64encode(rnd.randbytes(3000)).decode(), "the same words again and again " * 200, prose(rnd, 2000) + " lorem ipsum" * 4000]
    packer = zstandard.ZstdCompressor(level=3)
    assert all(op.in_bands(packer, t.encode())[0] for t in good)
    assert not any(op.in_bands(packer, t.encode())[0] for t in bad)


def test_every_byte_is_in_a_chunk():
    """From the rule: each byte counts once, as part of its chunk; what is left of the text, as part of its last 2000 bytes."""
    rnd = random.Random(7)
    packer = zstandard.ZstdCompressor(level=3)
    text, noise = prose(rnd, 4000).encode(), base64.b64encode(rnd.randbytes(9000))
    shapes = [(g, n) for g in (0, 300, 1999, 2000, 4000, 5000, 6000, 9500) for n in (0, 1, 700, 1500, 1850, 1999, 2000, 2001, 3500, 4000)]
    seen = set()
    for g, n in shapes:
        for t in (text[:g] + noise[:n], noise[:n] + text[:g]):
            bad = set()
            for i in range(len(t) if len(t) >= 2000 else 0):
                left = i // 2000 * 2000
                w = t[left:left + 2000] if left + 2000 <= len(t) else t[-2000:]
                r = len(w) / len(packer.compress(w)) if i % 100 == 0 or i == left else r
                if not 1.38 <= r <= 2.75:
                    bad.add(i)
            ok, whole, chunks, out = op.in_bands(packer, t)
            low, high = next((lo, hi) for least, lo, hi in reversed(op.BANDS) if len(t) >= least)
            assert ok == (low <= whole <= high and 4 * len(bad) <= len(t))
            assert (chunks, out) == (-(-len(t) // 2000) if len(t) >= 2000 else 0, len({i // 2000 for i in bad}))
            seen.add((ok, len(t) % 2000 > 0))
    assert len(seen) == 4


def test_noise_at_the_end_counts_wherever_the_cut_falls():
    rnd = random.Random(8)
    packer = zstandard.ZstdCompressor(level=3)
    good, noise = prose(rnd, 2000).encode(), base64.b64encode(rnd.randbytes(3000))
    for n in (1900, 1999, 2000, 2001):
        assert op.in_bands(packer, good[:4000] + noise[:n])[0] is False
        assert op.in_bands(packer, good[:4000 + n])[0] is True


def test_given_documents_are_kept(spark):
    """Of the documents labelled good with 20 words or more, the bands keep all."""
    d = "/root/testdata/sf0.01"
    good = spark.read.parquet(f"{d}/labels.parquet").filter("quality = 1").select("doc_id")
    rated = op.rate(spark.read.parquet(f"{d}/documents.parquet")).join(good, "doc_id")
    assert rated.filter("not base_failed and not kept").count() == 0


def test_filter_keeps_columns_and_repeated_rows(spark):
    rnd = random.Random(1)
    t = prose(rnd, 50)
    df = spark.createDataFrame([(1, t, "a", None), (1, t, "a", None), (None, t, None, 3), (2, None, "b", 4), (3, "short", "b", 5)], "doc_id long, text string, kept string, n_words int")
    kept = op.keep_good(df)
    assert kept.columns == df.columns
    assert sorted(kept.collect(), key=str) == sorted([(1, t, "a", None), (1, t, "a", None), (None, t, None, 3)], key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert op.rate(df).collect() == [] and op.keep_good(df).collect() == []


SCRIPTS = {"Cyrillic": 0x430, "Greek": 0x3B0, "Arabic": 0x627, "Devanagari": 0x915, "Thai": 0xE01, "Georgian": 0x10D0}


def in_script(text, first):
    """The same text, letters replaced one for one."""
    return text.lower().translate({ord("a") + i: chr(first + i) for i in range(26)})


def test_bands_hold_for_other_alphabets(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    good = [r.text for r in docs.join(labels.filter("quality = 1"), "doc_id").collect() if len((r.text or "").split()) >= 20]
    packer = zstandard.ZstdCompressor(level=3)
    rnd = random.Random(3)
    noise = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=8000))
    assert len(good) > 100
    for first in SCRIPTS.values():
        kept = [op.in_bands(packer, in_script(t, first).encode())[0] for t in good]
        assert sum(kept) >= 0.95 * len(kept)
        assert not op.in_bands(packer, in_script("the same words again and again " * 200, first).encode())[0]
        # 64 letters at random, in both cases of Cyrillic; 26 at random pass in Latin too
        assert op.in_bands(packer, in_script(noise, first).encode())[0] == op.in_bands(packer, noise.encode())[0]
    assert not op.in_bands(packer, "".join(chr(0x410 + rnd.randrange(64)) for _ in range(6000)).encode())[0]


def test_ideographs_keep_their_bytes():
    rnd = random.Random(5)
    packer = zstandard.ZstdCompressor(level=3)
    vocab = [chr(0x4E00 + rnd.randrange(4000)) for _ in range(1500)]
    zipf = [1 / (i + 1) for i in range(1500)]
    text = "".join(rnd.choices(vocab, zipf, k=4000))
    assert op.letters_as_bytes(text.encode()) == text.encode()
    assert op.in_bands(packer, text.encode())[0]
    assert not op.in_bands(packer, (text[:30] * 100).encode())[0]
    assert op.letters_as_bytes("aéあ日".encode()) == b"a\xe9" + bytes([0xC0 | 0x60 & 0x3F, 0xC2]) + "日".encode()
    assert op.letters_as_bytes(b"\xff\xfe bad") and op.letters_as_bytes(b"") == b""
