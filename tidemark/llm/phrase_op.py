"""Phrases of two or three words per language, counted in burst tries of word ids.

A task cuts slices of text into pieces and words, numbers the words, and enters each word position once,
with the two words that follow it in its piece (or the piece's end): a phrase's count is the sum
of what lies below it.

1. ``Trie``: first words lead to hash containers of (second, third) word; a container that outgrows
   ``BURST`` entries bursts into one per second word. Over ``BUDGET`` entries, whole subtrees, the
   largest first, are spilled as sorted runs, one per prefix partition (a hash of the first two
   words, so a frequent word's subtree spreads), and forgotten. Entries are counts: a frequent
   word or pair leaves a task as many times as different words follow it, not as often as it occurs.
2. Each prefix partition merges its runs and keeps what occurs ``least`` times or more. The number of
   partitions follows the bytes of the table.
3. Counts of the two parts of each cut are joined to the phrases (their parts occur at least as often,
   so they were kept too), and the score is exact in 38-digit decimals: counts up to 10^15.

Words are compared as bytes, never by hash.

Edge cases: a null text has no words; a null lang counts as ``und``; repeated rows, and rows with null
ids, count like any others; equal scores and counts are ranked by the phrase's UTF-8 bytes; a table
without words has no phrases. Other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import MULT, blob_rows, mixed, pack, slices, stored, tidy, unpack

#: Bytes of text that are numbered and counted at once before they are entered.
CHUNK = 4 << 20
#: Entries of a container before it bursts, of a trie before it spills, words before a trie starts anew.
BURST = 1 << 12
BUDGET = 1_000_000
WORDS = 1 << 20
#: Bytes of text per prefix partition.
SHARE = 16 << 20

#: What ends a piece.
ENDS = b".,;:!?\n\x0b\x0c\r"
_TO_WORDS = bytes.maketrans(ENDS + b"\t", b"." * len(ENDS) + b" ")
_TOKEN = re.compile(rb"[ \t]*([" + re.escape(ENDS) + rb"]|[^ \t" + re.escape(ENDS) + rb"]+)")
#: Numbers of words have 21 bits: WORDS and STEP together stay below that.
_LOW = (1 << 21) - 1
STEP = 1_000_000


class Trie:
    """Counts of (first, second, third) word of one language; 0 is the end of a piece. Keys hold the three numbers."""

    def __init__(self):
        self.ids: dict[bytes, int] = {b".": 0}
        self.hashes = np.empty(0, np.uint64)
        self.root: dict[int, dict] = {}
        self.burst: dict[int, dict[int, dict]] = {}
        self.size: dict[int, int] = {}
        self.entries = 0

    def add(self, tokens: list[bytes], count: int) -> None:
        """Count the first ``count`` words; those after them only follow."""
        known = self.ids
        for t in set(tokens).difference(known):
            known[t] = len(known)
        w = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
        w = np.concatenate((w, [0, 0]))
        first, second, third = w[:count], w[1:count + 1], w[2:count + 2]
        third = np.where(second == 0, 0, third)
        here = first != 0
        key, n = np.unique(first[here] << 42 | second[here] << 21 | third[here], return_counts=True)
        first = key >> 42
        cuts = np.concatenate(([0], np.flatnonzero(first[1:] != first[:-1]) + 1, [len(key)])).tolist()
        key, n, first = key.tolist(), n.tolist(), first.tolist()
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if lo < hi:
                self._enter(first[lo], key[lo:hi], n[lo:hi])

    def _enter(self, f: int, keys: list[int], n: list[int]) -> None:
        node = self.burst.get(f)
        before = self.size.get(f, 0)
        if node is None:
            box = self.root.setdefault(f, {})
            get = box.get
            for s, k in zip(keys, n, strict=True):
                box[s] = get(s, 0) + k
            size = len(box)
            if size > BURST:
                node = self.burst[f] = {}
                for s, k in self.root.pop(f).items():
                    node.setdefault(s >> 21, {})[s] = k
        else:
            size = before
            for s, k in zip(keys, n, strict=True):
                box = node.setdefault(s >> 21, {})
                if s in box:
                    box[s] += k
                else:
                    box[s] = k
                    size += 1
        self.size[f] = size
        self.entries += size - before

    def take(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Remove the largest subtrees until ``least`` entries or fewer are left: (keys, counts), unsorted."""
        keys, counts = [], []
        for f, size in sorted(self.size.items(), key=lambda x: -x[1]):
            if self.entries <= least:
                break
            self.entries -= size
            del self.size[f]
            for box in [self.root.pop(f)] if f in self.root else self.burst.pop(f).values():
                keys.extend(box)
                counts.extend(box.values())
        return np.array(keys, np.int64), np.array(counts, np.int64)

    def runs(self, least: int, parts: int, seed: int) -> list[tuple[int, bytes]]:
        """Spill: a run for each prefix partition, sorted by the words' numbers."""
        key, n = self.take(least)
        if not len(key):
            return []
        order = np.argsort(key)
        key, n = key[order], n[order]
        words = list(self.ids)
        fresh = words[len(self.hashes):]
        h = self.hashes = np.concatenate((self.hashes, np.fromiter(map(xxhash.xxh3_64_intdigest, fresh), np.uint64, len(fresh))))
        w = [key >> 42, key >> 21 & _LOW, key & _LOW]
        with np.errstate(over="ignore"):
            part = (mixed(h[w[0]] * np.uint64(MULT) + h[w[1]] + np.uint64(seed)) % np.uint64(parts)).astype(np.int64)
        one = np.flatnonzero(np.concatenate(([True], w[0][1:] != w[0][:-1])))
        ones, sums = w[0][one], np.add.reduceat(n, one)
        with np.errstate(over="ignore"):
            alone = (mixed(h[ones] + np.uint64(seed)) % np.uint64(parts)).astype(np.int64)
        order, order1 = np.argsort(part, kind="stable"), np.argsort(alone, kind="stable")
        n, w, ones, sums = n[order], [x[order] for x in w], ones[order1], sums[order1]
        span = np.searchsorted(part[order], np.arange(parts + 1)).tolist()
        span1 = np.searchsorted(alone[order1], np.arange(parts + 1)).tolist()
        rows = []
        for p in range(parts):
            lo, hi, lo1, hi1 = span[p], span[p + 1], span1[p], span1[p + 1]
            if lo == hi and lo1 == hi1:
                continue
            used, at = np.unique(np.concatenate([*[x[lo:hi] for x in w], ones[lo1:hi1], [0]]), return_inverse=True)
            at, size = at.astype(np.int32), hi - lo
            chosen = [words[i] for i in used.tolist()]
            rows.append((p, pack(at[:size], at[size:2 * size], at[2 * size:3 * size], n[lo:hi], at[3 * size:-1], sums[lo1:hi1],
                                 np.fromiter(map(len, chosen), np.int32, len(chosen)), text=b"".join(chosen))))
        return rows


def steps(data: bytes):
    """Words of a text in lots of ``STEP`` words at most, with the two that follow; ``.`` stands for a piece's end."""
    while data:
        cut = len(data)
        if cut > 2 * CHUNK:
            cut = 1 + max(data.rfind(bytes([c]), 0, 2 * CHUNK) for c in ENDS) or max(data.rfind(b" ", 0, 2 * CHUNK), data.rfind(b"\t", 0, 2 * CHUNK), 0) or cut
        tokens = data[:cut].translate(_TO_WORDS).replace(b".", b" . ").split()
        n = len(tokens)
        at = cut
        while len(tokens) < n + 2 and (m := _TOKEN.match(data, at)):
            tokens.append(m[1].translate(_TO_WORDS))
            at = m.end()
        for lo in range(0, n, STEP):
            yield tokens[lo:lo + STEP + 2], min(STEP, n - lo)
        data = data[cut:]


def _count(parts: int):
    def run(batches):
        tries: dict[str, Trie] = {}
        out: list[tuple[str, int, bytes]] = []

        def rows():
            b = blob_rows([(p, blob) for _, p, blob in out])
            b = pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), *b.columns], ["lang", "g", "blob"])
            out.clear()
            return b

        def spill(lang: str, least: int) -> None:
            out.extend((lang, *r) for r in tries[lang].runs(least, parts, xxhash.xxh3_64_intdigest(lang.encode())))

        for b in slices(batches, "text", CHUNK):
            texts: dict[str, list[bytes]] = {}
            for lang, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if t:
                    texts.setdefault(lang, []).append(t)
            for lang, t in texts.items():
                trie = tries.setdefault(lang, Trie())
                for tokens, n in steps(b".".join(t).lower()):
                    trie.add(tokens, n)
                    if len(trie.ids) > WORDS:
                        spill(lang, 0)
                        tries[lang] = trie = Trie()
            while sum(t.entries for t in tries.values()) > BUDGET:
                lang = max(tries, key=lambda x: tries[x].entries)
                spill(lang, tries[lang].entries // 4)
            if out:
                yield rows()
        for lang in list(tries):
            spill(lang, 0)
            del tries[lang]
        yield rows()
    return run


def sums_of(at: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    np.add.at(out, at, n)
    return out


def _merge(least: int):
    """Runs of one prefix partition of one language, merged: (lang, phrase, words, f) of what occurs ``least`` times
    or more, and a row of no words with the number of words that start with one of its prefixes."""
    def run(t: pa.Table) -> pa.Table:
        known: dict[bytes, int] = {b".": 0}
        first, second, third, n, ones, sums = ([] for _ in range(6))
        for blob in t.column("blob").to_pylist():
            a, b, c, k, o, s, size, text = unpack(blob, *[np.int32] * 3, np.int64, np.int32, np.int64, np.int32)
            ends = np.cumsum(size).tolist()
            words = [text[lo:hi] for lo, hi in zip([0, *ends[:-1]], ends, strict=True)]
            ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
            first.append(ids[a]), second.append(ids[b]), third.append(ids[c]), n.append(k), ones.append(ids[o]), sums.append(s)
        words, v = list(known), len(known)
        a, b, c, n = (np.concatenate(x) for x in (first, second, third, n))
        two, at = np.unique(a * v + b, return_inverse=True)
        f2 = sums_of(at, n, len(two))
        three, at3 = np.unique(at * v + c, return_inverse=True)
        f3 = sums_of(at3, n, len(three))
        f1 = sums_of(np.concatenate(ones), np.concatenate(sums), v)
        phrase, size, f = [], [], []

        def keep(k: int, columns: list[np.ndarray], count: np.ndarray) -> None:
            phrase.extend(b" ".join([words[i] for i in x]).decode() for x in zip(*[c.tolist() for c in columns], strict=True))
            size.extend([k] * len(count)), f.extend(count.tolist())

        phrase.append(None), size.append(0), f.append(int(f1.sum()))
        ok = f1 >= least
        keep(1, [np.flatnonzero(ok)], f1[ok])
        ok = (f2 >= least) & (two % v != 0)
        keep(2, [two[ok] // v, two[ok] % v], f2[ok])
        ok = (f3 >= least) & (three % v != 0)
        pair = two[three[ok] // v]
        keep(3, [pair // v, pair % v, three[ok] % v], f3[ok])
        return pa.table({"lang": pa.array([t.column("lang")[0].as_py()] * len(phrase), pa.string()), "phrase": pa.array(phrase, pa.string()),
                         "words": pa.array(size, pa.int32()), "f": pa.array(f, pa.int64())})
    return run


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))


def phrase_counts(docs: DataFrame, least: int = 10) -> DataFrame:
    """(lang, phrase, words, f) of the phrases of one to three words that occur ``least`` times or more; rows with 0 for
    ``words`` add up to the number of words of a language."""
    spark, rows = docs.sparkSession, _source(docs)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARE))
    runs = rows.mapInArrow(_count(parts), "lang string, g int, blob binary")
    return stored(runs.groupBy("lang", "g").applyInArrow(tidy(_merge(least)), "lang string, phrase string, words int, f long"), "phrases")


def collocations(counts: DataFrame, share: int = 50) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of the phrases of two and three words in ``phrase_counts``. The
    weakest cut counts. Phrases inside one that occurs ``share`` percent as often or more are left out."""
    word = F.split("phrase", " ")
    c = counts.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), word.alias("w"))
    cuts = c.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"), "w").select(
        "lang", "phrase", "words", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("cut") + 1, F.col("words")), " ").alias("right"))

    def part(side: str, f: str) -> DataFrame:
        return counts.select(F.col("lang").alias(f"{side}_lang"), F.col("phrase").alias(f"{side}_phrase"), F.col("f").alias(f))

    scored = cuts
    for side, f in (("left", "l"), ("right", "r")):
        scored = scored.join(part(side, f), (F.col("lang") == F.col(f"{side}_lang")) & (F.col(side) == F.col(f"{side}_phrase")))
    a, l, r = (F.col(x).cast("decimal(15,0)") for x in "alr")  # noqa: E741
    scored = scored.select("lang", "phrase", "words", "a", "cut", "l", "r", ((a * a * F.lit(1_000_000).cast("decimal(7,0)")).alias("over")), (l * r).alias("under"))
    scored = scored.withColumn("score", F.expr("over div under"))
    best = scored.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    three = c.filter("words = 3")
    inside = three.select("lang", F.array_join(F.slice("w", 1, 2), " ").alias("phrase"), "a").unionByName(
        three.select("lang", F.array_join(F.slice("w", 2, 2), " ").alias("phrase"), "a")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(inside, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    return kept.select("lang", "phrase", "words", "a", "b.l", "b.r", "b.score")


def top(docs: DataFrame, least: int = 10, share: int = 50, best: int = 2000) -> DataFrame:
    """Each language's ``best`` first phrases by score, with the language's number of words."""
    counts = phrase_counts(docs, least)
    w = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = collocations(counts, share).withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= best)
    n = counts.filter("words = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
