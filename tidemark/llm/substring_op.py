"""Substring dedup by super-k-mer partitioning.

Every window of ``window`` consecutive words has a minimiser: the smallest hash
among its ``m``-word grams. Consecutive windows that share it travel as
one packed string to the group of that minimiser, where sorting the windows
finds equal ones; all but the earliest of a class are marked, and the
marks go back to their documents.

Hot groups. A passage that a third of the documents hold gives its windows
equal strings; each map task keeps the first of equal strings and marks the others,
so such strings travel once per task. What is left are windows that
straddle the passage's edge: their strings differ but would share the passage's
minimiser. A first pass counts packed strings per minimiser slot (exactly,
pre-aggregated per task); grams in slots above a group's fair share are
demoted, so a window takes one of them only if it has no other gram, and
such a window is dealt by its own content instead. The list of hot slots is bounded
by the number of groups, whatever the data.

Edge cases: null or empty text has no words; a null doc_id sorts after all others; rows
that repeat a doc_id are one document each, and of equal windows at the same (doc_id,
start) neither is earlier, so both stay; a null doc_id is never earlier than
anything; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (BLOBS, NO_ID, as_bytes, blob_rows, equal_windows, groups, hot_slots, intern, mixed,
                     nullable, pack, rolling, slices, slot_rows, tidy, unpack, word_hashes, word_spans)

GRAM = 3
CHUNK = 12 << 20
HOT_BIT = np.uint64(1 << 63)


def _slots(n_groups: int) -> int:
    return 1 << max(16, (64 * n_groups - 1).bit_length())


def _chunk(batch: pa.RecordBatch):
    """Words of a slice of documents, in doc_id order, as one text and the bytes where they begin and end;
    the first word of each row; the words' hashes."""
    doc = nullable(batch.column(0).to_pylist())
    mark = np.array(batch.column(1).to_pylist(), np.int64)
    texts = as_bytes(batch.column(2))
    order = np.lexsort((mark, doc))
    doc, mark = doc[order], mark[order]
    rows = [b" ".join((texts[k] or b"").split()) for k in order]
    first = np.cumsum([0, *[r.count(b" ") + 1 if r else 0 for r in rows]])
    text = b"\n".join([r for r in rows if r])
    begin, end = word_spans(text)
    return doc, mark, (text, begin, end), first, word_hashes(text, begin, end)


def _runs(first: np.ndarray, h: np.ndarray, window: int, hot: np.ndarray | None, n_slots: int):
    """Super-k-mers: (first window, last window, owner row, bucket) of each."""
    empty = np.empty(0, np.int64)
    if len(h) < window:
        return empty, empty, empty, empty.astype(np.uint64)
    gram = mixed(rolling(h, GRAM)) & ~HOT_BIT
    if hot is not None and len(hot):
        table = np.zeros(n_slots, bool)
        table[hot] = True
        gram = np.where(table[(gram & np.uint64(n_slots - 1)).astype(np.int64)], gram | HOT_BIT, gram)
    span, low, width = window - GRAM + 1, gram, 1
    while width * 2 <= span:
        low = np.minimum(low[:len(low) - width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
    n = len(h) - window + 1
    low = low[:n]
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    real = owner[:n] == owner[window - 1:window - 1 + n]
    at_hot = (low & HOT_BIT) != 0
    if at_hot.any():  # no other gram to go by: the window itself decides
        low = np.where(at_hot, mixed(rolling(h, window))[:n] | HOT_BIT, low)
    begins = real.copy()
    begins[1:] &= ~real[:-1] | (low[1:] != low[:-1]) | (owner[1:n] != owner[:n - 1])
    lo = np.flatnonzero(begins)
    ends = real.copy()
    ends[:-1] &= ~real[1:] | begins[1:]
    hi = np.flatnonzero(ends)
    return lo, hi, owner[lo], low[lo]


def _distinct(words, lo, hi, owner, doc, first, window):
    """Packed strings; which of them equal a string that an earlier (doc, start) of this chunk has."""
    text, begin, end = words
    strings = [text[a:b] for a, b in zip(begin[lo].tolist(), end[hi + window - 1].tolist(), strict=True)]
    start = lo - first[owner]
    seen: dict[bytes, int] = {}
    get = seen.setdefault
    lead = np.fromiter((get(s, i) for i, s in enumerate(strings)), np.int64, len(strings))
    d = doc[owner]
    later = (d[lead] < d) | ((d[lead] == d) & (start[lead] < start))
    # rows are in doc_id order, so the first one met is the earliest but for repeated rows of a document
    later &= d != NO_ID
    return strings, start, later


def _count(n_groups: int, window: int):
    n_slots = _slots(n_groups)

    def run(batches):
        total = np.zeros(n_slots, np.int64)
        for b in slices(batches, "text", CHUNK):
            _, _, _, first, h = _chunk(b)
            lo, hi, owner, bucket = _runs(first, h, window, None, n_slots)
            if len(lo):  # equal strings of a slice count once, as only one travels
                _, fresh = np.unique(mixed(rolling(h, window)[lo]) + (hi - lo).astype(np.uint64), return_index=True)
                bucket = bucket[fresh]
            total += np.bincount((bucket & np.uint64(n_slots - 1)).astype(np.int64), minlength=n_slots)
        yield blob_rows(slot_rows(total, n_groups))
    return run


def _hot_slots(docs: DataFrame, window: int, n_groups: int) -> np.ndarray:
    """Minimiser slots with over an eighth of a group's fair share of packed strings."""
    return hot_slots(docs.mapInArrow(_count(n_groups, window), BLOBS), _slots(n_groups), n_groups, 64, 8 * n_groups)


def _deal(n_groups: int, window: int, hot: np.ndarray):
    n_slots = _slots(n_groups)

    def run(batches):
        for b in slices(batches, "text", CHUNK):
            doc, mark, words, first, h = _chunk(b)
            lo, hi, owner, bucket = _runs(first, h, window, hot, n_slots)
            strings, start, later = _distinct(words, lo, hi, owner, doc, first, window)
            # strings to be sorted go by bucket; marks that are known already only pass through
            g = (mixed(bucket) % np.uint64(n_groups)).astype(np.int64)
            g = np.where(later, doc[owner] % n_groups, g)
            order = np.lexsort((later, g))
            cuts = np.flatnonzero((np.diff(g[order]) != 0) | (np.diff(later[order].astype(np.int8)) != 0)) + 1
            out = []
            for part in np.split(order, cuts):
                if not len(part):
                    continue
                text = b"" if later[part[0]] else b"\n".join([strings[i] for i in part.tolist()])
                o = owner[part]
                out.append((int(g[part[0]]), pack(doc[o], mark[o], start[part].astype(np.int32), (hi - lo + 1)[part].astype(np.int32), text=text)))
            yield blob_rows(out)
    return run


def _merge(doc, mark, start, n):
    """Join intervals of marked windows that touch: one row for each."""
    order = np.lexsort((start, mark, doc))
    doc, mark, start, end = doc[order], mark[order], start[order].astype(np.int64), start[order].astype(np.int64) + n[order]
    if not len(doc):
        return doc, mark, start, end
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1]) | (start[1:] > end[:-1])))
    at = np.flatnonzero(new)
    return doc[at], mark[at], start[at], np.maximum.reduceat(end, at)


def _offsets(c: np.ndarray, window: int):
    """Of packed strings with ``c`` windows each: first word of each string, string and place in it of each window."""
    word0 = np.concatenate(([0], np.cumsum(c + window - 1)))[:-1]  # c windows take c + window - 1 words
    row = np.repeat(np.arange(len(c)), c)
    return word0, row, np.arange(len(row)) - np.repeat(np.cumsum(c) - c, c)


def _repeating(texts: list[bytes], c: np.ndarray, window: int) -> tuple[np.ndarray, list[bytes]]:
    """Packed strings with a window whose hash occurs twice or more, and their words."""
    text = b"\n".join(texts)
    begin, end = word_spans(text)
    word0, row, off = _offsets(c, window)
    h = rolling(word_hashes(text, begin, end), window)[word0[row] + off]
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    rows = np.unique(row[np.concatenate((order[1:][same], order[:-1][same]))])
    strings = [text[a:b] for a, b in zip(begin[word0[rows]].tolist(), end[word0[rows] + c[rows] + window - 2].tolist(), strict=True)]
    return rows, b"\n".join(strings).split()


def _sort_group(window: int):
    def run(t: pa.Table) -> pa.Table:
        doc, mark, start, n, texts, done = [], [], [], [], [], []
        for blob in t.column("blob").to_pylist():
            d, m, s, c, text = unpack(blob, np.int64, np.int64, np.int32, np.int32)
            if text:
                doc.append(d), mark.append(m), start.append(s), n.append(c)
                texts.append(text)
            else:
                done.append((d, m, s, c))
        if texts:
            d, m, s, c = (np.concatenate(x) for x in (doc, mark, start, n))
            rows, words = _repeating(texts, c.astype(np.int64), window)
            d, m, s, c = d[rows], m[rows], s[rows], c[rows].astype(np.int64)
            ids, h = intern(words)
            del words, texts
            word0, row, off = _offsets(c, window)
            at, label = equal_windows(ids, rolling(h, window), word0[row] + off, window)
            if len(at):
                r, pos = row[at], s[row[at]] + off[at]
                order = np.lexsort((pos, d[r], label))
                r, pos, label = r[order], pos[order], label[order]
                lead = np.maximum.accumulate(np.where(np.concatenate(([True], label[1:] != label[:-1])), np.arange(len(r)), 0))
                late = ((d[r[lead]] < d[r]) | (pos[lead] < pos)) & ~((d[r[lead]] == NO_ID) & (d[r] == NO_ID))
                done.append((d[r][late], m[r][late], pos[late].astype(np.int32), np.ones(int(late.sum()), np.int32)))
        whole = [np.concatenate(x) for x in zip(*done, strict=True)] if done else [np.empty(0, np.int64)] * 4
        d, m, lo, hi = _merge(*whole)
        return pa.table({"doc_id": pa.array(d, pa.int64()), "mark": pa.array(m, pa.int64()),
                         "lo": pa.array(lo, pa.int64()), "hi": pa.array(hi, pa.int64())})
    return run


def repeated_windows(docs: DataFrame, window: int = 20) -> DataFrame:
    """(doc_id, mark, lo, hi): windows lo..hi-1 of a document whose words also start
    earlier. ``mark`` is the text's hash; it tells rows that repeat a doc_id apart.
    A null doc_id is carried as the largest long."""
    spark = docs.sparkSession
    n_groups = groups(spark)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), F.col("text").cast("string").alias("text"))
    hot = _hot_slots(src, window, n_groups)
    dealt = src.mapInArrow(_deal(n_groups, window, hot), BLOBS)
    return dealt.groupBy("g").applyInArrow(tidy(_sort_group(window)), "doc_id long, mark long, lo long, hi long")


def _cut(window: int):
    def run(batches):
        for b in batches:
            out = []
            for text, spans in zip(as_bytes(b.column(1)), b.column(2).to_pylist(), strict=True):
                words = (text or b"").split()
                gone = np.zeros(len(words) + 1, np.int64)
                for x in spans or ():
                    gone[x["lo"]] += 1
                    gone[min(x["hi"] + window - 1, len(words))] -= 1
                stay = np.cumsum(gone)[:-1] == 0
                kept = b" ".join([w for w, k in zip(words, stay.tolist(), strict=True) if k]) if spans else b" ".join(words)
                out.append((len(words), int(len(words) - stay.sum()), kept))
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                pa.array([x[2].decode("utf-8", "surrogatepass") for x in out], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_text"])
    return run


def substring_dedup(docs: DataFrame, window: int = 20) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_text (the words left, joined by
    one space)."""
    spans = (repeated_windows(docs, window).groupBy("doc_id", "mark")
             .agg(F.collect_list(F.struct("lo", "hi")).alias("spans")))
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = src.withColumn("k", F.coalesce("doc_id", F.lit(int(NO_ID)))).withColumn("m", F.xxhash64("text"))
    spans = spans.withColumnsRenamed({"doc_id": "k", "mark": "m"})
    return (keyed.join(spans, ["k", "m"], "left").select("doc_id", "text", "spans")
            .mapInArrow(_cut(window), "doc_id long, n_words long, n_removed long, kept_text string"))


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
