"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs: up to the end of a line or sentence, white space after it included, and
longer runs where a hash of the last eight bytes says so, so that an edit moves no other cut. The k-th
occurrence of a paragraph in its text has a digest of its own. A fingerprint has ``CELLS`` cells: each
digest is added to one cell of each of three parts of it (number, sum of digests, sum of check values).

Fingerprints of two versions are subtracted cell by cell: what they share cancels. Cells that hold one
digest are read and taken off the others until none is left (peeling): that gives the digests
that differ, with their side. If cells remain, too much differs for the size, and sketches four times as
large are made of the same two texts, until peeling ends. The likeness of two texts is the Jaccard
index of their paragraphs, from the number of differing digests.

``neighbours``: the next document comes from one range shuffle of the texts, and is read from the
sorted stream. Ranges are cut by doc_id and text hash, so that many rows of one doc_id (or null) spread.
The last document of a range meets the first one of the next range in a join with two rows per range.
A task holds a slice of texts at a time.

Edge cases: a null text is the empty one; two empty texts have a likeness of 1; null doc_ids come last in the
descending order, equal ones in the order of a hash of the text; a row that is alone is its own next; repeated
rows give a row each; an empty table gives none. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MULT, mixed, rolling, slices, stored

#: Cells of a fingerprint (a multiple of three), and how much larger the sketches of a retry are.
CELLS, GROW = 12, 4
CHUNK = 2 << 20
#: Bytes from which a paragraph is cut further, and the mean length of these cuts.
LONG, MEAN = 512, 256
#: Paragraphs end with a line or a sentence.
PARAGRAPH = re.compile(rb"[^\n.!?]*+[\n.!?][\s.!?]*+|[^\n.!?]+")
_HEAD = np.dtype([("paragraphs", "<u4"), ("text", "<u8")])
_CELL = np.dtype([("count", "<i4"), ("key", "<u8"), ("check", "<u4")])
_LOW = np.uint64(0xFFFFFFFF)


def paragraphs(text: bytes) -> list[bytes]:
    """Paragraphs; joined they are the text."""
    out = []
    for p in PARAGRAPH.findall(text):
        if len(p) <= LONG:
            out.append(p)
            continue
        h = mixed(rolling(np.frombuffer(p, np.uint8).astype(np.uint64) + np.uint64(1), 8))
        cuts = (np.flatnonzero(h % np.uint64(MEAN) == 0) + 8).tolist()
        out += [x for x in (p[lo:hi] for lo, hi in zip([0, *cuts], [*cuts, len(p)], strict=True)) if x]
    return out


def digests(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Paragraph digests of all texts, and the text of each; the same paragraph again gets another one."""
    found = [[xxhash.xxh3_64_intdigest(p) for p in paragraphs(t)] for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(f) for f in found])
    h = np.array([x for f in found for x in f], np.uint64)
    if not len(h):
        return h, owner
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])))
    at = np.arange(len(h))
    again = at - np.maximum.accumulate(np.where(new, at, 0))
    with np.errstate(over="ignore"):
        return mixed(h + again.astype(np.uint64) * np.uint64(MULT)), owner


def _check(keys: np.ndarray) -> np.ndarray:
    return mixed(keys ^ np.uint64(0x5851F42D4C957F2D)) & _LOW


def _places(keys: np.ndarray, cells: int) -> list[np.ndarray]:
    part = cells // 3
    with np.errstate(over="ignore"):
        return [(mixed(keys * np.uint64(2 * j + 3) + np.uint64(cells)) % np.uint64(part)).astype(np.int64) + j * part for j in range(3)]


def sketch(keys: np.ndarray, owner: np.ndarray, n: int, cells: int) -> np.ndarray:
    """Sketches of ``n`` texts: (count, key, check) sums modulo 2^64, shape (3, n, cells)."""
    out = np.zeros((3, n * cells), np.uint64)
    values = np.ones(len(keys), np.uint64), keys, _check(keys)
    for place in _places(keys, cells):
        for total, v in zip(out, values, strict=True):
            np.add.at(total, owner * cells + place, v)
    return out.reshape(3, n, cells)


def peel(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Digests in differences of sketches: (text, digest, side 1 or -1), and which texts were peeled whole."""
    _, n, m = cells.shape
    count, key, check = (c.reshape(-1).copy() for c in cells)
    found: list[tuple] = []
    one, minus = np.uint64(1), np.uint64(2**64 - 1)
    active = np.flatnonzero((count != 0) | (key != 0))
    with np.errstate(over="ignore"):
        for _ in range(m + 8):  # a sketch of m cells gives one digest a round at least, or none
            side = count[active]
            at = active[(side == one) | (side == minus)]
            sign = count[at]  # 1 or -1 modulo 2^64
            keys = key[at] * sign
            pure = (check[at] * sign) & _LOW == _check(keys)
            at, keys, sign = at[pure], keys[pure], sign[pure]
            if not len(at):
                break
            text = at // m
            _, first = np.unique(np.stack((text.astype(np.uint64), keys), axis=1), axis=0, return_index=True)
            text, keys, sign = text[first], keys[first], sign[first]
            found.append((text, keys, np.where(sign == one, 1, -1)))
            values = sign, keys * sign, _check(keys) * sign
            for place in _places(keys, m):
                for total, v in zip((count, key, check), values, strict=True):
                    np.subtract.at(total, text * m + place, v)
            active = active[(count[active] != 0) | (key[active] != 0)]
    left = ((count != 0) | (key != 0) | (check & _LOW != 0)).reshape(n, m).any(axis=1)
    parts = [np.concatenate(x) if found else np.empty(0, t) for x, t in zip(zip(*found, strict=True) if found else [()] * 3, (np.int64, np.uint64, np.int64), strict=True)]
    return *parts, ~left


def differences(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Digests in which texts of ``a`` and ``b`` (as ``digests`` gives them) differ: (text, digest, side), and
    the cells each pair needed."""
    todo, cells, found, needed = np.arange(n), CELLS, [], np.zeros(n, np.int64)
    while len(todo):
        place = np.full(n, -1)
        place[todo] = np.arange(len(todo))
        sides = []
        for keys, owner in (a, b):
            here = place[owner] >= 0
            sides.append(sketch(keys[here], place[owner[here]], len(todo), cells))
        with np.errstate(over="ignore"):
            text, keys, side, whole = peel(sides[0] - sides[1])
        ok = whole[text]
        found.append((todo[text[ok]], keys[ok], side[ok]))
        needed[todo[whole]] = cells
        todo, cells = todo[~whole], cells * GROW
    return *[np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(3)], needed


def packed(keys: np.ndarray, owner: np.ndarray, texts: list[bytes]) -> list[bytes]:
    """Fingerprints of texts."""
    n = len(texts)
    cells = sketch(keys, owner, n, CELLS)
    rows = np.empty((n, CELLS), _CELL)
    rows["count"], rows["key"], rows["check"] = cells[0].astype(np.int64), cells[1], cells[2] & _LOW
    head = np.empty(n, _HEAD)
    head["paragraphs"] = np.bincount(owner, minlength=n)
    head["text"] = [xxhash.xxh3_64_intdigest(t) for t in texts]
    return [head[i].tobytes() + rows[i].tobytes() for i in range(n)]


def difference(a: bytes, b: bytes) -> tuple[list[int], list[int]] | None:
    """Digests that only the first, and only the second fingerprint has; None if more differs than they can tell."""
    cells = []
    for f in (a, b):
        rows = np.frombuffer(f, _CELL, offset=_HEAD.itemsize)
        cells.append(np.stack([rows["count"].astype(np.int64).view(np.uint64), rows["key"], rows["check"].astype(np.uint64)])[:, None, :])
    with np.errstate(over="ignore"):
        _, keys, side, whole = peel(cells[0] - cells[1])
    return (sorted(keys[side > 0].tolist()), sorted(keys[side < 0].tolist())) if whole[0] else None


def likeness(n_a: np.ndarray, n_b: np.ndarray, differ: np.ndarray) -> np.ndarray:
    both = n_a + n_b + differ
    return np.where(both == 0, 1.0, (n_a + n_b - differ) / np.maximum(both, 1))


_ROW = ("kind int, part int, doc_id long, n_chars long, edited_sha binary, fingerprint binary, edited_fingerprint binary, "
        "near_edited double, near_next double, n_paragraphs long, text string")
_SCHEMA = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha", pa.binary()), ("fingerprint", pa.binary()),
                     ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("n_paragraphs", pa.int64()), ("text", pa.string())])


def edit(text: str, following: str) -> str:
    """The last half of the code points replaced by as many first ones of the following text, or all of it."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compared(ids: list[int | None], texts: list[str], nexts: list[str] | None = None) -> pa.RecordBatch:
    """Rows of documents with their next ones: those of ``nexts``, or each the one after it in ``texts``, whose
    last one has no row."""
    raw = [t.encode() for t in texts]
    keys, owner = digests(raw)
    if nexts is None:
        n, following = len(ids), texts[1:]
        own = owner < n
        a, b = (keys[own], owner[own]), (keys[owner > 0], owner[owner > 0] - 1)
    else:
        n, following = len(ids), nexts
        a, b = (keys, owner), digests([t.encode() for t in nexts])
    changed = [edit(t, f).encode() for t, f in zip(texts[:n], following, strict=True)]
    e = digests(changed)
    size, size_b, size_e = (np.bincount(x[1], minlength=n) for x in (a, b, e))
    near = [likeness(size, s, np.bincount(differences(a, x, n)[0], minlength=n)) for x, s in ((e, size_e), (b, size_b))]
    cols = [[0] * n, [0] * n, ids, [len(t) for t in texts[:n]], [hashlib.sha256(c).digest() for c in changed], packed(*a, raw[:n]), packed(*e, changed), near[0], near[1], size, [None] * n]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SCHEMA, strict=True)], schema=_SCHEMA)


def _edge(kind: int, part: int, row: tuple[int | None, str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"kind": kind, "part": part, "doc_id": row[0], "text": row[1]}], _SCHEMA)


def _stream(batches):
    """Rows of one range in order: each against the next; the first and the last one also as they are (kinds 1 and 2)."""
    part, last = TaskContext.get().partitionId(), None
    for b in slices(batches, "text", CHUNK):
        rows = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        if last is None:
            yield _edge(1, part, rows[0])
        else:
            rows.insert(0, last)
        last = rows[-1]
        if len(rows) > 1:
            yield compared([r[0] for r in rows[:-1]], [r[1] for r in rows])
    if last is not None:
        yield _edge(2, part, last)


def _pairs(batches):
    for b in slices(batches, "text", CHUNK):
        yield compared(*[b.column(i).to_pylist() for i in range(3)])


def neighbours(docs: DataFrame) -> DataFrame:
    """A row per document: its fingerprint, that of its edited text, and the likeness to that and to the next
    document's (descending doc_id, after the last the first)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    order = [F.desc_nulls_last("doc_id"), F.col("h")]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = stored(rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(_stream, _ROW), "fingerprints")
    filled = sorted(r.part for r in made.filter("kind = 2").select("part").collect())  # at most one number per range
    after = F.broadcast(spark.createDataFrame(list(zip(filled, [*filled[1:], *filled[:1]], strict=True)), "part int, after int"))
    first = made.filter("kind = 1").select(F.col("part").alias("after"), F.col("text").alias("following"))
    edges = made.filter("kind = 2").select("part", "doc_id", "text").join(after, "part").join(first, "after").select("doc_id", "text", "following")
    return made.filter("kind = 0").unionByName(edges.mapInArrow(_pairs, _ROW)).drop("kind", "part", "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_paragraphs, fingerprint) of every row."""
    def run(batches):
        for b in slices(batches, "text", CHUNK):
            texts = [(t or "").encode() for t in b.column(1).to_pylist()]
            keys, owner = digests(texts)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.bincount(owner, minlength=len(texts)), pa.int64()), pa.array(packed(keys, owner, texts), pa.binary())],
                                             ["doc_id", "n_paragraphs", "fingerprint"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_paragraphs long, fingerprint binary")


def changes(versions: DataFrame) -> DataFrame:
    """Paragraph digests that differ between versions: rows (doc_id, old, new) give (doc_id, removed, added, cells)
    with the digests as signed 64-bit numbers in order, and the size of the sketches that told them."""
    def run(batches):
        for b in slices(batches, "old", CHUNK):
            old, new = (digests([(t or "").encode() for t in b.column(i).to_pylist()]) for i in (1, 2))
            text, keys, side, cells = differences(old, new, b.num_rows)
            out = []
            for s in (1, -1):
                mine = [[] for _ in range(b.num_rows)]
                for t, k in zip(text[side == s].tolist(), keys[side == s].astype(np.int64).tolist(), strict=True):
                    mine[t].append(k)
                out.append(pa.array([sorted(m) for m in mine], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([b.column(0), *out, pa.array(cells, pa.int64())], ["doc_id", "removed", "added", "cells"])
    return versions.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("old").cast("string").alias("old"), F.col("new").cast("string").alias("new")).mapInArrow(
        run, "doc_id long, removed array<long>, added array<long>, cells long")


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_chars", F.lower(F.hex("edited_sha")).alias("edited_sha256"), F.base64("fingerprint").alias("fingerprint"),
                       F.base64("edited_fingerprint").alias("edited_fingerprint"), "near_edited", "near_next", "n_paragraphs")


def from_string(fingerprint: str) -> bytes:
    return base64.b64decode(fingerprint)
