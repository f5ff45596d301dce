"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import functools
import itertools
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession

from ..session import work_path
from ..sources.tables import load

#: A word: a run of characters other than space and the five ASCII controls
#: from tab to carriage return (what ``bytes.split()`` separates at).
WORD = r"[^\x20\x09-\x0D]+"

#: Odd multiplier of the rolling hashes.
MULT = 0x9E3779B97F4A7C15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load(spark, sf_dir, name)


def groups(spark: SparkSession, per_partition: int = 4) -> int:
    """Number of hash groups that packed rows are dealt to: a small multiple of
    the shuffle partitions, so it follows the size the session is tuned for."""
    return per_partition * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: cuts the lineage
    and survives the loss of executors."""
    path = work_path(df.sparkSession, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_bytes(col: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """A string column as UTF-8 bytes (no decoding)."""
    wide = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return col.cast(wide).to_pylist()


@functools.lru_cache(maxsize=1)
def _trim():
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system: workers live on between tasks, and an executor has several."""
    pa.default_memory_pool().release_unused()
    if _trim():
        _trim()(0)


def tidy(f):
    """A function of a group that gives memory back when it is done."""
    def run(t: pa.Table) -> pa.Table:
        try:
            return f(t)
        finally:
            give_back()
    return run


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``max_bytes`` (one row at least),
    which bounds a task's memory whatever the row count of a batch."""
    for b in batches:
        col = b.column(b.schema.get_field_index(column))
        if b.num_rows == 0:
            continue
        sizes = np.array(pa.compute.binary_length(col).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        part = (np.cumsum(sizes) - sizes) // max_bytes
        cuts = np.flatnonzero(np.diff(part)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, b.num_rows], strict=True):
            yield b.slice(lo, hi - lo)
            give_back()


def intern(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of ``words`` (equal for equal words: the place of the first one) and their 64-bit hashes."""
    known: dict[bytes, int] = {}
    ids = np.fromiter(map(known.setdefault, words, itertools.count()), np.int64, len(words))
    by_id = np.zeros(len(words), np.uint64)
    by_id[np.fromiter(known.values(), np.int64, len(known))] = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))
    return ids, by_id[ids]


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word and the one after its last; one space or line break parts two words."""
    if not text:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    buf = np.frombuffer(text, np.uint8)
    gap = np.flatnonzero((buf == 32) | (buf == 10))
    return np.concatenate(([0], gap + 1)), np.concatenate((gap, [len(buf)]))


def word_hashes(text: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of ``text`` between ``begin`` and ``end``, eight bytes at a time."""
    size = end - begin
    with np.errstate(over="ignore"):
        h = size.astype(np.uint64) * np.uint64(MULT)
        eight = np.ndarray((len(text),), "<u8", text + bytes(8), strides=(1,))
        todo, done = np.flatnonzero((size > 0) & (size <= 256)), 0
        while len(todo):
            left = size[todo] - done
            block = eight[begin[todo] + done] & (np.uint64(2**64 - 1) >> (8 * np.maximum(8 - left, 0)).astype(np.uint64))
            h[todo] = mixed(h[todo] ^ block) * np.uint64(MULT)
            todo, done = todo[left > 8], done + 8
    for i in np.flatnonzero(size > 256).tolist():
        h[i] = xxhash.xxh3_64_intdigest(text[begin[i]:end[i]])
    return h


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` items starting at each position (positions within ``k - 1``
    of the end get no value: the result is shorter by that)."""
    out, done, power, width = None, 0, h, 1
    with np.errstate(over="ignore"):
        while k:
            if k & 1:
                if out is None:
                    out, done = power, width
                else:
                    n = len(power) - done if len(power) > done else 0
                    n = min(len(out), n)
                    out, done = out[:n] + power[done:done + n] * np.uint64(pow(MULT, done, 1 << 64)), done + width
            k >>= 1
            if k:
                n = max(0, len(power) - width)
                power = power[:n] + power[width:width + n] * np.uint64(pow(MULT, width, 1 << 64))
                width *= 2
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a rolling hash over all 64 bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return h ^ (h >> np.uint64(33))


def equal_windows(ids: np.ndarray, h: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``k`` ids that occur twice or more: (index into ``starts``, class
    label), sorted by label. Sorting by hash finds them, comparing the ids
    with the first of the class proves them."""
    if len(starts) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    w = h[starts]
    order = np.argsort(w)
    same = w[order][1:] == w[order][:-1]
    member = np.zeros(len(order), bool)
    member[1:] |= same
    member[:-1] |= same
    label = np.cumsum(np.concatenate(([True], ~same)))[member]
    at = order[member]
    if not len(at):
        return at, label
    first = np.concatenate(([True], label[1:] != label[:-1]))
    lead = starts[at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]]
    bad = np.zeros(len(at), bool)
    for j in range(k):
        bad |= ids[starts[at] + j] != ids[lead + j]
    if bad.any():  # two texts with one hash: split those classes by content
        rows = np.flatnonzero(np.isin(label, label[bad]))
        content: dict[tuple, int] = {}
        fresh = label.max() + 1
        for r in rows:
            key = (label[r], *ids[starts[at[r]]:starts[at[r]] + k].tolist())
            label[r] = content.setdefault(key, fresh + len(content))
        order = np.argsort(label, kind="stable")
        at, label = at[order], label[order]
    return at, label


def pack(*arrays: np.ndarray, text: bytes = b"") -> bytes:
    """Arrays and a text as one compressed string."""
    head = np.array([len(arrays), *[a.nbytes for a in arrays]], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(a.tobytes() for a in arrays) + text)


def unpack(blob: bytes, *types) -> list:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, n, 8)
    out, at = [], 8 + 8 * n
    for size, kind in zip(sizes, types, strict=True):
        out.append(np.frombuffer(raw, kind, int(size) // np.dtype(kind).itemsize, at))
        at += int(size)
    return [*out, raw[at:]]


def nullable(ids: list[int | None]) -> np.ndarray:
    """Ids as int64; a null becomes the largest value, so it sorts last."""
    return np.array([NO_ID if x is None else x for x in ids], np.int64)


NO_ID = np.iinfo(np.int64).max


def slot_rows(count: np.ndarray, n_groups: int) -> list[tuple[int, bytes]]:
    """Occurrences per slot, pre-aggregated by a task, as (range of slots, packed counts)."""
    wide = -(-len(count) // n_groups)
    return [(r, pack(count[r * wide:(r + 1) * wide].astype(np.int32))) for r in np.unique(np.flatnonzero(count) // wide).tolist()]


def hot_slots(counts: DataFrame, n_slots: int, n_groups: int, least: int, share: int) -> np.ndarray:
    """Slots that hold ``least`` occurrences or more and over 1 / ``share`` of all. ``counts`` has rows of
    ``slot_rows`` (g, blob). Fewer than ``share`` slots can do so: that bounds what the driver gets."""
    wide = -(-n_slots // n_groups)

    def total(t: pa.Table) -> pa.Table:
        n = sum(unpack(b, np.int32)[0].astype(np.int64) for b in t.column("blob").to_pylist())
        slot = t.column("g")[0].as_py() * wide + np.arange(len(n))
        return pa.table({"slot": slot, "n": n})

    per_slot = stored(counts.groupBy("g").applyInArrow(tidy(total), "slot long, n long").filter("n > 0"), "slots")
    whole = per_slot.agg({"n": "sum"}).first()[0] or 0
    rows = per_slot.filter((per_slot["n"] >= least) & (per_slot["n"] > whole // share)).select("slot").collect()
    return np.array([r[0] for r in rows], np.int64)


def blob_rows(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    """Rows (g, blob) as a batch."""
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["g", "blob"])


BLOBS = "g int, blob binary"
