"""Embedding near-dedup by cross-polytope hashing.

Vectors are padded to a power of two and turned by three rounds of random signs and a fast Hadamard
transform; the largest coordinate and its sign is a hash. ``k`` hashes make a bucket of a
table. A vector has its home bucket in each table and probes the buckets in which
one hash is replaced by the second largest coordinate. Two vectors meet in a bucket that is home
to one of them, and meeting pairs are verified by their cosine in double precision.

1. Equal vectors form a class, compared once and weighted by its copies.
2. Bucket keys are packed and dealt by hash; a group keeps the buckets in which somebody meets.
   Only those fetch vectors.
3. A bucket is compared as a matrix, a large one in pairs of blocks of ``BLOCK``. A pair that
   meets more than once counts where it meets first, which both sides' hashes
   tell, so links are counted and joined to stars in the task and pairs never leave it.
4. Counts are summed per class; components of the stars give the rest.

The number of hashes grows with the logarithm of the number of classes (buckets stay small) and
the number of tables with it, so that a pair at the threshold is missed with a probability of about
``MISS``. Nothing is capped.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing;
vectors of different length never link; rows that repeat a vec_id are vectors of their own; a null
vec_id takes part in links but is never a component's id; ``kept`` is true where vec_id equals component_id, or both are null.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOBS, blob_rows, groups, mixed, pack, stored, tidy, unpack
from .components import components, stars

BLOCK = 2048
ROUNDS = 3
#: Measured in 64 dimensions at a cosine of 0.95: the chances that a hash agrees, and that it
#: does not but agrees with the other side's second choice.
AGREE, SECOND = 0.59, 0.27
MISS = 0.004
ROWS = 4096


def shape(n_classes: int, width: int) -> tuple[int, int]:
    """(hashes per bucket, tables)."""
    k = max(2, math.ceil(math.log(max(2, n_classes)) / math.log(2 * max(2, width))))
    meet = AGREE ** k + k * AGREE ** (k - 1) * SECOND
    return k, math.ceil(math.log(MISS) / math.log(1 - meet))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, scaled to keep lengths."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x / math.sqrt(n)


@functools.lru_cache(maxsize=8)
def signs(width: int, n: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, width]).choice(np.array([-1.0, 1.0]), (n, ROUNDS, width))


def bucket_keys(x: np.ndarray, k: int, tables: int, seed: int = 11) -> np.ndarray:
    """Keys of shape (rows, tables, 1 + k): home, then one probe for each hash."""
    width = max(2, 1 << (x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), width))
    padded[:, :x.shape[1]] = x
    turn = signs(width, k * tables, seed)
    out = np.empty((len(x), tables, 1 + k), np.uint64)
    row = np.arange(len(x))
    with np.errstate(over="ignore"):
        for t in range(tables):
            first, second = [], []
            for j in range(k):
                y = padded
                for s in turn[t * k + j]:
                    y = hadamard(y * s)
                size = np.abs(y)
                a = size.argmax(1)
                size[row, a] = -1
                b = size.argmax(1)
                first.append((2 * a + (y[row, a] < 0)).astype(np.uint64)), second.append((2 * b + (y[row, b] < 0)).astype(np.uint64))
            for probe in range(-1, k):
                key = np.full(len(x), (t + 1) * 0x9E3779B97F4A7C15 + x.shape[1] & (1 << 64) - 1, np.uint64)
                for j in range(k):
                    key = mixed(key * np.uint64(2 * width + 1) + (second if j == probe else first)[j] + np.uint64(1))
                out[:, t, probe + 1] = key
    return out


def _rows(col) -> list[np.ndarray | None]:
    """Vectors that can link, else null."""
    out = []
    for v in col.to_pylist():
        x = np.array(v, np.float64) if v and None not in v else None
        n = None if x is None else np.linalg.norm(x)
        out.append(x if x is not None and np.isfinite(n) and n > 0 else None)
    return out


def _classes(batches):
    for b in batches:
        for lo in range(0, b.num_rows, ROWS):
            part = b.slice(lo, ROWS)
            vec = _rows(part.column(1))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([None if v is None else xxhash.xxh3_128_digest((v + 0.0).tobytes()) for v in vec], pa.binary()),
                                              pa.array(vec, pa.list_(pa.float64()))], ["vec_id", "class", "vec"])


def _keys(n_groups: int, n_classes: int):
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                names, vec = b.column(0).slice(lo, ROWS).to_pylist(), _rows(b.column(1).slice(lo, ROWS))
                out = []
                for width in {len(v) for v in vec}:
                    at = [i for i, v in enumerate(vec) if len(v) == width]
                    key = bucket_keys(np.stack([vec[i] for i in at]), *shape(n_classes, width))
                    ids = np.frombuffer(b"".join(names[i] for i in at), np.uint64).reshape(-1, 2)
                    home = np.zeros(key.shape, np.int8)
                    home[:, :, 0] = 1
                    who = np.repeat(np.arange(len(at)), key[0].size)
                    key, home = key.ravel(), home.ravel()
                    g = (mixed(key) % np.uint64(n_groups)).astype(np.int64)
                    order = np.argsort(g, kind="stable")
                    for p in np.split(order, np.flatnonzero(np.diff(g[order])) + 1):
                        out.append((int(g[p[0]]), pack(key[p], ids[who[p]].ravel(), home[p])))
                yield blob_rows(out)
    return run


def _meetings(t: pa.Table) -> pa.Table:
    """Members of the buckets in which somebody meets, with their block, for each pair of blocks."""
    parts = [unpack(b, np.uint64, np.uint64, np.int8) for b in t.column("blob").to_pylist()]
    key, ids, home = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]).reshape(-1, 2), np.concatenate([p[2] for p in parts])
    order = np.lexsort((ids[:, 1], ids[:, 0], key))
    key, ids, home = key[order], ids[order], home[order]
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.concatenate((begin, [len(key)])))
    met = np.repeat((size > 1) & (np.maximum.reduceat(home, begin) > 0), size)
    place = np.arange(len(key)) - np.repeat(begin, size)
    blocks = np.repeat(-(-size // BLOCK), size)
    key, ids, place, blocks = key[met], ids[met], place[met], blocks[met]
    block = place % blocks
    copies = np.repeat(np.arange(len(key)), blocks)
    other = np.arange(len(copies)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    i, j = np.minimum(block[copies], other), np.maximum(block[copies], other)
    raw = np.ascontiguousarray(ids[copies]).tobytes()
    return pa.table({"key": key[copies].view(np.int64), "i": i, "j": j, "block": block[copies],
                     "class": pa.array([raw[x:x + 16] for x in range(0, len(raw), 16)], pa.binary())})


def _meet_at(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of rows of keys: do they meet in a table, and in which bucket (that of the first if it is home to it)."""
    equal = a[:, :, 0] == b[:, :, 0]
    into_a = (b[:, :, 1:] == a[:, :, :1]).any(2)
    into_b = (a[:, :, 1:] == b[:, :, :1]).any(2)
    return equal | into_a | into_b, np.where(equal | into_a, a[:, :, 0], b[:, :, 0])


def _verify(least: float, n_classes: int):
    def run(t: pa.Table) -> pa.Table:
        key, i, j, block, name, copies = (t.column(c).to_pylist() for c in ("key", "i", "j", "block", "class", "copies"))
        vec = [np.array(v) for v in t.column("vec").to_pylist()]
        meet: dict[tuple, list[int]] = {}
        for r, k in enumerate(zip(key, i, j, strict=True)):
            meet.setdefault(k, []).append(r)
        links: dict[bytes, int] = {}
        pairs: list[tuple] = []
        for (bucket, bi, bj), rows in meet.items():
            rows.sort(key=lambda r: name[r])
            x = np.stack([vec[r] for r in rows])
            x /= np.linalg.norm(x, axis=1)[:, None]
            side = np.array([block[r] for r in rows])
            a, b = np.flatnonzero(side == bi), np.flatnonzero(side == bj)
            if not len(a) or not len(b) or len(rows) < 2:
                continue
            near = x[a] @ x[b].T >= least
            p, q = np.nonzero(near)
            p, q = a[p], b[q]
            ok = p < q if bi == bj else np.ones(len(p), bool)
            p, q = np.minimum(p, q)[ok], np.maximum(p, q)[ok]
            if not len(p):
                continue
            codes = bucket_keys(x, *shape(n_classes, x.shape[1]))
            weight = np.array([copies[r] for r in rows])
            count = np.zeros(len(rows), np.int64)
            root = list(range(len(rows)))
            for lo in range(0, len(p), 1 << 16):
                u, v = p[lo:lo + (1 << 16)], q[lo:lo + (1 << 16)]
                yes, at = _meet_at(codes[u], codes[v])
                first = yes.argmax(1)
                here = at[np.arange(len(u)), first].view(np.int64) == bucket
                here &= yes.any(1)
                np.add.at(count, u[here], weight[v[here]])
                np.add.at(count, v[here], weight[u[here]])
                grid = np.unique(np.stack([u[here], v[here]], 1), axis=0)
                for c, d in grid.tolist():  # a forest of what was met here
                    while root[c] != c:
                        root[c] = root[root[c]]
                        c = root[c]
                    while root[d] != d:
                        root[d] = root[root[d]]
                        d = root[d]
                    root[max(c, d)] = min(c, d)
            for r, n in enumerate(count.tolist()):
                if n:
                    links[name[rows[r]]] = links.get(name[rows[r]], 0) + n
                if root[r] != r:
                    pairs.append((name[rows[r]], name[rows[root[r]]]))
        up = dict(stars(pairs))
        return pa.table({"class": pa.array(list(links), pa.binary()), "n": pa.array(list(links.values()), pa.int64()),
                         "root": pa.array([up.get(c, c) for c in links], pa.binary())})
    return run


def near_duplicates(vectors: DataFrame, least: float = 0.95) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept."""
    n_groups = groups(vectors.sparkSession)
    src = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = stored(src.mapInArrow(_classes, "vec_id long, class binary, vec array<double>"), "vectors")
    classes = stored(rows.filter("class is not null").groupBy("class")
                     .agg(F.min("vec_id").alias("lead"), F.count(F.lit(1)).alias("copies"), F.first("vec").alias("vec")), "classes")
    n_classes = classes.count()
    met = (classes.select("class", "vec").mapInArrow(_keys(n_groups, n_classes), BLOBS)
           .groupBy("g").applyInArrow(tidy(_meetings), "key long, i long, j long, block long, class binary"))
    met = met.join(classes.select("class", "copies", "vec"), "class").withColumn("g", F.pmod(F.xxhash64("key", "i", "j"), F.lit(n_groups)))
    found = stored(met.groupBy("g").applyInArrow(tidy(_verify(least, n_classes)), "class binary, n long, root binary"), "links")
    links = found.groupBy("class").agg(F.sum("n").alias("n"))
    home = components(found.select(F.col("class").alias("a"), F.col("root").alias("b"))).withColumnsRenamed({"node": "class", "component": "home"})
    home = classes.select("class", "lead", "copies").join(home, "class", "left").withColumn("home", F.coalesce("home", "class"))
    ids = home.groupBy("home").agg(F.min("lead").alias("component_id"))
    label = home.join(ids, "home").join(links, "class", "left").select("class", "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.select("vec_id", "class").join(label, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
