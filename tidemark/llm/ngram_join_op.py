"""N-gram Jaccard join with vertical partitioning.

The global order of all shingles (by 64-bit hash) is cut into fragments, the same for all
documents of a size class. Sets with a Jaccard similarity of ``percent`` or more differ in few
shingles, which touch few fragments, so some fragment is equal in both: equal
fragments give the candidates, exactly. Partial overlaps of candidates are counted by a task per
fragment, and Spark sums them per pair.

1. Each document's set has a 128-bit fingerprint (equal sets form a class and are compared
   once) and a key for each fragment, packed and dealt by hash.
2. Each hash group sorts its keys and links the members of a key to the first of them, its lead. The
   components of these edges are clusters; every link lies within one.
3. Each class is paired with the lead that it shares most keys with, if sizes allow a link: one pair a class. The
   order is cut into ``CUTS`` ranges, each set into segments; segments of a lead and of up to ``PART`` of
   its classes meet by range, are counted, and the partial overlaps of a pair are summed by a ``groupBy``.
   Sums that reach the threshold are links.
4. A cluster that these links hold together is done: more links would change nothing. Classes of the
   others, cut into blocks of at most about ``BLOCK``, meet in pairs of
   blocks, which decides all their pairs: a matrix of overlaps grows by one fragment of the order at a time. A task
   returns a star per component that it finds, never its pairs.
5. Components of the links, joined to the classes, give each document's.

Hot groups. Copies fall into one class, pre-aggregated per task. A passage that many documents
hold would make fragments of only its shingles equal: shingles in hot slots of a
counting sketch don't make a usable fragment on their own. A lead with very many classes is sent to each ``PART`` of
them, so near copies of one text cost what they weigh. Only in a cluster that stays open are rows read once per other block.

Edge cases: a null or empty text has the empty set and links with nothing (its component is its
own doc_id); rows that repeat a doc_id are compared by their own text, and a row's component is the smallest
doc_id that its text reaches; a null doc_id takes part in links, has a row, and never
is a component's id (a component of nulls only has a null id).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import (BLOBS, WORD, as_bytes, blob_rows, groups, hot_slots, intern, mixed, pack, rolling, slices,
                     slot_rows, stored, tidy, unpack)
from .components import components, stars

CHUNK = 3 << 20
BLOCK = 1024
#: Ranges of the global order whose overlaps are counted apart, and classes that meet their lead in one group.
CUTS = 8
PART = 256
N_SLOTS = 1 << 20
#: Shared shingles whose overlaps are counted at a time.
FRAGMENT = 2048
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(texts: list[bytes | None], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one after another, and where each text's end."""
    words: list[bytes] = []
    n = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        w = t.translate(LOWER).split() if t else []
        words += w
        n[i] = len(w)
    h = intern(words)[1]
    gram = mixed(rolling(h, k)) if len(h) >= k else h[:0]
    ends = np.cumsum(n)
    out = []
    for a, b in zip((ends - n).tolist(), ends.tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(gram[a:b - k + 1]))
        else:  # the whole sequence is the one shingle; its length keeps it apart
            out.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(words[a:b]), b - a)] if b > a else [], np.uint64))
    return np.concatenate(out) if out else np.empty(0, np.uint64), np.cumsum([len(x) for x in out]).astype(np.int64)


def size_classes(percent: int, largest: int) -> np.ndarray:
    """Lower bounds of the size classes, each half as large again as the one before. Sets smaller
    than the first bound link with equal sets only."""
    low = [-(-percent // (100 - percent))]
    while low[-1] <= largest:
        low.append(low[-1] + max(1, low[-1] // 2))
    return np.array(low, np.int64)


def fragment_shape(percent: int) -> tuple[int, float]:
    """(shingles that a usable fragment needs, fragments per shingle of the largest set of a class): the most
    selective ones with which a set has a tenth more usable fragments than shingles that may differ."""
    share = (100 - percent) / percent
    for least in (3, 2, 1):
        for step in range(105, 1000):
            per = share * step / 100
            mean = 1 / per
            enough = 1 - math.exp(-mean) * sum(mean ** i / math.factorial(i) for i in range(least))
            if per <= 1 and per * enough >= 1.1 * share:
                return least, per
    return 1, 1.0


def fragment_keys(h: np.ndarray, ends: np.ndarray, hot: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): rows whose sets differ in at most the allowed number of shingles share a key.

    The smaller of two linked sets has a class; the larger is in that class or reaches down
    into it from the next. With F fragments and at most d < F differing shingles, one of the
    fragments is untouched. Only usable fragments (of ``fragment_shape``, not all hot) give
    keys; if a set has no more than d of these, all its fragments give keys too, and
    if it has no more than d of any, each shingle does. Of a pair without a common usable
    fragment all usable ones are touched on both sides, so both sets fall back."""
    n = np.diff(ends, prepend=0)
    if not len(h):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    low = size_classes(percent, int(n.max()))
    least, per = fragment_shape(percent)
    own = np.searchsorted(low, n, side="right") - 1
    # the least partner of a set of n shingles
    down = np.searchsorted(low, -(-percent * n // 100), side="right") - 1
    rows, keys = [], []
    for level in (own, np.where(down < own, down, -1)):
        use = np.flatnonzero(level >= 0)
        if not len(use):
            continue
        c = level[use]
        upper = low[np.minimum(c + 1, len(low) - 1)] - 1
        allowed = np.minimum(n[use], upper) * (100 - percent) // percent
        count = np.maximum(upper * (100 - percent) // percent + 2, np.ceil(per * upper).astype(np.int64))
        length = n[use]
        at = np.repeat(ends[use] - length - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
        x, r = h[at], np.repeat(np.arange(len(use)), length)
        frag = ((x >> np.uint64(32)) * count[r].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        begin = np.flatnonzero(np.concatenate(([True], (r[1:] != r[:-1]) | (frag[1:] != frag[:-1]))))
        fr, fi = r[begin], frag[begin]
        rare = ~hot[(x & np.uint64(len(hot) - 1)).astype(np.int64)] if len(hot) else np.ones(len(x), bool)
        held = np.diff(np.concatenate((begin, [len(x)])))
        usable = (held >= least) & (np.add.reduceat(rare.astype(np.int64), begin) > 0)
        with np.errstate(over="ignore"):
            content = np.add.reduceat(mixed(x ^ np.uint64(0x5851F42D4C957F2D)), begin)
            salt = mixed(((c[fr].astype(np.uint64) << np.uint64(40)) + fi.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
            key = mixed(content ^ salt)
            single = mixed(x * np.uint64(0x9E3779B97F4A7C15) + c[r].astype(np.uint64))
        few = np.bincount(fr, usable, len(use)) <= allowed
        none = np.bincount(fr, minlength=len(use)) <= allowed
        chosen = (allowed[fr] > 0) & (usable | few[fr])
        rows.append(use[fr[chosen]]), keys.append(key[chosen])
        alone = (none & (allowed > 0))[r]
        rows.append(use[r[alone]]), keys.append(single[alone])
    return (np.concatenate(rows), np.concatenate(keys)) if rows else (np.empty(0, np.int64), np.empty(0, np.uint64))


def _sketch(k: int, n_groups: int):
    def run(batches):
        total = np.zeros(N_SLOTS, np.int64)
        for b in slices(batches, "text", CHUNK):
            h, _ = shingle_hashes(as_bytes(b.column("text")), k)
            total += np.bincount((h & np.uint64(N_SLOTS - 1)).astype(np.int64), minlength=N_SLOTS)
        yield blob_rows(slot_rows(total, n_groups))
    return run


SETS = "doc_id long, mark long, n_shingles long, class binary"


def _fingerprints(h: np.ndarray, ends: np.ndarray) -> list[bytes]:
    raw, n = h.tobytes(), np.diff(ends, prepend=0)
    return [xxhash.xxh3_128_digest(raw[8 * (e - m):8 * e]) for e, m in zip(ends.tolist(), n.tolist(), strict=True)]


def _sets(k: int):
    def run(batches):
        for b in slices(batches, "text", CHUNK):
            h, ends = shingle_hashes(as_bytes(b.column("text")), k)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("mark"), pa.array(np.diff(ends, prepend=0), pa.int64()),
                                              pa.array(_fingerprints(h, ends), pa.binary())], ["doc_id", "mark", "n_shingles", "class"])
    return run


def _keys(k: int, percent: int, n_groups: int, hot_list: np.ndarray):
    def run(batches):
        hot = np.zeros(N_SLOTS, bool)
        hot[hot_list] = True
        for b in slices(batches, "text", CHUNK):
            h, ends = shingle_hashes(as_bytes(b.column("text")), k)
            names = _fingerprints(h, ends)
            seen: dict[bytes, int] = {}
            fresh = np.fromiter((seen.setdefault(x, i) == i for i, x in enumerate(names)), bool, len(names))
            row, key = fragment_keys(h, ends, hot, percent)
            row, key = row[fresh[row]], key[fresh[row]]
            g = (mixed(key) % np.uint64(n_groups)).astype(np.int64)
            order = np.argsort(g, kind="stable")
            row, key, g = row[order], key[order], g[order]
            blobs = []
            ids, size = np.frombuffer(b"".join(names), np.uint64).reshape(-1, 2), np.diff(ends, prepend=0).astype(np.int32)
            for part in np.split(np.arange(len(g)), np.flatnonzero(np.diff(g)) + 1):
                if len(part):  # ids and sizes of the part's classes once, then for each key which
                    own, which = np.unique(row[part], return_inverse=True)
                    blobs.append((int(g[part[0]]), pack(ids[own].ravel(), size[own], which.astype(np.int32), key[part])))
            yield blob_rows(blobs)
    return run


EDGES = "a binary, b binary, fits boolean, n_keys long"


def _key_edges(percent: int):
    """Edges from the first member of each key to the others, once each: whether their sizes allow a link, and
    how many keys of this group they share."""
    def run(t: pa.Table) -> pa.Table:
        hi, lo, size, keys = [], [], [], []
        for blob in t.column("blob").to_pylist():
            ids, sizes, which, key, _ = unpack(blob, np.uint64, np.int32, np.int32, np.uint64)
            ids = ids.reshape(-1, 2)
            hi.append(ids[which, 0]), lo.append(ids[which, 1]), size.append(sizes[which]), keys.append(key)
        hi, lo, size, key = np.concatenate(hi), np.concatenate(lo), np.concatenate(size).astype(np.int64), np.concatenate(keys)
        order = np.argsort(key, kind="stable")
        shared = np.zeros(len(order), bool)
        same = key[order][1:] == key[order][:-1]
        shared[1:] |= same
        shared[:-1] |= same
        at = order[shared]
        at = at[np.lexsort((lo[at], hi[at], key[at]))]
        hi, lo, size, key = hi[at], lo[at], size[at], key[at]
        first = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.empty(0, bool)
        lead = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0)) if len(key) else np.empty(0, np.int64)
        apart = np.flatnonzero((hi != hi[lead]) | (lo != lo[lead]))
        lead = lead[apart]
        pairs, at, n = np.unique(np.stack([hi[lead], lo[lead], hi[apart], lo[apart]], 1), axis=0, return_index=True, return_counts=True)
        one, two = size[lead][at], size[apart][at]
        fits = 100 * np.minimum(one, two) >= percent * np.maximum(one, two)
        raw = np.ascontiguousarray(pairs).tobytes()
        cut = [raw[i:i + 16] for i in range(0, len(raw), 16)]
        return pa.table({"a": pa.array(cut[::2], pa.binary()), "b": pa.array(cut[1::2], pa.binary()),
                         "fits": pa.array(fits, pa.bool_()), "n_keys": pa.array(n, pa.int64())})
    return run


SEGMENTS = "g int, star binary, part int, cut int, class binary, n long, segment binary"


def _segments(k: int, n_groups: int):
    """A row for each range of the order that a set has shingles in, and each group that the set has a role in.
    A lead's own rows are those with its name as class and star."""
    def run(batches):
        for b in slices(batches, "text", CHUNK):
            h, ends = shingle_hashes(as_bytes(b.column("text")), k)
            out = []
            for name, roles, x in zip(b.column("class").to_pylist(), b.column("roles").to_pylist(), np.split(h, ends[:-1]), strict=True):
                at = np.searchsorted(x >> np.uint64(32), (np.arange(CUTS + 1) << 32) // CUTS).tolist()
                for c in range(CUTS):
                    if at[c] < at[c + 1]:
                        seg = x[at[c]:at[c + 1]].tobytes()
                        out += [(xxhash.xxh3_64_intdigest(b"%s%d,%d" % (r["star"], r["part"], c)) % n_groups, r["star"], r["part"], c, name, len(x), seg) for r in roles]
                if len(out) > 20_000:
                    yield _rows(out)
                    out = []
            yield _rows(out)
    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.binary())
    names = ["g", "star", "part", "cut", "class", "n", "segment"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)


PARTIALS = "a binary, b binary, n_a long, n_b long, shared long"


def _partials(t: pa.Table) -> pa.Table:
    """Partial overlaps of a lead with its classes, in the ranges of this group."""
    star, name = t.column("star").to_pylist(), t.column("class").to_pylist()
    where = list(zip(star, t.column("part").to_pylist(), t.column("cut").to_pylist(), strict=True))
    n, segment = t.column("n").to_pylist(), t.column("segment")
    meet: dict[tuple, dict[bytes, int]] = {}
    for r, key in enumerate(where):
        meet.setdefault(key, {})[name[r]] = r
    out = []
    for (a, _, _), sides in meet.items():
        lead, rows = sides.pop(a, None), list(sides.values())
        if lead is None or not rows:
            continue
        own = np.frombuffer(segment[lead].as_py(), np.uint64)
        sets = [np.frombuffer(segment[r].as_py(), np.uint64) for r in rows]
        flat = np.concatenate(sets)
        hit = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
        both = np.bincount(np.repeat(np.arange(len(sets)), [len(x) for x in sets]), hit, len(sets)).astype(np.int64)
        out += [(a, name[r], n[lead], n[r], m) for r, m in zip(rows, both.tolist(), strict=True) if m]
    kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    return pa.table({c: pa.array([r[i] for r in out], kind) for i, (c, kind) in enumerate(zip(("a", "b", "n_a", "n_b", "shared"), kinds, strict=True))})


def partial_sums(edges: DataFrame, class_texts, k: int, n_groups: int) -> DataFrame:
    """Sizes of the sets' intersection (``shared``) of each class and the lead it shares most keys with: columns
    a, b, n_a, n_b, shared; pairs without a common shingle have no row. ``class_texts`` joins a table with a
    column class to the classes' texts."""
    pairs = edges.filter("fits").groupBy("b").agg(F.max_by("a", F.struct("n_keys", "a")).alias("a"))
    pairs = stored(pairs, "lead-pairs")
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    member = pairs.join(parts, "a").select(F.col("b").alias("class"), F.col("a").alias("star"), F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    lead = parts.select(F.col("a").alias("class"), F.col("a").alias("star"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    # a lead has a role for each part of its classes: 1 / PART of their number, of 20 bytes each
    roles = member.unionByName(lead).groupBy("class").agg(F.collect_list(F.struct("star", "part")).alias("roles"))
    rows = class_texts(roles).select("class", "roles", "text").mapInArrow(_segments(k, 4 * n_groups), SEGMENTS)
    partial = rows.groupBy("g").applyInArrow(tidy(_partials), PARTIALS)
    return partial.groupBy("a", "b").agg(F.max("n_a").alias("n_a"), F.max("n_b").alias("n_b"), F.sum("shared").alias("shared"))


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of sets of ``a`` and ``b``. The order of the shingles that both sides
    have is cut into fragments; partial overlaps are summed."""
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    common = np.intersect1d(flat_a, flat_b)
    out = np.zeros((len(a), len(b)), np.int32)
    if not len(common):
        return out
    sides = []
    for sets, flat in ((a, flat_a), (b, flat_b)):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(common, flat), len(common) - 1)
        hit = common[at] == flat
        order = np.argsort(at[hit], kind="stable")
        sides.append((row[hit][order], at[hit][order]))
    for lo in range(0, len(common), FRAGMENT):
        parts = []
        for (row, at), sets in zip(sides, (a, b), strict=True):
            i, j = np.searchsorted(at, (lo, lo + FRAGMENT))
            m = np.zeros((len(sets), min(FRAGMENT, len(common) - lo)), np.float32)
            m[row[i:j], at[i:j] - lo] = 1
            parts.append(m)
        out += np.rint(parts[0] @ parts[1].T).astype(np.int32)
    return out


def _links(sets_a, sets_b, same: bool, percent: int) -> list[tuple[int, int]]:
    """A spanning forest (index of a, index of b, b counted after a) of the links."""
    n_a, n_b = np.array([len(s) for s in sets_a]), np.array([len(s) for s in sets_b])
    both = overlaps(sets_a, sets_b)
    linked = np.stack([100 * row.astype(np.int64) >= percent * (n + n_b - row) for row, n in zip(both, n_a, strict=True)])
    if same:
        np.fill_diagonal(linked, False)
        size, grid = len(sets_a), linked
    else:
        size = len(sets_a) + len(sets_b)
        grid = np.zeros((size, size), bool)
        grid[:len(sets_a), len(sets_a):] = linked
        grid[len(sets_a):, :len(sets_a)] = linked.T
    left = grid.any(1)
    out = []
    while left.any():
        root = int(np.argmax(left))
        left[root] = False
        edge = [root]
        while edge:
            reach = grid[edge].any(0) & left
            left &= ~reach
            edge = np.flatnonzero(reach).tolist()
            out += [(root, x) for x in edge]
    return out


def _verify(k: int, percent: int):
    def run(t: pa.Table) -> pa.Table:
        cluster, i, j, block = (t.column(c).to_pylist() for c in ("cluster", "i", "j", "block"))
        names, texts = t.column("class").to_pylist(), as_bytes(t.column("text"))
        meet: dict[tuple, dict[bytes, int]] = {}
        side = {}
        for r, key in enumerate(zip(cluster, i, j, strict=True)):
            meet.setdefault(key, {}).setdefault(names[r], r)
            side[r] = block[r]
        pairs = []
        for (_, bi, bj), rows in meet.items():
            rows = list(rows.values())
            h, ends = shingle_hashes([texts[r] for r in rows], k)
            sets = np.split(h, ends[:-1])
            a = [x for x, r in enumerate(rows) if side[r] == bi]
            b = [x for x, r in enumerate(rows) if side[r] == bj] if bi != bj else a
            if not a or not b or len(rows) < 2:
                continue
            whole = a if bi == bj else a + b
            found = _links([sets[x] for x in a], [sets[x] for x in b], bi == bj, percent)
            pairs += [(names[rows[whole[x]]], names[rows[whole[y]]]) for x, y in found]
        out = stars(pairs)
        return pa.table({"a": pa.array([p[0] for p in out], pa.binary()), "b": pa.array([p[1] for p in out], pa.binary())})
    return run


def jaccard_components(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """One row per input row: doc_id, mark (hash of its text), n_shingles, class (fingerprint of its set),
    home (the component's smallest class), component_id. Documents link when 100 * |intersection| >= percent * |union|; percent from 70 to 99."""
    if not 70 <= percent <= 99:
        raise ValueError("percent must lie between 70 and 99: size classes are half as large again")
    spark = docs.sparkSession
    n_groups = groups(spark)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), F.col("text").cast("string").alias("text"))
    hot = hot_slots(src.mapInArrow(_sketch(k, n_groups), BLOBS), N_SLOTS, n_groups, 256, 1 << 18)
    sets = stored(src.mapInArrow(_sets(k), SETS), "shingle-sets")
    # keys are made in a pass of their own: to store them with the sets would take their size on disk twice
    edges = src.select("text").mapInArrow(_keys(k, percent, n_groups, hot), BLOBS).groupBy("g").applyInArrow(tidy(_key_edges(percent)), EDGES)
    edges = stored(edges.groupBy("a", "b").agg(F.first("fits").alias("fits"), F.sum("n_keys").alias("n_keys")), "key-edges")
    clusters = components(edges.select("a", "b")).withColumnsRenamed({"node": "class", "component": "cluster"})

    # one document stands for each class; only those of candidates bring their text
    lead = sets.groupBy("class").agg(F.min(F.struct("doc_id", "mark")).alias("d"))

    def class_texts(classes: DataFrame) -> DataFrame:
        named = classes.join(lead, "class").withColumn("_d", F.col("d.doc_id")).withColumn("_m", F.col("d.mark")).drop("d")
        # rows that repeat a doc_id and its text come once for each: tasks go by the class
        return src.join(named, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("mark") == F.col("_m"))).drop("_d", "_m", "doc_id", "mark")

    sums = partial_sums(edges, class_texts, k, n_groups)
    links = stored(sums.filter(100 * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("shared"))).select("a", "b"), "links")
    joined = components(links).withColumnsRenamed({"node": "class", "component": "joined"})

    # clusters that the links don't hold together
    state = clusters.join(joined, "class", "left").withColumn("joined", F.coalesce("joined", "class"))
    sizes = (state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.min("joined").alias("j0"), F.max("joined").alias("j1"))
             .filter("j0 != j1").select("cluster", "n"))
    part = (clusters.join(sizes, "cluster")
            .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
            .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")))
    met = (class_texts(part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("class", "cluster", "text", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
           .withColumn("g", F.pmod(F.xxhash64("cluster", "i", "j"), F.lit(4 * n_groups)).cast("int")))
    found = components(links.unionByName(met.groupBy("g").applyInArrow(tidy(_verify(k, percent)), "a binary, b binary")))

    # of each class: where it belongs, and the smallest doc_id there
    home = (lead.select("class", F.col("d.doc_id").alias("least"))
            .join(found.withColumnsRenamed({"node": "class", "component": "home"}), "class", "left")
            .withColumn("home", F.coalesce("home", "class")))
    least = sets.groupBy("class").agg(F.min("doc_id").alias("least"))
    home = home.drop("least").join(least, "class")
    ids = home.groupBy("home").agg(F.min("least").alias("component_id"))
    label = home.join(ids, "home").select("class", "home", "component_id")
    return (sets.join(label, "class", "left")
            .select("doc_id", "mark", "n_shingles", "class", "home",
                    F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stand for their component: those with its smallest doc_id, the first by text
    hash if several have it. Columns stay. Rows without text are all kept, of repeated rows
    one is; a row with a null doc_id goes if a component with an id holds its text."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    doc_id, text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    found = jaccard_components(plain.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), k, percent)
    heads = (found.filter("n_shingles > 0").groupBy("home").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "mark")).alias("h"))
             .select(F.col("h.doc_id").alias("_d"), F.col("h.mark").alias("_m")))
    rows = found.groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("_rows"))
    heads = heads.join(rows, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("mark") == F.col("_m"))).select("_d", "_m", "_rows")
    some_words = F.coalesce(F.col(text), F.lit("")).rlike(WORD)
    kept = (plain.filter(some_words).withColumn("_mark", F.xxhash64(text))
                  .join(heads, F.col(doc_id).cast("long").eqNullSafe(F.col("_d")) & (F.col("_mark") == F.col("_m"))).drop("_d", "_m"))
    # only rows that repeat a head need to be told apart
    twin = F.row_number().over(Window.partitionBy(doc_id, "_mark").orderBy(*[F.col(c).cast("string") for c in names]))
    once = kept.filter("_rows > 1").withColumn("_n", twin).filter("_n = 1")
    return (kept.filter("_rows = 1").select(*names).unionByName(once.select(*names)).unionByName(plain.filter(~some_words))).toDF(*docs.columns)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_shingles", "component_id")
