"""Prefix trie of conversations, built as burst tries.

A turn is a 16-byte id: the UTF-8 length of its text (4 bytes) and 96 bits of a digest of its role
and text. A conversation is the string of its turns' ids, so byte order is the order of a trie.

1. ``distinct``: conversations with the same turns become one row with their number, smallest id and
   the digest of all their ids. Rows are dealt by ranges of (sequence, conv_id), so a third of all
   conversations being one spreads over tasks; each task packs its ids, and the packs of a
   sequence, in order, are run through one SHA-256 without holding them.
2. ``burst``: a container holds the suffixes below one head; all start below the root. An oversized one
   becomes a path of trie nodes (what its suffixes have in common) and a container for each next
   turn. The limit is a share of all turns, so at most ``HEADS`` containers are oversized in a round:
   that bounds what is broadcast. Suffixes differ, so each round parts them, whatever they share.
3. ``sweep``: remaining containers are dealt to shards, sorted, and each is swept into nodes. A
   container holds at most ``LEAST`` turns or a ``HEADS``-th of all, or one conversation.
4. Sums of the containers go up to the heads above them.

A conversation is one row of 16 bytes a turn.

Edge cases: rows without conv_id belong to no conversation and are left out; a null role or text counts
as the empty one; turns with one number (null is one, and the first) come in the order of their ids, which depends on
role and text alone; repeated rows are turns of their own; an empty table has no node, not even a root. Other
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pack, stored, unpack

#: Turns a container may hold, and the share of all turns that it may hold in larger tables.
LEAST = 1024
HEADS = 1 << 18
#: Conversation ids in a pack.
PACK = 1 << 16
ID = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string, turn_id binary, path array<binary>")


def conversations(convs: DataFrame) -> DataFrame:
    """(conv_id, base, ids): the turn ids of each conversation in order, as hex strings."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    size = F.octet_length(text)
    body = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    conv = F.col("conv_id").cast("long")
    turns = convs.select(conv.alias("conv_id"), (conv - conv % 5).alias("base"), F.col("turn").cast("long").alias("turn"),
                         F.concat(F.lpad(F.hex(size), 8, "0"), F.substring(F.md5(body), 1, 24)).alias("id")).filter("conv_id is not null")
    # dealt by base: what is done next per conversation and per five of them needs no further shuffle
    own = turns.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id"))).alias("t"))
    return own.select("conv_id", "base", F.transform("t", lambda t: t["id"]).alias("ids"))


def sequences(convs: DataFrame) -> DataFrame:
    """(conv_id, seq) of the conversations as they are."""
    return conversations(convs).select("conv_id", F.unhex(F.array_join("ids", "")).alias("seq"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """(conv_id, seq): each conversation c with its first h turns replaced by those of c - c % 5."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    first = F.first(F.when(F.col("conv_id") == F.col("base"), F.slice("ids", 1, 8)), ignorenulls=True).over(Window.partitionBy("base"))
    all_ = conversations(convs).select("conv_id", "ids", h.alias("h"), F.coalesce(first, F.array().cast("array<string>")).alias("first"))
    ids = F.concat(F.slice("first", F.lit(1), F.col("h")), F.slice("ids", F.col("h") + 1, F.size("ids")))
    return all_.select("conv_id", F.unhex(F.array_join(ids, "")).alias("seq"))


def _packs(batches):
    """Sorted (key, conv_id, seq) as packs (key, first, blob, seq) of ascending ids."""
    key, seq, ids = None, None, []
    out: list[tuple] = []

    def close():
        if ids:
            out.append((key, ids[0], pack(np.diff(np.array(ids, np.int64), prepend=np.int64(0))), seq))
            ids.clear()

    def batch():
        b = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.binary(), pa.binary()))], ["key", "first", "blob", "seq"])
        out.clear()
        return b

    for b in batches:
        for k, c, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            if k != key or len(ids) == PACK:
                close()
                key, seq = k, s
            ids.append(c)
        if len(out) > 5000:
            yield batch()
    close()
    yield batch()


def _digests(batches):
    """Packs sorted by (key, first) as (seq, n, min_id, sha)."""
    key, row, sha, out = None, None, None, []

    def batch():
        b = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.int64(), pa.string()))], ["seq", "n", "min_id", "sha"])
        out.clear()
        return b

    for b in batches:
        for k, first, blob, seq in zip(*[b.column(i).to_pylist() for i in range(4)], strict=True):
            ids = np.cumsum(unpack(blob, np.int64)[0]).tolist()
            if k != key:
                if row:
                    out.append((*row, sha.hexdigest()))
                key, row, sha = k, [seq, 0, first], hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(",".join(map(str, ids)).encode())
            row[1] += len(ids)
        if len(out) > 5000:
            yield batch()
    if row:
        out.append((*row, sha.hexdigest()))
    yield batch()


def distinct(seqs: DataFrame) -> DataFrame:
    """(head, seq, n, min_id, sha) of the distinct sequences, all below the root: conversations, smallest id, digest of all ids."""
    seqs = stored(seqs, "conversations")
    packs = (seqs.select(F.unhex(F.md5("seq")).alias("key"), "conv_id", "seq").repartitionByRange("key", "conv_id")
             .sortWithinPartitions("key", "conv_id").mapInArrow(_packs, "key binary, first long, blob binary, seq binary"))
    rows = packs.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digests, "seq binary, n long, min_id long, sha string")
    return stored(rows.withColumn("head", F.unhex(F.lit("00" * ID))), "sequences")


def shared(a: bytes, b: bytes) -> int:
    """Turns that two sequences begin with in common."""
    n = min(len(a), len(b)) // ID
    x, y = (np.frombuffer(s, np.uint64, 2 * n).reshape(n, 2) for s in (a, b))
    differ = (x != y).any(axis=1)
    return int(differ.argmax()) if differ.any() else n


def text_bytes(ids: bytes) -> list[int]:
    return np.frombuffer(ids, ">u4")[::ID // 4].tolist()


def _paths(batches):
    """Oversized containers: what their suffixes share, from the first and last in order."""
    for b in batches:
        c = b.to_pydict()
        depth = [shared(lo, hi) for lo, hi in zip(c["lo"], c["hi"], strict=True)]
        ids = [lo[ID * max(d0 - 1, 0):ID * d] for lo, d0, d in zip(c["lo"], c["d0"], depth, strict=True)]
        own = [(n - 1) * sum(text_bytes(i)) for n, i in zip(c["n"], ids, strict=True)]
        yield pa.RecordBatch.from_pydict({"head": c["head"], "d0": c["d0"], "depth": depth, "n": c["n"], "min_id": c["min_id"], "parent": c["parent"],
                                          "path": c["path"], "ids": ids, "own": own}, _HEAD)


_HEAD = pa.schema([("head", pa.binary()), ("d0", pa.int64()), ("depth", pa.int64()), ("n", pa.int64()), ("min_id", pa.int64()), ("parent", pa.int64()),
                   ("path", pa.list_(pa.binary())), ("ids", pa.binary()), ("own", pa.int64())])


def burst(rows: DataFrame, limit: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Containers that hold ``limit`` turns at most, and the heads above them with their ends."""
    settled, heads = [], []
    while True:
        sums = rows.groupBy("head").agg(F.sum(F.length("seq") / ID - F.col("d0") + 1).alias("w"), F.count("*").alias("c"), F.sum("n").alias("n"), F.min("min_id").alias("min_id"),
                                        F.min("seq").alias("lo"), F.max("seq").alias("hi"), *[F.first(x).alias(x) for x in ("d0", "parent", "path")])
        large = stored(sums.filter((F.col("w") > limit) & (F.col("c") > 1)).select("head", "d0", "n", "min_id", "parent", "path", "lo", "hi")
                       .mapInArrow(_paths, "head binary, d0 long, depth long, n long, min_id long, parent long, path array<binary>, ids binary, own long"), "trie-heads")
        if large.isEmpty():
            return [*settled, rows], heads
        # at most HEADS rows of three numbers: each holds over a HEADS-th of all turns
        mark = F.broadcast(large.select(F.col("head").alias("at"), "depth", F.col("min_id").alias("top")))
        dealt = stored(rows.join(mark, F.col("head") == F.col("at"), "left"), "trie-rows")
        settled.append(dealt.filter("at is null").select(*rows.columns))
        below = F.length("seq") > F.col("depth") * ID
        ends = dealt.filter("at is not null").filter(~below).select("at", F.col("sha").alias("end"))
        heads.append(large.join(ends, F.col("head") == F.col("at"), "left").drop("at"))
        step = F.expr(f"substring(seq, cast(depth * {ID} + 1 as int), {ID})")
        rows = dealt.filter("at is not null").filter(below).select(
            F.unhex(F.md5(F.concat("head", step))).alias("head"), (F.col("depth") + 1).alias("d0"), "seq", "n", "min_id", "sha",
            F.col("top").alias("parent"), F.concat("path", F.array("head")).alias("path"))


def sweep_container(rows: list[tuple], d0: int, parent: int | None, path: list[bytes]) -> list[tuple]:
    """Nodes of one container, parents first: ``rows`` are its (seq, n, min_id, sha) in order."""
    depth, up, count, low, size, kids, end, turn = [], [], [], [], [], [], [], []
    stack: list[int] = []
    before = b""
    for seq, n, least, sha in rows:
        keep = shared(before, seq) if stack else d0 - 1
        del stack[max(keep - d0 + 1, 0):]
        bytes_ = text_bytes(seq)
        for d in range(keep + 1, len(seq) // ID + 1):
            up.append(stack[-1] if stack else -1)
            stack.append(len(depth))
            depth.append(d), count.append(0), low.append(least), kids.append(0), end.append(NO_ENDS)
            size.append(bytes_[d - 1] if d else 0), turn.append(seq[ID * (d - 1):ID * d] if d else None)
        count[stack[-1]], end[stack[-1]] = n, sha
        before = seq
    leaves, saved = [0] * len(depth), [0] * len(depth)
    for i in range(len(depth) - 1, -1, -1):
        leaves[i] = leaves[i] or 1
        saved[i] += (count[i] - 1) * size[i]
        if (p := up[i]) >= 0:
            count[p] += count[i]
            low[p] = min(low[p], low[i])
            kids[p] += 1
            leaves[p] += leaves[i]
            saved[p] += saved[i]
    return [(low[i], depth[i], low[p] if p >= 0 else parent, count[i], kids[i], leaves[i], saved[i], end[i], turn[i], None if p >= 0 else path)
            for i, p in enumerate(up)]


_TYPES = [pa.int64()] * 7 + [pa.string(), pa.binary(), pa.list_(pa.binary())]
_NAMES = [c.strip().split(" ")[0] for c in NODE.split(",")]


def _node_batch(nodes: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in nodes], t) for i, t in enumerate(_TYPES)], _NAMES)


def _sweep(batches):
    """Rows sorted by (head, seq) as nodes, container by container."""
    head, top, rows, nodes = None, None, [], []
    for b in batches:
        for h, d0, parent, path, *row in zip(*[b.column(i).to_pylist() for i in range(8)], strict=True):
            if h != head:
                if rows:
                    nodes += sweep_container(rows, *top)
                head, top, rows = h, (d0, parent, path), []
                if len(nodes) > 10_000:
                    yield _node_batch(nodes)
                    nodes = []
            rows.append(tuple(row))
    if rows:
        nodes += sweep_container(rows, *top)
    yield _node_batch(nodes)


def _head_nodes(batches):
    """Nodes on the paths of the heads."""
    for b in batches:
        nodes = []
        for r in b.to_pylist():
            saved, size = r["saved"], text_bytes(r["ids"])
            for d in range(r["depth"], r["d0"] - 1, -1):
                at = d - max(r["d0"], 1)  # the root has no turn
                saved += (r["n"] - 1) * size[at] if d else 0
                last = d == r["depth"]
                nodes.append((r["min_id"], d, r["parent"] if d == r["d0"] else r["min_id"], r["n"], r["kids"] if last else 1, r["leaves"], saved,
                              (r["end"] if last else None) or NO_ENDS, r["ids"][ID * at:ID * at + ID] if d else None, None))
            if len(nodes) > 10_000:
                yield _node_batch(nodes)
                nodes = []
        yield _node_batch(nodes)


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """Nodes of the trie of (conv_id, seq): smallest member, depth, the parent's smallest member, members, children,
    leaves, saved bytes, digest of the conversations that end there, id of the node's turn."""
    spark = seqs.sparkSession
    rows = distinct(seqs)
    turns = rows.agg(F.sum(F.length("seq") / ID + 1).cast("long")).first()[0] or 0
    start = rows.select("head", F.lit(0).cast("long").alias("d0"), "seq", "n", "min_id", "sha",
                        F.lit(None).cast("long").alias("parent"), F.array().cast("array<binary>").alias("path"))
    settled, heads = burst(start, max(LEAST, turns // HEADS))
    containers = settled[0]
    for s in settled[1:]:
        containers = containers.unionByName(s)
    swept = stored(containers.select("head", "d0", "parent", "path", "seq", "n", "min_id", "sha").repartition("head").sortWithinPartitions("head", "seq")
                   .mapInArrow(_sweep, NODE), "trie-nodes")
    nodes = swept.drop("path")
    if not heads:
        return nodes
    above = heads[0]
    for s in heads[1:]:
        above = above.unionByName(s)

    def parts(df, leaves, saved):
        return df.select(leaves.alias("leaves"), saved.alias("saved"), F.size("path").alias("depth_of"), F.posexplode("path").alias("pos", "at"))

    sums = (parts(swept.filter("path is not null"), F.col("n_leaves"), F.col("saved_tokens"))
            .unionByName(parts(above, F.lit(0).cast("long"), F.col("own"))).groupBy("at")
            .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.sum((F.col("pos") + 1 == F.col("depth_of")).cast("long")).alias("kids")))
    paths = above.join(sums, F.col("head") == F.col("at")).select("d0", "depth", "n", "min_id", "parent", "ids", "end", "leaves", "saved", "kids")
    top = paths.mapInArrow(_head_nodes, NODE).drop("path")
    return spark.createDataFrame([], nodes.schema).unionByName(nodes).unionByName(top)


def with_text(nodes: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes with the role and text of their last turn (null at the root)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    body = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    turns = convs.select(F.unhex(F.concat(F.lpad(F.hex(F.octet_length(text)), 8, "0"), F.substring(F.md5(body), 1, 24))).alias("turn_id"),
                         role.alias("role"), text.alias("text")).groupBy("turn_id").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    return nodes.join(turns, "turn_id", "left")


def digest(nodes: DataFrame) -> DataFrame:
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
