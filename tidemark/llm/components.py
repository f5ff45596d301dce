"""Connected components by alternating large and small stars (joins and aggregates).

Edges stay distributed. Each partition first contracts its own edges to
stars with a union-find, the pre-aggregation; then rounds of large stars (a node's larger
neighbours go to its smallest) and small stars (its smaller ones do) halve the
depth until nothing changes. A hub's edges are aggregated with partial minima and
joined by a plain equi-join, which Spark can split where it is skewed. Each round
is checkpointed to ``spark.checkpoint.dir``, so a lost executor costs one round.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_root


def stars(pairs: list[tuple]) -> list[tuple]:
    """(node, smallest node of its component) for all nodes that aren't the smallest."""
    up: dict = {}

    def top(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        if a < b:
            up[b] = a
        elif b < a:
            up[a] = b
    return [(x, top(x)) for x in up if top(x) != x]


def _contract(batches):
    pairs = [p for b in batches for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
    kind = None
    out = stars(pairs)
    for lo in range(0, len(out), 50_000):
        part = out[lo:lo + 50_000]
        kind = pa.binary() if isinstance(part[0][0], bytes) else pa.int64()
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in part], kind) for i in (0, 1)], ["a", "b"])


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and a sum of hashes: equal for equal sets."""
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b): the smallest node that it
    reaches. Null ends and loops are ignored; repeated edges count once."""
    spark = edges.sparkSession
    work_root(spark)  # sets a checkpoint folder where the cluster names none
    kind = dict(edges.dtypes)["a"]
    edges = edges.filter("a is not null and b is not null and a != b")
    # distinct first: tasks that found the same edge would each return a star of it
    edges = edges.distinct().mapInArrow(_contract, f"a {kind}, b {kind}").distinct().checkpoint()
    before = _mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = (joined.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).filter("a != b"))
        edges = small.distinct().checkpoint()
        after = _mark(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
