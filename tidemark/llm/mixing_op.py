"""Mixing sources to target weights, with DataFrame functions only.

A source's words form a stream (its documents by doc_id), packed into blocks of
``block_words``. Its share of the mix is a number of slots, whole passes over its
blocks and a part of one more, cut so that the words taken are the target. All sources share
one number of output shards, by the words of the whole mix. Each slot draws its shard on its own, by a hash of source, pass and
slot: a source's counts over the shards are a multinomial draw of its total (``shard_counts``), so
every shard has the target mix but for the draw's noise. Within a pass a pseudorandom permutation of the source's block
indexes (their rank by MD5) says which block a slot takes, and slots are joined to blocks by that
index.

Nothing gathers a source in one task: streams and ranks are cut by range over (source, order), sums
per range and source are prefixed, and the rest is a window within the range; so a
source with a third of all rows spreads over many tasks. Targets come from repeated
aggregates over the table of sources, of which the driver sees three numbers each.

Edge cases: a null text has no words; documents without words are taken 0 times; null sources are one source,
last in order; rows are documents of their own, so repeated rows each hold words; a null
doc_id comes first in its source's stream; with no words at all every target is 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, stored

BLOCK_WORDS = 1024
#: Slots that an output shard holds on average.
SHARD_SLOTS = 256
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2


def size(text: Column) -> Column:
    """Number of words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cut(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` in ranges of ``order``, numbered in column ``pid``; stored, as bounds are drawn anew on each run."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(df.repartitionByRange(parts, *order).withColumn("pid", F.spark_partition_id()), name)


def before(df: DataFrame, group: str, order: list[Column], value: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over earlier rows of the same group. ``df`` comes from ``cut``
    by (group, order); a group has one row per range at most in the table that is prefixed."""
    per = df.groupBy("pid", group).agg(F.sum(value).alias("_in"))
    w = Window.partitionBy(group).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("pid", F.col(group).alias("_g"), F.coalesce(F.sum("_in").over(w), F.lit(0)).alias("_off"))
    own = Window.partitionBy("pid", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    first = df.withColumn("_own", F.coalesce(F.sum(value).over(own), F.lit(0)))
    return (first.join(per.withColumnRenamed("pid", "_pid"), (F.col("pid") == F.col("_pid")) & F.col(group).eqNullSafe(F.col("_g")))
            .withColumn(name, (F.col("_off") + F.col("_own")).cast("long")).drop("_own", "_off", "_pid", "_g"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, size): weights repeat over the sources by code
    point, nulls last; no target is above ``most`` times its source's size."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = before(cut(per.withColumn("_all", F.lit(0)), [F.col("source").asc_nulls_last()], "sources"),
                  "_all", [F.col("source").asc_nulls_last()], F.lit(1), "rank")
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    per = stored(rank.select("source", "source_size", w.cast("double").alias("w"), (F.col("source_size") * most).alias("most")), "weights")
    level, full = None, -1
    while True:
        open_ = F.lit(True) if level is None else F.col("most") > F.lit(level) * F.col("w")
        r = per.agg(F.sum("source_size"), F.sum(F.when(open_, F.col("w"))), F.sum(F.when(~open_, F.col("most"))), F.sum((~open_).cast("long"))).first()
        if not r[0] or not r[1] or r[3] == full:
            break
        full, level = r[3], (share * r[0] - (r[2] or 0)) / r[1]
    return per.select("source", "source_size", F.least(F.col("most").cast("double"), F.lit(float(level or 0.0)) * F.col("w")).alias("target"))


def _dealt(docs: DataFrame, block_words: int, keys: tuple[str, ...], shard_slots: int, **how) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents cut at the bounds of blocks; slots with the block, words and output shard of each; rows without words."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keys, F.col("source").cast("string").alias("source"),
                       size(F.col("text").cast("string")).alias("size"), F.xxhash64("text").alias("_mark"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("_mark"), *[F.col(k) for k in keys]]
    rows = cut(rows, [F.col("source").asc_nulls_last(), *order], "rows")
    per = stored(targets(rows, **how), "targets").withColumnRenamed("source", "_s")
    shards = max(1, math.ceil((per.agg(F.sum("target")).first()[0] or 0) / (block_words * shard_slots)))
    rows = rows.join(per, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    none = rows.filter("size = 0").withColumn("taken", F.lit(0).cast("long")).drop("pid", "_mark")
    stream = before(rows.filter("size > 0"), "source", order, F.col("size"), "off")

    # the part of a document in each block that it reaches
    n = F.lit(block_words)
    part = (stream.withColumn("block", F.explode(F.sequence(F.floor(F.col("off") / n), F.floor((F.col("off") + F.col("size") - 1) / n))))
            .withColumn("lo", F.greatest(F.col("block") * n, F.col("off")))
            .withColumn("hi", F.least((F.col("block") + 1) * n, F.col("off") + F.col("size"))))
    part = stored(part.drop("pid", "_mark"), "parts")

    # a block is where its first word is; its slot in a pass is its rank by hash
    source_key = F.concat(F.when(F.col("source").isNull(), "-").otherwise("+"), F.coalesce("source", F.lit("")))
    key = F.md5(F.concat(source_key, F.lit(":"), F.col("block").cast("string")).cast("binary"))
    block = part.filter(F.col("lo") == F.col("block") * n).select("source", "block", "source_size", "target", key.alias("key"))
    by = [F.col("key"), F.col("block")]
    block = before(cut(block, [F.col("source").asc_nulls_last(), *by], "blocks"), "source", by, F.lit(1), "slot")
    last = F.floor((F.col("source_size") - 1) / n)
    short = (last + 1) * n - F.col("source_size")
    block = stored(block.select("source", "block", "slot", "source_size", "target", (last + 1).alias("blocks"), short.alias("short"),
                                F.when(F.col("block") == last, short).otherwise(0).alias("lacks")), "slots")
    tail = block.filter("lacks > 0").select(F.col("source").alias("_s"), F.col("slot").alias("tail"))
    block = block.join(tail, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")

    # slots of whole passes take whole blocks; the slots of the last pass take words until the target is met
    words = F.floor(F.col("target") + 1e-6).cast("long")
    whole = F.floor(words / F.col("source_size"))
    start = F.col("slot") * n - F.when(F.col("tail") < F.col("slot"), F.col("short")).otherwise(0)
    rest = F.greatest(F.lit(0), F.least(n - F.col("lacks"), words - whole * F.col("source_size") - start))
    slot = (block.withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), whole)))
            .withColumn("words", F.when(F.col("pass") < whole, n - F.col("lacks")).otherwise(rest)).filter("words > 0")
            .withColumn("shard", F.pmod(F.xxhash64(source_key, "pass", "slot"), F.lit(shards).cast("long"))))
    return part, slot, none


def shard_counts(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, **how) -> DataFrame:
    """The draw: slots and words that each output shard takes of each source; columns shard, source, slots, words."""
    _, slot, _ = _dealt(docs, block_words, (), shard_slots, **how)
    return slot.groupBy("shard", "source").agg(F.count(F.lit(1)).alias("slots"), F.sum("words").alias("words"))


def plan(docs: DataFrame, block_words: int = BLOCK_WORDS, keys: tuple[str, ...] = (), shard_slots: int = SHARD_SLOTS, **how) -> tuple[DataFrame, DataFrame]:
    """What the mix takes.

    First: a row per input row with words: doc_id, ``keys``, source, size, source_size, target, taken and
    ``spans`` (pass, first word, words, shard). Second: the same columns for rows without words."""
    part, slot, none = _dealt(docs, block_words, keys, shard_slots, **how)
    n = F.lit(block_words)
    took = (slot.groupBy("source", "block").agg(F.collect_list(F.struct("pass", "words", "shard")).alias("slots"))
            .withColumnsRenamed({"source": "_s", "block": "_b"}))

    # join blocks by index, and count what each slot takes of each document
    got = part.join(took, (F.col("block") == F.col("_b")) & F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s", "_b")
    first, length = F.col("lo") - F.col("off"), F.col("hi") - F.col("lo")
    spans = F.transform("slots", lambda s: F.struct(
        s["pass"].alias("pass"), first.alias("first"),
        F.greatest(F.lit(0), F.least(length, s["words"] - (F.col("lo") - F.col("block") * n))).cast("long").alias("words"), s["shard"].alias("shard")))
    got = got.withColumn("spans", F.filter(F.coalesce(spans, F.array().cast("array<struct<pass:bigint,first:bigint,words:bigint,shard:bigint>>")), lambda s: s["words"] > 0))
    row = ["source", "off", "doc_id", *keys, "size", "source_size", "target"]
    out = got.groupBy(*row).agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                F.sum(F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["words"])).alias("taken"))
    return out.drop("off"), none


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, **how) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken."""
    some, none = plan(docs, block_words, **how)
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    return some.select(*cols).unionByName(none.select(*cols))


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, shard: str | None = None, **how) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a row per pass that takes words of a document.
    A pass that takes all its words has the text unchanged, else the words taken, by one space. With ``shard``, the name
    of a column that is added, a row per pass and output shard: what a document's blocks bring to each shard."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    at = {c: names[docs.columns.index(c)] for c in ("doc_id", "source", "text")}
    # rows that agree in doc_id, source and text are told apart by a number
    twins = Window.partitionBy(at["doc_id"], at["source"], "_mark").orderBy(*[F.col(c).cast("string") for c in names])
    plain = plain.withColumn("_mark", F.xxhash64(at["text"])).withColumn("_twin", F.row_number().over(twins))
    some, _ = plan(plain.select(*[F.col(v).alias(k) for k, v in at.items()], F.col("_mark").alias("m"), F.col("_twin").alias("k")), block_words, ("m", "k"), **how)
    spans = some.select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), "m", "k", "size", F.explode("spans").alias("x"))
    where = [F.col("x.pass").alias("pass")] + ([F.col("x.shard").alias("_shard")] if shard else [])
    each = (spans.groupBy("_d", "_s", "m", "k", "size", *where)
            .agg(F.sum("x.words").alias("n"), F.array_sort(F.collect_list(F.struct("x.first", "x.words"))).alias("ranges")))
    out = plain.join(each, F.col(at["doc_id"]).cast("long").eqNullSafe(F.col("_d")) & F.col(at["source"]).cast("string").eqNullSafe(F.col("_s"))
                     & (F.col("_mark") == F.col("m")) & (F.col("_twin") == F.col("k")))
    text = F.col(at["text"])
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    # the words are an argument, so they are made once, not for each range
    some_words = F.array_join(F.flatten(F.get(F.transform(F.array(words), lambda w: F.transform(
        "ranges", lambda r: F.slice(w, (r["first"] + 1).cast("int"), r["words"].cast("int")))), F.lit(0))), " ")
    out = out.withColumn(at["text"], F.when(F.col("n") == F.col("size"), text).otherwise(some_words))
    if shard:
        return out.select(*names, "_shard").toDF(*docs.columns, shard)
    return out.select(*names).toDF(*docs.columns)
