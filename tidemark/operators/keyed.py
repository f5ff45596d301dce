"""Per-key ordering primitives shared by the CDC operators.

* ``latest_per_key``  WIN-1/WIN-2: ``rank() = 1`` over (keys, order desc),
  ties kept. Spark plans it as a ``WindowGroupLimit``, whose partial half
  runs before the shuffle, so a hot key ships at most its local winners.
* ``ordered_neighbors`` previous / next row values within a key in a given
  order (``lag``/``lead``) without putting a whole key into one task: rows
  are range-partitioned on (keys, order), so a hot key spreads over several
  partitions; windows run per (partition, key) segment, and each segment's
  first/last row is then patched from the neighbouring segment through a
  small per-segment table (at most one row per segment and key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_root


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str | Column,
                   *, ties: bool = True) -> DataFrame:
    """Rows holding the greatest ``order`` value per key (``rank() = 1``)."""
    o = F.col(order) if isinstance(order, str) else order
    w = Window.partitionBy(*keys).orderBy(o.desc())
    fn = F.rank() if ties else F.row_number()
    return df.withColumn("_rank", fn.over(w)).filter("_rank = 1").drop("_rank")


def ordered_neighbors(df: DataFrame, keys: Sequence[str], order: Sequence,
                      cols: Sequence[str], *, partitions: int | None = None) -> DataFrame:
    """Add ``prev_<c>``/``next_<c>`` for each ``c`` in ``cols`` and the flags
    ``_has_prev``/``_has_next``, following ``order`` within each key.

    Ties in ``order`` are broken arbitrarily, as with ``lag``/``lead``.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order_cols = _cols(order)
    seg = (df.repartitionByRange(n, *_cols(keys), *order_cols)
           .withColumn("_seg", F.spark_partition_id())
           # the windows' shuffle: a range goes to a task as it is, not in pieces to all of them
           .repartitionById(n, F.col("_seg")))
    w = Window.partitionBy("_seg", *keys).orderBy(*order_cols)
    one = F.lit(1)
    seg = (seg.withColumn("_rn", F.row_number().over(w))
              .withColumn("_last", F.lead(one).over(w).isNull()))
    for c in cols:
        seg = (seg.withColumn(f"prev_{c}", F.lag(c).over(w))
                  .withColumn(f"next_{c}", F.lead(c).over(w)))
    work_root(spark)  # make sure a checkpoint folder is configured
    seg = seg.checkpoint(eager=True)
    # Only the first and the last key of a range partition can continue in
    # the neighbouring partition, so the fix-up table has at most two rows per
    # partition: a proven bound, broadcast without shuffling the rows.
    pos = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)],
                   *[o.alias(f"o{j}") for j, o in enumerate(order_cols)])
    row = F.struct(pos.alias("pos"), F.struct(*[F.col(c) for c in cols]).alias("v"))
    ends = seg.groupBy("_seg").agg(F.min_by(row, pos).alias("f"), F.max_by(row, pos).alias("l"))
    ws = Window.orderBy("_seg")  # one row per partition
    ends = ends.withColumn("pl", F.lag("l").over(ws)).withColumn("nf", F.lead("f").over(ws))

    def same(a: str, b: str) -> Column:
        c = F.lit(True)
        for i in range(len(keys)):
            c = c & F.col(f"{a}.pos.k{i}").eqNullSafe(F.col(f"{b}.pos.k{i}"))
        return c

    def key_of(side: str) -> list[Column]:
        return [F.col(f"{side}.pos.k{i}").alias(k) for i, k in enumerate(keys)]

    vtype = seg.select(F.struct(*[F.col(c) for c in cols]).alias("v")).schema["v"].dataType
    none = F.lit(None).cast(vtype)
    firsts = (ends.filter(F.col("pl").isNotNull() & same("pl", "f"))
              .select("_seg", *key_of("f"), F.col("pl.v").alias("_pl"), none.alias("_nf")))
    lasts = (ends.filter(F.col("nf").isNotNull() & same("l", "nf"))
             .select("_seg", *key_of("l"), none.alias("_pl"), F.col("nf.v").alias("_nf")))
    fix = (firsts.unionByName(lasts).groupBy("_seg", *keys)
           .agg(F.first("_pl", ignorenulls=True).alias("_pl"), F.first("_nf", ignorenulls=True).alias("_nf"),
                F.max(F.col("_pl").isNotNull()).alias("_pe"), F.max(F.col("_nf").isNotNull()).alias("_ne")))
    fix = F.broadcast(fix)
    # null-safe: rows of a NULL key spread over ranges like those of any other
    fix = fix.withColumnsRenamed({c: f"_k_{c}" for c in ["_seg", *keys]})
    match = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in ["_seg", *keys]]
    out = seg.join(fix, match, "left").drop(*[f"_k_{c}" for c in ["_seg", *keys]])
    first, last = F.col("_rn") == 1, F.col("_last")
    for c in cols:
        out = (out.withColumn(f"prev_{c}", F.when(first, F.col("_pl")[c]).otherwise(F.col(f"prev_{c}")))
                  .withColumn(f"next_{c}", F.when(last, F.col("_nf")[c]).otherwise(F.col(f"next_{c}"))))
    out = (out.withColumn("_has_prev", ~first | F.coalesce("_pe", F.lit(False)))
              .withColumn("_has_next", ~last | F.coalesce("_ne", F.lit(False))))
    return out.drop("_seg", "_rn", "_last", "_pl", "_nf", "_pe", "_ne")
