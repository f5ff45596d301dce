"""Plan shapes that matter at scale (checked with explain, no data volume needed)."""
import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import cdc
from tidemark.operators.joins import broadcast_if_small
from tidemark.operators.keyed import latest_per_key
from tidemark.plans import bookstore as bs

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rank1_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    p = plan(latest_per_key(df, ["k"], "o"))
    # partial WindowGroupLimit runs on the map side, before the exchange
    assert p.count("WindowGroupLimit") == 2
    assert p.index("Exchange") < p.rindex("WindowGroupLimit")


def test_topic_filter_prunes_partitions_and_columns(spark):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        bs.orders_raw(spark, SF).select("order_id").explain("formatted")
    formatted = buf.getvalue()
    assert "PartitionFilters: [isnotnull(topic" in formatted and "= orders)" in formatted
    assert "ReadSchema: struct<value:binary>" in formatted


def test_lookup_broadcast_is_size_checked(spark):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only our hint may broadcast
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        big = spark.range(100000).withColumnRenamed("id", "k")
        small = spark.range(10).withColumnRenamed("id", "k")
        assert "BroadcastHashJoin" in plan(big.join(broadcast_if_small(small), "k"))
        assert "BroadcastHashJoin" not in plan(big.join(broadcast_if_small(small, max_bytes=1), "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_small_batch_upsert_does_not_shuffle_target(spark, fresh):
    t0 = dt.datetime(2024, 1, 1)
    spark.range(5000).select(F.col("id"), F.lit("a").alias("v"), F.lit(t0).alias("ts")) \
        .write.parquet(f"{fresh}/target")
    target = spark.read.parquet(f"{fresh}/target")
    # a micro-batch read from files has size statistics (an in-memory list has none)
    spark.createDataFrame([(3, "b", t0 + dt.timedelta(1))], "id BIGINT, v STRING, ts TIMESTAMP") \
        .write.parquet(f"{fresh}/batch")
    batch = spark.read.parquet(f"{fresh}/batch")
    res = cdc.upsert(target, batch, ["id"], "ts")
    p = plan(res.table)
    # the target is only read through broadcast semi/anti joins
    assert "BroadcastHashJoin" in p and "LeftAnti" in p and "LeftSemi" in p
    assert res.table.count() == 5000


def test_hot_key_spreads_over_range_partitions(spark):
    hot = spark.range(20000).select(F.lit(0).alias("k"), F.col("id").alias("o"))
    parts = (hot.repartitionByRange(8, "k", "o").select(F.spark_partition_id().alias("p"))
             .distinct().count())
    assert parts > 1  # the single key is split across tasks
