"""Landed envelopes: computed once, in spans of time; topics parsed once."""
import datetime as dt

from pyspark.sql import functions as F

from tidemark.plans import streams
from tidemark.sources import ingest
from tidemark.sources.bookstore import BRONZE_SCHEMA, ENVELOPE_SCHEMA, parse_topic


def tables(spark, path):
    day = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(i, day + dt.timedelta(days=i % 60)) for i in range(300)], "o_orderkey long, o_orderdate timestamp").write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame([(i,) for i in range(300)], "l_orderkey long").write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(i, day + dt.timedelta(hours=i)) for i in range(300)], "event_id long, ts timestamp").write.parquet(f"{path}/events.parquet")


def test_envelopes_are_computed_once_and_land_by_time(spark, fresh, monkeypatch):
    tables(spark, fresh)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    def envelopes(spark, sf_dir):
        ms = F.lit(1704067200000) + F.col("id") % 60 * 86400000
        rows = spark.range(900).select(
            F.lit(None).cast("binary").alias("key"), F.lit(b"{}").alias("value"), F.element_at(F.array(*map(F.lit, ("orders", "customers", "books"))), (F.col("id") % 3 + 1).cast("int")).alias("topic"),
            F.lit(0).cast("long").alias("partition"), F.col("id").alias("offset"), F.when(F.col("id") != 7, ms).alias("timestamp"))
        return rows.mapInArrow(counted, ENVELOPE_SCHEMA)

    monkeypatch.setattr(ingest, "raw_envelopes", envelopes)
    monkeypatch.setattr(ingest, "LANDED_BYTES", 1024)
    path = ingest.land_raw(spark, fresh)
    assert seen.value == 900  # a range shuffle runs its input for samples too
    rows = spark.read.schema(ENVELOPE_SCHEMA).json(path).withColumn("file", F.input_file_name())
    assert rows.count() == 900 and rows.select("offset").distinct().count() == 900
    per_file = rows.groupBy("file").agg(F.countDistinct("topic").alias("topics"), F.min("timestamp").alias("a"), F.max("timestamp").alias("b"), F.min("topic").alias("topic")).collect()
    assert len(per_file) > 6 and {r.topics for r in per_file} == {1}
    for topic in ("orders", "customers", "books"):
        spans = sorted((r.a, r.b) for r in per_file if r.topic == topic and r.a is not None)
        assert all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False))


def test_spans_hold_about_as_many_rows_each(spark):
    rows = spark.range(10_000).select(F.timestamp_micros(F.when(F.col("id") % 10 == 0, F.col("id") * 1_000_000).otherwise(F.col("id") * 1_000)).alias("at"))
    of = ingest._spans(spark, rows.unionByName(spark.createDataFrame([(None,), (dt.datetime(1, 1, 1),), (dt.datetime(9999, 1, 1),)], "at timestamp")), F.col("at"), 4)
    held = dict(rows.groupBy(of(F.unix_micros("at")).alias("s")).count().collect())
    assert set(held) <= {0, 1, 2, 3} and sum(held.values()) == 10_000
    none = spark.createDataFrame([], "at timestamp")
    assert rows.select(ingest._spans(spark, none, F.col("at"), 4)(F.unix_micros("at")).alias("s")).distinct().collect() == [(0,)]


def test_a_filtered_topic_is_parsed_once(spark, fresh, monkeypatch):
    spark.createDataFrame([(b"k", b'{"order_id": 1, "quantity": 3}', 0, 0, None, "orders", "2024-01"), (b"k", b'{"order_id": 2, "quantity": 0}', 0, 0, None, "orders", "2024-01"),
                           (b"k", None, 0, 0, None, "orders", "2024-01")], BRONZE_SCHEMA).write.parquet(fresh)
    bronze = spark.read.schema(BRONZE_SCHEMA).parquet(fresh)
    plain, once = (parse_topic(bronze, "orders", once=x) for x in (False, True))
    assert once.schema == plain.schema and once.exceptAll(plain).isEmpty() and plain.exceptAll(once).isEmpty()
    kept = once.filter("quantity > 0")
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1  # two without: in the filter and above it
    assert [r.order_id for r in kept.collect()] == [1]
    monkeypatch.setattr(streams, "bronze_of", lambda *a: fresh)
    assert "inline(array(from_json" in streams.orders_stream(spark, fresh)._jdf.queryExecution().analyzed().toString()
