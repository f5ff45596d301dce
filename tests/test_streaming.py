"""Streaming semantics: stream-static invariance, watermarks across runs."""
import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.joins import explode_join
from tidemark.streaming.runner import drain, stream_static_join

ORDERS = "order_id BIGINT, order_timestamp TIMESTAMP, books ARRAY<STRUCT<book_id: BIGINT, quantity: BIGINT>>"


def _orders(spark, path, rows):
    spark.createDataFrame(rows, ORDERS).coalesce(1).write.mode("overwrite").json(path)


def test_stream_static_join_invariance(spark, fresh):
    t0 = dt.datetime(2024, 1, 1)
    books = f"{fresh}/books"
    spark.createDataFrame([(1, 10.0), (2, 20.0)], "book_id BIGINT, price DOUBLE").write.parquet(books)
    _orders(spark, f"{fresh}/in/01", [(1, t0, [(1, 1), (2, 2)])])

    def run():
        s = spark.readStream.schema(ORDERS).option("recursiveFileLookup", "true").json(f"{fresh}/in")
        stream_static_join(s, lambda: spark.read.parquet(books),
                           lambda mb, b: explode_join(mb, b, "books", "book", "book_id", "book_id"),
                           f"{fresh}/out", f"{fresh}/ckpt")
        return spark.read.parquet(f"{fresh}/out")

    assert run().count() == 2
    # new static data alone triggers nothing
    spark.createDataFrame([(1, 11.0), (2, 21.0), (3, 30.0)], "book_id BIGINT, price DOUBLE") \
        .write.mode("overwrite").parquet(books)
    assert run().count() == 2
    # new stream rows join the current static table
    _orders(spark, f"{fresh}/in/02", [(2, t0, [(3, 1), (1, 1)])])
    out = run()
    assert out.count() == 4
    assert sorted(r.price for r in out.filter("order_id = 2").collect()) == [11.0, 30.0]


def test_dedup_watermark_drops_late_rows(spark, fresh):
    sch = "id BIGINT, ts TIMESTAMP"
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    src, out = f"{fresh}/src", f"{fresh}/out"

    def land(name, rows):
        spark.createDataFrame(rows, sch).coalesce(1).write.mode("overwrite").json(f"{src}/{name}")

    def run():
        s = spark.readStream.schema(sch).option("recursiveFileLookup", "true").json(src)
        d = s.withWatermark("ts", "30 seconds").dropDuplicates(["id", "ts"])
        drain(d.writeStream.outputMode("append"), f"{fresh}/ckpt", to_path=out)
        return sorted(r.id for r in spark.read.parquet(out).collect())

    land("01", [(1, t0), (1, t0), (2, t0 + dt.timedelta(minutes=10))])
    assert run() == [1, 2]
    # watermark is now 10:09:30: a repeat of id 1 and a new but late id 3 are dropped
    land("02", [(1, t0), (3, t0 + dt.timedelta(seconds=5)), (4, t0 + dt.timedelta(minutes=11))])
    assert run() == [1, 2, 4]


def test_window_append_emits_closed_windows(spark, fresh):
    sch = "k STRING, ts TIMESTAMP, v DOUBLE"
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    src, out = f"{fresh}/src", f"{fresh}/out"
    spark.createDataFrame([("a", t0, 1.0), ("a", t0 + dt.timedelta(minutes=1), 3.0),
                           ("a", t0 + dt.timedelta(minutes=16), 5.0)], sch) \
        .coalesce(1).write.json(f"{src}/01")
    s = spark.readStream.schema(sch).json(f"{src}/01")
    agg = (s.withWatermark("ts", "10 minutes").groupBy(F.window("ts", "5 minutes"), "k")
           .agg(F.count("*").alias("n"), F.avg("v").alias("avg_v")))
    drain(agg.writeStream.outputMode("append"), f"{fresh}/ckpt", to_path=out)
    got = [(r.window.start, r.n, r.avg_v) for r in spark.read.parquet(out).collect()]
    # watermark 10:06: the 10:00-10:05 window is closed and emitted, 10:15 is open
    assert got == [(t0, 2, 2.0)]


def test_landed_envelopes_are_compressed_and_lines_are_listed_after_the_shuffle(spark, fresh):
    import os

    from tidemark.session import use_subdir
    from tidemark.sources.bookstore import orders_payload
    from tidemark.sources.ingest import ensure_bronze, land_raw, read_bronze
    sf = "/root/testdata/sf0.001"
    before = spark.conf.get("tidemark.work.subdir")
    use_subdir(spark, f"{before}/landed-{os.path.basename(fresh)}")
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        names = [f for f in os.listdir(land_raw(spark, sf).removeprefix("file:")) if f.startswith("part-")]
        assert names and all(f.endswith(".json.gz") for f in names)
        assert read_bronze(spark, ensure_bronze(spark, sf)).count() == spark.read.json(land_raw(spark, sf)).count()
    finally:
        use_subdir(spark, before)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == split
    plan = orders_payload(spark, sf)._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning(l_orderkey")
    assert "collect_list" in plan[:shuffle] and "collect_list" not in plan[shuffle:]


def test_stream_stream_join_runs_once_a_batch(spark, fresh, monkeypatch):
    import os

    from tidemark.plans import streams as st
    from tidemark.session import use_subdir
    sf = "/root/testdata/sf0.001"
    before, ran = spark.conf.get("tidemark.work.subdir"), {}

    def noted(writer, checkpoint, **kw):
        q = drain(writer, checkpoint, **kw)
        ran[os.path.basename(checkpoint)] = q.recentProgress
        return q

    monkeypatch.setattr(st, "drain", noted)
    use_subdir(spark, f"{before}/once-{os.path.basename(fresh)}")
    try:
        orders = st.customers_orders(spark, sf).read().count()
        feed = st.customers_silver(spark, sf).changes(start=1).filter("_change_type IN ('insert', 'update_postimage')").count()
        n = st.bs.orders_silver(spark, sf).filter("customer_id IS NOT NULL").count()
        stored = sum(o.numRowsUpdated for p in ran["customers_orders"] for o in p.stateOperators)
        assert orders and stored == n + feed
    finally:
        use_subdir(spark, before)
