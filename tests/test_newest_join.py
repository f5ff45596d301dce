"""Bounded stream-stream join: results by plain Python, state size, expiry."""
import datetime as dt

from pyspark.sql import functions as F

from tidemark.streaming.batches import BatchLog
from tidemark.streaming.newest_join import newest_join, newest_view
from tidemark.streaming.runner import drain

LEFT = "order_id long, customer_id long, at timestamp"
RIGHT = "customer_id long, name string, seq long"
T0 = dt.datetime(2024, 1, 1)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


class Flow:
    def __init__(self, spark, path, **options):
        self.spark, self.path, self.options, self.n = spark, path, options, 0

    def run(self, left, right):
        for side, rows, schema in (("l", left, LEFT), ("r", right, RIGHT)):
            self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.path}/{side}")
        streams = [self.spark.readStream.schema(s).parquet(f"{self.path}/{x}") for x, s in (("l", LEFT), ("r", RIGHT))]
        joined = newest_join(*streams, ["customer_id"], "seq", time="at", **self.options)
        self.log = BatchLog(self.spark, f"{self.path}/out", joined.schema)
        q = drain(joined.writeStream.foreachBatch(self.log.append), f"{self.path}/ck")
        return q.lastProgress["stateOperators"][0]["numRowsTotal"] if q.lastProgress and q.lastProgress["stateOperators"] else None

    def view(self):
        rows = newest_view(self.log.read(), ["customer_id"], "seq").select("left.order_id", "right.name", "right.seq").collect()
        return sorted(tuple(r) for r in rows)


def test_newest_row_wins_in_every_order_of_arrival(spark, fresh):
    f = Flow(spark, fresh)
    f.run([(1, 7, at(0)), (2, 8, at(0)), (9, None, at(0))], [(7, "a", 1)])
    assert f.view() == [(1, "a", 1)]
    f.run([(3, 7, at(1))], [(7, "old", 0), (8, "b", 5), (None, "x", 1)])
    assert f.view() == [(1, "a", 1), (2, "b", 5), (3, "a", 1)]
    f.run([(4, 8, at(2))], [(7, "c", 2), (8, "b5", 5)])  # a tie: the larger row, in any order
    assert f.view() == [(1, "c", 2), (2, "b5", 5), (3, "c", 2), (4, "b5", 5)]


def test_state_is_one_row_per_key_and_open_orders(spark, fresh):
    f = Flow(spark, fresh)
    for k in range(3):
        f.run([(100 * k + i, i % 5, at(k)) for i in range(50)], [(c, f"n{k}", k) for c in range(4)])
    # four customers, and the list of the thirty orders whose customer never came
    assert f.run([], [(0, "z", 0)]) == 5
    assert len(f.view()) == 120 and {r[1] for r in f.view()} == {"n2"}


def test_waiting_rows_expire(spark, fresh):
    f = Flow(spark, fresh, wait_seconds=3600)
    f.run([(1, 7, at(0)), (2, 8, at(50))], [])
    f.run([(3, 9, at(60))], [])
    f.run([], [(7, "late", 1), (8, "late", 1), (9, "in time", 1)])
    assert [r[0] for r in f.view()] == [3]


def test_salts_give_the_same(spark, fresh):
    rows = [(i, i % 3, at(i % 4)) for i in range(40)]
    views = []
    for salts in (1, 4):
        f = Flow(spark, f"{fresh}-{salts}", salts=salts)
        f.run(rows[:20], [(0, "a", 1), (1, "a", 1)])
        f.run(rows[20:], [(0, "b", 2), (2, "c", 3)])
        views.append(f.view())
        assert f.log.read().filter("kind = 'newer'").count() == 4
    assert views[0] == views[1] and len(views[0]) == 40


def test_a_replayed_batch_replaces_its_rows(spark, fresh):
    log = BatchLog(spark, fresh, "k long, v string")
    assert log.read().count() == 0
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    log.append(df, 0)
    log.append(df.withColumn("v", F.lit("c")), 1)
    log.append(df.filter("k = 1").withColumn("v", F.lit("d")), 1)
    assert sorted((r.k, r.v) for r in log.newest(["k"]).collect()) == [(1, "d"), (2, "b")]


def test_query_matches_the_unbounded_join(spark):
    from tidemark.plans import flows
    sf = "/root/testdata/sf0.001"
    out, q = flows.customers_orders_bounded(spark, sf)
    assert len(q.recentProgress) >= 3
    customers = flows.customer_rows(spark, sf).select("customer_id").distinct().count()
    orders = out.count()
    left = spark.read.parquet(flows.table_root(spark, sf) + "/bounded-1/landing/orders").count()
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= customers + left - orders
    again, _ = flows.customers_orders_bounded(spark, sf)  # takes nothing anew
    assert again.count() == orders


def test_keys_share_groups(spark, fresh, monkeypatch):
    from tidemark.streaming import newest_join as nj
    monkeypatch.setattr(nj, "BUCKETS", 2)  # many keys a group, so that lists are appended to and folded
    monkeypatch.setattr(nj, "CHUNK", 7)
    f, want, seen = Flow(spark, fresh), {}, 0
    for k in range(4):
        left = [(100 * k + i, i, at(k)) for i in range(40)]
        right = [(c, f"n\t{c}\n{k}", (k * 7) % 5) for c in range(10 * k, 40)]
        seen = f.run(left, right)
        for c, name, seq in right:
            if c not in want or (seq, name) > want[c][::-1]:
                want[c] = (name, seq)
    assert f.view() == sorted((100 * k + c, *want[c]) for k in range(4) for c in range(40))
    assert seen <= 4  # two lists of two groups, not a row a key


def test_rows_order_as_spark_orders_them(spark):
    import json

    from tidemark.streaming.newest_join import ROW_JSON, order_of
    nan = float("nan")
    rows = [(x, y, z) for x in (None, -1.5, -0.25, 3e300, nan, float("inf")) for y in (None, [], ["a"], ["a", "b"], ["é"])
            for z in (None, T0, T0 + dt.timedelta(microseconds=1))]
    df = spark.createDataFrame(rows, "x double, y array<string>, z timestamp").select(F.struct("x", "y", "z").alias("r"))
    texts = [r[0] for r in df.orderBy("r").select(F.to_json("r", {**ROW_JSON, "ignoreNullFields": "false"})).collect()]
    order = order_of(df.schema["r"].dataType)
    assert texts == sorted(texts, key=lambda t: order(json.loads(t)))
    back = spark.createDataFrame([(t,) for t in texts], "t string").select(F.from_json("t", df.schema["r"].dataType, ROW_JSON).alias("r"))
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
