"""The skew-safe neighbour helper equals plain lag/lead, also with a hot key."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.keyed import latest_per_key, ordered_neighbors


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 10_000)), min_size=1, max_size=60,
                unique_by=lambda x: x))
def test_neighbors_match_window(spark, pairs):
    # key 0 is hot: every generated row is duplicated onto it with a distinct order value
    data = pairs + [(0, 20_000 + i) for i in range(len(pairs) * 3)]
    df = spark.createDataFrame(data, "k INT, o INT").withColumn("v", F.col("o") * 2)
    got = ordered_neighbors(df, ["k"], ["o"], ["v"], partitions=4)
    w = Window.partitionBy("k").orderBy("o")
    want = df.select("k", "o", F.lag("v").over(w).alias("prev_v"), F.lead("v").over(w).alias("next_v"))
    a = sorted(tuple(r) for r in got.select("k", "o", "prev_v", "next_v").collect())
    b = sorted(tuple(r) for r in want.collect())
    assert a == b


def test_latest_per_key_keeps_ties(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (1, 3), (2, 1)], "k INT, o INT")
    assert sorted(tuple(r) for r in latest_per_key(df, ["k"], "o").collect()) == [(1, 5), (1, 5), (2, 1)]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 30), st.integers(0, 3), max_size=20),
       st.dictionaries(st.integers(0, 30), st.integers(0, 3), max_size=20))
def test_snapshot_diff_replays_to_new(spark, old, new):
    from tidemark.operators.changes import snapshot_diff
    o = spark.createDataFrame(list(old.items()), "k INT, v INT")
    n = spark.createDataFrame(list(new.items()), "k INT, v INT")
    state = dict(old)
    for r in snapshot_diff(o, n, ["k"]).collect():
        if r._change_type in ("insert", "update_postimage"):
            state[r.k] = r.v
        elif r._change_type == "delete":
            state.pop(r.k)
    assert state == new


def test_grouped_mean_hot_key_and_nulls(spark):
    from tidemark.functions.udfs import grouped_mean
    rows = [(0, float(i) if i % 7 else None) for i in range(9000)] + \
           [(k, float(k)) for k in range(1, 50)] + [(99, None)]
    df = spark.createDataFrame(rows, "k INT, v DOUBLE").repartition(6)
    got = {r.k: r.m for r in grouped_mean(df, "k", "v", "m").collect()}
    want = {r.k: r.m for r in df.groupBy("k").agg(F.avg("v").alias("m")).collect()}
    assert got.keys() == want.keys() and got[99] is None
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want if want[k] is not None)


def test_rules_with_or_are_kept_together():
    from tidemark.operators.quality import quarantine_expr
    assert quarantine_expr({"a": "x > 1 OR y > 1", "b": "z > 1"}) == "NOT ((x > 1 OR y > 1) AND (z > 1))"


def test_tied_sources_raise(spark):
    import pytest
    from tidemark.operators.cdc import upsert
    t = spark.createDataFrame([(1, 1, "a")], "k int, ts int, v string")
    s = spark.createDataFrame([(1, 2, "b"), (1, 2, "c"), (2, 1, "d")], "k int, ts int, v string")
    with pytest.raises(Exception, match="several source rows"):
        upsert(t, s, ["k"], "ts").table.collect()


def test_file_stats_tell_folders_apart(spark, fresh):
    from tidemark.operators.maintenance import file_stats
    spark.createDataFrame([(i, i % 3) for i in range(9)], "a int, p int").coalesce(1).write.partitionBy("p").parquet(fresh)
    assert sorted(r.num_records for r in file_stats(spark.read.parquet(fresh), ["a"]).collect()) == [3, 3, 3]


def test_neighbors_send_a_range_to_a_task_as_it_is(spark, monkeypatch):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    plans, checkpoint = [], type(df).checkpoint

    def noted(self, *a, **kw):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return checkpoint(self, *a, **kw)

    monkeypatch.setattr(type(df), "checkpoint", noted)
    assert ordered_neighbors(df, ["k"], ["o"], ["o"]).filter("_has_prev").count() == 97
    assert "rangepartitioning" in plans[0] and "hashpartitioning" not in plans[0]
