"""Erasure on storage, append-only history, run metrics, update mode, replaced tables, sorted store."""
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.operators import cdc
from tidemark.operators.erasure import erase, files_with
from tidemark.operators.governance import create_mask_function, is_member, set_groups
from tidemark.operators.sorted_store import write_sorted
from tidemark.plans import flows
from tidemark.streaming.history import AutoCdcLog, Scd2Log
from tidemark.streaming.runner import drain
from tidemark.streaming.rule_metrics import collecting, observe_rules
from tidemark.streaming.static import PublishedTable

SF = "/root/testdata/sf0.001"


def files(path):
    path = path.removeprefix("file://")
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_erase_touches_only_files_that_hold_the_keys(spark, fresh):
    rows = [(k, p, i) for p in ("a", "b", "c", None) for i in range(20) for k in ([1, 2] if p in ("a", None) else [3] if p == "b" else [9])]
    df = spark.createDataFrame([*rows, (None, "a", 99)], "k long, p string, i int")
    df.repartition("p").write.partitionBy("p").parquet(f"{fresh}/t")
    before = files(f"{fresh}/t")
    keys = spark.createDataFrame([(1,), (9,), (77,), (None,)], "k long")
    assert files_with(spark.read.parquet(f"{fresh}/t"), keys, "k").count() == 3
    assert erase(spark, f"{fresh}/t", keys, "k", ["p"], f"{fresh}/s1") == 3
    left = spark.read.parquet(f"{fresh}/t")
    assert sorted((r.k or 0, r.p or "", r.i) for r in left.collect()) == sorted((k or 0, p or "", i) for k, p, i in [*rows, (None, "a", 99)] if k not in (1, 9))
    after = files(f"{fresh}/t")
    assert {f: t for f, t in after.items() if "p=b" in f} == {f: t for f, t in before.items() if "p=b" in f}
    assert not any("p=c" in f for f in after)  # all of it erased
    for f in after:  # no file holds an erased key
        assert not set(pq.read_table(f, columns=["k"], partitioning=None)["k"].to_pylist()) & {1, 9}
    assert erase(spark, f"{fresh}/t", keys, "k", ["p"], f"{fresh}/s2") == 0  # once more: nothing to do
    assert files(f"{fresh}/t") == after


SCHEMA = "book_id BIGINT, title STRING, price DOUBLE, current BOOLEAN, effective_date TIMESTAMP, end_date TIMESTAMP"


def test_scd2_log_equals_one_merge_and_rewrites_nothing(spark, fresh):
    rnd = random.Random(5)
    rows = [(rnd.randrange(6), f"t{i % 2}", float(rnd.randrange(3)), i) for i in range(90)]
    ups = spark.createDataFrame(rows, "book_id long, title string, price double, n long").withColumn("updated", F.timestamp_seconds("n"))
    empty = spark.createDataFrame([], SCHEMA)
    want = cdc.scd2_merge(empty, ups.drop("n"), "book_id", "updated").table
    log = Scd2Log(spark, fresh, SCHEMA, "book_id")
    for b, (lo, hi) in enumerate(((0, 40), (40, 41), (41, 90))):
        before = files(fresh)
        part = ups.filter(f"n >= {lo} and n < {hi}").drop("n")
        log.merge(part, "updated", b)
        assert before.items() <= files(fresh).items()  # only added to
        keys = part.select("book_id").distinct().count()
        assert log.open.read().filter(F.col("batch") == b).count() == keys
        if b == 1:
            log.merge(part, "updated", b)  # replayed
    key = lambda df: sorted(map(str, df.select(*empty.columns).collect()))
    assert key(log.read()) == key(want)
    assert key(log.current()) == key(want.filter("current"))


@pytest.mark.parametrize("seed", range(3))
def test_auto_cdc_does_not_depend_on_cuts_or_order(spark, fresh, seed):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(4), rnd.choice("abc"), rnd.randrange(5), rnd.random() < .2) for _ in range(60)]  # many ties
    schema = "k long, v string, t long, gone boolean"
    df = spark.createDataFrame(rows, schema)
    whole = cdc.scd1_rows(cdc.apply_changes_scd1(None, df, ["k"], "t", delete_when="gone", except_columns=["gone"]))
    want = sorted(tuple(r) for r in whole.collect())
    assert len({r[0] for r in want}) == len(want)  # one row per key
    rnd.shuffle(rows)
    cuts = sorted(rnd.sample(range(60), 3))
    stored = None
    log = AutoCdcLog(spark, fresh, df.schema, ["k"], "t", ["gone"], "gone")
    for b, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, 60], strict=True)):
        part = spark.createDataFrame(rows[lo:hi], schema)
        log.append(part, b)
        stored = cdc.apply_changes_scd1(stored, part, ["k"], "t", delete_when="gone", except_columns=["gone"])
    assert sorted(tuple(r) for r in cdc.scd1_rows(stored).collect()) == want
    assert sorted(tuple(r) for r in log.scd1().collect()) == want
    history = cdc.scd2_rows(cdc.apply_changes_scd2(None, df, ["k"], "t", delete_when="gone", except_columns=["gone"]))
    assert sorted(map(str, log.scd2().collect())) == sorted(map(str, history.collect()))


def test_metrics_of_the_run(spark, fresh):
    rows = [(i, None if i % 7 == 0 else i % 10) for i in range(100)]
    spark.createDataFrame(rows, "i long, q long").repartitionByRange(4, "i").write.parquet(f"{fresh}/in")
    s = spark.readStream.schema("i long, q long").option("maxFilesPerTrigger", 2).parquet(f"{fresh}/in")
    with collecting(spark, f"{fresh}/m") as m:
        drain(observe_rules(s, {"small": "q < 5", "early": "i < 50"}, "d").writeStream, f"{fresh}/ck", to_path=f"{fresh}/out")
    got = m.read().groupBy("rule").agg(F.sum("passed_records").alias("p"), F.sum("failed_records").alias("f"), F.count_distinct("batch").alias("b")).collect()
    small = sum(q is not None and q < 5 for _, q in rows)
    assert {r.rule: (r.p, r.f, r.b) for r in got} == {"small": (small, 100 - small, 2), "early": (50, 50, 2)}


def test_update_mode_emits_changed_windows_only(spark):
    log = flows.windows_updated(spark, SF)
    per_batch = {r.batch: r.n for r in log.read().groupBy("batch").agg(F.count("*").alias("n")).collect()}
    windows = log.newest(["time", "author"]).count()
    assert len(per_batch) >= 3 and max(per_batch.values()) < windows < sum(per_batch.values())
    assert flows.windows_updated(spark, SF).read().count() == sum(per_batch.values())


def test_a_pinned_version_survives_a_replacement(spark, fresh):
    t = PublishedTable(spark, fresh)
    t.publish(spark.range(1))
    assert t.read_for("r", 0).count() == 1
    t.publish(spark.range(2))
    assert (t.read_for("r", 0).count(), t.read_for("r", 1).count(), t.read().count(), t.read_for("other", 0).count()) == (1, 2, 2, 2)


def test_replaced_books_and_second_runs(spark):
    log = flows.sales_with_replaced_books(spark, SF)
    n = log.read().count()
    assert n and log.read().select("batch").distinct().count() == 2
    assert flows.sales_with_replaced_books(spark, SF).read().count() == n


def test_sorted_store_skips_row_groups(spark, fresh):
    path = write_sorted(spark.range(200_000).select((F.col("id") * 7919 % 200_000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")), fresh, ["k"], 3, 64 << 10)
    hit = total = 0
    for f in files(path):
        m = pq.ParquetFile(f).metadata
        for g in range(m.num_row_groups):
            stats = m.row_group(g).column(0).statistics
            total += 1
            hit += stats.max >= 50_000 and stats.min < 50_100
    assert total > 20 and hit <= 2
    read = spark.read.parquet(path).filter("k >= 50000 and k < 50100")
    assert read.count() == 100 and "PushedFilters: [IsNotNull(k), GreaterThanOrEqual(k,50000)" in read._jdf.queryExecution().toString()


def test_group_names_are_values(spark):
    set_groups(spark, ["it's"])
    assert spark.range(1).select(is_member("it's").alias("m")).first().m
    assert not spark.range(1).select(is_member("x') OR (1=1) OR array_contains(groups, 'y").alias("m")).first().m
    create_mask_function(spark, "hide_it", "x') OR (1=1) OR array_contains(groups, 'y", "no 'one' \\ sees")
    assert spark.sql("SELECT hide_it('v', array('a')) AS v").first().v == "no 'one' \\ sees"
    set_groups(spark, [])


def test_states_between_batches_are_not_trivial(spark):
    from tidemark.plans import catalog_flows  # noqa: F401  (registers queries)
    from tidemark.plans.catalog import QUERIES
    sf = "/root/testdata/sf0.01"
    early = QUERIES["state_as_of_batch"](spark, sf).count()
    assert 0 < QUERIES["rows_superseded"](spark, sf).count() < early  # some rows are subtracted
    assert {r._change_type for r in QUERIES["state_changes"](spark, sf).select("_change_type").distinct().collect()} == {
        "insert", "delete", "update_preimage", "update_postimage"}
    assert {r.status for r in QUERIES["requests_partly_done"](spark, sf).select("status").distinct().collect()} == {"requested", "deleted"}


def test_statistics_in_the_catalog_change_the_plan(spark):
    from tidemark.operators import catalog_tables as ct
    db = flows.listed_tables(spark, SF)
    profile = {r.table_name: r.row_count for r in ct.profile(spark, db).collect()}
    assert profile["lineitem"] == spark.table(f"{db}.lineitem").count() and len(profile) == 14
    ct.analyze(spark, db, "customer", ["c_custkey"])
    ct.analyze(spark, db, "orders", ["o_custkey", "o_orderkey"])
    size = spark.table(f"{db}.orders")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    join = f"SELECT * FROM {db}.orders o JOIN (SELECT o_orderkey AS k FROM {db}.orders WHERE o_orderkey = 1) x ON o.o_orderkey = x.k"
    plans = {}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(min(int(str(size)) // 20, 2000)))
    try:
        for cbo in ("false", "true"):
            spark.conf.set("spark.sql.cbo.enabled", cbo)
            plans[cbo] = spark.sql(join)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.cbo.enabled")
    assert "BroadcastHashJoin" not in plans["false"] and "BroadcastHashJoin" in plans["true"]
    ct.register(spark, "odd_db", f"{flows.work_path(spark, 'odd')}", {})
    assert ct.profile(spark, "odd_db").count() == 0


def test_checked_insert(spark, fresh):
    from tidemark.streaming.batches import BatchLog
    log = BatchLog(spark, fresh, "a int")
    rows = spark.createDataFrame([(1,), (-1,)], "a int")
    assert not flows.checked_insert(log, rows, {"p": "a > 0"}, 0) and log.read().count() == 0
    assert flows.checked_insert(log, rows.filter("a > 0"), {"p": "a > 0"}, 0) and log.read().count() == 1


@pytest.mark.parametrize("by_days", [False, True])
def test_steps_compute_their_rows_once(spark, fresh, by_days):
    from tidemark.plans import streams as st
    seen = spark.sparkContext.accumulator(0)

    def look(i):
        seen.add(1)
        return i % 10 != 0

    rows = spark.range(60).select("id", F.expr("timestamp'2024-01-01' + make_dt_interval(id)").alias("t")).unionByName(
        spark.sql("SELECT 99L AS id, CAST(NULL AS TIMESTAMP) AS t")).filter(F.udf(look, "boolean")("id"))
    landed = []

    def run():
        landed.append(sorted(r.id for r in spark.read.schema("id long, t timestamp").option("recursiveFileLookup", "true").format(fmt).load(fresh).collect()))

    if by_days:  # rows without a time are not landed
        fmt, go, n = "json", st._stepped, 54
    else:
        fmt, go, n = "parquet", flows.stepped, 55
    go(spark, rows, "t", fresh, run)
    assert seen.value <= 2 * 61  # one look for the span of time, one for the rows
    steps = 12 if by_days else 3
    assert len(landed) == steps and len(landed[-1]) == n
    assert all(set(a) < set(b) for a, b in zip(landed, landed[1:], strict=False))
    go(spark, rows, "t", fresh, run)  # all had landed: one more run, no new rows
    assert len(landed) == steps + 1 and landed[-1] == landed[-2]


def test_books_do_not_pass_the_driver(spark):
    from tidemark.sources.bookstore import books_payload
    plan = books_payload(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
