"""MERGE / CDC semantics."""
import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import cdc

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id BIGINT, v STRING, ts TIMESTAMP"


def t(h):
    return T0 + dt.timedelta(hours=h)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_upsert_guard_is_strict(spark):
    target = spark.createDataFrame([(1, "a", t(1)), (2, "b", t(1)), (3, "c", t(1))], SCHEMA)
    src = spark.createDataFrame([(1, "same-time", t(1)), (2, "older", t(0)), (3, "newer", t(2)),
                                 (4, "new", t(1))], SCHEMA)
    res = cdc.upsert(target, src, ["id"], "ts")
    assert rows(res.table, "id", "v") == [(1, "a"), (2, "b"), (3, "newer"), (4, "new")]
    ch = rows(res.changes, "id", "v", "_change_type")
    assert ch == [(3, "c", "update_preimage"), (3, "newer", "update_postimage"), (4, "new", "insert")]


def test_upsert_latest_in_batch_and_ties_insert_twice(spark):
    target = spark.createDataFrame([], SCHEMA)
    src = spark.createDataFrame([(1, "x", t(1)), (1, "y", t(2)), (2, "p", t(1)), (2, "q", t(1))], SCHEMA)
    res = cdc.upsert(target, src, ["id"], "ts")
    # rank() keeps ties: both newest rows of an unmatched key insert
    assert rows(res.table, "id", "v") == [(1, "y"), (2, "p"), (2, "q")]
    amb = cdc.ambiguous_matches(spark.createDataFrame([(2, "z", t(0))], SCHEMA), src, ["id"], "ts")
    assert amb.count() == 1


def test_upsert_delete_clause(spark):
    target = spark.createDataFrame([(1, "a", t(1)), (2, "b", t(1))], SCHEMA)
    src = (spark.createDataFrame([(1, "delete", t(2)), (3, "delete", t(2))], SCHEMA))
    res = cdc.upsert(target, src, ["id"], "ts", delete_when=F.col("v") == "delete")
    assert rows(res.table, "id", "v") == [(2, "b")]
    assert rows(res.changes, "id", "_change_type") == [(1, "delete")]


def test_insert_only_null_keys_and_existing(spark):
    target = spark.createDataFrame([(1, "a", t(1))], SCHEMA)
    src = spark.createDataFrame([(1, "dup", t(1)), (None, "n", t(1)), (2, "b", t(1))], SCHEMA)
    res = cdc.insert_only(target, src, ["id"])
    assert rows(res.changes, "v") == [("b",), ("n",)]


def test_delete_by_keys_keeps_null_keys(spark):
    target = spark.createDataFrame([(1, "a", t(1)), (None, "n", t(1)), (2, "b", t(1))], SCHEMA)
    reqs = spark.createDataFrame([(1,), (None,)], "id BIGINT")
    res = cdc.delete_by_keys(target, reqs, ["id"])
    assert rows(res.table, "v") == [("b",), ("n",)]
    assert rows(res.changes, "v") == [("a",)]


def test_update_matched_distinct_source_keys(spark):
    target = spark.createDataFrame([(1, "requested", t(1)), (1, "requested", t(2)), (2, "requested", t(1))],
                                   SCHEMA)
    src = spark.createDataFrame([(1,), (1,)], "id BIGINT")
    res = cdc.update_matched(target, src, ["id"], {"v": F.lit("deleted")})
    assert rows(res.table, "id", "v") == [(1, "deleted"), (1, "deleted"), (2, "requested")]
    assert res.changes.count() == 4


BOOKS = "book_id BIGINT, title STRING, price DOUBLE, updated TIMESTAMP"
SCD2 = "book_id BIGINT, title STRING, price DOUBLE, current BOOLEAN, effective_date TIMESTAMP, end_date TIMESTAMP"


def test_scd2_merge_rules(spark):
    table = spark.createDataFrame([(1, "t1", 10.0, True, t(0), None),
                                   (2, "t2", 20.0, True, t(0), None)], SCD2)
    upd = spark.createDataFrame([
        (1, "renamed", 10.0, t(1)),     # same price: no-op even though title differs
        (2, "t2", 21.0, t(1)),          # price change: close + insert
        (2, "t2", 22.0, t(2)),          # second change in the batch: chained
        (3, "t3", 30.0, t(1)),          # unseen key
        (1, "t1", None, t(3)),          # NULL price: no-op
    ], BOOKS)
    res = cdc.scd2_merge(table, upd, "book_id", "updated")
    got = rows(res.table, "book_id", "price", "current", "effective_date", "end_date")
    assert got == [(1, 10.0, True, t(0), None),
                   (2, 20.0, False, t(0), t(1)),
                   (2, 21.0, False, t(1), t(2)),
                   (2, 22.0, True, t(2), None),
                   (3, 30.0, True, t(1), None)]
    types = sorted(r._change_type for r in res.changes.collect())
    assert types == ["insert", "insert", "insert", "update_postimage", "update_preimage"]


def test_scd2_batches_equal_one_batch(spark):
    upd = [(1, "a", float(p), t(i)) for i, p in enumerate([1, 1, 2, 3, 3, 1])]
    empty = spark.createDataFrame([], SCD2)
    one = cdc.scd2_merge(empty, spark.createDataFrame(upd, BOOKS), "book_id", "updated").table
    tab = empty
    for i in range(0, len(upd), 2):
        tab = cdc.scd2_merge(tab, spark.createDataFrame(upd[i:i + 2], BOOKS), "book_id", "updated").table
        tab = spark.createDataFrame(tab.collect(), SCD2)
    cols = ("price", "current", "effective_date", "end_date")
    assert rows(one, *cols) == rows(tab, *cols)


def test_scd2_out_of_order_update_becomes_current(spark):
    table = spark.createDataFrame([(1, "a", 10.0, True, t(5), None)], SCD2)
    upd = spark.createDataFrame([(1, "a", 11.0, t(1))], BOOKS)
    got = rows(cdc.scd2_merge(table, upd, "book_id", "updated").table,
               "price", "current", "effective_date", "end_date")
    assert got == [(10.0, False, t(5), t(1)), (11.0, True, t(1), None)]


def test_auto_cdc_scd2_order_insensitive_and_deletes(spark):
    data = [(1, "a", 1.0, "u", t(0)), (1, "a", 1.0, "u", t(1)), (1, "a", 2.0, "u", t(2)),
            (1, None, None, "d", t(3)), (1, "a", 2.0, "u", t(4)), (2, "b", 5.0, "u", t(0))]
    sch = "book_id BIGINT, title STRING, price DOUBLE, op STRING, updated TIMESTAMP"
    a = cdc.apply_changes_scd2(None, spark.createDataFrame(data, sch), ["book_id"], "updated",
                               except_columns=["op", "updated"], delete_when="op = 'd'")
    b = cdc.apply_changes_scd2(None, spark.createDataFrame(list(reversed(data)), sch), ["book_id"],
                               "updated", except_columns=["op", "updated"], delete_when="op = 'd'")
    a_stored = a
    a, b = cdc.scd2_rows(a), cdc.scd2_rows(b)
    want = [(1, 1.0, t(0), t(2)), (1, 2.0, t(2), t(3)), (1, 2.0, t(4), None), (2, 5.0, t(0), None)]
    assert rows(a, "book_id", "price", "__START_AT", "__END_AT") == want
    assert rows(b, "book_id", "price", "__START_AT", "__END_AT") == want
    # incremental: a second batch against the stored history
    more = spark.createDataFrame([(2, "b", 6.0, "u", t(9))], sch)
    c = cdc.apply_changes_scd2(a_stored, more, ["book_id"], "updated", except_columns=["op", "updated"],
                               delete_when="op = 'd'")
    c = cdc.scd2_rows(c)
    assert rows(c, "book_id", "price", "__START_AT", "__END_AT")[-2:] == [
        (2, 5.0, t(0), t(9)), (2, 6.0, t(9), None)]


def test_auto_cdc_scd1_keeps_sequence_and_deletes(spark):
    sch = "id BIGINT, v STRING, op STRING, ts TIMESTAMP"
    upd = spark.createDataFrame([(1, "a", "u", t(1)), (1, "b", "u", t(2)), (2, "x", "u", t(1)),
                                 (2, None, "d", t(2))], sch)
    out = cdc.apply_changes_scd1(None, upd, ["id"], "ts", except_columns=["op", "ts"],
                                 delete_when="op = 'd'")
    assert rows(cdc.scd1_rows(out), "id", "v") == [(1, "b")]
    # rows older than what is stored, one of them older than its key's delete
    late = spark.createDataFrame([(1, "late", "u", t(0)), (2, "late", "u", t(1))], sch)
    out2 = cdc.apply_changes_scd1(out, late, ["id"], "ts", except_columns=["op", "ts"])
    assert rows(cdc.scd1_rows(out2), "id", "v") == [(1, "b")]


def test_auto_cdc_does_not_depend_on_batches(spark):
    """Random cuts and orders of a change log, rows delivered twice included."""
    import random
    sch = "id BIGINT, v STRING, op STRING, ts TIMESTAMP"
    rnd = random.Random(7)
    data = [(k, rnd.choice("AAB"), rnd.choice("uuud"), t(h)) for k in (1, 2, None) for h in range(8)]
    log = dict(except_columns=["op", "ts"], delete_when="op = 'd'")

    def run(apply, view, batches):
        stored = None
        for b in batches:
            stored = apply(stored, spark.createDataFrame(b, sch), ["id"], "ts", **log)
        return sorted(map(tuple, view(stored).collect()), key=str)

    for apply, view in ((cdc.apply_changes_scd1, cdc.scd1_rows), (cdc.apply_changes_scd2, cdc.scd2_rows)):
        want = run(apply, view, [data])
        assert want
        mixed = rnd.sample(data, len(data))
        assert run(apply, view, [mixed[:9], mixed[9:11], mixed[5:]]) == want


def test_auto_cdc_scd2_late_row_and_stored_delete(spark):
    sch = "id BIGINT, v STRING, op STRING, ts TIMESTAMP"
    log = dict(except_columns=["op", "ts"], delete_when="op = 'd'")
    first = [(1, "A", "u", t(1)), (1, "A", "u", t(3)), (2, "x", "u", t(1)), (2, None, "d", t(2))]
    stored = cdc.apply_changes_scd2(None, spark.createDataFrame(first, sch), ["id"], "ts", **log)
    late = [(1, "B", "u", t(2)), (2, "y", "u", t(5))]
    stored = cdc.apply_changes_scd2(stored, spark.createDataFrame(late, sch), ["id"], "ts", **log)
    assert sorted(map(tuple, cdc.scd2_rows(stored).collect()), key=str) == sorted([
        (1, "A", t(1), t(2)), (1, "B", t(2), t(3)), (1, "A", t(3), None),
        (2, "x", t(1), t(2)), (2, "y", t(5), None)], key=str)
