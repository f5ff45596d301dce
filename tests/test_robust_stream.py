"""Evolving schemas and bad records on streams."""
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import robust_stream as rs
from tidemark.sources.robust import RESCUED


def ddl(text):
    return T.StructType.fromDDL(text)


def land(spark, path, lines):
    spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x),) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


@pytest.mark.parametrize("a, b, want", [
    ("a INT", "a BIGINT", "a BIGINT"), ("a BIGINT", "a DOUBLE", "a DOUBLE"), ("a DECIMAL(3,1)", "a BIGINT", "a DOUBLE"),
    ("a BIGINT", "a STRING", "a STRING"), ("a BOOLEAN", "a BIGINT", "a STRING"), ("a STRUCT<x: INT>", "a STRUCT<y: STRING>", "a STRUCT<x: INT, y: STRING>"),
    ("a ARRAY<BIGINT>", "a ARRAY<DOUBLE>", "a ARRAY<DOUBLE>"), ("a STRUCT<x: INT>", "a ARRAY<INT>", "a STRING"), ("a INT", "b INT", "a INT, b INT")])
def test_merge_types(spark, a, b, want):
    assert rs.merge_types(ddl(a), ddl(b)) == ddl(want)
    again = rs.merge_types(ddl(want), ddl(b))
    assert again == ddl(want)  # nothing changes any more


def test_declared_types_that_fit_stay(spark):
    declared = ddl("i INT, d DECIMAL(9,2), t TIMESTAMP, s STRING, a ARRAY<SMALLINT>, o STRUCT<x: DATE, y: BOOLEAN>")
    assert rs.extend(declared, ddl("i BIGINT, d BIGINT, t STRING, s BOOLEAN, a ARRAY<BIGINT>, o STRUCT<x: STRING, y: BOOLEAN>")) == declared
    wider = rs.extend(declared, ddl("i DOUBLE, t BIGINT, a ARRAY<DOUBLE>, o STRUCT<y: STRING, z: INT>, n INT"))
    assert wider == ddl("i DOUBLE, d DECIMAL(9,2), t STRING, s STRING, a ARRAY<DOUBLE>, o STRUCT<x: DATE, y: STRING, z: INT>, n INT")
    assert rs.differences(declared, wider) == ["i", "t", "a[]", "o.y", "o.z", "n"]


def test_observed_schema_is_merged_over_all_lines(spark):
    rows = [{"a": 1, "n": None}, {"a": 1.5, "o": {"x": 1, "odd name`": True}}, {"o": {"y": [1, 2.5]}}, "not json", "[1]", {"v": 1}, {"v": "t"}, {"OBJECT": 1, "VARIANT": 2}, {}]
    lines = spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x),) for x in rows], "value string").repartition(4)
    got = rs.observed(lines)
    want = {"a": T.DoubleType(), "v": T.StringType(), "OBJECT": T.LongType(), "VARIANT": T.LongType()}
    assert {f.name: f.dataType for f in got.fields if f.name != "o"} == want
    assert {f.name: f.dataType for f in got["o"].dataType.fields} == {"x": T.LongType(), "odd name`": T.BooleanType(), "y": T.ArrayType(T.DoubleType())}
    assert rs.observed(spark.createDataFrame([("x",)], "value string")) == T.StructType([])


def ingest(spark, root, table, mode):
    rs.evolving_ingest(rs.line_stream(spark, f"{root}/in"), table, mode, f"{root}/ck")


def test_add_fails_once_and_goes_on_from_the_checkpoint(spark, fresh):
    table = rs.EvolvingTable(spark, f"{fresh}/t", ddl("a BIGINT, o STRUCT<x: BIGINT>, l ARRAY<BIGINT>"))
    land(spark, f"{fresh}/in", [{"a": 1, "o": {"x": 1}, "l": [1]}])
    ingest(spark, fresh, table, "addNewColumns")
    land(spark, f"{fresh}/in", [{"a": 2.5, "o": {"x": "t", "y": True}, "l": [0.5], "b": "new"}, "{bad"])
    with pytest.raises(Exception, match="new fields in input: .'a', 'b', 'l\\[\\]', 'o.x', 'o.y'"):
        ingest(spark, fresh, table, "addNewColumns")
    assert table.read().count() == 1
    ingest(spark, fresh, table, "addNewColumns")
    ingest(spark, fresh, table, "addNewColumns")
    rows = sorted((r.a or 0, r.o.x if r.o else None, r.o.y if r.o else None, r.l, r.b) for r in table.read().collect())
    assert rows == [(0, None, None, None, None), (1.0, "1", None, [1.0], None), (2.5, "t", True, [0.5], "new")]


def test_fail_until_the_schema_is_put(spark, fresh):
    table = rs.EvolvingTable(spark, f"{fresh}/t", ddl("a BIGINT"))
    land(spark, f"{fresh}/in", [{"a": 1, "b": 2}])
    for _ in range(2):
        with pytest.raises(Exception, match="new fields"):
            ingest(spark, fresh, table, "failOnNewColumns")
    table.versions.put(ddl("a BIGINT, b BIGINT"))
    ingest(spark, fresh, table, "failOnNewColumns")
    assert [(r.a, r.b) for r in table.read().collect()] == [(1, 2)]


def test_rescue_keeps_what_does_not_fit(spark, fresh):
    table = rs.EvolvingTable(spark, f"{fresh}/t", ddl("id STRING, a BIGINT, o STRUCT<x: BIGINT>"), keep_rescued=True)
    land(spark, f"{fresh}/in", [{"id": "p", "a": 1, "o": {"x": 2}}, {"id": "q", "a": "t", "o": {"x": 3, "y": [1]}, "b": {"c": 1}}, {"id": "r", "a": None}])
    ingest(spark, fresh, table, "rescue")
    rows = {r.id: r for r in table.read().collect()}
    assert rows["p"][RESCUED] is None and rows["r"][RESCUED] is None and (rows["p"].a, rows["r"].a) == (1, None)
    assert json.loads(rows["q"][RESCUED]) == {"a": "t", "o.y": "[1]", "b": '{"c":1}'} and rows["q"].o.x == 3


def test_unknown_mode(spark, fresh):
    with pytest.raises(ValueError):
        rs.evolving_ingest(None, None, "other", "")


def test_bad_lines_keep_file_and_reason_and_replays_add_nothing(spark, fresh):
    for folder, lines in (("x", ['{"id": 1, "k": 2}', '{"id": 2', '{"id": "t", "k": 1}']), ("y", ['{"id": 3}', '{"id": 4, "k": 5, "z": 1}', ""])):
        land(spark, f"{fresh}/in/{folder}", lines)
    args = (ddl("id BIGINT, k INT"), f"{fresh}/good", f"{fresh}/bad")
    good, bad = rs.split_stream(rs.line_stream(spark, f"{fresh}/in"), *args, f"{fresh}/ck", required=["id", "k"])

    def seen():
        folder = F.regexp_extract("file", "/in/([^/]*)/", 1)
        return (sorted((r.id, r.k, r.f) for r in good.read().withColumn("f", folder).collect()),
                sorted((r.value, r.f, r.reason) for r in bad.read().withColumn("f", folder).collect()))
    want = ([(1, 2, "x"), (4, 5, "y")],
            [("", "y", "malformed"), ('{"id": "t", "k": 1}', "x", "type mismatch"), ('{"id": 2', "x", "malformed"), ('{"id": 3}', "y", "missing k")])
    assert seen() == want
    rs.split_stream(rs.line_stream(spark, f"{fresh}/in"), *args, f"{fresh}/ck", required=["id", "k"])
    assert seen() == want  # nothing new
    rs.split_stream(rs.line_stream(spark, f"{fresh}/in"), *args, f"{fresh}/ck-lost", required=["id", "k"])
    assert seen() == want  # batch 0 once more: replaced
