"""Reliable JSON ingest: bad records, required fields, schema evolution (SRC-9, SRC-10).

All functions work on a DataFrame of raw JSON lines (column ``value``), so the
same code runs on a batch read (``spark.read.text``) or inside
``foreachBatch`` of a text file stream.

Schema evolution modes, after the file-ingest options they mirror:

* ``addNewColumns``    new fields fail the run once; the stored schema is
                       extended (new fields as STRING) so the next run passes.
* ``rescue``           the schema never changes; fields outside it are kept
                       as JSON text in ``_rescued_data``.
* ``failOnNewColumns`` new fields fail every run until the schema is changed.
* ``none``             new fields are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists

CORRUPT = "_corrupt_record"
RESCUED = "_rescued_data"


class UnknownFieldsError(Exception):
    def __init__(self, fields):
        super().__init__(f"new fields in input: {sorted(fields)}")
        self.fields = sorted(fields)


def parse_lines(lines: DataFrame, schema: str | T.StructType, *, keep_raw: bool = False) -> DataFrame:
    """``from_json`` in PERMISSIVE mode with a corrupt-record column: malformed
    lines and type mismatches keep their raw text in ``_corrupt_record``."""
    st = _struct(lines.sparkSession, schema)
    full = T.StructType(list(st.fields) + [T.StructField(CORRUPT, T.StringType())])
    parsed = lines.select(*(["value"] if keep_raw else []),
                          F.from_json("value", full, {"mode": "PERMISSIVE",
                                                      "columnNameOfCorruptRecord": CORRUPT}).alias("v"))
    return parsed.select(*(["value"] if keep_raw else []), "v.*")


def split_bad_records(parsed: DataFrame, required: list[str] = ()):
    """(good, bad) rows. Bad = unparseable or type-mismatched lines, plus
    lines missing a required field (which the parser alone accepts)."""
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    bad_cond = F.col(CORRUPT).isNotNull() | missing
    return parsed.filter(~bad_cond).drop(CORRUPT), parsed.filter(bad_cond)


def field_names(lines: DataFrame) -> DataFrame:
    """Distinct top-level field names present in the lines (a distributed
    distinct; the result is one row per field name)."""
    keys = F.map_keys(F.from_json("value", "map<string,string>"))
    return lines.select(F.explode(keys).alias("field")).distinct()


def new_fields(lines: DataFrame, schema: T.StructType) -> list[str]:
    known = [f.name for f in schema.fields]
    rows = field_names(lines).filter(~F.col("field").isin(known)).collect()
    return sorted(r.field for r in rows)


def rescue(lines: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Parse with a fixed schema and keep unknown fields in ``_rescued_data``."""
    st = _struct(lines.sparkSession, schema)
    known = F.array(*[F.lit(f.name) for f in st.fields])
    extra = F.map_filter(F.from_json("value", "map<string,string>"),
                         lambda k, v: ~F.array_contains(known, k))
    out = parse_lines(lines, st, keep_raw=True)
    return out.withColumn(RESCUED, F.when(F.size(extra) > 0, F.to_json(extra))).drop("value")


class SchemaStore:
    """The evolving schema of one ingest, kept as JSON next to its checkpoint."""

    def __init__(self, spark: SparkSession, path: str, initial: str | T.StructType):
        self.spark, self.path = spark, path.rstrip("/")
        self.initial = _struct(spark, initial)

    def get(self) -> T.StructType:
        if not path_exists(self.spark, self.path):
            return self.initial
        row = self.spark.read.text(self.path).first()
        return T.StructType.fromJson(json.loads(row.value))

    def put(self, schema: T.StructType) -> None:
        (self.spark.createDataFrame([(json.dumps(schema.jsonValue()),)], "value string")
         .coalesce(1).write.mode("overwrite").text(self.path))


def evolve(lines: DataFrame, store: SchemaStore, mode: str = "addNewColumns") -> DataFrame:
    """Parse ``lines`` under the stored schema and the given evolution mode."""
    schema = store.get()
    if mode == "rescue":
        return rescue(lines, schema)
    if mode == "none":
        return parse_lines(lines, schema)
    fresh = new_fields(lines, schema)
    if fresh and mode == "failOnNewColumns":
        raise UnknownFieldsError(fresh)
    if fresh and mode == "addNewColumns":
        store.put(T.StructType(list(schema.fields) +
                               [T.StructField(f, T.StringType()) for f in fresh]))
        raise UnknownFieldsError(fresh)
    return parse_lines(lines, schema)


def _struct(spark: SparkSession, schema: str | T.StructType) -> T.StructType:
    return spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
