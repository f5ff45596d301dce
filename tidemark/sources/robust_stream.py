"""Reliable JSON ingest as streams: bad records to a side path, schemas that evolve (SRC-9, SRC-10).

``split_stream`` writes good rows and bad lines of each micro-batch to two logs; a replayed batch
replaces its rows in both.

``evolving_ingest`` keeps the schema of an ingest in numbered versions. Per micro-batch one distributed
aggregate gives the merged schema of its lines, nested paths included, as one string; ``extend`` adds
it to the stored one (integers widen to doubles, what does not fit to strings; declared types that fit stay). If
that changes anything, the mode decides:

* ``addNewColumns``    the run fails once, after storing the merged schema as the next version; the next run
                       takes the same batch again from the checkpoint and passes
* ``failOnNewColumns`` every run fails until the schema is extended by hand (``SchemaVersions.put``)
* ``rescue``           the schema stays; unknown fields at any depth and values of another type are kept in
                       ``_rescued_data`` as a JSON object from path to text
* ``none``             they are ignored

Rows are stored under the version that they were parsed with and read as the newest one. Lines that are
not JSON objects give a row of nulls.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists
from ..streaming.batches import BatchLog
from ..streaming.runner import drain, kept
from .robust import CORRUPT, RESCUED, UnknownFieldsError

LINES = "value string, file string"


def line_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of text files with the file they come from."""
    r = spark.readStream.option("recursiveFileLookup", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.text(path).select("value", F.col("_metadata.file_path").alias("file"))


# ---------------------------------------------------------------------------
# Bad records

def bad_reason(schema: T.StructType, required: Sequence[str]) -> Column:
    """Why a parsed line is bad, or null."""
    reason = F.when(F.try_parse_json("value").isNull(), "malformed").when(F.col(CORRUPT).isNotNull(), "type mismatch")
    for c in required:
        reason = reason.when(F.col(c).isNull(), f"missing {c}")
    return reason


def split_stream(lines: DataFrame, schema: T.StructType, good_path: str, bad_path: str, checkpoint: str,
                 required: Sequence[str] = ()) -> tuple[BatchLog, BatchLog]:
    """Parse a stream of lines: good rows (schema and file) and bad ones (line, file, reason)."""
    spark = lines.sparkSession
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    good = BatchLog(spark, good_path, T.StructType([*schema.fields, T.StructField("file", T.StringType())]))
    bad = BatchLog(spark, bad_path, LINES + ", reason string")

    def split(mb: DataFrame, batch_id: int) -> None:
        parsed = mb.select("value", "file", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("v"))
        with kept(parsed.select("value", "file", "v.*").withColumn("reason", bad_reason(schema, required))) as rows:
            good.append(rows.filter("reason is null"), batch_id)
            bad.append(rows.filter("reason is not null"), batch_id)

    drain(lines.writeStream.foreachBatch(split), checkpoint)
    return good, bad


# ---------------------------------------------------------------------------
# Evolving schemas

_TEXTS = "map<string,string>"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMBER = (*_INTEGRAL, T.FloatType, T.DoubleType, T.DecimalType)


def merge_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds values of both."""
    if isinstance(a, T.NullType) or a == b:
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        theirs = {f.name: f.dataType for f in b.fields}
        fields = [T.StructField(f.name, merge_types(f.dataType, theirs.pop(f.name, T.NullType()))) for f in a.fields]
        return T.StructType([*fields, *[T.StructField(n, t) for n, t in theirs.items()]])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merge_types(a.elementType, b.elementType))
    if isinstance(a, _NUMBER) and isinstance(b, _NUMBER):
        return T.LongType() if isinstance(a, _INTEGRAL) and isinstance(b, _INTEGRAL) else T.DoubleType()
    return T.StringType()


def fits(declared: T.DataType, seen: T.DataType) -> bool:
    """Whether JSON values that look like ``seen`` are read as ``declared``: a time stamp is text in JSON."""
    if isinstance(declared, _INTEGRAL):
        return isinstance(seen, _INTEGRAL)
    if isinstance(declared, _NUMBER):
        return isinstance(seen, _NUMBER)
    text = (T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)
    return isinstance(declared, T.StringType) or isinstance(declared, text) and isinstance(seen, T.StringType)


def extend(declared: T.DataType, seen: T.DataType) -> T.DataType:
    """``declared`` with what ``seen`` adds to it; types that fit stay as declared."""
    if isinstance(declared, T.StructType) and isinstance(seen, T.StructType):
        theirs = {f.name: f.dataType for f in seen.fields}
        fields = [T.StructField(f.name, extend(f.dataType, theirs.pop(f.name, T.NullType()))) for f in declared.fields]
        return T.StructType([*fields, *[T.StructField(n, t) for n, t in theirs.items()]])
    if isinstance(declared, T.ArrayType) and isinstance(seen, T.ArrayType):
        return T.ArrayType(extend(declared.elementType, seen.elementType))
    return declared if fits(declared, seen) else merge_types(declared, seen)


def known_types(t: T.DataType) -> T.DataType:
    """Without what has only been null so far, and decimals as doubles."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, k) for f in t.fields if not isinstance(k := known_types(f.dataType), T.NullType)])
    if isinstance(t, T.ArrayType):
        inner = known_types(t.elementType)
        return T.NullType() if isinstance(inner, T.NullType) else T.ArrayType(inner)
    return T.DoubleType() if isinstance(t, T.DecimalType) else t


def variant_type(text: str) -> T.DataType:
    """A type as variant schemas name it: objects are structs, mixed values text."""
    parts = re.split(r"(`(?:[^`]|``)*`)", text)
    parts[::2] = [re.sub(r"(?<=: )VARIANT\b|(?<=ARRAY<)VARIANT\b", "STRING", p.replace("OBJECT<", "STRUCT<")) for p in parts[::2]]
    return T.DataType.fromDDL("".join(parts)) if text not in ("VARIANT", "VOID") else T.NullType()


def observed(lines: DataFrame) -> T.StructType:
    """Merged schema of JSON lines, by one distributed aggregate that returns one string."""
    value = F.try_parse_json("value")
    text = lines.select(value.alias("v")).filter(F.schema_of_variant("v").startswith("OBJECT<")).agg(F.schema_of_variant_agg("v")).first()[0]
    found = known_types(variant_type(text)) if text else T.NullType()
    return found if isinstance(found, T.StructType) else T.StructType([])


def differences(a: T.DataType, b: T.DataType, path: str = "") -> list[str]:
    """Paths at which ``b`` has a field or a type that ``a`` has not."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        mine = {f.name: f.dataType for f in a.fields}
        out = []
        for f in b.fields:
            p = f"{path}.{f.name}" if path else f.name
            out += differences(mine[f.name], f.dataType, p) if f.name in mine else [p]
        return out
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return differences(a.elementType, b.elementType, f"{path}[]")
    return [] if a == b else [path]


class SchemaVersions:
    """Schemas of an ingest, numbered; a version is a folder of one line of JSON."""

    def __init__(self, spark: SparkSession, path: str, initial: T.StructType):
        self.spark, self.path, self.initial = spark, path.rstrip("/"), initial

    def all(self) -> list[T.StructType]:
        found = [self.initial]
        while path_exists(self.spark, f"{self.path}/v={len(found)}/_SUCCESS"):
            line = self.spark.read.text(f"{self.path}/v={len(found)}").first().value
            found.append(T.StructType.fromJson(json.loads(line)))
        return found

    def put(self, schema: T.StructType) -> None:
        n = len(self.all())
        self.spark.createDataFrame([(json.dumps(schema.jsonValue()),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/v={n}")


def _json_path(path: tuple[str, ...]) -> str:
    return "$" + "".join(f"['{p}']" for p in path)


def _structs(schema: T.StructType, path: tuple[str, ...] = ()):
    yield path, schema
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            yield from _structs(f.dataType, (*path, f.name))


def _beyond(path: tuple[str, ...], s: T.StructType) -> Column:
    """Map from path to text of the fields of one object that its struct has not."""
    inner = F.col("value") if not path else F.get_json_object("value", _json_path(path))
    names = F.array(*[F.lit(f.name) for f in s.fields]).cast("array<string>")
    extra = F.map_filter(F.from_json(inner, _TEXTS), lambda k, _: ~F.array_contains(names, k))
    if path:
        extra = F.transform_keys(extra, lambda k, _: F.concat(F.lit(".".join(path) + "."), k))
    return F.coalesce(extra, F.create_map().cast(_TEXTS))


def _misfit(at: tuple[str, ...], row: str) -> Column:
    """Map from path to text of a field whose value is not of its type."""
    parsed, raw = F.col(row), F.get_json_object("value", _json_path(at))
    for p in at:
        parsed = parsed[p]
    return F.when(parsed.isNull() & raw.isNotNull(), F.create_map(F.lit(".".join(at)), raw)).otherwise(F.create_map().cast(_TEXTS))


def rescued(schema: T.StructType, row: str) -> Column:
    """JSON object from path to text, of what a line holds beyond ``schema``; null if nothing. ``row`` is the parsed struct."""
    maps = []
    for path, s in _structs(schema):
        maps.append(_beyond(path, s))
        maps += [_misfit((*path, f.name), row) for f in s.fields if not isinstance(f.dataType, T.StructType)]
    whole = F.map_concat(*maps)
    return F.when(F.size(whole) > 0, F.to_json(whole))


def conform(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """A column of an older type as a newer one."""
    if have == want:
        return c
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        mine = {f.name: f.dataType for f in have.fields}
        return F.when(c.isNotNull(), F.struct(*[
            (conform(c[f.name], mine[f.name], f.dataType) if f.name in mine else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: conform(x, have.elementType, want.elementType))
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType)):
        return F.to_json(c)
    return c.cast(want)


class EvolvingTable:
    """Rows stored under the schema version that they were parsed with."""

    def __init__(self, spark: SparkSession, path: str, initial: T.StructType, keep_rescued: bool = False):
        self.spark, self.path, self.keep_rescued = spark, path.rstrip("/"), keep_rescued
        self.versions = SchemaVersions(spark, f"{path}/_schemas", initial)

    def log(self, version: int, schema: T.StructType) -> BatchLog:
        extra = [T.StructField(RESCUED, T.StringType())] if self.keep_rescued else []
        return BatchLog(self.spark, f"{self.path}/rows/schema={version}", T.StructType([*schema.fields, *extra]))

    def read(self) -> DataFrame:
        schemas = self.versions.all()
        newest, out = schemas[-1], None
        for version, s in enumerate(schemas):
            rows = self.log(version, s).read()
            extra = [F.col(RESCUED)] if self.keep_rescued else []
            have = {f.name: f.dataType for f in s.fields}
            rows = rows.select(*[(conform(F.col(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
                                 for f in newest.fields], *extra)
            out = rows if out is None else out.unionByName(rows)
        return out


def evolving_ingest(lines: DataFrame, table: EvolvingTable, mode: str, checkpoint: str) -> None:
    """Run a stream of lines into ``table``; raises ``UnknownFieldsError`` (by way of the query's error) as its mode says."""
    if mode not in ("addNewColumns", "failOnNewColumns", "rescue", "none"):
        raise ValueError(f"no such mode: {mode}")

    def ingest(mb: DataFrame, batch_id: int) -> None:
        schemas = table.versions.all()
        schema = schemas[-1]
        with kept(mb) as mb:
            if mode in ("addNewColumns", "failOnNewColumns"):
                merged = extend(schema, observed(mb))
                fresh = differences(schema, merged)
                if fresh:
                    if mode == "addNewColumns":
                        table.versions.put(merged)
                    raise UnknownFieldsError(fresh)
            rows = mb.select("value", F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("v"))
            extra = [rescued(schema, "v").alias(RESCUED)] if table.keep_rescued else []
            table.log(len(schemas) - 1, schema).append(rows.select("v.*", *extra), batch_id)

    drain(lines.writeStream.foreachBatch(ingest), checkpoint)


def with_restarts(run, times: int = 1) -> int:
    """Call ``run`` again after a failure for new fields, ``times`` times at most; returns how often it failed."""
    for failures in range(times + 1):
        try:
            run()
            return failures
        except Exception as e:
            if "new fields in input" not in str(e) or failures == times:
                raise
    return times
