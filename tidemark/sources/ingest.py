"""Raw file landing and incremental ingest into the multiplex bronze table.

SRC-1 batch JSON scan, SRC-2 incremental file ingest (each file once,
tracked by the stream checkpoint), SRC-8 micro-batch size limits, SNK-1/2
checkpointed, Hive-partitioned streaming append.
"""

from __future__ import annotations

import os
import shutil
from collections.abc import Callable, Iterable, Iterator

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import estimated_bytes
from ..session import content_state, dataset_tag, list_dirs, local_path, move_dir, path_exists, remove_dir, settings, touch, work_path
from ..streaming.runner import drain
from .bookstore import BRONZE_SCHEMA, ENVELOPE_SCHEMA, raw_envelopes
from .tables import load


# Bytes of the given tables (estimated) whose envelopes make one landed file.
LANDED_BYTES = 4 << 20
# Cells of equal length that a topic's time is counted in.
CELLS = 8192
# Files (about) that share a folder when each key gets a file, and folders that are listed and scanned at once.
FOLDER_FILES = 1024
SCANNED_FOLDERS = 64


def _spans(spark: SparkSession, rows: DataFrame, at: Column, parts: int) -> Callable[[Column], Column]:
    """Which of ``parts`` consecutive spans of time of about as many rows each a time lies in. ``rows`` are scanned for
    ``at`` only; the driver gets a count for each of ``CELLS`` at most. Times beyond a thousandth at either end share an end cell."""
    us = F.unix_micros(at.cast("timestamp"))
    lo, hi = rows.agg(F.percentile_approx(us, [0.001, 0.999], 10_000)).first()[0] or (0, 0)

    def cell(t: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.lit(CELLS - 1), F.floor((t - F.lit(lo)) / float(hi - lo + 1) * CELLS))).cast("int")

    if parts == 1:
        return lambda t: F.lit(0)
    held = dict(rows.groupBy(cell(us).alias("c")).count().collect())
    whole, seen, of = max(1, sum(held.values())), 0, []
    for c in range(CELLS):
        of.append(min(parts - 1, seen * parts // whole))
        seen += held.get(c, 0)
    spans = F.lit(of)
    return lambda t: F.coalesce(F.element_at(spans, cell(t) + 1), F.lit(0))


def land_raw(spark: SparkSession, sf_dir: str) -> str:
    """Write the Kafka-shaped JSON files derived from the given tables once.

    Files are grouped by topic and event time, like consecutive topic dumps, and compressed:
    the envelope holds each value in base64, four times the size of the table it comes from.
    The spans of time are read from the given tables: a range shuffle would join, list and write JSON twice, once for its samples.
    """
    path = work_path(spark, "landing", dataset_tag(spark, sf_dir), "kafka-raw")
    if not path_exists(spark, f"{path}/_SUCCESS"):
        orders, lines, events = (load(spark, sf_dir, t) for t in ("orders", "lineitem", "events"))
        n_orders, n_events = (max(1, -(-sum(map(estimated_bytes, x)) // LANDED_BYTES)) for x in ((orders, lines), (events,)))
        of_orders, of_events = _spans(spark, orders, F.col("o_orderdate"), n_orders), _spans(spark, events, F.col("ts"), n_events)
        t = F.col("timestamp") * 1000
        span = (F.when(F.col("topic") == "orders", of_orders(t)).when(F.col("topic") == "customers", n_orders + of_events(t))
                .otherwise(n_orders + n_events + of_events(t)))
        rows = raw_envelopes(spark, sf_dir)
        (rows.withColumn("_span", span.cast("int")).repartitionById(n_orders + 2 * n_events, F.col("_span")).drop("_span")
         .write.mode("overwrite").json(path, compression="gzip"))
    return path


def land_steps(rows: DataFrame, step: str, n: int, landing: str, run: Callable[[], object], *, fmt: str, part: str = "step={}",
               **options: str) -> bool:
    """Land ``rows`` in ``n`` steps by their column ``step`` (0 to n-1; rows without one do not land), and call ``run``
    after each one landed now. Returns whether any was.

    ``rows`` are computed once: one job writes all steps beside ``landing``, and a step lands when its complete folder
    is moved into it. A step without rows lands as an empty write.
    """
    spark, staged = rows.sparkSession, f"{landing}-staged"
    news = False
    for s in range(n):
        dest = f"{landing}/{part.format(s)}"
        if path_exists(spark, f"{dest}/_SUCCESS"):
            continue
        if not path_exists(spark, f"{staged}/_SUCCESS"):
            rows.filter(F.col(step).isNotNull()).write.mode("overwrite").partitionBy(step).options(**options).format(fmt).save(staged)
        if path_exists(spark, f"{staged}/{step}={s}"):
            touch(spark, f"{staged}/{step}={s}/_SUCCESS")
            move_dir(spark, f"{staged}/{step}={s}", dest)
        else:
            empty = spark.createDataFrame([], rows.drop(step).schema)
            empty.write.mode("overwrite").options(**options).format(fmt).save(dest)
        run()
        news = True
    return news


def with_bronze_columns(raw: DataFrame) -> DataFrame:
    """Epoch ms -> TIMESTAMP, plus the ``year_month`` partition column (FN-2, FN-3)."""
    return (raw.withColumn("timestamp", (F.col("timestamp") / 1000).cast("timestamp"))
            .withColumn("year_month", F.date_format("timestamp", "yyyy-MM")))


def raw_stream(spark: SparkSession, landing: str, *, max_files: int | None = None,
               max_bytes: int | None = None) -> DataFrame:
    """Incremental JSON ingest with a declared schema (SRC-2, SRC-8).

    Sub-folders are ingested too (``recursiveFileLookup``). Size limits must
    be integers for the open-source file source.
    """
    r = (spark.readStream.schema(ENVELOPE_SCHEMA)
         .option("recursiveFileLookup", "true"))
    if max_files:
        r = r.option("maxFilesPerTrigger", int(max_files))
    if max_bytes:
        r = r.option("maxBytesPerTrigger", int(max_bytes))
    return r.json(landing)


def ingest_bronze(spark: SparkSession, landing: str, bronze: str, checkpoint: str, *,
                  max_files: int | None = None, max_bytes: int | None = None) -> str:
    """Stream landed files into bronze, partitioned by (topic, year_month).

    A task sorts what it reads by partition, so it reads few compressed bytes (they are a seventh of the lines).
    """
    stream = with_bronze_columns(raw_stream(spark, landing, max_files=max_files, max_bytes=max_bytes))
    with settings(spark, spark__sql__files__maxPartitionBytes="16m"):
        drain(stream.writeStream.partitionBy("topic", "year_month").outputMode("append").option("compression", "zstd"),
              checkpoint, to_path=bronze)
    return bronze


def ensure_bronze(spark: SparkSession, sf_dir: str) -> str:
    """Bronze for ``sf_dir``, brought up to date with its landing folder.

    The stream checkpoint only admits files not yet ingested, and readers see only
    files the sink log committed. The stream is not started while the landing folder
    is as the last ingest left it.
    """
    tag = dataset_tag(spark, sf_dir)
    bronze = work_path(spark, "tables", tag, "bronze")
    landing = land_raw(spark, sf_dir)
    taken = f"{bronze}-taken/{content_state(spark, landing)}"
    if not path_exists(spark, taken):
        ingest_bronze(spark, landing, bronze, work_path(spark, "checkpoints", tag, "bronze"))
        touch(spark, taken)
    return bronze


def read_bronze(spark: SparkSession, bronze: str) -> DataFrame:
    return spark.read.schema(BRONZE_SCHEMA).parquet(bronze)


def bronze_stream(spark: SparkSession, bronze: str, *, max_files: int | None = None) -> DataFrame:
    """Streaming read of the bronze table (SRC-4)."""
    r = spark.readStream.schema(BRONZE_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", int(max_files))
    return r.parquet(bronze)


def read_json_batch(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Batch JSON scan, inferred schema unless given (SRC-1)."""
    r = spark.read
    if schema:
        r = r.schema(schema)
    return r.json(path)


def binary_files(spark: SparkSession, path: str | list[str], glob: str = "*",
                 stream: bool = False) -> DataFrame:
    """Binary-file scan with a file-name glob (SRC-7); a batch scan takes several folders too."""
    r = spark.readStream if stream else spark.read
    r = r.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    if stream:
        r = r.schema("path STRING, modificationTime TIMESTAMP, length LONG, content BINARY")
    return r.load(path)


def file_writer(folder: str) -> Callable[[Iterable[tuple[str, bytes | None]], int, int], None]:
    """A writer of (name, line) pairs to the files ``<name>.txt`` of ``part=<part>`` in ``folder``. They are written elsewhere
    and moved there when all are; of several attempts at a part the first counts. Workers get it whole, they need no import of ours."""
    def write(lines: Iterable[tuple[str, bytes | None]], part: int, attempt: int) -> None:
        own, to = f"{folder}/_attempt-{attempt}", f"{folder}/part={part}"
        os.makedirs(own)
        for name, line in lines:
            with open(f"{own}/{name}.txt", "ab") as f:
                f.write((line or b"") + b"\n")
        try:
            os.rename(own, to)
        except OSError:
            if not os.path.isdir(to):
                raise
            shutil.rmtree(own)
    return write


def land_files(rows: DataFrame, key: str, text: str, path: str) -> None:
    """Write a text file for each value of ``key``, named by it, with a line for each of its rows' ``text``.

    Files share folders (``part=``), about ``FOLDER_FILES`` each. Hadoop's local file system starts a process for each
    file it makes, another one for its checksums, and Spark's writer needs a folder for each file: in a local (shared)
    folder the tasks write for themselves. Other stores get Spark's files, in a folder for each key within ``part=``.
    """
    spark = rows.sparkSession
    remove_dir(spark, path)  # what a run that did not end has left
    parts = rows.select(key).count() // FOLDER_FILES + 1
    rows = rows.select(key, text).repartition(parts, F.col(key))
    local = local_path(spark, path)
    if local is None:
        rows.withColumn("part", F.spark_partition_id()).write.partitionBy("part", key).text(path)
        return

    write = file_writer(local)

    def run(batches: Iterator) -> Iterator:
        task = TaskContext.get()
        write((x for b in batches for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)),
              task.partitionId(), task.taskAttemptId())
        yield from ()

    name = F.concat(F.lit(f"{key}="), F.coalesce(F.col(key).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))
    (rows.select(name.alias("name"), F.col(text).cast("binary").alias("line")).mapInArrow(run, "n long")
     .write.format("noop").mode("overwrite").save())
    touch(spark, f"{path}/_SUCCESS")


def scan_files(spark: SparkSession, path: str, glob: str, of: Callable[[DataFrame], DataFrame], to: str) -> DataFrame:
    """``of`` the binary files that ``land_files`` wrote, stored in ``to``.

    The driver keeps the status of each file of a scan, so ``SCANNED_FOLDERS`` are scanned at a time. Files count as
    16 kB besides their length when they are dealt to tasks (4 MB by default: a few files a task).
    """
    folders = [f"{path}/{d}" for d in list_dirs(spark, path) if d.startswith("part=")] or [path]
    with settings(spark, spark__sql__files__openCostInBytes="16k", spark__sql__sources__ignoreDataLocality="true",
                  spark__sql__hive__manageFilesourcePartitions="false"):
        for i in range(0, len(folders), SCANNED_FOLDERS):
            of(binary_files(spark, folders[i:i + SCANNED_FOLDERS], glob)).write.mode("append").parquet(to)
    return spark.read.parquet(to)
