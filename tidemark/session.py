"""Session setup and the shared work folder.

Everything the library writes between steps (landed raw files, bronze,
versioned silver tables, stream checkpoints) lives under the folder the
cluster names in ``spark.checkpoint.dir``. Only when that setting is absent
(local tests) do we create one of our own.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings every query relies on. They are all SQL confs, so they can
# be applied to a session someone else built.
RUNTIME_CONF = {
    # Output timestamps and year_month partitions are derived in UTC.
    "spark.sql.session.timeZone": "UTC",
    # AQE: coalesce small shuffle partitions, split skewed join partitions,
    # and switch sort-merge joins to broadcast when runtime sizes allow it.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming state (dedup keys, window aggregates, the stream-stream join
    # buffers) off the JVM heap in RocksDB, with changelog checkpointing. A
    # checkpoint keeps the provider it was created with.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # One RocksDB instance a partition of a stream-stream join instead of four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def build_session(master: str = "local[8]", app: str = "tidemark",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests, the bench and local runs (UI off, UTC)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in {**RUNTIME_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent)."""
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    return spark


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """SQL settings (dots as ``__``) within the block; a stream keeps those that it is started with."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def work_root(spark: SparkSession) -> str:
    """Shared folder for written tables and checkpoints.

    Read from ``spark.checkpoint.dir``; when unset (tests), create a fresh
    temporary folder and register it so later calls agree.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = jdir.get() if jdir.isDefined() else None
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(d)
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def work_path(spark: SparkSession, *parts: str) -> str:
    sub = spark.conf.get("tidemark.work.subdir", "") or ""
    base = [work_root(spark)] + ([sub.strip("/")] if sub else [])
    return "/".join([*base, *[p.strip("/") for p in parts]])


def use_subdir(spark: SparkSession, name: str) -> None:
    """Keep this session's derived tables in a sub-folder of the work root
    (a bench run measures a cold build instead of reusing earlier output)."""
    spark.conf.set("tidemark.work.subdir", name)


# Version of the derived-data layout (landed files, bronze). Bump it whenever
# their format changes so files written by older code are never reused.
LAYOUT = "l19"


def dataset_tag(spark: SparkSession, sf_dir: str) -> str:
    """Short name for an input folder as it is now, used to key derived tables: replaced
    tables get another name, so results never come from tables built from earlier data.
    One summary per table (length, files, time of change), whatever its number of files."""
    base = os.path.basename(sf_dir.rstrip("/")) or "data"
    fs, p = _fs(spark, sf_dir)
    seen = [sf_dir]
    for s in fs.listStatus(p) if fs.exists(p) else []:
        total = fs.getContentSummary(s.getPath())
        seen.append(f"{s.getPath().getName()} {total.getLength()} {total.getFileCount()} {s.getModificationTime()}")
    return f"{base}-{hashlib.sha1(chr(10).join([seen[0], *sorted(seen[1:])]).encode()).hexdigest()[:12]}-{LAYOUT}"


def generation(spark: SparkSession, sf_dir: str) -> int:
    """Current generation of the pipeline's refreshable tables (STR-10)."""
    marker = work_path(spark, "tables", dataset_tag(spark, sf_dir), "_generations")
    gens = [int(d[1:]) for d in list_dirs(spark, marker) if d.startswith("g")]
    return max(gens, default=0)


def table_root(spark: SparkSession, sf_dir: str, variant: str = "main") -> str:
    """Folder of the refreshable tables of one pipeline variant. Reset-protected
    tables (bronze) live outside it and survive a full refresh."""
    return work_path(spark, "tables", dataset_tag(spark, sf_dir), f"g{generation(spark, sf_dir)}", variant)


def start_generation(spark: SparkSession, sf_dir: str) -> int:
    """Begin a new generation: later builds of refreshable tables start from
    scratch in new folders (earlier ones are left in place, nothing is deleted)."""
    g = generation(spark, sf_dir) + 1
    touch(spark, work_path(spark, "tables", dataset_tag(spark, sf_dir), "_generations", f"g{g}", "_SET"))
    return g


def fresh_path(spark: SparkSession, *parts: str) -> str:
    """A new, unused folder below the work root (one per run)."""
    base = work_path(spark, *parts)
    n = 0
    while path_exists(spark, f"{base}-{n}"):
        n += 1
    return f"{base}-{n}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def local_path(spark: SparkSession, path: str) -> str | None:
    """``path`` as open() takes it, if it lies in the local file system, where all machines share the work folder."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (metadata only, works on any FS)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match ``pattern`` (metadata only)."""
    fs, p = _fs(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or [])


def content_state(spark: SparkSession, path: str) -> str:
    """Number and bytes of the files below ``path``: another state when files are added."""
    fs, p = _fs(spark, path)
    total = fs.getContentSummary(p)
    return f"{total.getFileCount()}-{total.getLength()}"


def touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def move_dir(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder of ours; ``to`` must not exist."""
    fs, p = _fs(spark, path)
    _, dest = _fs(spark, to)
    fs.mkdirs(dest.getParent())
    if not fs.rename(p, dest):
        raise OSError(f"{path} was not moved to {to}")


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of a table of ours."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)
