"""Running streaming queries to completion.

The reference processes everything available and then stops
(``trigger(availableNow=True)`` + ``awaitTermination``); every streaming
operator here is run the same way, with its checkpoint under the shared work
folder so a restarted job resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


def drain(writer: DataStreamWriter, checkpoint: str, *, to_path: str | None = None,
          fmt: str = "parquet", timeout_s: float | None = None):
    """Start ``writer`` with availableNow, wait for it, raise its error if any."""
    w = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    q = w.start(to_path, format=fmt) if to_path else w.start()
    if q.awaitTermination(timeout_s) is False:
        q.stop()
        raise TimeoutError(f"stream not finished after {timeout_s} s; a rerun goes on from its checkpoint")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` persisted while the block reads it several times, and given back if the block fails too."""
    df = df.persist()
    try:
        yield df
    finally:
        df.unpersist()


def stream_static_join(stream: DataFrame, read_static: Callable[[], DataFrame],
                       join: Callable[[DataFrame, DataFrame], DataFrame], out: str,
                       checkpoint: str):
    """Stream-static join appended to ``out`` (JOI-3).

    The stream drives: each micro-batch re-reads the static side through
    ``read_static`` (a table replaced between runs is seen by the next batch,
    but a change to it alone produces nothing). Each batch writes its own
    folder, which a replayed batch replaces, so it adds nothing.
    """
    def batch(mb: DataFrame, batch_id: int) -> None:
        join(mb, read_static()).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return drain(stream.writeStream.foreachBatch(batch), checkpoint)
