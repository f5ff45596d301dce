"""Stream-stream join with the newest row per key, in bounded state (JOI-2, STR-4).

A plain inner stream-stream join without a time bound keeps all rows of both sides for ever. What a
sink that keeps the newest joined row per key needs is less: per key the newest right row,
and the left rows that wait for a first one. ``newest_join`` keeps just that, and lets a
waiting row go ``wait`` of event time after its own.

The result is a stream of rows (kind, left, right):

* ``joined``  a left row with the newest right row known when it met one
* ``newer``   a right row that replaces the newest one; left is null. Earlier joined rows take its
              values: ``newest_view`` does so when they are read.

Left rows of one key may be many: they are dealt to ``salts`` groups, and right rows go to
each of them, so state holds ``salts`` right rows per key at most.

Spark calls a Python processor once a group and micro-batch, and each call, state access and output batch costs
more than many rows do. So keys share groups: ``BUCKETS`` of them, by hash. A group's state is two lists of chunks of
lines, to which a micro-batch appends what is new; rows travel as JSON, which Spark writes and reads.
"""

from __future__ import annotations

import base64
import decimal
import json
import math
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

JOINED, NEWER = "joined", "newer"
#: Groups that keys are dealt to, for each salt; a checkpoint keeps the number it was made with.
BUCKETS = 4096
#: Rows of an output batch, and lines of a chunk of state.
CHUNK = 5000
#: When a waiting row goes that never does.
NEVER = 2**63 - 1
# microseconds, in one zone: time stamps of rows order as their texts do
ROW_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timeZone": "UTC"}


def order_of(kind: T.DataType) -> Callable:
    """What orders the JSON values of a type as Spark does: nulls first, NaN last."""
    if isinstance(kind, T.StructType):
        parts = [(f.name, order_of(f.dataType)) for f in kind.fields]
        plain = lambda v: tuple(of(v.get(n)) for n, of in parts)
    elif isinstance(kind, T.ArrayType):
        item = order_of(kind.elementType)
        plain = lambda v: [item(x) for x in v]
    elif isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        plain = lambda v: (math.isnan(x := float(v)), 0.0 if math.isnan(x) else x)
    elif isinstance(kind, T.BinaryType):
        plain = base64.b64decode
    else:
        plain = lambda v: v
    return lambda v: (False,) if v is None else (True, plain(v))


def rank_of(row: str, sequence: str, seq_order: Callable, order: Callable) -> tuple:
    """A total order of rows: by ``sequence``, then by all values (null first)."""
    v = json.loads(row, parse_float=decimal.Decimal)
    return seq_order(v.get(sequence)), order(v)


class NewestRow(StatefulProcessor):
    """State per group: the newest right row of each key, and left rows that came before any of theirs."""

    def __init__(self, right: T.StructType, sequence: str, waits: bool):
        self.right, self.sequence, self.waits = right, sequence, waits

    def init(self, handle) -> None:
        self.handle = handle
        self.newest = handle.getListState("newest", "rows STRING")
        self.waiting = handle.getListState("waiting", "rows STRING")
        self.order, self.seq_order = order_of(self.right), order_of(self.right[self.sequence].dataType)

    @staticmethod
    def _lines(state) -> Iterator[list[str]]:
        for (chunk,) in state.get():
            for line in chunk.split("\n"):
                yield line.split("\t")

    @staticmethod
    def _chunks(lines: list[str]) -> list[tuple[str]]:
        return [("\n".join(lines[i:i + CHUNK]),) for i in range(0, len(lines), CHUNK)]

    def _rank(self, row: str) -> tuple:
        return rank_of(row, self.sequence, self.seq_order, self.order)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known, n = {}, 0
        for k, row in self._lines(self.newest):
            known[k], n = row, n + 1  # the last line of a key counts
        before, left, rank = known.copy(), {}, {}
        for f in rows:
            for k, due, one, two in zip(f["key"], f["due"], f["left"], f["right"], strict=True):
                if isinstance(one, str):
                    left.setdefault(k, []).append((due, one))
                    continue
                new = self._rank(two)
                if k in known and k not in rank:
                    rank[k] = self._rank(known[k])
                if k not in known or new > rank[k]:
                    known[k], rank[k] = two, new
        changed = {k: known[k] for k in rank if known[k] != before.get(k)}
        if changed:
            lines = [f"{k}\t{row}" for k, row in changed.items()]
            if n + len(lines) > 2 * len(known):
                self.newest.put(self._chunks([f"{k}\t{row}" for k, row in known.items()]))
            else:
                self.newest.appendList(self._chunks(lines))
        wait = [(due, k, x) for k, xs in left.items() if k not in known for due, x in xs]
        if wait:
            self.waiting.appendList(self._chunks([f"{due}\t{k}\t{x}" for due, k, x in wait]))
            self._wake(min(due for due, _, _ in wait))
        yield from self._output(key, known, changed, before, left)

    def _output(self, key, known, changed, before, left) -> Iterator[pd.DataFrame]:
        out = [(NEWER, None, row) for row in changed.values()] if key[-1] == 0 else []  # one of the salted groups tells
        for k, xs in left.items():
            if k in known:
                out += [(JOINED, x, known[k]) for _, x in xs]
        fresh = changed.keys() - before.keys()
        if fresh and self.waiting.exists():
            rest, found = [], False
            for due, k, x in self._lines(self.waiting):
                if k in fresh:
                    found = True
                    out.append((JOINED, x, known[k]))
                else:
                    rest.append(f"{due}\t{k}\t{x}")
            if found:
                self._keep(rest)
        for i in range(0, len(out), CHUNK):
            yield pd.DataFrame(out[i:i + CHUNK], columns=["kind", "left", "right"])

    def _keep(self, lines: list[str]) -> None:
        if lines:
            self.waiting.put(self._chunks(lines))
        else:
            self.waiting.clear()

    def _wake(self, due: int) -> None:
        if self.waits and due != NEVER:
            self.handle.registerTimer(int(due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Waiting rows whose time is over go; the next timer is that of the first one left."""
        now, mark = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        lines = list(self._lines(self.waiting))
        left = [x for x in lines if now < int(x[0]) and mark <= int(x[0])]
        if len(left) < len(lines):
            self._keep(["\t".join(x) for x in left])
        if left:
            self._wake(min(int(x[0]) for x in left))
        return iter(())

    def close(self) -> None:
        pass


def newest_join(left: DataFrame, right: DataFrame, keys: Sequence[str], sequence: str, *, time: str,
                delay: str = "0 seconds", wait_seconds: int | None = None, salts: int = 1) -> DataFrame:
    """Join the streams ``left`` and ``right`` on ``keys``; ``sequence`` orders right rows, ``time`` is
    the event time of left rows, ``delay`` the lateness that the watermark allows. Rows with a null key join nothing."""
    from functools import reduce

    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    ltype, rtype = T.StructType(left.schema.fields), T.StructType(right.schema.fields)
    none = F.lit(None).cast("string")

    def row(df):
        return F.to_json(F.struct(*df.columns), {**ROW_JSON, "ignoreNullFields": "false"})

    def side(df, event_time, salt, l, r):  # noqa: E741
        return df.filter(has_key).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], salt.alias("_salt"),
                                         event_time.alias("_time"), l.alias("left"), r.alias("right"))

    events = side(left, F.col(time), F.pmod(F.xxhash64(F.struct(*left.columns)), F.lit(salts)).cast("int"), row(left), none).unionByName(
        side(right, F.lit(None).cast("timestamp"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))), none, row(right)))
    # equal keys have one text: of both sides' common type, and without a zero of its own for negative numbers
    one = [F.col(f"_k{i}") + F.lit(0.0).cast(k) if k in ("float", "double") else F.col(f"_k{i}")
           for i, k in enumerate(dict(events.dtypes)[f"_k{j}"] for j in range(len(keys)))]
    due = F.lit(NEVER) if wait_seconds is None else F.coalesce(F.unix_millis(F.col("_time").cast("timestamp")) + wait_seconds * 1000, F.lit(NEVER))
    events = events.select(F.to_json(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(one)]), ROW_JSON).alias("key"), F.col("_salt").alias("salt"), "_time",
                           due.alias("due"), "left", "right")
    # columns of a frame: pandas renames those that begin with an underscore
    events = events.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int"))
    if wait_seconds is not None:
        events = events.withWatermark("_time", delay)
    out = events.groupBy("bucket", "salt").transformWithStateInPandas(
        NewestRow(rtype, sequence, wait_seconds is not None), "kind STRING, left STRING, right STRING",
        "Append", "None" if wait_seconds is None else "EventTime")
    strict = {**ROW_JSON, "mode": "FAILFAST"}
    return out.select("kind", F.from_json("left", ltype, strict).alias("left"), F.from_json("right", rtype, strict).alias("right"))


def newest_view(rows: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """Each joined left row with the newest right row of its key: (left, right)."""
    total = F.struct(F.col(f"right.{sequence}"), F.col("right"))
    newest = rows.filter(F.col("kind") == NEWER).groupBy(*[F.col(f"right.{k}").alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.max_by("right", total).alias("_newest"))
    on = [F.col(f"left.{k}") == F.col(f"_k{i}") for i, k in enumerate(keys)]
    return rows.filter(F.col("kind") == JOINED).select("left").join(newest, on).select("left", F.col("_newest").alias("right"))
