"""MERGE / CDC operators as DataFrame transforms (§2.9).

Open Spark has no MERGE or DELETE on Parquet tables, so each statement of
the reference is a function ``(target, source) -> MergeResult(table,
changes)``: ``table`` is the new table content and ``changes`` the change
feed rows (table columns + ``_change_type``) that the same commit produces.
Every operator is one join on the merge keys; when the batch's key set is
provably small, the target is first split by broadcast semi/anti joins so
only rows sharing a key with the batch take part and the target is never
shuffled. Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import BROADCAST_MAX_BYTES, broadcast_if_small, estimated_bytes
from .keyed import latest_per_key, ordered_neighbors

INSERT, PRE, POST, DELETE = "insert", "update_preimage", "update_postimage", "delete"


class MergeResult(NamedTuple):
    table: DataFrame
    changes: DataFrame
    # The join both outputs derive from; a commit persists it across its two
    # writes so the join runs once.
    shared: DataFrame | None = None


def _expr(e) -> Column | None:
    if e is None:
        return None
    return F.expr(e) if isinstance(e, str) else e


def _side(prefix: str, cols: Sequence[str], change: str | None = None) -> Column:
    fields = [F.col(prefix + c).alias(c) for c in cols]
    if change is not None:
        fields.append(F.lit(change).alias("_change_type"))
    return F.struct(*fields)


def _emit(rows: DataFrame, cases: list[tuple[Column, Column]]) -> DataFrame:
    """Turn (condition, struct) pairs into change rows in one pass."""
    arr = F.filter(F.array(*[F.when(c, s) for c, s in cases]), lambda x: x.isNotNull())
    return rows.select(F.inline(arr))


def _prefixed(df: DataFrame, prefix: str, flag: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns], F.lit(True).alias(flag))


def _on(keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        c = F.col("t__" + k) == F.col("s__" + k)
        cond = c if cond is None else cond & c
    return cond


def _batch_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The batch's distinct keys, broadcast, when provably small; else None."""
    ks = source.select(*keys).dropDuplicates()
    try:
        return F.broadcast(ks) if estimated_bytes(ks) <= BROADCAST_MAX_BYTES else None
    except Exception:
        return None


def split_target(target: DataFrame, source: DataFrame, keys: Sequence[str]):
    """(rows the batch can touch, rows it cannot) by broadcast semi / anti joins
    on the batch keys, so the large target is scanned but never shuffled.
    Returns (target, None) when the batch key set is too large to broadcast."""
    ks = _batch_keys(source, keys)
    if ks is None:
        return target, None
    return target.join(ks, list(keys), "left_semi"), target.join(ks, list(keys), "left_anti")


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> MergeResult:
    """``MERGE … WHEN NOT MATCHED THEN INSERT *`` (CDC-1).

    Only the rows to append are computed (a left-anti join on the keys); the
    existing table is not rewritten. NULL keys never match, so such rows are
    inserted every time, and duplicates inside the source all insert.
    """
    existing, _ = split_target(target.select(*keys), source, keys)
    new = source.select(*target.columns).join(
        existing, list(keys), "left_anti").select(*target.columns)
    return MergeResult(target.unionByName(new),
                       new.withColumn("_change_type", F.lit(INSERT)))


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], sequence: str, *,
           delete_when=None, rank_updates: bool = True) -> MergeResult:
    """Newest-wins upsert (CDC-2/3/4).

    ``MERGE INTO t USING latest(s) ON keys
      [WHEN MATCHED AND <delete_when> THEN DELETE]
      WHEN MATCHED AND t.seq < s.seq THEN UPDATE SET *
      WHEN NOT MATCHED THEN INSERT *``

    ``*`` means the target's columns: extra source columns are ignored. The
    guard is strict, so equal sequence values keep the target row. A source
    row flagged for delete that matches nothing is not inserted.

    Only target rows whose key occurs in the batch take part in the join
    (``split_target``); the others are carried over unchanged.
    """
    cols = target.columns
    src = latest_per_key(updates, keys, sequence) if rank_updates else updates
    dcol = _expr(delete_when) if delete_when is not None else F.lit(False)
    # newest rows that tie: a MERGE must not update one target row from several
    src = src.withColumn("_ties", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    s = src.select(*[F.col(c).alias("s__" + c) for c in cols], "_ties",
                   F.coalesce(dcol, F.lit(False)).alias("_del"), F.lit(True).alias("_s"))
    touched, untouched = split_target(target, src, keys)
    t = _prefixed(touched, "t__", "_t")
    j = t.join(s, _on(keys), "full_outer")
    has_t, has_s = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    several = F.raise_error(F.lit("several source rows match one target row")).cast("boolean")
    has_t = F.when(has_t & has_s & (F.col("_ties") > 1), several).otherwise(has_t)
    newer = F.coalesce(F.col("t__" + sequence) < F.col("s__" + sequence), F.lit(False))
    is_del = has_t & has_s & F.col("_del")
    ins = has_s & ~has_t & ~F.col("_del")
    upd = has_t & has_s & ~F.col("_del") & newer
    keep = has_t & ~is_del & ~upd
    table = (j.select(F.when(ins | upd, _side("s__", cols))
                      .when(keep, _side("t__", cols)).alias("r"))
             .filter(F.col("r").isNotNull()).select("r.*"))
    if untouched is not None:
        table = untouched.unionByName(table)
    changes = _emit(j, [(ins, _side("s__", cols, INSERT)),
                        (upd, _side("t__", cols, PRE)),
                        (upd, _side("s__", cols, POST)),
                        (is_del, _side("t__", cols, DELETE))])
    return MergeResult(table, changes, j)


def ambiguous_matches(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                      sequence: str) -> DataFrame:
    """Keys where several newest source rows would match one target row (a
    MERGE error). Returns the offending keys; callers count it."""
    ranked = latest_per_key(updates, keys, sequence)
    dup = ranked.groupBy(*keys).count().filter("count > 1").select(*keys)
    return dup.join(target.select(*keys), list(keys), "left_semi")


def delete_by_keys(target: DataFrame, requests: DataFrame, keys: Sequence[str]) -> MergeResult:
    """``DELETE FROM t WHERE k IN (SELECT k FROM r)`` (CDC-10).

    Kept rows = anti join, deleted rows = semi join. Rows with a NULL key are
    kept, as ``IN`` never matches NULL.
    """
    ks = broadcast_if_small(requests.select(*keys).dropDuplicates())
    kept = target.join(ks, list(keys), "left_anti").select(*target.columns)
    gone = target.join(ks, list(keys), "left_semi").select(*target.columns)
    return MergeResult(kept, gone.withColumn("_change_type", F.lit(DELETE)))


def update_matched(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   assignments: dict[str, object]) -> MergeResult:
    """``MERGE … WHEN MATCHED THEN UPDATE SET c = v`` (CDC-11).

    The source is reduced to its distinct keys first, so several source rows
    for one key update the row once.
    """
    cols = target.columns
    ks = broadcast_if_small(source.select(*keys).dropDuplicates().withColumn("_m", F.lit(True)))
    j = target.join(ks, list(keys), "left")
    m = F.col("_m").isNotNull()
    new_vals = {c: (F.when(m, _expr(v) if isinstance(v, str) else v).otherwise(F.col(c)))
                for c, v in assignments.items()}
    after = F.struct(*[(new_vals.get(c, F.col(c))).alias(c) for c in cols])
    before = F.struct(*[F.col(c) for c in cols])
    table = j.select(after.alias("r")).select("r.*")
    changes = _emit(j, [(m, F.struct(*[before[c].alias(c) for c in cols], F.lit(PRE).alias("_change_type"))),
                        (m, F.struct(*[after[c].alias(c) for c in cols], F.lit(POST).alias("_change_type")))])
    return MergeResult(table, changes, j)


def scd2_merge(table: DataFrame, updates: DataFrame, key: str, sequence: str, *,
               track: Sequence[str] = ("price",), current: str = "current",
               start: str = "effective_date", end: str = "end_date", of_batch: bool = False) -> MergeResult:
    """Type 2 history by staged merge (CDC-5).

    For each update of a key: if the key's current row differs on ``track``
    (``<>``, so NULL compares as no change), the current row is closed with
    ``end = update.sequence`` and the update becomes the current row; an
    unseen key is inserted as current; an equal value is a no-op even when
    other columns differ. Updates are not checked against the current row's
    start time (an out-of-order update still becomes current). Several
    updates of one key in a batch are applied in ``sequence`` order, each one
    against the version before it. Update rows with a NULL tracked value are
    no-ops.

    ``of_batch`` says that ``table`` holds rows of the updates' keys only, so it is not split by them again.
    """
    attrs = [c for c in table.columns if c not in (current, start, end)]
    is_cur = F.coalesce(F.col(current), F.lit(False))
    hist = table.filter(~is_cur)
    cur = table.filter(is_cur)
    cur, cur_untouched = (cur, None) if of_batch else split_target(cur, updates, [key])
    if cur_untouched is not None:
        hist = hist.unionByName(cur_untouched)  # carried over unchanged
    not_null = None
    for c in track:
        nn = F.col(c).isNotNull()
        not_null = nn if not_null is None else not_null & nn
    chain = (cur.select(*attrs, F.col(start).alias("_seq"), F.lit(0).alias("_ord"))
             .unionByName(updates.filter(not_null)
                          .select(*attrs, F.col(sequence).alias("_seq"), F.lit(1).alias("_ord"))))
    chain = chain.withColumn("_h", F.struct(*[F.col(c) for c in track]))
    n1 = ordered_neighbors(chain, [key], ["_ord", "_seq"], ["_h"])
    version = (F.col("_ord") == 0) | ~F.col("_has_prev") | ~F.col("prev__h").eqNullSafe(F.col("_h"))
    v = n1.filter(version).select(*attrs, "_seq", "_ord")
    n2 = ordered_neighbors(v, [key], ["_ord", "_seq"], ["_seq"])
    closed = F.col("_has_next")
    out_cols = [*[F.col(c) for c in attrs],
                (~closed).alias(current),
                F.col("_seq").alias(start),
                F.when(closed, F.col("next__seq")).cast(table.schema[end].dataType).alias(end)]
    rows = n2.select(*out_cols, "_ord")
    new_table = hist.unionByName(rows.drop("_ord"))
    was = F.struct(*[F.col(c) for c in attrs], F.lit(True).alias(current),
                   F.col("_seq").alias(start), F.lit(None).cast(table.schema[end].dataType).alias(end))
    old_cur = F.col("_ord") == 0
    changes = _emit(n2.select("*", F.struct(*out_cols).alias("_now"), was.alias("_was")),
                    [(old_cur & closed, _with_type(F.col("_was"), attrs + [current, start, end], PRE)),
                     (old_cur & closed, _with_type(F.col("_now"), attrs + [current, start, end], POST)),
                     (~old_cur, _with_type(F.col("_now"), attrs + [current, start, end], INSERT))])
    return MergeResult(new_table, changes)


def _with_type(s: Column, cols: Sequence[str], change: str) -> Column:
    return F.struct(*[s[c].alias(c) for c in cols], F.lit(change).alias("_change_type"))


def _touched(stored: DataFrame, updates: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(stored rows of keys that ``updates`` holds, the others); a NULL key is a key like any other."""
    ks = broadcast_if_small(updates.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).dropDuplicates())
    match = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return stored.join(ks, match, "left_semi"), stored.join(ks, match, "left_anti")


def apply_changes_scd1(stored: DataFrame | None, updates: DataFrame, keys: Sequence[str],
                       sequence: str, *, except_columns: Sequence[str] = (),
                       delete_when=None) -> DataFrame:
    """AUTO CDC into an SCD type 1 table (CDC-7): the stored form, read with ``scd1_rows``.

    Keeps the newest row per key by ``sequence`` over the stored rows and the new ones.
    Hidden columns: ``__SEQ`` and ``__DELETED``. A deleted key stays as a row marked so,
    and older rows that arrive later lose against it. Rows of one key are in one total order
    (sequence, a delete last, then a hash of the row), so ties leave one row and the result depends neither
    on the order of arrival nor on how changes are cut into batches. ``except_columns`` are not stored.
    """
    dflag = _expr(delete_when) if delete_when is not None else F.lit(False)
    out = [c for c in updates.columns if c not in set(except_columns)]
    new = updates.select(*out, F.col(sequence).alias("__SEQ"), F.coalesce(dflag, F.lit(False)).alias("__DELETED"))
    total = F.struct("__SEQ", "__DELETED", F.xxhash64(*out))
    if stored is None:
        return latest_per_key(new, keys, total, ties=False)
    touched, untouched = _touched(stored, new, keys)
    return untouched.unionByName(latest_per_key(touched.unionByName(new), keys, total, ties=False))


def scd1_rows(stored: DataFrame) -> DataFrame:
    """What a reader sees of an SCD type 1 table."""
    return stored.filter(~F.col("__DELETED")).drop("__SEQ", "__DELETED")


def apply_changes_scd2(stored: DataFrame | None, updates: DataFrame, keys: Sequence[str],
                       sequence: str, *, except_columns: Sequence[str] = (),
                       delete_when=None, track: Sequence[str] | None = None) -> DataFrame:
    """AUTO CDC into an SCD type 2 table (CDC-8): the stored form, read with ``scd2_rows``.

    The stored form has a row for each distinct change (a point): those that open a version have
    ``__START_AT``/``__END_AT``; deletes and changes that left the tracked columns (default: all
    output columns) as they were have no ``__START_AT``. Hidden columns: ``__SEQ``,
    ``__DELETED``. All points of the keys that ``updates`` touches are ordered anew by sequence
    (equal ones by a hash of the row), so the result depends neither on the order of arrival nor
    on how changes are cut into batches, and rows delivered again add nothing.
    """
    dflag = _expr(delete_when) if delete_when is not None else F.lit(False)
    out = [c for c in updates.columns if c not in set(except_columns)]
    track = list(track or [c for c in out if c not in keys])
    new = updates.select(*out, F.col(sequence).alias("__SEQ"), F.coalesce(dflag, F.lit(False)).alias("__DELETED"))
    untouched = None
    if stored is not None:
        old, untouched = _touched(stored, new, keys)
        new = old.select(*new.columns).unionByName(new)
    points = (new.withColumn("_h", F.struct(*[F.col(c) for c in track]))
              .withColumn("_x", F.xxhash64(*out, "__DELETED")))
    n1 = ordered_neighbors(points, keys, ["__SEQ", "_x"], ["_h", "_x", "__SEQ", "__DELETED"])
    again = F.col("_has_prev") & F.col("prev___SEQ").eqNullSafe(F.col("__SEQ")) & (F.col("prev__x") == F.col("_x"))
    n1 = n1.filter(~again)
    opens = ~F.col("__DELETED") & (~F.col("_has_prev") | F.col("prev___DELETED")
                                   | ~F.col("prev__h").eqNullSafe(F.col("_h")))
    bounds = n1.filter(opens | F.col("__DELETED")).select(*out, "__SEQ", "__DELETED", "_x")
    n2 = ordered_neighbors(bounds, keys, ["__SEQ", "_x"], ["__SEQ"])
    version = ~F.col("__DELETED")
    marked = n2.select(*out, F.when(version, F.col("__SEQ")).alias("__START_AT"),
                       F.when(version & F.col("_has_next"), F.col("next___SEQ")).alias("__END_AT"), "__SEQ", "__DELETED")
    none = F.lit(None).cast(marked.schema["__START_AT"].dataType)
    same = n1.filter(~opens & ~F.col("__DELETED")).select(
        *out, none.alias("__START_AT"), none.alias("__END_AT"), "__SEQ", "__DELETED")
    res = marked.unionByName(same)
    return res if untouched is None else untouched.unionByName(res)


def scd2_rows(stored: DataFrame) -> DataFrame:
    """What a reader sees of an SCD type 2 table: its versions."""
    return stored.filter(F.col("__START_AT").isNotNull()).drop("__SEQ", "__DELETED")


def snapshot_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change rows between two states of the same rows (see ``changes.snapshot_diff``)."""
    from .changes import snapshot_diff
    return snapshot_diff(old, new, keys)
