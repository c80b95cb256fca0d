"""Change-history algebra over append-only change rows.

A history is any DataFrame with key column(s), payload columns and three metadata columns:
``_change_type`` ('insert', 'update_preimage', 'update_postimage', 'delete'),
``_commit_version`` (bigint, totally orders the changes of a key together with optional tie
columns) and ``_commit_timestamp``.  Histories with or without preimages are accepted: the state
operators ignore preimages; the audit trail uses a same-version preimage when there is one
and the key's previous image otherwise.

Scale notes
-----------
* ``current_state`` / ``as_of`` / ``apply_changes`` are one keyed ``row_number() = 1``: a
  partial WindowGroupLimit runs before the shuffle, so a key with a third of all rows is
  reduced map-side.  ``apply_changes`` is a union + that window, or, over a replica whose key
  is known to be unique, one left join that leaves the replica where it is.
* Rows with a null key take part in no keyed operator (a null key matches nothing).
* ``next_in_key`` / ``prev_in_key`` (validity intervals, audit trail) split every key into
  version buckets: the window runs per (key, bucket), and one edge row per bucket is carried to the
  neighbouring bucket before it.  The whole rows are shuffled once, and a hot key is spread over
  many tasks instead of being sorted in one.
* ``diff_snapshots`` is one full outer join on the (unique) primary key, comparing a row
  hash first and the columns (null-safe) to confirm equality.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyloop.operators.keyed import (DEFAULT_MAX_BROADCAST_BYTES, _all_not_null,
                                     broadcast_if_small, latest_per_key)

# The change types of a change feed.
INSERT = "insert"
PREIMAGE = "update_preimage"
POSTIMAGE = "update_postimage"
DELETE = "delete"

CT, VER, TS = "_change_type", "_commit_version", "_commit_timestamp"
META = (CT, VER, TS)

# Width of a version bucket for the two-level neighbour windows.
DEFAULT_BUCKET_WIDTH = 1 << 16


def _cols(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def payload_columns(history: DataFrame, pk: Sequence[str], extra: Sequence[str] = ()
                    ) -> list[str]:
    """The row-image columns of a history (neither key nor change metadata)."""
    skip = set(pk) | set(META) | set(extra)
    return [c for c in history.columns if c not in skip]


def not_preimage(history: DataFrame) -> DataFrame:
    """Drop update preimages (a null change type is kept)."""
    return history.filter(~F.col(CT).eqNullSafe(PREIMAGE))


# ------------------------------------------------------------------------ H2, H3, H7, S11
def latest_changes(history: DataFrame, pk: str | Sequence[str],
                   order: Sequence[str] = (VER,), tie: Sequence[str] = ()) -> DataFrame:
    """The latest non-preimage change per key, deletes included (tombstones)."""
    return latest_per_key(not_preimage(history), _cols(pk), list(order), list(tie),
                          nulls_first=False)


def current_state(history: DataFrame, pk: str | Sequence[str],
                  order: Sequence[str] = (VER,), tie: Sequence[str] = (),
                  keep_meta: bool = False) -> DataFrame:
    """H2: the net table: latest non-preimage change per key, keys whose latest is a delete
    are absent."""
    out = latest_changes(history, pk, order, tie).filter(~F.col(CT).eqNullSafe(DELETE))
    return out if keep_meta else out.drop(*[c for c in META if c in out.columns])


def as_of(history: DataFrame, pk: str | Sequence[str], version: int | None = None,
          timestamp=None, order: Sequence[str] = (VER,), tie: Sequence[str] = (),
          keep_meta: bool = False) -> DataFrame:
    """H3: the table as it was at a version (inclusive) or a commit timestamp (inclusive)."""
    if version is not None:
        history = history.filter(F.col(VER) <= F.lit(version))
    if timestamp is not None:
        history = history.filter(F.col(TS) <= F.lit(timestamp))
    return current_state(history, pk, order, tie, keep_meta)


def read_changes(history: DataFrame, from_version: int | None = None,
                 to_version: int | None = None) -> DataFrame:
    """The change rows of a version range (both ends inclusive, either optional)."""
    if from_version is not None:
        history = history.filter(F.col(VER) >= F.lit(from_version))
    if to_version is not None:
        history = history.filter(F.col(VER) <= F.lit(to_version))
    return history


def history_read(history: DataFrame, order: str = TS) -> DataFrame:
    """H7: all rows, newest first (Spark SQL order: nulls last)."""
    return history.orderBy(F.desc(order), F.desc(VER))


# ------------------------------------------------------------------------ S6 apply
def apply_changes(snapshot: DataFrame, changes: DataFrame, pk: str | Sequence[str],
                  since_version: int, keep_tombstones: bool = False,
                  snapshot_is_keyed: bool = False,
                  max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Bring a keyed snapshot taken at ``since_version`` up to date with the changes of
    higher versions: upsert the latest non-preimage change per key, remove deleted keys.

    Expressed as union + latest-per-key (the snapshot rows carry ``since_version``), so a
    replayed or out-of-order batch changes nothing: versions decide, not arrival.  Rows with a
    null key and stored preimages are left out, a key that the snapshot repeats comes out once.
    With ``keep_tombstones`` the deleted keys stay as 'delete' rows (state for later batches).

    ``snapshot_is_keyed``: the caller vouches that the snapshot's key is unique (a replica
    that ``snapshot_sync`` checked).  Then the snapshot is not shuffled for its own sake: one
    left join with the latest changes (broadcast behind a size check) decides each row, and the
    keys new to it are added.  The result is the same either way, whatever the sizes.
    """
    pk = _cols(pk)
    cols = [c for c in snapshot.columns if c not in META]
    ts_type = dict(changes.dtypes).get(TS, "timestamp")
    base = not_preimage(snapshot.select(
        *cols,
        (F.col(CT) if CT in snapshot.columns else F.lit(INSERT)).alias(CT),
        (F.col(VER) if VER in snapshot.columns else F.lit(since_version)).cast("bigint").alias(VER),
        (F.col(TS) if TS in snapshot.columns else F.lit(None)).cast(ts_type).alias(TS)))
    newer = changes.filter(F.col(VER) > F.lit(since_version)).select(
        *cols, F.col(CT), F.col(VER).cast("bigint").alias(VER), F.col(TS))
    if snapshot_is_keyed:
        base = base.filter(_all_not_null(pk))
        latest_new = latest_changes(newer, pk)
        new = latest_new.select(*[F.col(k).alias(f"__k_{k}") for k in pk],
                                F.struct(*latest_new.columns).alias("__new"))
        new = broadcast_if_small(new, max_broadcast_bytes)
        on = F.lit(True)
        for k in pk:
            on = on & (F.col(k) == F.col(f"__k_{k}"))
        # of two images of a key the one of the higher version counts, as in the merge
        wins = F.col("__new").isNotNull() & (F.col("__new")[VER] > F.coalesce(F.col(VER), F.lit(since_version)))
        decided = base.join(new, on, "left").select(*[
            F.when(wins, F.col("__new")[c]).otherwise(F.col(c)).alias(c) for c in base.columns])
        added = latest_new.join(base.select(*pk), pk, "left_anti").select(*base.columns)
        latest = decided.unionByName(added)
    else:
        latest = latest_changes(base.unionByName(newer), pk)
    if keep_tombstones:
        return latest
    return latest.filter(~F.col(CT).eqNullSafe(DELETE)).select(*cols)


# ------------------------------------------------------------------------ W3 neighbours
def _order_by(order: Sequence[str], tie: Sequence[str]) -> list[Column]:
    return [F.asc_nulls_first(c) for c in (*order, *tie)]


def _bucket_of(order: Sequence[str], width: int) -> Column:
    return F.floor(F.col(order[0]) / F.lit(width))


def _carried(edges: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """The edge rows of (key, bucket), each moved to the key's neighbouring bucket that has rows
    (``target``: the window function ``lag`` or ``lead``) and marked; the last one goes nowhere."""
    b = "__bucket"
    near = getattr(F, target)(F.struct(F.col(b).alias("b"))).over(
        Window.partitionBy(*keys).orderBy(F.asc_nulls_first(b)))
    return (edges.withColumn("__to", near).filter(F.col("__to").isNotNull())
            .withColumn(b, F.col("__to")["b"]).drop("__to").withColumn("__carried", F.lit(True)))


def _neighbour(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               values: Sequence[str], direction: str, prefix: str,
               bucket_width: int, tie: Sequence[str] = ()) -> DataFrame:
    """Add ``prefix + v`` = value of the next (or previous) row of the same key in ``order``,
    then ``tie`` (nulls first), and ``prefix + "has"`` = whether there is one.  Null keys are
    a key like any other; the result does not depend on ``bucket_width``.

    ``order[0]`` must be an integral version; rows are bucketed by ``order[0] // width``.  The whole
    rows are shuffled once: the row of each (key, bucket) that a neighbouring bucket sees, cut down
    before its shuffle, joins that bucket's rows as one more row of the window and leaves after it.
    """
    keys, order, values, tie = list(keys), list(order), list(values), list(tie)
    b = "__bucket"
    sort = _order_by(order, tie)
    fn, target = (F.lead, "lag") if direction == "next" else (F.lag, "lead")
    d = df.withColumn(b, _bucket_of(order, bucket_width))
    # the first or last row of a bucket in the same order as the rows (WindowGroupLimit)
    outer = sort if direction == "next" else [F.desc_nulls_last(c) for c in (*order, *tie)]
    edges = (d.select(*keys, b, *[c for c in dict.fromkeys([*order, *tie, *values]) if c not in keys])
             .withColumn("__rn", F.row_number().over(Window.partitionBy(*keys, b).orderBy(*outer)))
             .filter("__rn = 1").drop("__rn"))
    rows = d.withColumn("__carried", F.lit(False)).unionByName(
        _carried(edges, keys, target), allowMissingColumns=True)
    near = fn(F.struct(F.lit(True).alias("has"), *[F.col(v).alias(f"v_{v}") for v in values])).over(
        Window.partitionBy(*keys, b).orderBy(*sort))
    out = rows.withColumn("__near", near).filter(~F.col("__carried"))
    for v in values:
        out = out.withColumn(prefix + v, F.col("__near")[f"v_{v}"])
    return out.withColumn(prefix + "has", F.col("__near").isNotNull()).drop(b, "__near", "__carried")


def next_in_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                values: Sequence[str], prefix: str = "next_",
                bucket_width: int = DEFAULT_BUCKET_WIDTH, tie: Sequence[str] = ()) -> DataFrame:
    """``lead`` per key, skew-safe (see module notes)."""
    return _neighbour(df, keys, order, values, "next", prefix, bucket_width, tie)


def prev_in_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                values: Sequence[str], prefix: str = "prev_",
                bucket_width: int = DEFAULT_BUCKET_WIDTH, tie: Sequence[str] = ()) -> DataFrame:
    """``lag`` per key, skew-safe (see module notes)."""
    return _neighbour(df, keys, order, values, "prev", prefix, bucket_width, tie)


# ------------------------------------------------------------------------ H4, H5
def validity_intervals(history: DataFrame, pk: str | Sequence[str],
                       order: Sequence[str] = (VER,),
                       bucket_width: int = DEFAULT_BUCKET_WIDTH,
                       tie: Sequence[str] = ()) -> DataFrame:
    """H4 (SCD type 2): one row per row version with ``valid_from`` (its commit time),
    ``valid_to`` (the next change's commit time) and ``is_current`` (there is no next change;
    a next change without a commit time leaves ``valid_to`` null all the same).
    A delete closes the previous interval and opens none.  Rows with a null key are left out,
    as in ``current_state``; ``tie`` orders the changes of one version."""
    pk = _cols(pk)
    rows = not_preimage(history).filter(_all_not_null(pk))
    rows = next_in_key(rows, pk, list(order), [TS], "__next", bucket_width, tie)
    out = (rows.filter(~F.col(CT).eqNullSafe(DELETE))
               .withColumn("valid_from", F.col(TS))
               .withColumn("valid_to", F.col(f"__next{TS}"))
               .withColumn("is_current", ~F.col("__nexthas"))
               .drop(f"__next{TS}", "__nexthas"))
    return out


def audit_trail(history: DataFrame, pk: str | Sequence[str], payload: Sequence[str],
                order: Sequence[str] = (VER,),
                bucket_width: int = DEFAULT_BUCKET_WIDTH,
                tie: Sequence[str] = (), actor: str | None = None) -> DataFrame:
    """H5: who changed what and when: every non-preimage change with the row image before
    (``old_*``) and after (``new_*``: null for a delete), and its ``actor`` (a column of the
    history) where there is one.

    The before image is the preimage of the same key and version when the history has one
    (a change feed with preimages, also correct on a truncated range of versions); otherwise
    it is the key's previous non-preimage image (null for the first change or after a
    delete).  Rows with a null key are left out; ``tie`` orders the changes of one version
    (its preimage comes first).

    The previous image is found in the (key, version bucket) layout of ``prev_in_key``: the
    window runs per bucket, into which the last image of the key's bucket before is carried as one more
    row.  The whole rows are shuffled once.
    """
    pk, order, tie = _cols(pk), list(order), list(tie)
    b = "__bucket"
    is_pre = F.col(CT).eqNullSafe(PREIMAGE)
    img = F.struct(*[F.col(c) for c in payload], F.col(CT).alias(CT))
    d = history.filter(_all_not_null(pk)).withColumn(b, _bucket_of(order, bucket_width))
    # the last non-preimage row of every (key, bucket) in the same order, seen by the next one
    last = Window.partitionBy(*pk, b).orderBy(*[F.desc_nulls_last(c) for c in (*order, *tie)])
    needed = dict.fromkeys([*order, *tie, *payload, CT])
    edges = (not_preimage(d).select(*pk, b, *[c for c in needed if c not in pk])
             .withColumn("__rn", F.row_number().over(last)).filter("__rn = 1").drop("__rn"))
    d = d.withColumn("__carried", F.lit(False)).unionByName(
        _carried(edges, pk, "lead"), allowMissingColumns=True).withColumn("__pre", is_pre.cast("int"))
    first = [F.asc_nulls_first(c) for c in order] + [F.desc("__pre")] + _order_by((), tie)
    w = Window.partitionBy(*pk, b).orderBy(*first)
    rows = (d.withColumn("__lag_pre", F.lag("__pre").over(w))
             .withColumn("__lag_ver", F.lag(F.col(order[0])).over(w))
             .withColumn("__lag_img", F.lag(img).over(w))
             .withColumn("__last_np", F.last(F.when(~is_pre, img), ignorenulls=True)
                         .over(w.rowsBetween(Window.unboundedPreceding, -1)))
             .filter(~is_pre & ~F.col("__carried")))
    prev = F.col("__last_np")
    has_pre = (F.col("__lag_pre") == 1) & F.col("__lag_ver").eqNullSafe(F.col(order[0]))
    gone = prev.isNull() | prev[CT].eqNullSafe(DELETE)
    is_del = F.col(CT).eqNullSafe(DELETE)
    sel = [*[F.col(k) for k in pk], F.col(VER), F.col(TS), F.col(CT)]
    if actor is not None:
        sel.append(F.col(actor).alias("actor"))
    for c in payload:
        old = (F.when(has_pre, F.col("__lag_img")[c])
                .when(gone, F.lit(None)).otherwise(prev[c]))
        sel.append(old.alias(f"old_{c}"))
        sel.append(F.when(is_del, F.lit(None)).otherwise(F.col(c)).alias(f"new_{c}"))
    return rows.select(*sel)


def audit_histories(histories: Mapping[str, tuple[DataFrame, Sequence[str], Sequence[str], str | None]]
                    ) -> DataFrame:
    """H5 over several histories, name -> (history, key, payload, actor column or None): one
    row a change with table_name, the key, the image before and after as JSON, and who did it."""
    out = None
    for name, (history, pk, payload, actor) in histories.items():
        t = audit_trail(history, list(pk), list(payload), actor=actor)
        image = lambda side, t=t, payload=payload: F.when(
            F.coalesce(*[F.col(f"{side}_{c}").cast("string") for c in payload]).isNotNull(),
            F.to_json(F.struct(*[F.col(f"{side}_{c}").alias(c) for c in payload])))
        t = t.select(F.lit(name).alias("table_name"),
                     F.concat_ws("/", *[F.col(k).cast("string") for k in pk]).alias("row_key"),
                     (F.col("actor") if actor else F.lit(None).cast("string")).alias("actor"),
                     VER, TS, CT, image("old").alias("old_row"), image("new").alias("new_row"))
        out = t if out is None else out.unionByName(t)
    return out


def union_histories(histories: Mapping[str, DataFrame], table_col: str = "table_name",
                    with_json: bool = False) -> DataFrame:
    """One audit stream over several history tables of different schemas."""
    out = None
    for name, h in histories.items():
        h = h.withColumn(table_col, F.lit(name))
        if with_json:
            payload = [c for c in h.columns if c not in (*META, table_col)]
            h = h.withColumn("row_json", F.to_json(F.struct(*payload)))
        out = h if out is None else out.unionByName(h, allowMissingColumns=True)
    return out


# ------------------------------------------------------------------------ H6 diff
def diff_snapshots(old: DataFrame, new: DataFrame, pk: str | Sequence[str],
                   version: int, timestamp=None, compare: Sequence[str] | None = None
                   ) -> DataFrame:
    """H6: change rows that turn ``old`` into ``new``: insert / update_preimage +
    update_postimage / delete; unchanged rows give nothing.

    ``compare`` (default: all non-key columns) decides equality, null-safely; a row hash is
    checked first and only equal hashes are confirmed column by column.
    """
    pk = _cols(pk)
    cols = compare or [c for c in new.columns if c not in pk]
    allc = [c for c in new.columns if c not in pk]
    o = old.select(*pk, F.struct(*allc).alias("__o"), F.xxhash64(*cols).alias("__oh"))
    n = new.select(*pk, F.struct(*allc).alias("__n"), F.xxhash64(*cols).alias("__nh"))
    j = o.join(n, pk, "full_outer")
    same = F.lit(True)
    for c in cols:
        same = same & F.col("__o")[c].eqNullSafe(F.col("__n")[c])
    changed = F.when(F.col("__oh") != F.col("__nh"), F.lit(True)).otherwise(~same)
    img = lambda s, t: F.struct(F.lit(t).alias("t"), F.col(s).alias("img"))
    arr = (F.when(F.col("__o").isNull(), F.array(img("__n", INSERT)))
            .when(F.col("__n").isNull(), F.array(img("__o", DELETE)))
            .when(changed, F.array(img("__o", PREIMAGE), img("__n", POSTIMAGE))))
    x = j.select(*pk, F.explode(arr).alias("__c"))
    ts = _commit_ts(timestamp)
    return x.select(*pk, *[F.col("__c.img")[c].alias(c) for c in allc],
                    F.col("__c.t").alias(CT), F.lit(version).cast("bigint").alias(VER),
                    ts.alias(TS))


def change_counts(history: DataFrame, by: Sequence[str] = (CT,)) -> DataFrame:
    """Change events per group (e.g. per table and change type)."""
    return history.groupBy(*by).agg(F.count(F.lit(1)).alias("n_changes"))


def with_meta(df: DataFrame, change_type: str | Column, version: int | Column,
              timestamp=None) -> DataFrame:
    """Stamp change metadata onto rows (used by the writers)."""
    ct = F.lit(change_type) if isinstance(change_type, str) else change_type
    ver = F.lit(version).cast("bigint") if isinstance(version, int) else version
    return df.select(*df.columns, ct.alias(CT), ver.alias(VER), _commit_ts(timestamp).alias(TS))


def _commit_ts(timestamp=None) -> Column:
    """A commit timestamp as a wall-clock ``timestamp_ntz`` (the type of the tables'
    timestamps): the given value, or now in the session time zone."""
    if timestamp is None:
        return F.localtimestamp()
    return F.lit(timestamp).cast("timestamp_ntz")
