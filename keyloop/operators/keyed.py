"""Keyed operators: latest row per key, dimension joins, anti joins, positional overwrite,
key comparison, first-k distinct keys and newest-k feeds.

Scale notes
-----------
* ``latest_per_key`` is ``row_number() = 1`` over ``partitionBy(keys)``; Spark plans it with a
  partial ``WindowGroupLimit`` *before* the shuffle, so a hot key is cut to one row per map
  task before it moves, and the final window sees at most one row per key per map task.
* ``join_dim`` broadcasts the dimension only when the optimizer's size estimate is known and
  below a bound; otherwise it leaves the choice to AQE, which re-plans from the real shuffle
  sizes (sort-merge join, skew-split when a key is hot).
* Nothing here collects data to the driver except plan statistics.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyloop.session import scratch_root

# Upper bound for an explicit broadcast hint.  Beyond it (or when the size is unknown) the
# join is left to AQE / sort-merge.
DEFAULT_MAX_BROADCAST_BYTES = 8 * 1024 * 1024


def _cols(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of ``df``: for a scan, file sizes times the share of the
    columns read.  Rows in memory may be several times larger, so bounds on it are kept low;
    joins multiply their sides.  None if there is no estimate."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - statistics are best effort
        return None


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its estimated size is known and at most ``max_bytes``."""
    size = estimated_bytes(df)
    if size is not None and 0 <= size <= max_bytes:
        return F.broadcast(df)
    return df


def join_dim(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "inner",
             max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Fact-to-dimension equi-join (inner drops orphans, left keeps them).

    The dimension is broadcast only behind a size check; a null fact key never matches.
    """
    return fact.join(broadcast_if_small(dim, max_broadcast_bytes), _cols(on), how)


def reduce_to_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str],
                   max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Keep only rows of ``df`` whose key occurs in ``keys`` when that key set is small
    by that estimate: a broadcast left-semi join runs map-side, before any shuffle of ``df``.  Beyond the
    bound ``df`` is returned unchanged (the later join does the matching)."""
    on = _cols(on)
    k = keys.select(*on)
    size = estimated_bytes(k)
    if size is not None and 0 <= size <= max_broadcast_bytes:
        return df.join(F.broadcast(k), on, "left_semi")
    return df


def latest_per_key(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str],
                   tie: str | Sequence[str] = (), nulls_first: bool = True,
                   drop_null_keys: bool = True) -> DataFrame:
    """One row per key, the greatest by ``order`` (descending) then ``tie`` (descending).

    ``nulls_first`` makes a null order value win, as a Postgres ``ORDER BY .. DESC`` does.
    Rows with a null key are dropped (``key = NULL`` never matches in the lateral it models).
    """
    keys, order, tie = _cols(keys), _cols(order), _cols(tie)
    sort = [F.desc_nulls_first(c) if nulls_first else F.desc_nulls_last(c) for c in order]
    sort += [F.desc_nulls_last(c) for c in tie]
    w = Window.partitionBy(*keys).orderBy(*sort)
    if drop_null_keys:
        df = df.filter(_all_not_null(keys))
    return (df.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1)
              .drop("__rn"))


def _all_not_null(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def without_match(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` with no row in ``right`` on the key (left anti join).

    Only key existence matters, so ``right`` is reduced to its distinct keys first: the
    map-side combine turns a hot key (say a ticket with a third of all actions) into one row
    per map task before the shuffle, and the anti join reuses that hash partitioning.
    """
    keys = _cols(on)
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def top_k(df: DataFrame, k: int, order: str | Sequence[str], tie: str | Sequence[str] = (),
          nulls_first: bool = True) -> DataFrame:
    """O3: newest k rows (descending ``order`` then ``tie``); plans as TakeOrderedAndProject,
    so every task keeps only its own k rows."""
    sort = [F.desc_nulls_first(c) if nulls_first else F.desc_nulls_last(c) for c in _cols(order)]
    sort += [F.desc_nulls_last(c) for c in _cols(tie)]
    return df.orderBy(*sort).limit(k)


def top_k_through_joins(fact: DataFrame, k: int, order: str | Sequence[str],
                        tie: str | Sequence[str], joins, oversample: int = 4,
                        nulls_first: bool = True, dims: Sequence[DataFrame] = (),
                        max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """O3 over ``joins(fact)``, where ``joins`` only adds columns or drops rows (inner joins to
    dimensions with unique keys: each fact row gives at most one output row).

    Exact without joining the whole fact table: the newest ``k * oversample`` fact rows are
    taken first (a distributed top-k) and joined; if at least ``k`` of them survive, no older
    row can enter the result, so their top k is the answer.  Otherwise (many orphans among the
    newest rows) the full join is used.  The candidates, at most ``k * oversample`` rows, are
    checkpointed, so the fact table is read once for the count and the answer.

    When every dimension in ``dims`` is provably small, the joins are broadcast (map-side, no
    shuffle) and one top-k over the joined rows is cheaper than the two-step plan.
    """
    if dims and all((b := estimated_bytes(d)) is not None and 0 <= b <= max_broadcast_bytes
                    for d in dims):
        return top_k(joins(fact), k, order, tie, nulls_first)
    scratch_root(fact.sparkSession)   # sets the context's checkpoint folder
    cand = joins(top_k(fact, k * oversample, order, tie, nulls_first)).checkpoint(eager=True)
    if cand.count() >= k:
        return top_k(cand, k, order, tie, nulls_first)
    return top_k(joins(fact), k, order, tie, nulls_first)


def first_k_keys(df: DataFrame, key: str, order: str, k: int) -> DataFrame:
    """A5: the first k distinct keys in order of first appearance (``order`` ascending).

    Returns (key, first_seen, pos) with pos = 1..k.  The group-by is partial-aggregated,
    the limit is a distributed top-k; only k rows are ever ranked in one partition.
    """
    firsts = df.groupBy(key).agg(F.min(order).alias("first_seen"))
    top = firsts.orderBy(F.col("first_seen"), F.col(key)).limit(k)
    return top.withColumn("pos", F.row_number().over(
        Window.orderBy(F.col("first_seen"), F.col(key))))


def overwrite_first_k(target: DataFrame, key: str, order: str | Sequence[str],
                      replacements: DataFrame, values: Mapping[str, Column],
                      k: int) -> DataFrame:
    """The i-th replacement row (``pos`` = i) overwrites the i-th target row in ``order``.

    ``replacements`` has at most ``k`` rows (a ``pos`` column 1..k); ``values`` maps target
    columns to expressions over the replacement columns.  Only k target keys are ranked, and
    the k-row overwrite table is broadcast (its size is bounded by k, not by the data).
    """
    order = _cols(order)
    first = (target.select(key, *[c for c in order if c != key])
             .orderBy(*order).limit(k)
             .withColumn("pos", F.row_number().over(Window.orderBy(*order)))
             .select(key, "pos"))
    # both sides hold at most k rows: broadcasting them is bounded by k, not by the data
    patch = first.join(F.broadcast(replacements), "pos").select(
        F.col(key), F.lit(True).alias("__hit"),
        *[expr.alias(f"__new_{c}") for c, expr in values.items()])
    joined = target.join(F.broadcast(patch), key, "left")
    out_cols = []
    for c in target.columns:
        if c in values:
            out_cols.append(F.when(F.col("__hit"), F.col(f"__new_{c}"))
                            .otherwise(F.col(c)).alias(c))
        else:
            out_cols.append(F.col(c))
    return joined.select(*out_cols)


def compare_keys(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Every key of either side with ``side`` in ('both', 'left_only', 'right_only').

    One shuffle: the tagged key sets are unioned and grouped (map-side combine removes
    duplicate keys before they move).
    """
    keys = _cols(keys)
    tagged = (left.select(*keys, F.lit(1).alias("__l"), F.lit(0).alias("__r"))
              .unionByName(right.select(*keys, F.lit(0).alias("__l"), F.lit(1).alias("__r"))))
    g = tagged.groupBy(*keys).agg(F.max("__l").alias("__l"), F.max("__r").alias("__r"))
    side = (F.when((F.col("__l") == 1) & (F.col("__r") == 1), "both")
            .when(F.col("__l") == 1, "left_only").otherwise("right_only"))
    return g.select(*keys, side.alias("side"))
