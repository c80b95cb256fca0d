"""Keyed replicas of analytical tables: snapshot sync (S5), triggered sync (S6), table
counts (S9) and reconciliation (S10)."""

from __future__ import annotations

import uuid

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from keyloop.operators.history import apply_changes


class PrimaryKeyError(ValueError):
    """A snapshot's primary key is missing, null or not unique."""


def check_primary_key(df: DataFrame, pk: Sequence[str]) -> int:
    """Reject a null or duplicated key; returns the row count.  One distributed pass over the
    key columns only (column pruning): a partial-aggregated count per key, then one global
    row with the total, the largest group and the null keys."""
    if not pk:
        raise PrimaryKeyError("a primary key (list of columns) is required")
    null_key = F.lit(False)
    for k in pk:
        null_key = null_key | F.col(k).isNull()
    per_key = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("__n"))
    r = per_key.agg(F.sum("__n").alias("rows"), F.max("__n").alias("most"),
                    F.sum(F.when(null_key, 1).otherwise(0)).alias("nulls")).first()
    if (r["most"] or 0) > 1 or (r["nulls"] or 0) > 0:
        raise PrimaryKeyError(f"primary key {list(pk)} is null or not unique "
                              f"(largest group {r['most']}, null keys {r['nulls']})")
    return int(r["rows"] or 0)


def snapshot_sync(df: DataFrame, pk: Sequence[str], target: str | None,
                  fmt: str = "parquet", options: dict | None = None,
                  verify: bool = True, table: str | None = None,
                  buckets: int | None = None) -> DataFrame:
    """S5 (with S1): full keyed copy of ``df`` after a primary-key check; each sync writes a new
    version below ``target`` and then moves the pointer (``read_replica``), data and schema are
    replaced as one; with ``verify`` the replica's row count (parquet metadata, no data scan)
    must equal the source's.  ``fmt`` / ``options`` select any Spark writer (e.g. a JDBC
    table with ``target=None``).

    With ``table`` (a catalog table) and ``buckets``, the replica is bucketed and sorted by
    the primary key: later key joins between replicas with the same bucket count (diff,
    reconcile, apply) read co-partitioned data and need no shuffle.  Returns the replica."""
    n = check_primary_key(df, list(pk))
    spark = df.sparkSession
    if table is not None:
        w = df.write.mode("overwrite").format(fmt).options(**(options or {}))
        if buckets:
            w = w.bucketBy(buckets, *pk).sortBy(*pk)
        w.saveAsTable(table)
        replica = spark.table(table)
        if verify and replica.count() != n:
            raise RuntimeError(f"replica has {replica.count()} rows, source {n}")
        return replica
    r = spark.read.format(fmt).options(**(options or {}))
    if target is None:
        df.write.mode("overwrite").format(fmt).options(**(options or {})).save()
        replica = r.load()
    else:
        # a new version folder, then the pointer: readers see the old replica until the new
        # one is complete, and a replica can be synced from itself
        version = f"v{uuid.uuid4().hex}"
        df.write.format(fmt).options(**(options or {})).save(f"{target}/{version}")
        replica = r.load(f"{target}/{version}")
    if verify and replica.count() != n:
        raise RuntimeError(f"replica has {replica.count()} rows, source {n}")
    if target is not None:
        try:      # versions are numbered: a clock that goes back cannot bring an old replica back
            last = spark.read.parquet(f"{target}/_current").agg(F.max("number")).first()[0]
        except AnalysisException:
            last = None
        spark.range(1).select(F.lit(version).alias("version"), F.lit(fmt).alias("fmt"),
                              F.lit(0 if last is None else last + 1).cast("long").alias("number")).coalesce(1) \
            .write.mode("append").parquet(f"{target}/_current")
    return replica


def read_replica(spark: SparkSession, target: str, options: dict | None = None) -> DataFrame:
    """The replica that the pointer of ``snapshot_sync`` names: the newest complete version."""
    last = spark.read.parquet(f"{target}/_current").orderBy(F.desc("number")).first()
    return spark.read.format(last["fmt"]).options(**(options or {})).load(f"{target}/{last['version']}")


def triggered_sync(replica: DataFrame, changes: DataFrame, pk: Sequence[str],
                   last_version: int) -> DataFrame:
    """Refresh a replica taken at ``last_version`` with the changes after it: the latest
    non-preimage change per key is upserted, deletes remove the key.  The replica's key is
    unique (``snapshot_sync`` checks it)."""
    return apply_changes(replica, changes, list(pk), last_version, snapshot_is_keyed=True)


def table_counts(spark: SparkSession, tables: Mapping[str, str | DataFrame],
                 fmt: str = "parquet") -> DataFrame:
    """One row (table_name, n_rows, status) per table; a missing path is reported as
    status 'missing' with a null count instead of raising."""
    parts = []
    for name, src in tables.items():
        try:
            df = src if isinstance(src, DataFrame) else spark.read.format(fmt).load(src)
            parts.append(df.agg(F.count(F.lit(1)).alias("n_rows"))
                           .select(F.lit(name).alias("table_name"), "n_rows",
                                   F.lit("ok").alias("status")))
        except AnalysisException:
            parts.append(spark.range(1).select(F.lit(name).alias("table_name"),
                                               F.lit(None).cast("bigint").alias("n_rows"),
                                               F.lit("missing").alias("status")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reconcile(source: DataFrame, replica: DataFrame, pk: Sequence[str]) -> DataFrame:
    """One summary row: rows on both sides, keys missing in the replica, keys only in
    the replica, and keys on both sides whose rows differ (null-safe, column by column over
    the common columns).  A full outer join on the primary key (J6), then one global
    aggregate of partial counts."""
    pk = list(pk)
    common = [c for c in source.columns if c in replica.columns and c not in pk]
    s = source.select(*pk, F.lit(True).alias("__s"), *[F.col(c).alias(f"__s_{c}") for c in common])
    r = replica.select(*pk, F.lit(True).alias("__r"), *[F.col(c).alias(f"__r_{c}") for c in common])
    j = s.join(r, pk, "full_outer")
    same = F.lit(True)
    for c in common:
        same = same & F.col(f"__s_{c}").eqNullSafe(F.col(f"__r_{c}"))
    both = F.col("__s").isNotNull() & F.col("__r").isNotNull()

    def n(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")

    return j.agg(
        n(F.col("__s").isNotNull()).alias("source_rows"),
        n(F.col("__r").isNotNull()).alias("replica_rows"),
        n(F.col("__r").isNull()).alias("missing_in_replica"),
        n(F.col("__s").isNull()).alias("extra_in_replica"),
        n(both & ~same).alias("changed_keys"))


def reconcile_keys(source: DataFrame, replica: DataFrame, pk: Sequence[str]) -> DataFrame:
    """S10 detail / U1: the keys present on one side only, with ``side``."""
    from keyloop.operators.keyed import compare_keys
    return compare_keys(source, replica, list(pk)).filter(F.col("side") != "both")


def reconcile_tables(pairs: Mapping[str, tuple[DataFrame, DataFrame, Sequence[str]]]
                     ) -> DataFrame:
    """S10 for several tables: one summary row per table (``table_name`` first)."""
    out = None
    for name, (source, replica, pk) in pairs.items():
        r = reconcile(source, replica, pk)
        r = r.select(F.lit(name).alias("table_name"), *r.columns)
        out = r if out is None else out.unionByName(r)
    return out
