"""Writes as DataFrame transforms: each returns the new current table and the change rows
it produced (the capture), so nothing is written until the caller sinks them.

H1 insert_rows, H1b update_where, H1c delete_where, P12 validate_rows, P16 assign_keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloop.functions.rows import short_name
from keyloop.operators.history import DELETE, INSERT, POSTIMAGE, PREIMAGE, with_meta

#: Bits of the filter of orphaned references: 4 MB, whatever the tables.
ORPHAN_BITS = 1 << 25


def assign_keys(new: DataFrame, key: str, start_after: int | Column = 0) -> DataFrame:
    """SERIAL-like ids for new rows: unique, above ``start_after``, gaps allowed.

    Distributed, no single-partition window: each row gets (partition id, index within the
    partition) from ``monotonically_increasing_id``; the per-partition row counts (one small
    row per partition, never per data row) give dense offsets.  The input is checkpointed
    first, so that a recomputed partition keeps its ids; without a checkpoint folder that is
    refused.
    """
    spark = new.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            raise RuntimeError("set spark.checkpoint.dir: ids must survive a recomputation")
        spark.sparkContext.setCheckpointDir(folder)
    mid = F.monotonically_increasing_id()
    tagged = new.withColumn("__mid", mid).withColumn("__pid", F.spark_partition_id())
    tagged = tagged.checkpoint(eager=True)
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"),
                                         F.min("__mid").alias("__base"))
    # offsets: running total of the (small) per-partition counts
    from pyspark.sql import Window
    counts = counts.withColumn(
        "__off", F.coalesce(F.sum("__n").over(Window.orderBy("__pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)))
    start = F.lit(start_after) if isinstance(start_after, int) else start_after
    out = tagged.join(F.broadcast(counts.select("__pid", "__off", "__base")), "__pid")
    return out.withColumn(key, (start + F.col("__off") + (F.col("__mid") - F.col("__base"))
                                + 1).cast("bigint")).drop("__mid", "__pid", "__off", "__base")


def insert_rows(current: DataFrame | None, new: DataFrame, rules: Mapping[str, Column],
                version: int, timestamp=None, defaults: Mapping[str, Column] | None = None,
                key: str | None = None, required: Sequence[str] = (),
                domains: Mapping[str, Sequence[str]] | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """H1: insert rows.

    Order of the steps: ``defaults`` fill columns *absent* from ``new`` (a DDL default: an
    explicit null stays null, P11); ``rules`` rewrite columns (P8-P10); rows failing
    ``required`` / ``domains`` are left out (P12, see ``validate_rows`` for the rejects);
    ``key`` gets fresh ids above the current maximum (P16).  Returns the new table and one
    'insert' change row per inserted row.
    """
    rows = new
    for c, expr in (defaults or {}).items():
        if c not in rows.columns:
            rows = rows.withColumn(c, expr)
    for c, expr in rules.items():
        rows = rows.withColumn(c, expr)
    if required or domains:
        rows, _ = validate_rows(rows, required, domains)
    if key is not None:
        top = 0
        if current is not None:
            # one scalar from a distributed aggregate
            top = current.agg(F.max(key)).first()[0] or 0
        rows = assign_keys(rows.drop(key) if key in rows.columns else rows, key,
                           start_after=int(top))
    changes = with_meta(rows, INSERT, version, timestamp)
    merged = rows if current is None else current.unionByName(rows, allowMissingColumns=True)
    return merged, changes


def update_where(current: DataFrame, predicate: Column, assignments: Mapping[str, Column],
                 version: int, timestamp=None) -> tuple[DataFrame, DataFrame]:
    """Conditional update.  Matched rows (predicate true; null is no match) get the
    assignments and emit a preimage and a postimage; no match is no error and no change."""
    hit = F.coalesce(predicate, F.lit(False))
    cols = current.columns
    new_image = [F.when(hit, assignments[c]).otherwise(F.col(c)).alias(c) if c in assignments
                 else F.col(c) for c in cols]
    # both images of a matched row out of one scan
    images = F.explode(F.array(
        F.struct(F.lit(PREIMAGE).alias("t"), F.struct(*cols).alias("row")),
        F.struct(F.lit(POSTIMAGE).alias("t"), F.struct(*new_image).alias("row"))))
    both = current.filter(hit).select(images.alias("__i")).select(
        *[F.col("__i.row")[c].alias(c) for c in cols], F.col("__i.t").alias("__t"))
    changes = with_meta(both, F.col("__t"), version, timestamp).drop("__t")
    return current.select(*new_image), changes


def delete_where(current: DataFrame, predicate: Column, version: int,
                 timestamp=None) -> tuple[DataFrame, DataFrame]:
    """Remove the rows where the predicate is true (null keeps the row)."""
    hit = F.coalesce(predicate, F.lit(False))
    return current.filter(~hit), with_meta(current.filter(hit), DELETE, version, timestamp)


def validate_rows(df: DataFrame, required: Sequence[str] = (),
                  domains: Mapping[str, Sequence[str]] | None = None,
                  references: Mapping[str, tuple[DataFrame, Sequence[str]]] | None = None
                  ) -> tuple[DataFrame, DataFrame]:
    """Split into (accepted, rejected); rejected rows carry ``reasons`` (a
    '; '-joined list).  A required column fails when null or empty; a domain check fails
    when the value is not null and not in the list; a reference, name -> (table, columns of both),
    fails when no value of it is null and the table has no such row ('<columns> not in <name>')."""
    references = dict(references or {})
    checks = []
    for c in required:
        checks.append(F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""),
                             F.lit(f"{c} is required")))
    for c, allowed in (domains or {}).items():
        checks.append(F.when(F.col(c).isNotNull() & ~F.col(c).isin(list(allowed)),
                             F.lit(f"{c} not in domain")))
    for i, (name, (table, columns)) in enumerate(references.items()):
        df = mark_orphans(df, table, columns, f"__orphan_{i}")
        checks.append(F.when(F.col(f"__orphan_{i}"), F.lit(f"{', '.join(columns)} not in {name}")))
    reasons = F.concat_ws("; ", *checks) if checks else F.lit("")
    tagged = df.withColumn("reasons", reasons).drop(*[f"__orphan_{i}" for i in range(len(references))])
    return (tagged.filter(F.col("reasons") == "").drop("reasons"),
            tagged.filter(F.col("reasons") != ""))


def mark_orphans(df: DataFrame, table: DataFrame, columns: Sequence[str], into: str,
                 bits: int = ORPHAN_BITS) -> DataFrame:
    """``df`` plus a boolean: the values of ``columns`` are all known, and ``table`` has no such row.

    The distinct values of the rows (a hot one is one per map task) are anti-joined with the table; the
    values left over, the orphans, set bits of a Bloom filter of fixed size (one hash, ``bits`` bits, at
    most ``bits / 8`` bytes broadcast).  Rows whose bit is not set are fine and stay where they are.  Only
    the others meet the orphans in a join, which decides exactly; a hot orphan is split by adaptive
    execution.  A filter that is full sends more rows there, with the same result.
    """
    columns = list(columns)
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    orphans = (df.filter(known).select(*columns).distinct()
               .join(table.select(*columns), columns, "left_anti"))
    place = F.pmod(F.xxhash64(*columns), F.lit(bits))
    # bitmaps of 32,768 bits, each bit a place
    maps = (orphans.select(F.bitmap_bucket_number(place).alias("__map"), F.bitmap_bit_position(place).alias("bit"))
            .groupBy("__map").agg(F.bitmap_construct_agg("bit").alias("__bits")))
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("__bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    flag = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (bit % 8).cast("int") + 1)
    is_set = F.coalesce(byte.bitwiseAND(flag) != 0, F.lit(False))
    seen = (df.withColumn("__map", F.when(known, F.bitmap_bucket_number(place)))
            .join(F.broadcast(maps), "__map", "left").withColumn("__suspect", is_set))
    fine = seen.filter(~F.col("__suspect")).select(*df.columns, F.lit(False).alias(into))
    suspects = seen.filter("__suspect").select(*df.columns).join(
        orphans.withColumn(into, F.lit(True)), columns, "left")
    return fine.unionByName(suspects.select(*df.columns, F.coalesce(into, F.lit(False)).alias(into)))


def stamp_actor(df: DataFrame, email: str | Column, column: str = "changed_by") -> DataFrame:
    """The rows with who wrote them: the part of the e-mail before ``@`` (all of a name
    without one).  ``email`` is a column expression, or a value (the signed-in user's)."""
    who = F.lit(email) if isinstance(email, str) else email
    return df.withColumn(column, short_name(who))
