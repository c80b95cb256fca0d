"""Replicas at scale: reconciled by checksums (S10), refreshed bucket by bucket (S6), and read as
of a version from the nearest snapshot and the log after it (H3 / S12).

Versions and pointers are numbers that go up, never clock times; files are complete before the
pointer that names them is written, so a reader sees the state before or after, never between.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloop.operators.history import META, VER, apply_changes, as_of
from keyloop.plans.sync import reconcile

# ------------------------------------------------------------------ S10 by checksums
#: Children of a node of the checksum tree, and its levels: at most FANOUT ** LEVELS sums a table reach the driver.
FANOUT, LEVELS = 256, 2
_SUMMARY = "table_name string, source_rows long, replica_rows long, missing_in_replica long, extra_in_replica long, changed_keys long"


def _node(pk: Sequence[str], level: int) -> F.Column:
    """The node of a key at a level of the tree; -1 for a null key, which matches nothing."""
    null = F.lit(False)
    for k in pk:
        null = null | F.col(k).isNull()
    return F.when(null, F.lit(-1)).otherwise(F.pmod(F.xxhash64(*pk), F.lit(FANOUT ** level))).cast("long")


def _only(df: DataFrame, pk: Sequence[str], nodes: DataFrame, level: int) -> DataFrame:
    """The rows below the given nodes of a level (a bounded list, broadcast)."""
    return df.withColumn("__node", _node(pk, level)).join(F.broadcast(nodes), "__node", "left_semi").drop("__node")


def differing_nodes(pairs: Mapping[str, tuple[DataFrame, DataFrame, Sequence[str]]], level: int) -> DataFrame:
    """(table_name, node, n_source, n_replica, differs) of each node that has rows on a side.

    A row counts by two hashes of its key and common columns, added and combined by exclusive or: sums do not
    depend on the order of rows, and one aggregate with partial sums covers both sides of all tables.
    """
    rows = None
    for name, (source, replica, pk) in pairs.items():
        common = [c for c in source.columns if c in replica.columns]
        for side, df in ((0, source), (1, replica)):
            part = df.select(F.lit(name).alias("table_name"), _node(pk, level).alias("node"), F.lit(side).alias("side"),
                             F.xxhash64(*common).alias("h"), F.xxhash64(F.lit(1), *common).alias("g"))
            rows = part if rows is None else rows.unionByName(part)
    of = lambda side, x: F.when(F.col("side") == side, x)
    sums = rows.groupBy("table_name", "node").agg(
        F.count(of(0, 1)).alias("n_source"), F.count(of(1, 1)).alias("n_replica"),
        *[f(of(s, x)).alias(f"{n}{s}") for s in (0, 1) for n, f, x in (
            ("sum", F.sum, F.col("h").cast("decimal(38,0)")), ("xor", F.bit_xor, F.col("g")))])
    same = (F.col("node") >= 0) & (F.col("n_source") == F.col("n_replica"))
    for n in ("sum", "xor"):
        same = same & F.col(f"{n}0").eqNullSafe(F.col(f"{n}1"))
    return sums.select("table_name", "node", "n_source", "n_replica", (~same).alias("differs"))


def reconcile_by_sums(pairs: Mapping[str, tuple[DataFrame, DataFrame, Sequence[str]]]) -> DataFrame:
    """The summary of ``sync.reconcile`` for each table, by a tree of checksums: only rows below
    nodes whose sums differ are compared key by key; equal replicas are not joined at all."""
    spark = next(iter(pairs.values()))[0].sparkSession
    counts, below = {}, dict(pairs)
    nodes: dict[str, list[int]] = {}
    for level in range(1, LEVELS + 1):
        if not below:
            break
        found = differing_nodes(below, level)
        if level == 1:
            total = found.groupBy("table_name").agg(
                F.sum("n_source"), F.sum("n_replica"), F.collect_list(F.when(F.col("differs"), F.col("node")))).collect()
        else:
            total = found.filter("differs").groupBy("table_name").agg(
                F.lit(0), F.lit(0), F.collect_list("node")).collect()
        for name, n_source, n_replica, differing in total:
            if level == 1:
                counts[name] = (n_source, n_replica)
            nodes[name] = differing
        below = {n: (_only(s, pk, _listed(spark, nodes[n]), level), _only(r, pk, _listed(spark, nodes[n]), level), pk)
                 for n, (s, r, pk) in below.items() if nodes.get(n)}
    out = None
    for name in pairs:
        n_source, n_replica = counts.get(name, (0, 0))
        if name in below:
            r = reconcile(*below[name]).select(
                F.lit(name).alias("table_name"), F.lit(n_source).cast("long").alias("source_rows"),
                F.lit(n_replica).cast("long").alias("replica_rows"), "missing_in_replica", "extra_in_replica", "changed_keys")
        else:
            r = spark.createDataFrame([(name, n_source, n_replica, 0, 0, 0)], _SUMMARY)
        out = r if out is None else out.unionByName(r)
    return out


def _listed(spark: SparkSession, nodes: Sequence[int]) -> DataFrame:
    return spark.createDataFrame([(int(n),) for n in nodes], "__node long")


# ------------------------------------------------------------------ numbered pointers
def _next_number(spark: SparkSession, path: str) -> tuple[int, DataFrame | None]:
    """(number for the next entry, the entries so far) of a pointer folder."""
    try:
        rows = spark.read.parquet(path)
        last = rows.agg(F.max("number")).first()[0]
    except AnalysisException:
        return 0, None
    return (0 if last is None else int(last) + 1), rows


# ------------------------------------------------------------------ S6 by buckets
class BucketReplica:
    """A replica in buckets of its key; a refresh reads and writes the buckets that its changes hit,
    files of other buckets stay as they are.  One writer at a time, any number of readers."""

    def __init__(self, spark: SparkSession, root: str, pk: Sequence[str], buckets: int = 64):
        self.spark, self.root, self.pk, self.buckets = spark, root.rstrip("/"), list(pk), buckets

    def _bucket(self) -> F.Column:
        return F.pmod(F.xxhash64(*self.pk), F.lit(self.buckets)).cast("int")

    def _map(self) -> tuple[int, dict[int, tuple[int, bool]]]:
        """(next number, {bucket: (number of the refresh that wrote it, whether it has rows)}), one row a bucket."""
        number, rows = _next_number(self.spark, f"{self.root}/pointer")
        if rows is None:
            return 0, {}
        return number, {r.bucket: (r.written, r.filled) for r in rows.filter(F.col("number") == number - 1).collect()}

    def _put(self, df: DataFrame, number: int, touched: Sequence[int], before: dict) -> None:
        path = f"{self.root}/data/number={number}"
        (df.withColumn("__bucket", self._bucket()).repartition("__bucket")
           .write.mode("overwrite").partitionBy("__bucket").parquet(path))
        try:
            filled = {r[0] for r in self.spark.read.parquet(path).select("__bucket").distinct().collect()}
        except AnalysisException:      # no rows, no files
            filled = set()
        entries = {**before, **{b: (number, b in filled) for b in touched}}
        self.spark.createDataFrame([(number, b, n, f) for b, (n, f) in entries.items()],
                                   "number long, bucket int, written long, filled boolean").coalesce(1) \
            .write.mode("append").parquet(f"{self.root}/pointer")

    def write(self, df: DataFrame) -> None:
        """The whole replica anew."""
        self._put(df, self._map()[0], range(self.buckets), {})

    def _load(self, buckets: Mapping[int, tuple[int, bool]], schema) -> DataFrame:
        paths = [f"{self.root}/data/number={n}/__bucket={b}" for b, (n, filled) in buckets.items() if filled]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, schema) -> DataFrame:
        """The replica as of the last refresh."""
        return self._load(self._map()[1], schema)

    def refresh(self, changes: DataFrame, last_version: int, schema) -> list[int]:
        """Apply the changes above ``last_version``; returns the buckets that they hit."""
        number, now = self._map()
        newer = changes.filter(F.col(VER) > last_version)
        hit = sorted(r[0] for r in newer.select(self._bucket().alias("b")).distinct().collect())
        if hit:
            old = self._load({b: now[b] for b in hit if b in now}, schema)
            self._put(apply_changes(old, newer, self.pk, last_version), number, hit, now)
        return hit


# ------------------------------------------------------------------ H3 / S12 from snapshots
class SnapshotLog:
    """A change log in ranges of versions, with snapshots of the table at some versions.  An
    as-of read takes the nearest snapshot not above its version and the log in between; ranges of the log
    before the snapshot are not scanned.  One writer at a time."""

    def __init__(self, spark: SparkSession, root: str, pk: Sequence[str], width: int = 1 << 20):
        self.spark, self.root, self.pk, self.width = spark, root.rstrip("/"), list(pk), width

    def append(self, changes: DataFrame) -> None:
        """Add changes.  Snapshots at or above the least version added no longer hold and are struck out
        first; rows without a version belong to no state and are left out."""
        changes = changes.filter(F.col(VER).isNotNull())
        least = changes.agg(F.min(VER)).first()[0]
        if least is None:
            return
        self._mark([v for v in self.snapshots() if v >= least], False)
        (changes.withColumn("__part", F.floor(F.col(VER) / self.width).cast("long"))
         .write.mode("append").partitionBy("__part").parquet(f"{self.root}/log"))

    def _mark(self, versions: Sequence[int], live: bool, folder: str = "") -> None:
        if versions:
            number, _ = _next_number(self.spark, f"{self.root}/snapshots/index")
            self.spark.createDataFrame([(number, v, live, folder) for v in versions],
                                       "number long, version long, live boolean, folder string").coalesce(1) \
                .write.mode("append").parquet(f"{self.root}/snapshots/index")

    def snapshots(self) -> dict[int, str]:
        """{version: folder} of the snapshots that hold (one row a snapshot)."""
        _, rows = _next_number(self.spark, f"{self.root}/snapshots/index")
        if rows is None:
            return {}
        last = rows.groupBy("version").agg(F.max(F.struct("number", "live", "folder")).alias("x")).collect()
        return {r.version: r.x.folder for r in last if r.x.live}

    def as_of(self, version: int) -> DataFrame:
        """The table as it was at a version."""
        held = {v: f for v, f in self.snapshots().items() if v <= version}
        part = F.col("__part")
        log = self.spark.read.parquet(f"{self.root}/log").filter(part <= version // self.width)
        if not held:
            return as_of(log.drop("__part"), self.pk, version=version)
        at = max(held)
        log = log.filter((part >= (at + 1) // self.width) & (F.col(VER) > at) & (F.col(VER) <= version)).drop("__part")
        schema = [f for f in log.schema.fields if f.name not in META]
        snapshot = self.spark.read.schema(type(log.schema)(schema)).parquet(f"{self.root}/snapshots/{held[at]}")
        return apply_changes(snapshot, log, self.pk, at, snapshot_is_keyed=True)

    def record(self, version: int) -> None:
        """Write the snapshot at a version, itself from the nearest earlier one."""
        number, _ = _next_number(self.spark, f"{self.root}/snapshots/index")
        folder = f"number={number}-version={version}"
        self.as_of(version).write.mode("overwrite").parquet(f"{self.root}/snapshots/{folder}")
        self._mark([version], True, folder)
