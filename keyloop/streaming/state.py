"""Keyed tables kept current by Structured Streaming in Spark's own state store (ST2 / S7, ST5).

A table is a streaming aggregate in update mode over the RocksDB state store, and its folder is
the checkpoint of that query: a micro-batch writes only the keys it touches (change logs, with
snapshots now and then), commits atomically and exactly once, and a restarted query goes on
where the last commit ended.  Reading is a batch scan of the committed state (the
``statestore`` source), also of an earlier batch that the store still holds; any number of
readers, none of which the query has to know.  There are no files beside Spark's own.

Order safety: rows carry their version and the aggregate keeps the greatest image per key, so
late, repeated or reordered changes can neither overwrite a newer row nor bring a deleted key
back: deletes stay in the state as tombstones.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloop.operators.history import CT, DELETE, META, VER, not_preimage
from keyloop.operators.keyed import _all_not_null

#: The state store of the tables; a query takes these settings into its checkpoint.
STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def suggest_partitions(size_bytes: int | None, target_bytes: int = 128 << 20, least: int = 4,
                       most: int = 1 << 16) -> int:
    """State partitions for about ``target_bytes`` each (fixed once a table's query has run)."""
    return int(min(most, max(least, -(-(size_bytes or 0) // target_bytes))))


@contextmanager
def _settings(spark: SparkSession, settings: dict):
    """Session settings for as long as a query is started; it keeps its own copy of them."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class StateTable:
    """What a streaming aggregate by ``pk`` holds; ``values`` name its aggregates in order."""

    def __init__(self, spark: SparkSession, root: str, pk: Sequence[str], values: Sequence[str],
                 partitions: int = 8):
        self.spark, self.root = spark, root.rstrip("/")
        self.pk, self.values, self.partitions = list(pk), list(values), partitions

    def aggregate(self, stream: DataFrame) -> DataFrame:
        raise NotImplementedError

    def read(self, batch_id: int | None = None) -> DataFrame | None:
        """The committed state: the keys and the values; after ``batch_id``, or the last batch.
        None while no batch is committed."""
        source = self.spark.read.format("statestore")
        if batch_id is not None:
            source = source.option("batchId", batch_id)
        try:
            state = source.load(self.root)
        except (AnalysisException, PySparkException) as e:
            if batch_id is None and not self._committed():
                return None
            raise e
        # the store names fields after functions and expressions: name them by place
        for part, names in (("key", self.pk), ("value", self.values)):
            fields = zip(names, state.schema[part].dataType.fields, strict=True)
            named = ", ".join(f"`{n}`: {f.dataType.simpleString()}" for n, f in fields)
            state = state.withColumn(part, F.col(part).cast(f"struct<{named}>"))
        return state.select("key.*", "value.*")

    def _committed(self) -> bool:
        """Whether the query's log names a committed batch."""
        try:
            return not self.spark.read.text(f"{self.root}/commits").isEmpty()
        except AnalysisException:
            return False

    def current(self, schema: str | None = None, batch_id: int | None = None) -> DataFrame | None:
        """The table; while it is empty, an empty one of ``schema`` (DDL), or None without one."""
        df = self.read(batch_id=batch_id)
        if df is None:
            return None if schema is None else self.spark.createDataFrame([], schema)
        return df

    def start(self, stream: DataFrame, publish=None, available_now: bool = True,
              processing_time: str | None = None):
        """Keep the table current from a stream.  ``publish(rows, batch_id)``, if given, gets what each
        micro-batch changed: the touched keys with their new values."""
        writer = self.aggregate(stream).writeStream.outputMode("update").option("checkpointLocation", self.root)
        if publish:
            writer = writer.foreachBatch(lambda df, batch_id: publish(df, int(batch_id)))
        else:
            writer = writer.format("noop")
        writer = (writer.trigger(availableNow=True) if available_now or not processing_time
                  else writer.trigger(processingTime=processing_time))
        with _settings(self.spark, STORE | {"spark.sql.shuffle.partitions": str(self.partitions)}):
            return writer.start()


class KeyedState(StateTable):
    """The latest row of each key of a change stream, by ``order``, then ``tie`` (descending), then
    the other columns, so that the choice never depends on arrival.  ``nulls_first``: a null order
    value wins.  Preimages and rows with a null key are left out."""

    def __init__(self, spark: SparkSession, root: str, pk: Sequence[str], order: Sequence[str] = (VER,),
                 tie: Sequence[str] = (), nulls_first: bool = False, partitions: int = 8):
        super().__init__(spark, root, pk, ["row"], partitions)
        self.order, self.tie, self.nulls_first = list(order), list(tie), nulls_first

    def aggregate(self, stream: DataFrame) -> DataFrame:
        if CT in stream.columns:
            stream = not_preimage(stream)
        own = [c for c in stream.columns if c not in {*self.pk, *self.order, *self.tie}]
        if CT in own:      # of two images of one version a delete comes last
            own = [CT, *[c for c in own if c != CT]]
        rank = [x for c in self.order for x in ([F.col(c).isNull().alias(f"__null_{c}")] if self.nulls_first else [])
                + [F.col(c)]]
        return (stream.filter(_all_not_null(self.pk)).groupBy(*self.pk)
                .agg(F.max(F.struct(*rank, *self.tie, *own)).alias("row")))

    def read(self, include_tombstones: bool = False, batch_id: int | None = None) -> DataFrame | None:
        """The latest rows with their change metadata."""
        state = super().read(batch_id)
        if state is None:
            return None
        df = state.select(*self.pk, "row.*")
        df = df.drop(*[c for c in df.columns if c.startswith("__null_")])
        if not include_tombstones and CT in df.columns:
            df = df.filter(~F.col(CT).eqNullSafe(DELETE))
        return df

    def current(self, schema: str | None = None, batch_id: int | None = None) -> DataFrame | None:
        """The net table: live rows, change metadata dropped."""
        df = super().current(schema, batch_id)
        return None if df is None else df.drop(*[c for c in META if c in df.columns])


class AdditiveState(StateTable):
    """Sums per key: each batch adds to them exactly once, in any order; a negative value takes away."""

    def __init__(self, spark: SparkSession, root: str, pk: Sequence[str], values: Sequence[str],
                 partitions: int = 8):
        super().__init__(spark, root, pk, values, partitions)

    def aggregate(self, stream: DataFrame) -> DataFrame:
        return stream.groupBy(*self.pk).agg(*[F.sum(v).alias(v) for v in self.values])


def continuous_sync(changes_stream: DataFrame, state: StateTable, publish=None,
                    available_now: bool = True, processing_time: str | None = None):
    """S7 / ST2: keep ``state`` up to date from a change stream.

    ``available_now`` processes what is there and stops (tests, scheduled runs); otherwise
    ``processing_time`` (e.g. '15 seconds') runs continuously.
    """
    return state.start(changes_stream, publish, available_now, processing_time)
