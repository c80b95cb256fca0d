"""Maintained results as streams of signed rows: what a micro-batch adds (+1) and takes away (-1).

The sum of all changes is the result; a consumer applies a batch's changes to its own copy, or
keeps them and sums on reading.  Batches are published under their id, so one that runs again
replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloop.streaming.state import STORE, _settings

CHANGE = "change"
#: Changed rows that a stateful task holds before it passes them on.
PUBLISHED = 10_000


def start_deltas(stream: DataFrame, checkpoint: str, publish: Callable[[DataFrame, int], None],
                 available_now: bool = True, processing_time: str = "15 seconds", partitions: int = 8):
    """Start a stateful query in update mode; ``publish(changes, batch_id)`` gets each micro-batch's."""
    writer = (stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
              .foreachBatch(lambda df, batch_id: publish(df, int(batch_id))))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    with _settings(stream.sparkSession, STORE | {"spark.sql.shuffle.partitions": str(partitions)}):
        return writer.start()


def held_entries():
    """A class that keeps many short texts in one entry of a map state, as Arrow's compressed bytes: a call
    to the store costs far more than a text, so neighbours share it.  It is local, so that it travels to
    executors by value; ``key_type`` is the Arrow type of the texts' names."""
    class Entries:
        FORMAT = "entry binary"

        def __init__(self, state, key_type: str):
            self.state, self.key_type = state, key_type

        def read(self, at: tuple) -> dict:
            import pyarrow as pa

            old = self.state.getValue(at)
            if not old:
                return {}
            held = pa.ipc.open_stream(bytes(old[0])).read_all()
            return dict(zip(*(c.to_pylist() for c in held.columns)))

        def write(self, at: tuple, texts: dict) -> None:
            import pyarrow as pa

            held = pa.RecordBatch.from_arrays(
                [pa.array(list(texts), self.key_type), pa.array(list(texts.values()), "string")], ["name", "text"])
            to = pa.BufferOutputStream()
            with pa.ipc.new_stream(to, held.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as stream:
                stream.write_batch(held)
            self.state.updateValue(at, (to.getvalue().to_pybytes(),))

    return Entries


def delta_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A ``publish`` that keeps each batch's changes as a folder of ``path``."""
    def publish(changes: DataFrame, batch_id: int) -> None:
        changes.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return publish


def summed(changes: DataFrame, *more: str) -> DataFrame:
    """What a sequence of changes adds up to: the rows left (``batch`` and ``more`` play no part)."""
    cols = [c for c in changes.columns if c not in {CHANGE, "batch", *more}]
    return changes.groupBy(*cols).agg(F.sum(CHANGE).alias("__n")).filter("__n > 0").drop("__n")
