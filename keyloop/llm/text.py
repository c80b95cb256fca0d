"""Text columns as flat numpy arrays: splitting, hashing and windows without a loop over words.

All functions work on slices of bounded size, so a task's memory follows ``SLICE_BYTES`` (or the
longest single text), never the partition.
"""

from __future__ import annotations

import ctypes
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that are split into words at once.
SLICE_BYTES = 4 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)


def ascii_lower_table() -> bytes:
    """Byte map: A-Z to a-z, all else unchanged (UTF-8 bytes of other letters included)."""
    return bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def raw_bytes(col: pa.Array) -> tuple[np.ndarray, memoryview]:
    """(offsets, bytes) of a string or binary array; a null is an empty text."""
    col = pc.fill_null(col.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = memoryview(col.buffers()[2] or b"")[offsets[0]:offsets[-1]] if len(col) else memoryview(b"")
    return offsets - (offsets[0] if len(col) else 0), data


def release() -> None:
    """Hand freed memory back to the system: a worker serves many tasks, and what one of them
    once needed would otherwise stay with it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices(batches, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each has at most ``most`` bytes in the column, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends, _ = raw_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
        del batch
        release()


def split_words(col: pa.Array, table: bytes | None = None) -> tuple[pa.Array, np.ndarray]:
    """All maximal runs of bytes other than 20, 09-0D (hex), after ``bytes.translate(table)``:
    (flat words, offsets), text ``i`` having the words ``offsets[i]:offsets[i + 1]``."""
    offsets, data = raw_bytes(col)
    raw = bytes(data).translate(table) if table else bytes(data)
    texts = pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(raw)])
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten()
    full = pc.greater(pc.binary_length(words), 0)
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    at = np.asarray(lists.offsets).astype(np.int64)
    return words.filter(full), kept[at - at[0]] if len(at) else np.zeros(1, np.int64)


def word_hashes(words: pa.Array, seed: int = 0) -> np.ndarray:
    """One 64-bit hash for each word (uint64); each distinct word is hashed once."""
    if not len(words):
        return np.zeros(0, np.uint64)
    coded = words.cast(pa.large_binary()).dictionary_encode()
    own = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in coded.dictionary.to_pylist()),
                      np.uint64, len(coded.dictionary))
    return own[coded.indices.to_numpy()]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on; the array is k-1 shorter than ``words``."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = words[:n].copy()
    for j in range(1, k):
        acc *= _ODD
        acc += words[j:j + n]
    return mix(acc)


def owners(offsets: np.ndarray) -> np.ndarray:
    """For each flat position the number of its text."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def inside(offsets: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of the first n flat positions start k words that lie in one text."""
    ends = np.repeat(offsets[1:], np.diff(offsets))[:n]
    return np.arange(n) + k <= ends


def covered(starts: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of n positions lie in one of the windows of k positions from ``starts`` on."""
    step = np.zeros(n + k + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, np.asarray(starts) + k, -1)
    return np.cumsum(step)[:n] > 0


class _Packed:
    """Pickled bytes that unpickle to the object itself, so a worker does not keep them beside it."""

    def __init__(self, value):
        self.blob = cloudpickle.dumps(value)

    def __reduce__(self):
        return pickle.loads, (self.blob,)


class Shared:
    """A broadcast of any object: its classes travel with it, so executors need no copy of the package.

    A worker holds the object once, for all tasks that use it; they must not change it."""

    def __init__(self, spark: SparkSession, value):
        self._sent = spark.sparkContext.broadcast(_Packed(value))

    @property
    def value(self):
        return self._sent.value

    def unpersist(self) -> None:
        self._sent.unpersist()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share (``spark.checkpoint.dir``).

    Where that is unset (tests), the context's checkpoint folder or, on a local master only, a
    fresh temporary folder is used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        from keyloop.session import scratch_root

        root = scratch_root(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: lineage ends here, and a lost
    executor costs no recomputation of what lies before."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """Like ``stored``, dealt and sorted by a key, so that later joins and aggregates by it do
    not move the rows again.  The table's name is dropped; its files stay in the shared folder."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    table = "t" + path.rpartition("-")[2]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(n, key).write.bucketBy(n, key).sortBy(key)
     .option("path", path).format("parquet").saveAsTable(table))
    back = spark.table(table)
    back.schema  # resolved while the name exists
    spark.sql(f"DROP TABLE {table}")
    return back


def without(df: DataFrame, *names: str) -> DataFrame:
    """The frame less the columns that the operator is about to add (names in any case)."""
    gone = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in gone])


def _aside(columns: list[str], names: tuple[str, ...]) -> dict[str, str]:
    taken = {n.lower() for n in names}
    return {c: f"__own_{i}" for i, c in enumerate(columns) if c.lower() in taken}


def beside(df: DataFrame, *names: str) -> DataFrame:
    """The frame with a copy of those of its columns that an operator adding ``names`` replaces."""
    copies = _aside(df.columns, names)
    return df.withColumns({own: F.col(f"`{c}`") for c, own in copies.items()}) if copies else df


def back(df: DataFrame, columns: list[str], *names: str) -> DataFrame:
    """The ``columns`` that went into ``beside``, under their own names."""
    copies = _aside(columns, names)
    return df.select(*[F.col(f"`{copies.get(c, c)}`").alias(c) for c in columns])


def ddl(df: DataFrame) -> str:
    """The frame's schema as DDL text, for mapInArrow."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
