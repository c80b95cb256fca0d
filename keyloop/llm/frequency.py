"""Bloom filters over hashes, one bit layer per number of sightings (seen once, seen twice, ...).

Building shuffles 4 bytes a hash: the top bits choose one of ``BLOCKS`` blocks, the rest go to
the task that fills the block.  A block never exceeds ``BLOCK_BITS`` bits a layer, so the whole
filter, which is broadcast, has a fixed bound of ``BLOCKS * BLOCK_BITS / 8`` = 32 MB a layer at
any input size.  Beyond about a quarter of a billion hashes it fills up and lets more through; callers
confirm what it passes exactly, so that costs time, never results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloop.llm.text import Shared, ddl

BLOCK_SHIFT = 54  # 64 - log2(BLOCKS)
BLOCKS = 1024
BLOCK_BITS = 1 << 18
#: Bits for each hash while the block is below its bound.
BITS_PER_HASH = 4
PAYLOAD = "block int, payload binary"
#: Hashes that a task gathers before it hands them on.
GATHER = 1 << 21


def _positions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a = x & np.uint32(BLOCK_BITS - 1)
    b = (x * np.uint32(0x9E3779B1)) >> np.uint32(14)
    return a, np.where(a == b, a ^ np.uint32(1), b)


def payloads(hash_arrays):
    """Record batches of PAYLOAD from an iterator of uint64 arrays (one entry a sighting)."""
    kept, size = [], 0

    def flush():
        h = np.concatenate(kept)
        block = (h >> np.uint64(BLOCK_SHIFT)).astype(np.uint16)
        order = np.argsort(block, kind="stable")
        low = (h & np.uint64(0xFFFFFFFF)).astype("<u4")[order]
        cut = np.searchsorted(block[order], np.arange(BLOCKS + 1))
        full = np.flatnonzero(np.diff(cut))
        return pa.RecordBatch.from_arrays([
            pa.array(full.astype(np.int32)),
            pa.array([low[cut[b]:cut[b + 1]].tobytes() for b in full], pa.binary())],
            names=["block", "payload"])

    for h in hash_arrays:
        if len(h):
            kept.append(h)
            size += len(h)
        if size >= GATHER:
            yield flush()
            kept, size = [], 0
    if size:
        yield flush()


def _fill(levels: tuple[int, ...]):
    """Task code: payloads sorted by block to one row of bit layers a block."""
    top = max(levels)

    def added(counts, parts):
        both = np.concatenate(_positions(np.concatenate(parts)))
        both &= np.uint32(len(counts) - 1)
        return np.minimum(counts + np.bincount(both, minlength=len(counts)), top)

    def close(block, counts, parts, total):
        want = max(1 << 10, 1 << int(max(1, BITS_PER_HASH * total) - 1).bit_length())
        if counts is None:
            counts = np.zeros(min(want, BLOCK_BITS), np.int64)
        if parts:
            counts = added(counts, parts)
        out = [np.packbits(counts >= level, bitorder="little").tobytes() for level in levels]
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([out], pa.list_(pa.binary()))],
            names=["block", "layers"])

    def run(batches):
        now, counts, parts, waiting, total = None, None, [], 0, 0
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if block != now:
                    if now is not None:
                        yield close(now, counts, parts, total)
                    now, counts, parts, waiting, total = block, None, [], 0, 0
                parts.append(np.frombuffer(payload, "<u4"))
                waiting += len(parts[-1])
                total += len(parts[-1])
                if waiting >= BLOCK_BITS:
                    counts = added(np.zeros(BLOCK_BITS, np.int64) if counts is None else counts, parts)
                    parts, waiting = [], 0
        if now is not None:
            yield close(now, counts, parts, total)

    return run


def _hashes(batches):
    """Payloads of a column of longs."""
    yield from payloads(b.column(0).to_numpy().view(np.uint64) for b in batches)


def among(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` less most of those whose key is not in ``keys``, and none whose key is: what a join by
    the key would drop goes without moving."""
    own = F.xxhash64(key)
    filt = seen_filter(keys.select(own).mapInArrow(_hashes, PAYLOAD), (1,))

    def run(batches):
        for batch in batches:
            h = batch.column("__h").to_numpy().view(np.uint64)
            yield batch.drop_columns(["__h"]).filter(pa.array(filt.value.seen(h)))

    return rows.withColumn("__h", own).mapInArrow(run, ddl(rows))


class SeenFilter:
    """Membership of hashes in a layer: never wrong for a hash seen often enough."""

    def __init__(self, rows, layers: int):
        self.size = np.zeros(BLOCKS, np.int64)  # bits of each block
        blobs: list[dict[int, bytes]] = [{} for _ in range(layers)]
        for block, parts in rows:
            self.size[block] = 8 * len(parts[0])
            for k, part in enumerate(parts):
                blobs[k][block] = bytes(part)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.layers = [np.frombuffer(b"".join(x[b] for b in sorted(x)) or b"\0", np.uint8)
                       for x in blobs]

    def seen(self, h: np.ndarray, layer: int = 0) -> np.ndarray:
        block = (h >> np.uint64(BLOCK_SHIFT)).astype(np.int64)
        size, start, bits = self.size[block], self.start[block], self.layers[layer]
        ok = size > 0
        last = np.maximum(size - 1, 0)
        for p in _positions((h & np.uint64(0xFFFFFFFF)).astype(np.uint32)):
            at = start + (p.astype(np.int64) & last)
            at[~ok] = 0
            ok &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
        return ok


def seen_filter(payload_rows: DataFrame, levels: tuple[int, ...] = (2,)):
    """Broadcast SeenFilter whose layer ``i`` holds the hashes sighted ``levels[i]`` times or
    more.  Only the filter's bits reach the driver: BLOCKS * BLOCK_BITS / 8 bytes a layer at
    most."""
    spark: SparkSession = payload_rows.sparkSession
    n = min(BLOCKS, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows = (payload_rows.repartition(n, "block").sortWithinPartitions("block")
            .mapInArrow(_fill(levels), "block int, layers array<binary>").collect())
    return Shared(spark, SeenFilter(rows, len(levels)))

