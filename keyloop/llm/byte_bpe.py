"""Byte-level BPE: encoding by overlapping chunks, decoding by joining the tokens' raw bytes.

A text longer than a chunk is cut into chunks that overlap; these are rows of their own, dealt
over all tasks, pre-tokenised and merged there.  Stitching walks a text's chunks in order and
changes from one to the next at the first boundary of pre-tokens both have (the pattern looks
only ahead, so from a common boundary on both agree).  Boundaries within ``LOOK_AHEAD``
characters of a chunk's cut end are not trusted.  Where an overlap has no common boundary, as in
one endless word, the two chunks are joined and split again.  Shorter texts are one chunk and
never leave their task.

Definitions: no special tokens; a null text is empty and gives no ids.  Decoding gives bytes, as
ids cut at any place need not be UTF-8; an id outside the vocabulary is an error.
"""

from __future__ import annotations

import base64
import heapq
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloop.llm.text import Shared, ddl, slices, without

CHUNK = 1 << 15
#: Bytes of text whose pieces are merged side by side.
SLICE = 1 << 20
#: Places of a matrix of ids: each step of a merge holds several such arrays of 64-bit numbers.
CELLS = 1 << 18
OVERLAP = 1 << 9
#: Longest literal of the pattern and one more: a match may depend on so much behind it.
LOOK_AHEAD = 4
#: Distinct pieces beyond which a task forgets the ids it remembers.
REMEMBERED = 1 << 17
_NONE = 1 << 40  # rank of a pair that does not merge


def load_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary file: a line a token, base64 of its bytes and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Vocabulary:
    """Ranks of tokens and of pairs; what is broadcast has the size of the vocabulary file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)])
        pairs = sorted((ranks[t[:i]] << 32 | ranks[t[i:]], rank) for t, rank in ranks.items()
                       for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks)
        self.keys = np.array([k for k, _ in pairs] + [1 << 62])
        self.merged = np.array([r for _, r in pairs] + [_NONE])

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """What adjacent ids merge into; _NONE if into nothing."""
        key = a << 32 | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merged[at], _NONE)


def merge(pieces: list[bytes], vocabulary: Vocabulary) -> list[bytes]:
    """The int32 ids of each piece, as bytes: of adjacent pairs that of least rank is merged first, the
    leftmost of equals.  Pieces of about the same length are merged side by side."""
    out: list = [None] * len(pieces)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    for low, high in ((0, 6), (6, 10), (10, 16), (16, 32), (32, 64)):
        own = np.flatnonzero((sizes > low) & (sizes <= high))
        rows = CELLS // high
        for a in range(0, len(own), rows):
            _merge_matrix(own[a:a + rows], pieces, sizes, high, vocabulary, out)
    for i in np.flatnonzero((sizes > 64) | (sizes == 0)):
        out[i] = array("i", _merge_long(pieces[i], vocabulary.ranks) if pieces[i] else []).tobytes()
    return out


def _merge_matrix(rows, pieces, sizes, width, vocabulary, out):
    """One merge a step in every row of a matrix of ids, as long as any row has one."""
    raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in rows), np.uint8).reshape(-1, width)
    size = sizes[rows].copy()
    col = np.arange(width)
    ids = np.where(col < size[:, None], vocabulary.single[raw], 0)
    ranks = np.where(col[1:] < size[:, None], vocabulary.pair(ids[:, :-1], ids[:, 1:]), _NONE)
    # a piece that is a token is that token, however its bytes would merge
    whole = np.array([vocabulary.ranks.get(pieces[i], -1) for i in rows])
    ids[whole >= 0, 0] = whole[whole >= 0]
    size[whole >= 0] = 1
    live = np.flatnonzero((whole < 0) & (size > 1))
    while len(live):
        at = ranks[live].argmin(axis=1)
        best = ranks[live, at]
        go = best != _NONE
        live, at, best = live[go], at[go], best[go]
        if not len(live):
            break
        now, r = ids[live], ranks[live]
        # drop the right part of the pair and what stood between it and its neighbour
        now = np.take_along_axis(now, np.minimum(col + (col > at[:, None]), width - 1), axis=1)
        r = np.take_along_axis(r, np.minimum(col[:-1] + (col[:-1] >= at[:, None]), width - 2), axis=1)
        n = np.arange(len(live))
        now[n, at] = best
        size[live] -= 1
        left = at > 0
        r[n[left], at[left] - 1] = vocabulary.pair(now[n[left], at[left] - 1], best[left])
        right = at + 1 < size[live]
        r[n[right], at[right]] = vocabulary.pair(best[right], now[n[right], at[right] + 1])
        r[col[:-1] + 1 >= size[live][:, None]] = _NONE
        ids[live], ranks[live] = now, r
    flat = ids[col < size[:, None]].astype(np.int32).tobytes()
    ends = 4 * np.cumsum(size)
    for i, a, b in zip(rows.tolist(), (ends - 4 * size).tolist(), ends.tolist()):
        out[i] = flat[a:b]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same in n log n: a heap of pairs over a linked list of parts, by their starts."""
    n = len(piece)
    end = list(range(1, n + 1)) + [n]  # of the part that starts here; 0 once it is merged away
    before = list(range(-1, n))
    heap = []

    def push(i):
        if i >= 0 and end[i] < n:
            j = end[i]
            rank = ranks.get(piece[i:end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[i], end[j]))

    for i in range(n - 1):
        push(i)
    while heap:
        _, i, j, stop = heapq.heappop(heap)
        if end[i] != j or j >= n or end[j] != stop:
            continue  # one of the two has changed since
        end[i], end[j] = stop, 0
        if stop < n:
            before[stop] = i
        push(before[i])
        push(i)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class _Ids(dict):
    """piece -> bytes of its int32 ids, for the pieces of the texts last learned."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def learn(self, pieces: set[str]) -> None:
        if len(self) > REMEMBERED:
            self.clear()
        new = list(pieces - self.keys())
        self.update(zip(new, merge([p.encode() for p in new], self.vocabulary)))


def _whole(text: str, pattern: str, ranks):
    def run(batches):
        split, known = regex.compile(pattern), _Ids(ranks.value)
        for part in slices(batches, text, SLICE):
            pieces = [split.findall(t or "") for t in part.column(text).to_pylist()]
            known.learn(set().union(*pieces))
            ids = [b"".join(map(known.__getitem__, p)) for p in pieces]
            ends = np.cumsum([0, *map(len, ids)]) // 4
            rows = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)),
                                            pa.array(np.frombuffer(b"".join(ids), np.int32)))
            yield part.append_column("ids", rows)
    return run


def _chunks(pattern: str, ranks):
    """Ids of each chunk's pieces, where the pieces start, and how many ids each has."""
    def run(batches):
        split, known = regex.compile(pattern), _Ids(ranks.value)
        for part in slices(batches, "part", SLICE):
            starts, counts, ids = [], [], []
            for t in part.column("part").to_pylist():
                pieces = split.findall(t)
                known.learn(set(pieces))
                own = [known[p] for p in pieces]
                starts.append(np.cumsum([0, *map(len, pieces)])[:-1].astype("<i4").tobytes())
                counts.append(np.array([len(x) // 4 for x in own], "<i4").tobytes())
                ids.append(b"".join(own))
            for name, col in (("starts", starts), ("counts", counts), ("ids", ids)):
                part = part.append_column(name, pa.array(col, pa.binary()))
            yield part
    return run


class _Chunk:
    """Pieces of a stretch of a text that begins at character ``at``."""

    def __init__(self, at, text, starts, counts, ids):
        self.at, self.text, self.end = at, text, at + len(text)
        self.starts = starts + at
        self.cuts = np.cumsum([0, *counts], dtype=np.int64)
        self.ids = ids

    def upto(self, p: int, frm: int) -> np.ndarray:
        """Ids of the pieces that start in [frm, p)."""
        a, b = np.searchsorted(self.starts, [frm, p])
        return self.ids[self.cuts[a]:self.cuts[b]]


def _split(at, text, split, known) -> _Chunk:
    pieces = split.findall(text)
    known.learn(set(pieces))
    own = [known[p] for p in pieces]
    return _Chunk(at, text, np.cumsum([0, *map(len, pieces)], dtype=np.int64)[:-1], [len(x) // 4 for x in own],
                  np.frombuffer(b"".join(own), np.int32))


def stitch(chunks, split, known) -> np.ndarray:
    """Ids of a text from its chunks in order."""
    out, now, frm = [], None, 0
    for nxt in chunks:
        if now is not None:
            last = now.end - LOOK_AHEAD
            common = np.intersect1d(now.starts[(now.starts >= frm) & (now.starts <= last)], nxt.starts)
            if len(common):
                out.append(now.upto(common[0], frm))
                frm = common[0]
            else:
                safe = now.starts[(now.starts >= frm) & (now.starts <= last)]
                p = int(safe[-1]) if len(safe) else frm
                out.append(now.upto(p, frm))
                frm = p
                rest = now.text[p - now.at:max(0, nxt.at - now.at)] + nxt.text[max(0, p - nxt.at):]
                nxt = _split(p, rest, split, known)
        now = nxt
    out.append(now.upto(now.end, frm))
    return np.concatenate(out)


def _stitch(pattern: str, ranks, size: int):
    """Streams chunk rows sorted by (key, k) into one row of ids a text."""
    def run(batches):
        split, known = regex.compile(pattern), _Ids(ranks.value)
        now, chunks = None, []

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([now]), pa.array([stitch(chunks, split, known)], pa.list_(pa.int32()))],
                names=["key", "ids"])

        for batch in batches:
            for r in batch.to_pylist():
                if r["key"] != now:
                    if chunks:
                        yield row()
                    now, chunks = r["key"], []
                chunks.append(_Chunk(r["k"] * size, r["part"], *(
                    np.frombuffer(r[c], "<i4").astype(np.int64) for c in ("starts", "counts")),
                    np.frombuffer(r["ids"], np.int32)))
        if chunks:
            yield row()
    return run


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``docs`` plus ids array<int>, the token ids of the whole text.

    A column ``ids`` is replaced, others pass through.  The vocabulary is broadcast: its size is
    that of its file.  Repeated long texts are encoded once.
    """
    if chunk < 1 or overlap <= LOOK_AHEAD:
        raise ValueError("chunk must be positive and overlap over LOOK_AHEAD")
    docs = without(docs, "ids", "__key")
    vocabulary = Shared(docs.sparkSession, Vocabulary(ranks))
    is_long = F.coalesce(F.length(text) > chunk + overlap, F.lit(False))
    short = docs.where(~is_long).mapInArrow(
        _whole(text, pattern, vocabulary), ddl(docs) + ", ids array<int>")

    keyed = docs.where(is_long).withColumn("__key", F.sha2(F.col(text), 256))
    part = (keyed.select(F.col("__key").alias("key"), F.col(text).alias("t")).dropDuplicates(["key"])
            .select("key", "t", F.explode(F.sequence(
                F.lit(0), F.ceil((F.length("t") - overlap) / chunk).cast("int") - 1)).alias("k"))
            .select("key", "k", F.expr(f"substring(t, k * {chunk} + 1, {chunk + overlap})").alias("part")))
    pieces = part.repartition("key", "k").mapInArrow(
        _chunks(pattern, vocabulary),
        "key string, k int, part string, starts binary, counts binary, ids binary")
    ids = (pieces.repartition("key").sortWithinPartitions("key", "k")
           .mapInArrow(_stitch(pattern, vocabulary, chunk), "key string, ids array<int>"))
    long = keyed.join(ids, keyed["__key"] == ids["key"]).drop("__key", "key")
    return short.unionByName(long)


def decode(docs: DataFrame, ranks: dict[bytes, int], ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``docs`` plus a binary column, the joined bytes of the ids' tokens (null ids: empty)."""
    docs = without(docs, into)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    tokens = Shared(docs.sparkSession, table)

    def run(batches):
        known = pa.array(tokens.value, pa.large_binary())
        for batch in batches:
            col = batch.column(ids)
            size = np.nan_to_num(pc.list_value_length(col).to_numpy(zero_copy_only=False)).astype(np.int64)
            raw = known.take(col.flatten())  # side by side in one buffer
            ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
            cuts = np.ascontiguousarray(ends[np.concatenate([[0], np.cumsum(size)])])
            joined = pa.Array.from_buffers(pa.large_binary(), len(size), [
                None, pa.py_buffer(cuts), raw.buffers()[2]])
            yield batch.append_column(into, joined.cast(pa.binary()))

    return docs.mapInArrow(run, f"{ddl(docs)}, `{into}` binary")


def tokens_digest(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """What op4 returns."""
    coded = decode(encode(docs.select("doc_id", "text"), ranks, pattern).drop("text"), ranks)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
