"""Substring dedup: relative Lempel-Ziv factors of documents against indexed reference blocks.

A factor is a run of words of one document that also stands in a reference document; factors of
at least ``window`` words become duplicate spans when the reference has a smaller id.

Reference blocks are cut by content, so that a document is only factored against blocks which
can hold its words.  Every window of ``window`` words has an anchor, the smallest hash among
its runs of ``ANCHOR_WORDS`` words; equal windows have equal anchors.  All windows of an anchor
are in one block, and consecutive windows with one anchor form a piece.

1. A two-layer Bloom filter (``frequency``) over all anchors finds those sighted twice.
2. Each slice is a reference block of its own first: a window that starts in a document of the
   slice with a smaller id is decided there, so a hot passage leaves a slice once, not once a
   document.  Undecided pieces with suspected anchors go to the block of the anchor.
3. A block reads its pieces in id order, factors each greedily against the windows indexed so
   far and then indexes its new ones.
4. Factors return to their documents.  Windows that straddle the boundary of two factors are
   judged like any other, so the union of the spans is exact.

Definitions: words are runs of bytes other than 20, 09-0D (hex), unchanged; null has none.
Windows are judged on the input.  Rows with a null id are never a source and stay whole; of rows
with equal ids none is smaller than the other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloop.llm.frequency import PAYLOAD, payloads, seen_filter
from keyloop.llm.text import (covered, ddl, inside, ngram_hashes, owners, slices, split_words,
                              without, word_hashes)

WINDOW = 13
ANCHOR_WORDS = 4


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values."""
    n, span = len(x) - w + 1, 1
    if n <= 0:
        return x[:0]
    while span * 2 <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[w - span:w - span + n])


def _pieces(hashes: np.ndarray, offsets: np.ndarray, window: int):
    """(anchor of each window, first windows of pieces, their sizes), over valid windows only."""
    k = min(ANCHOR_WORDS, window)
    anchors = _sliding_min(ngram_hashes(hashes, k), window - k + 1)
    ok = np.flatnonzero(inside(offsets, window, len(anchors)))
    if not len(ok):
        return anchors, ok, ok
    own = owners(offsets)[ok]
    new = np.ones(len(ok), bool)
    new[1:] = (anchors[ok][1:] != anchors[ok][:-1]) | (own[1:] != own[:-1])
    first = np.flatnonzero(new)
    return anchors, ok[first], np.diff(np.append(first, len(ok)))


def _sketch(text: str, window: int):
    def run(batches):
        def hashes():
            for part in slices(batches, text):
                words, offsets = split_words(part.column(text))
                anchors, first, _ = _pieces(word_hashes(words), offsets, window)
                yield anchors[first]
        yield from payloads(hashes())
    return run


_PIECE = "id {0}, fp long, anchor long, start int, n int, wins binary"


def _ranks(ids: pa.Array) -> np.ndarray:
    """Ranks that order like the ids; equal ids share one."""
    if pa.types.is_integer(ids.type):
        return ids.to_numpy(zero_copy_only=False)
    coded = ids.dictionary_encode()
    place = np.empty(len(coded.dictionary), np.int64)
    place[pc.sort_indices(coded.dictionary.cast(pa.large_binary()) if pa.types.is_string(ids.type)
                          else coded.dictionary).to_numpy()] = np.arange(len(place))
    return place[coded.indices.to_numpy()]


def _emit(text: str, ident: str, window: int, filt):
    """Pieces to be judged by blocks, and spans (wins null) that the slice decides itself."""
    def run(batches):
        for part in slices(batches, text):
            part = part.filter(pc.is_valid(part.column(ident)))
            if not part.num_rows:
                continue
            words, offsets = split_words(part.column(text))
            hashes = word_hashes(words)
            anchors, first, size = _pieces(hashes, offsets, window)
            ok = filt.value.seen(anchors[first])
            first, size = first[ok], size[ok]
            if not len(first):
                continue
            at = np.repeat(first, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            wins = ngram_hashes(hashes, window)[at]
            own = owners(offsets)
            rank = _ranks(part.column(ident))[own[at]]
            order = np.lexsort((rank, wins))
            new = np.ones(len(order), bool)
            new[1:] = wins[order][1:] != wins[order][:-1]
            smallest = rank[order][np.flatnonzero(new)][np.cumsum(new) - 1]
            known = np.zeros(len(at), bool)
            known[order] = rank[order] > smallest
            cut = np.cumsum(size) - size
            full = np.add.reduceat(known, cut, dtype=np.int64) == size
            keep = ~full
            # decided pieces that follow each other without a gap are one span
            f, s = first[full], size[full]
            join = np.ones(len(f), bool)
            join[1:] = (f[1:] != f[:-1] + s[:-1]) | (own[f[1:]] != own[f[:-1]])
            begin = np.flatnonzero(join)
            f2, s2 = f[begin], np.add.reduceat(s, begin) if len(begin) else s[:0]
            start = np.concatenate([f2, first[keep]])
            count = np.concatenate([s2, size[keep]])
            text_of = own[start]
            raw = wins.astype("<u8")
            blobs = [None] * len(f2) + [
                raw[a:a + n].tobytes() for a, n in zip(cut[keep].tolist(), size[keep].tolist())]
            take = pa.array(text_of)
            yield pa.RecordBatch.from_arrays([
                part.column(ident).take(take), part.column("__fp").take(take),
                # decided spans are dealt out by their text, they need no block
                pa.array(np.concatenate([
                    part.column("__fp").take(take).to_numpy()[:len(f2)],
                    anchors[first[keep]].view(np.int64)])),
                pa.array((start - offsets[text_of]).astype(np.int32)),
                pa.array(count.astype(np.int32)), pa.array(blobs, pa.binary())],
                names=["id", "fp", "anchor", "start", "n", "wins"])
    return run


def _factor(batches):
    """Greedy factors of a block's pieces (sorted by anchor, id) against its earlier windows."""
    now, index = None, {}
    for batch in batches:
        ids, fps, out = batch.column("id").to_pylist(), batch.column("fp"), []
        anchors, starts = batch.column("anchor").to_pylist(), batch.column("start").to_pylist()
        sizes = batch.column("n").to_pylist()
        for i, blob in enumerate(batch.column("wins").to_pylist()):
            if blob is None:  # a span that its slice has decided
                out.append((i, starts[i], sizes[i]))
                continue
            if anchors[i] != now:
                now, index = anchors[i], {}
            ident, begin, n = ids[i], None, len(blob) // 8
            for j in range(n):
                known = index.setdefault(blob[8 * j:8 * j + 8], ident) != ident
                if known and begin is None:
                    begin = j
                elif not known and begin is not None:
                    out.append((i, starts[i] + begin, j - begin))
                    begin = None
            if begin is not None:
                out.append((i, starts[i] + begin, n - begin))
        at = pa.array([x[0] for x in out], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(at), fps.take(at), pa.array([x[1] for x in out], pa.int32()),
             pa.array([x[2] for x in out], pa.int32())], names=["id", "fp", "start", "n"])


def _cut(text: str, window: int):
    """Texts less the words of their spans; n windows from start on are a span."""
    def run(batches):
        for part in slices(batches, text):
            words, offsets = split_words(part.column(text))
            spans = part.column("__spans")
            rows = spans.flatten()
            per = np.nan_to_num(pc.list_value_length(spans).to_numpy(zero_copy_only=False)).astype(np.int64)
            if len(rows):
                base = np.repeat(offsets[:-1], per) + rows.field("start").to_numpy()
                n = rows.field("n").to_numpy().astype(np.int64)
                starts = np.repeat(base, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                gone = covered(starts, window, len(words))
            else:
                gone = np.zeros(len(words), bool)
            kept = words.filter(pa.array(~gone))
            ends = np.concatenate([[0], np.cumsum(~gone)])[offsets]
            lists = pa.LargeListArray.from_arrays(pa.array(ends), kept)
            own = owners(offsets)
            names = [c for c in part.schema.names if c not in ("__spans", "__fp")]
            cols = [pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string()) if c == text else part.column(c)
                    for c in names]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(np.diff(offsets)),
                 pa.array(np.bincount(own[gone], minlength=part.num_rows).astype(np.int64))],
                names=[*names, "n_words", "n_removed"])
    return run


def dedup_substrings(docs: DataFrame, window: int = WINDOW, ident: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """``docs`` with each word cut that a window of ``window`` words covers whose words also
    start in a row with a smaller id; the words left are joined by one space.  Adds n_words
    (before) and n_removed; columns of these names are replaced, others pass through.

    Memory of a task: one slice, or the distinct windows of one anchor.  A passage that a third
    of all documents share reaches its block once a slice and is read there in a stream.
    """
    docs = without(docs, "n_words", "n_removed", "__fp", "__spans")
    kind = docs.schema[ident].dataType.simpleString()
    filt = seen_filter(docs.select(text).mapInArrow(_sketch(text, window), PAYLOAD))
    keyed = docs.withColumn("__fp", F.xxhash64(text))  # rows may repeat an id with other text
    spans = (keyed.select(ident, text, "__fp")
             .mapInArrow(_emit(text, ident, window, filt), _PIECE.format(kind))
             .repartition("anchor").sortWithinPartitions("anchor", "id")
             .mapInArrow(_factor, f"id {kind}, fp long, start int, n int")
             .groupBy("id", "fp").agg(F.collect_list(F.struct("start", "n")).alias("__spans")))
    marked = keyed.join(spans, (keyed[ident] == spans["id"]) & (keyed["__fp"] == spans["fp"]),
                        "left").drop("id", "fp") if ident != "id" else keyed.join(
        spans.withColumnRenamed("id", "__id"),
        (F.col("id") == F.col("__id")) & (F.col("__fp") == F.col("fp")), "left").drop("__id", "fp")
    return marked.mapInArrow(_cut(text, window), ddl(docs) + ", n_words long, n_removed long")


def substring_digest(docs: DataFrame) -> DataFrame:
    """What op10 returns."""
    kept = dedup_substrings(docs.select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


#: The same in SQL (DuckDB).
ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 11))) AS i FROM d)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY t) AS first FROM win)
  WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM dup),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, count(gone.p) AS n_removed,
    string_agg(word, ' ' ORDER BY p) FILTER (WHERE gone.p IS NULL) AS t
  FROM word LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
