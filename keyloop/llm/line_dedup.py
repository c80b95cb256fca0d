"""Line dedup: lines found in many documents lose all, or all but their first, occurrences.

Method: two Bloom layers over line hashes (seen once, seen twice; ``frequency``).  Only a line that the
second layer has seen leaves its task, as a 128-bit digest with a count, for the exact
confirmation and the choice of the first occurrence.  Text is never shuffled while the
confirmed digests fit the broadcast bound; beyond it they go to the documents by a join.

Definitions: a text is split at \\n (null or empty: one empty line).  A line's key is the line
without leading and trailing bytes 20, 09-0D (hex), A-Z lower-cased.  Empty keys are never
dropped.  Each row counts as one document, also when its id is null or repeated.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloop.llm.frequency import PAYLOAD, payloads, seen_filter
from keyloop.llm.text import (Shared, ascii_lower_table, ddl, raw_bytes, slices, stored, without)

#: Confirmed lines that are broadcast at most (16 bytes each); more go by a join.
BROADCAST_LINES = 1 << 21
_LOWER = ascii_lower_table()
_DIGEST = np.dtype([("hi", "<u8"), ("lo", "<u8")])


def line_digests(col: pa.Array) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Lines of each text, the flat digests of their keys (zero for an empty key), offsets."""
    ends, data = raw_bytes(col)
    raw = bytes(data)
    lines, keys = [], []
    for a, b in zip(ends[:-1], ends[1:]):
        own = raw[a:b].split(b"\n")
        lines.append(own)
        keys.extend(own)
    keys = [k.strip(b" \t\n\x0b\x0c\r").translate(_LOWER) for k in keys]
    blob = b"".join(blake2b(k, digest_size=16).digest() if k else bytes(16) for k in keys)
    return lines, np.frombuffer(blob, _DIGEST), np.cumsum([0, *map(len, lines)])


def _once_a_text(digests, offsets):
    """Positions of the first line of each key in each text, without empty keys."""
    own = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.flatnonzero((digests["hi"] != 0) | (digests["lo"] != 0))
    order = at[np.lexsort((at, digests["lo"][at], own[at]))]
    new = np.ones(len(order), bool)
    new[1:] = (digests["lo"][order][1:] != digests["lo"][order][:-1]) | (
        own[order][1:] != own[order][:-1])
    return order[new], own


def _sketch(text: str):
    def run(batches):
        def hashes():
            for part in slices(batches, text):
                _, digests, offsets = line_digests(part.column(text))
                at, _ = _once_a_text(digests, offsets)
                yield digests["lo"][at].astype(np.uint64)
        yield from payloads(hashes())
    return run


_SUSPECT = "hi long, lo long, n long, doc {0}, line long"


def _suspects(text: str, ident: str, filt, combine: bool):
    """Suspected keys of a task's documents; one row a key and slice if ``combine``, with the
    first document (ids in order, null last) and line."""
    def run(batches):
        for part in slices(batches, text):
            _, digests, offsets = line_digests(part.column(text))
            at, own = _once_a_text(digests, offsets)
            at = at[filt.value.seen(digests["lo"][at].astype(np.uint64))]
            if not len(at):
                continue
            rows = pa.table({
                "hi": digests["hi"][at].view(np.int64), "lo": digests["lo"][at].view(np.int64),
                "n": np.ones(len(at), np.int64),
                "doc": part.column(ident).take(pa.array(own[at])),
                "line": at - offsets[own[at]]})
            if combine:
                rows = rows.sort_by([("doc", "ascending"), ("line", "ascending")])
                rows = rows.group_by(["hi", "lo"], use_threads=False).aggregate(
                    [("n", "sum"), ("doc", "first"), ("line", "first")]).rename_columns(
                    {"n_sum": "n", "doc_first": "doc", "line_first": "line"})
            yield from rows.select(["hi", "lo", "n", "doc", "line"]).to_batches()
    return run


def _kept(part, text, ident, bad_of, keep_first):
    """The slice with its text less dropped lines, and the counts of lines."""
    lines, digests, offsets = line_digests(part.column(text))
    gone, first_doc, first_line = bad_of(digests, offsets)
    if keep_first:
        own = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        ids = part.column(ident).to_pylist()
        for at in np.flatnonzero(gone):
            if first_doc[at] == ids[own[at]] and first_line[at] == at - offsets[own[at]]:
                gone[at] = False
    texts, dropped = [], []
    for i, own in enumerate(lines):
        out = gone[offsets[i]:offsets[i + 1]]
        dropped.append(int(out.sum()))
        texts.append(b"\n".join([x for x, g in zip(own, out) if not g] if out.any() else own))
    cols = [pa.array(texts, pa.binary()).cast(pa.string()) if n == text else part.column(n)
            for n in part.schema.names if n != "__bad"]
    names = [n for n in part.schema.names if n != "__bad"]
    return pa.RecordBatch.from_arrays(
        [*cols, pa.array(list(map(len, lines)), pa.int64()), pa.array(dropped, pa.int64())],
        names=[*names, "n_lines", "n_dropped"])


def _lookup(hi, lo, doc, line):
    """bad_of for a table sorted by (lo, hi)."""
    def bad_of(digests, offsets):
        at = np.searchsorted(lo, digests["lo"], "left")
        gone = np.zeros(len(digests), bool)
        row = np.zeros(len(digests), np.int64)
        live = np.arange(len(digests))
        while len(live) and len(lo):  # equal lo with another hi: the next row
            live = live[at[live] < len(lo)]
            live = live[lo[at[live]] == digests["lo"][live]]
            hit = hi[at[live]] == digests["hi"][live]
            gone[live[hit]] = True
            row[live[hit]] = at[live[hit]]
            live = live[~hit]
            at[live] += 1
        return gone, doc[row] if len(doc) else None, line[row] if len(line) else None
    return bad_of


def _table(rows):
    """(hi, lo, doc, line) arrays sorted for _lookup, from tuples."""
    hi = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    lo = np.array([r[1] for r in rows], np.int64).view(np.uint64)
    order = np.lexsort((hi, lo))
    doc = np.array([r[2] for r in rows], object)[order]
    line = np.array([r[3] for r in rows], np.int64)[order]
    return hi[order], lo[order], doc, line


def dedup_lines(docs: DataFrame, min_docs: int = 2, keep: str = "first", ident: str = "doc_id",
                text: str = "text", broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """``docs`` with repeated lines taken out of the text, plus n_lines (before) and n_dropped.

    A key found in at least ``min_docs`` rows is repeated.  ``keep="first"`` keeps its first
    line of the row with the smallest id (rows that repeat that id each keep theirs; with
    null ids only, none is kept); ``keep="none"`` keeps no line.  The text of a row that loses nothing
    is unchanged, but a null becomes the empty text.  Columns named n_lines or n_dropped are
    replaced; all others pass through.  An empty table gives an empty table.
    """
    if keep not in ("first", "none"):
        raise ValueError(f"keep: {keep}")
    if min_docs < 2:
        raise ValueError("min_docs must be 2 or more: the filter finds lines seen twice")
    docs = without(docs, "n_lines", "n_dropped", "__bad")
    spark = docs.sparkSession
    kind = docs.schema[ident].dataType.simpleString()
    slim = docs.select(ident, text)
    filt = seen_filter(slim.select(text).mapInArrow(_sketch(text), PAYLOAD))
    schema = _SUSPECT.format(kind)
    found = stored(
        slim.mapInArrow(_suspects(text, ident, filt, True), schema).groupBy("hi", "lo")
        .agg(F.sum("n").alias("n"), F.min(F.struct(F.col("doc").isNull(), "doc", "line")).alias("at"))
        .where(F.col("n") >= min_docs)
        .select("hi", "lo", F.col("at.doc").alias("doc"), F.col("at.line").alias("line")),
        "repeated-lines")
    out = ddl(docs) + ", n_lines long, n_dropped long"
    first = keep == "first"
    if found.count() <= broadcast_lines:
        if not first:
            found = found.withColumn("doc", F.lit(None).cast(kind))
        small = Shared(spark, _table(found.collect()))

        def by_broadcast(batches):
            bad_of = _lookup(*small.value)
            for part in slices(batches, text):
                yield _kept(part, text, ident, bad_of, first)

        return docs.mapInArrow(by_broadcast, out)

    bad = (slim.mapInArrow(_suspects(text, ident, filt, False), schema)
           .select("hi", "lo", F.col("doc").alias("own")).distinct()
           .join(found, ["hi", "lo"])
           .groupBy("own").agg(F.collect_list(F.struct("hi", "lo", "doc", "line")).alias("__bad")))

    def by_join(batches):
        for part in slices(batches, text):
            for i in range(part.num_rows):
                one = part.slice(i, 1)
                rows = [tuple(r.values()) for r in one.column("__bad")[0].as_py() or []]
                yield _kept(one, text, ident, _lookup(*_table(rows)), first)

    joined = docs.join(bad, docs[ident].eqNullSafe(bad["own"]), "left").drop("own")
    return joined.mapInArrow(by_join, out)


def dedup_digest(docs: DataFrame) -> DataFrame:
    """What op1 returns: lines in ten or more documents go everywhere."""
    kept = dedup_lines(docs.select("doc_id", "text"), min_docs=10, keep="none")
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


#: The same in SQL (DuckDB).
ORACLE = r"""
WITH lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (
  SELECT *, regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS k FROM lines),
bad AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(bad.k) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE bad.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN bad USING (k) GROUP BY doc_id
"""
