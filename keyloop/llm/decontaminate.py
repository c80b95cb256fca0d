"""Benchmark decontamination by suffix arrays of the training text.

Every task builds a suffix array over each slice of its documents (a shard) and binary-searches
all benchmark suffixes in it.  The range a suffix hits gives all its locations; hits along a
diagonal join into the longest verbatim matches.  Equal windows of an item are searched once; where an item
repeats words, each match is the longest from its start, and the next starts after it.  The array holds only suffixes whose first words open some
benchmark window, as no other can match.  Nothing is shuffled.  The benchmark is the query
set: it is broadcast in blocks of at most ``BLOCK_CHARS`` characters, one pass a block.

Definitions: words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  An item's windows are all its
runs of ``window`` words; an item of fewer words, but not none, is one window.  A null text has
no words.  Items with a null id count for words hit, but are not listed; rows that repeat an
item id are one item.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloop.llm.text import (Shared, back, beside, ddl, inside, owners, slices, split_words, stored,
                              without)

#: Characters of benchmark text in one broadcast block; the rest takes further passes.
BLOCK_CHARS = 16 << 20
#: Bytes of text in one suffix array.
SHARD = 2 << 20
#: Byte map: A-Z lower-cased, every other byte that is no word byte to a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def _keys(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int, pad: int) -> np.ndarray:
    """Words from each start on as bytes that sort like the word sequences."""
    at = starts[:, None] + np.arange(width)
    inside_text = at < ends[:, None]
    words = np.where(inside_text, codes[np.minimum(at, max(0, len(codes) - 1))], pad)
    return np.ascontiguousarray(words.astype(">u4")).view(f"S{4 * width}").ravel()


class Suffixes:
    """The benchmark's windows, as word codes of its own vocabulary."""

    def __init__(self, ids: pa.Array, texts: pa.Array, window: int):
        words, offsets = split_words(texts, _WORD_BYTES)
        self.ids, self.window = ids, window
        self.vocabulary = pc.unique(words)
        codes = self.code(words)
        size = np.diff(offsets)
        own, at = owners(offsets), np.arange(len(codes))
        start, stop = offsets[:-1][own] if len(own) else at, offsets[1:][own] if len(own) else at
        opens = np.where(size[own] >= window, at + window <= stop, at == start) if len(own) else at > 0
        begin, item = at[opens], own[opens]
        length = np.minimum(window, stop[opens] - begin)
        within = begin - start[opens]
        self.head = int(min(2, length.min())) if len(length) else 1
        low = _keys(codes, begin, begin + length, window, 0)
        # equal windows of an item are one window with several places in it
        same = np.unique(low, return_inverse=True)[1]
        order = np.lexsort((within, same, item))
        item, same, self.places = item[order], same[order], within[order]
        new = np.ones(len(order), bool)
        new[1:] = (item[1:] != item[:-1]) | (same[1:] != same[:-1])
        one = order[new]
        self.place_at = np.append(np.flatnonzero(new), len(order))
        self.item, self.length, begin = item[new], length[one], begin[one]
        self.opening = self.heads(codes, begin)
        self.opening_set = np.unique(self.opening)
        self.low = low[one]
        self.high = _keys(codes, begin, begin + self.length, window, 0xFFFFFFFF)

    def code(self, words: pa.Array) -> np.ndarray:
        """1, 2, ... for words of the vocabulary, else 0."""
        if not len(self.vocabulary):
            return np.zeros(len(words), np.int64)
        found = pc.index_in(words, value_set=self.vocabulary)
        return pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1

    def heads(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """A number for the first ``head`` words."""
        if self.head == 1 or not len(at):
            return codes[at]
        return codes[at] * (len(self.vocabulary) + 1) + codes[np.minimum(at + 1, len(codes) - 1)]

    def search(self, codes: np.ndarray, offsets: np.ndarray):
        """(window number, position) of all occurrences of windows in the texts."""
        none = np.zeros(0, np.int64)
        at = np.flatnonzero(codes > 0)
        at = at[inside(offsets, self.head, len(codes))[at]]
        heads = self.heads(codes, at)
        slot = np.searchsorted(self.opening_set, heads)
        slot[slot == len(self.opening_set)] = 0
        fits = self.opening_set[slot] == heads if len(self.opening_set) else heads < 0
        at, heads = at[fits], heads[fits]
        if not len(at):
            return none, none
        ends = np.repeat(offsets[1:], np.diff(offsets))[at]
        keys = _keys(codes, at, ends, self.window, 0)
        order = np.argsort(keys, kind="stable")
        suffixes, at = keys[order], at[order]
        ask = np.flatnonzero(np.isin(self.opening, heads))
        first = np.searchsorted(suffixes, self.low[ask], "left")
        last = np.searchsorted(suffixes, self.high[ask], "right")
        n = np.maximum(last - first, 0)
        which = np.repeat(ask, n)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return which, at[np.repeat(first, n) + nth]


def _longest(test: Suffixes, which, at, text_of):
    """(text, item, start, length, start in item) of verbatim matches from window hits, in this order.

    An item has one hit at most at a position, as equal windows are one.  Along hits at consecutive positions
    a match goes on while a diagonal does; if it ends, the next starts with the window after."""
    item, text = test.item[which], text_of[at]
    order = np.lexsort((at, item, text))
    which, item, text, at = (x[order] for x in (which, item, text, at))
    place = test.places[test.place_at[which]]
    several = test.place_at[which + 1] - test.place_at[which] > 1
    broken = np.ones(len(at), bool)
    broken[1:] = (item[1:] != item[:-1]) | (text[1:] != text[:-1]) | (at[1:] != at[:-1] + 1)
    new = broken.copy()
    new[1:] |= place[1:] != place[:-1] + 1
    first = place.copy()
    if several.any():
        run = np.cumsum(broken) - 1
        cut = np.append(np.flatnonzero(broken), len(at))
        for r in np.unique(run[several]).tolist():
            a, b = int(cut[r]), int(cut[r + 1])
            new[a:b], first[a:b] = _diagonals(test, which[a:b])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at)) - 1 if len(at) else begin
    return text[begin], item[begin], at[begin], at[end] + test.length[which][end] - at[begin], first[begin]


#: Bytes of place sets that are kept for further use.
_SETS = 32 << 20


def _diagonals(test: Suffixes, which: np.ndarray):
    """(whether a match starts here, its first place in the item) for windows at consecutive positions.

    The places of a window are the bits of a number, so one shift and one AND follow all
    diagonals at once; each match is the longest from its start."""
    new, first = np.zeros(len(which), bool), np.zeros(len(which), np.int64)
    known, held, alive, since = {}, 0, 0, 0
    for i, w in enumerate(which.tolist()):
        if (own := known.get(w)) is None:
            bits = test.places[test.place_at[w]:test.place_at[w + 1]]
            flags = np.zeros(bits[-1] + 1, np.uint8)
            flags[bits] = 1
            own = int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")
            held += len(flags) >> 3
            if held > _SETS:
                known, held = {}, len(flags) >> 3
            known[w] = own
        on = alive << 1 & own
        if not on:
            if i:
                first[since] = _lowest(alive) - (i - 1 - since)
            new[i], since, on = True, i, own
        alive = on
    first[since] = _lowest(alive) - (len(which) - 1 - since)
    return new, first


def _lowest(bits: int) -> int:
    return (bits & -bits).bit_length() - 1


#: Columns that ``find_matches`` adds or needs for itself.
ADDED = ("n_words", "n_hit", "matches", "__found", "__words")
_MATCH = "array<struct<item_id:{0},start:int,length:int,item_start:int>>"


def _scan(text: str, test_of, item_type: pa.DataType, last: bool):
    """Adds a block's matches and the number of words; with the ``last`` block also the words hit."""
    match_type = pa.struct([("item_id", item_type), ("start", pa.int32()), ("length", pa.int32()),
                            ("item_start", pa.int32())])

    def run(batches):
        test = test_of.value
        for part in slices(batches, text, SHARD):
            words, offsets = split_words(part.column(text), _WORD_BYTES)
            which, at = test.search(test.code(words), offsets)
            own, item, start, length, within = _longest(test, which, at, owners(offsets))
            cuts = np.searchsorted(own, np.arange(part.num_rows + 1))
            rows = pa.StructArray.from_arrays(
                [test.ids.take(pa.array(item)).cast(item_type),
                 *(pa.array(x.astype(np.int32)) for x in (
                     start - offsets[own] if len(own) else start, length, within))],
                fields=list(match_type))
            found = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), rows)
            kept = [part.column(n) for n in part.schema.names if n not in ("__found", "__words")]
            if "__found" in part.schema.names:  # an earlier block's matches go first
                found = pa.array([a + b for a, b in zip(
                    part.column("__found").to_pylist(), found.to_pylist())], pa.list_(match_type))
            names = [n for n in part.schema.names if n not in ("__found", "__words")]
            out = pa.RecordBatch.from_arrays(
                [*kept, found, pa.array(np.diff(offsets))], names=[*names, "__found", "__words"])
            if last:
                n_hit = [int(_union(m)) for m in found.to_pylist()]
                out = out.append_column("n_hit", pa.array(n_hit, pa.int64()))
            yield out
    return run


def _union(matches: list[dict]) -> int:
    """Words in any of the matches."""
    total, upto = 0, -1
    for a, b in sorted((m["start"], m["start"] + m["length"]) for m in matches):
        total += max(0, b - max(a, upto))
        upto = max(upto, b)
    return total


def find_matches(docs: DataFrame, items: DataFrame, window: int = 10, text: str = "text",
                 item_id: str = "item_id", item_text: str = "text",
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` plus n_words, n_hit (words inside an occurrence of a window) and matches, the
    longest verbatim matches: item_id, start and length in the document's words, item_start.

    Whole texts are searched for every window of every item.  Columns of these names are
    replaced, others pass through.  Empty tables are fine on either side.
    """
    docs = without(docs, *ADDED)
    spark = docs.sparkSession
    items = items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text"))
    n_blocks = max(1, -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars))
    block = F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks))
    kind = items.schema["id"].dataType.simpleString()
    out = docs
    for b in range(n_blocks):
        rows = items.where(block == b).toArrow()
        ids = rows.column("id").combine_chunks()
        test = Shared(spark,
            Suffixes(ids, rows.column("text").combine_chunks(), window))
        last = b == n_blocks - 1
        schema = f"{ddl(docs)}, __found {_MATCH.format(kind)}, __words long" + ", n_hit long" * last
        out = out.mapInArrow(_scan(text, test, ids.type, last), schema)
        if not last:
            out = stored(out, "benchmark-block")
    return out.withColumnsRenamed({"__found": "matches", "__words": "n_words"})


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that hold any window of a benchmark item; columns unchanged."""
    found = find_matches(beside(docs, *ADDED), items, **options)
    return back(found.where("n_hit = 0"), docs.columns, *ADDED)


def contamination_digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """What op2 returns."""
    found = find_matches(docs.select("doc_id", "text"), items)
    ids = F.array_sort(F.array_distinct(F.array_compact(
        F.transform("matches", lambda m: m["item_id"].cast("string")))))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


#: The same in SQL (DuckDB).
ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (SELECT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0)),
spot AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS t
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
hit AS (SELECT DISTINCT doc_id, item_id, i, spot.k FROM spot JOIN win USING (k, t)),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
item AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (doc_id) LEFT JOIN item USING (doc_id)
"""
