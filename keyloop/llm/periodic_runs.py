"""Periodic runs: stretches of words that repeat with a period, found and collapsed.

Method: an enhanced suffix array (order, ranks by doubling, LCP) of a slice of documents, each
document apart, and the branching-tandem test on it.  Every LCP interval of depth q has suffixes
that share q words; for the suffixes i of all its children but the largest, ISA[i + q] and
ISA[i - q] are looked up in the interval: a hit is a square of period q, branching where the word
after it breaks the period.  The ranks of doubling then rotate a square to the left, powers of two
of places at once, until the period breaks; squares of one stretch merge into its run.
Intervals are index ranges of the array throughout; there are no tree nodes.

A run is a stretch of words with smallest period q (words q apart are equal), of at least
``min_length`` words and ``min_exponent`` periods, that no neighbouring word extends.  The
documents of a slice never meet, so a partition is worked off in slices of bounded size
(or one text, whatever its length) and nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloop.llm.text import ddl, slices, split_words, without

#: Bytes of text whose suffix array is built at once.
SLICE = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"


def suffix_array(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(order, levels) of the suffixes of texts that lie behind each other.

    ``words`` are integers that differ between texts, ``ends[i]`` is the end of the text of
    position i.  ``levels[k]`` ranks positions by their first 2**k words: equal ranks, equal
    words.  The last level is the inverse of the order.  Each has one more entry, -1, at the end.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    ranked = words[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    start = np.flatnonzero(new)
    rank = np.full(n + 1, -1, np.int32)
    rank[order] = np.repeat(start, np.diff(np.append(start, n)))
    levels, width = [rank], 1
    # places in the order whose suffix still shares its rank
    size = np.diff(np.append(start, n))
    open_at = np.flatnonzero(np.repeat(size > 1, size))
    while len(open_at):
        own = order[open_at]
        then = own + width
        second = np.where(then < ends[own], rank[np.minimum(then, n)], -1).astype(np.int64)
        key = rank[own].astype(np.int64) * (n + 1) + second + 1
        by = np.argsort(key, kind="stable")
        own, key = own[by], key[by]
        order[open_at] = own
        new = np.concatenate([[True], key[1:] != key[:-1]])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(own)))
        rank = rank.copy()
        rank[own] = np.repeat(open_at[start], size)
        levels.append(rank)
        open_at = open_at[np.repeat(size > 1, size)]
        width *= 2
    return order, levels


def lcp_array(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Common words of the suffixes at j - 1 and j of the order; 0 at both ends."""
    n = len(order)
    out = np.zeros(n + 1, np.int64)
    if n < 2:
        return out
    alive, held = np.arange(1, n), []
    for rank in levels[:-1]:
        alive = alive[rank[order[alive - 1]] == rank[order[alive]]]
        held.append(alive)
        if not len(alive):
            break
    for k in range(len(held) - 1, -1, -1):
        at, rank = held[k], levels[k]
        a, b = order[at - 1] + out[at], order[at] + out[at]
        more = at[rank[np.minimum(a, n)] == rank[np.minimum(b, n)]]
        out[more] += 1 << k
    return out


def _nearest_less(lcp: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
    """For each boundary of ``at`` the nearest one before (step -1) or after it with a smaller LCP."""
    near = np.arange(len(lcp)) + step
    while len(at):
        at = at[lcp[near[at]] >= lcp[at]]
        near[at] = near[near[at]]
    return near


def _spread(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, position) of all positions of the ranges start .. start + size."""
    owner = np.repeat(np.arange(len(starts)), sizes)
    skip = np.cumsum(sizes) - sizes
    return owner, np.arange(len(owner)) - skip[owner] + starts[owner]


def branching_squares(order, levels, lcp, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of the squares whose following word breaks the period and that end
    ``least`` or more repetitions of their period."""
    n, isa = len(order), levels[-1]
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(lcp > 0)
    if not len(at):
        return none
    low, high = _nearest_less(lcp, at, -1), _nearest_less(lcp, at, 1)
    at = at[high[at] - low[at] >= least]       # a period repeated so often occurs so often
    if not len(at):
        return none
    at = at[np.lexsort((at, lcp[at], low[at]))]
    first = np.concatenate([[True], (low[at][1:] != low[at][:-1]) | (lcp[at][1:] != lcp[at][:-1])])
    last = np.append(first[1:], True)
    # the children of an interval lie between its separators
    starts = np.concatenate([low[at[first]], at])
    stops = np.concatenate([at[first], np.where(last, high[at], np.append(at[1:], 0))])
    group = np.cumsum(first) - 1
    group = np.concatenate([np.arange(first.sum()), group])
    by = np.argsort(group, kind="stable")
    starts, stops, group = starts[by], stops[by], group[by]
    size = stops - starts
    heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    most = np.flatnonzero(size == np.maximum.reduceat(size, heads)[group])
    largest = most[np.unique(group[most], return_index=True)[1]]
    small = np.ones(len(size), bool)
    small[largest] = False
    starts, size, group = starts[small], size[small], group[small]
    low, high, depth = low[at[first]], high[at[first]], lcp[at[first]]
    owner, place = _spread(starts, size)
    owner = group[owner]
    i, q, lo, hi = order[place], depth[owner], low[owner], high[owner]

    def inside(x, lo, hi):
        own = isa[np.clip(x, 0, n)]
        return (x >= 0) & (x < n) & (own >= lo) & (own < hi)

    ahead, behind = inside(i + q, lo, hi), inside(i - q, lo, hi)
    s = np.concatenate([i[ahead], (i - q)[behind]])
    q, lo, hi = (np.concatenate([x[ahead], x[behind]]) for x in (q, lo, hi))
    ok = levels[0][np.minimum(s + q, n)] != levels[0][np.minimum(s + 2 * q, n)]
    for back in range(1, least - 1):
        ok &= inside(s - back * q, lo, hi)
    found = np.unique(np.stack([s[ok], q[ok]]), axis=1)
    return found[0], found[1]


def runs_of(words: np.ndarray, offsets: np.ndarray, min_length: int, min_exponent: int
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period), flat positions, of all runs of the texts
    ``words[offsets[i]:offsets[i + 1]]``, by start, then period."""
    if not len(words):
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    own = owner * (int(words.max()) + 1) + words
    order, levels = suffix_array(own, offsets[1:][owner])
    s, q = branching_squares(order, levels, lcp_array(order, levels), min_exponent)
    end = s + 2 * q
    start = s - (min_exponent - 2) * q
    for k in range(len(levels) - 2, -1, -1):   # rotate to the left as far as words are equal
        to = start - (1 << k)
        same = (to >= 0) & (levels[k][np.maximum(to, 0)] == levels[k][np.maximum(to, 0) + q])
        start = np.where(same, to, start)
    long = end - start >= min_length
    start, end, q = start[long], end[long], q[long]
    by = np.lexsort((q, end, start))           # multiples of the smallest period fall away
    start, end, q = start[by], end[by], q[by]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, q = start[new], end[new], q[new]
    by = np.lexsort((q, start))
    return start[by], (end - start)[by], q[by]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _find(text: str, min_length: int, min_exponent: int):
    def run(batches):
        for part in slices(batches, text, SLICE):
            words, offsets = split_words(part.column(text))
            n = len(words)
            coded = words.dictionary_encode()
            ids = coded.indices.to_numpy().astype(np.int64)
            start, length, period = runs_of(ids, offsets, min_length, min_exponent)
            own = np.searchsorted(offsets, start, "right") - 1
            step = np.zeros(n + 1, np.int64)   # words after a run's first period, to its end
            np.add.at(step, start + period, 1)
            np.add.at(step, start + length, -1)
            kept = np.cumsum(step)[:n] == 0
            left = np.concatenate([[0], np.cumsum(kept)])[offsets]
            lists = pa.ListArray.from_arrays(left.astype(np.int32), words.filter(pa.array(kept)))
            found = pa.ListArray.from_arrays(
                np.searchsorted(own, np.arange(part.num_rows + 1)).astype(np.int32),
                pa.StructArray.from_arrays([pa.array(start - offsets[own]), pa.array(length),
                                            pa.array(period)], fields=list(_RUN)))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(np.diff(offsets)), found,
                 pc.binary_join(lists, pa.scalar(" ", lists.type.value_type)).cast(pa.string())],
                names=[*part.schema.names, "n_words", "runs", "collapsed"])
    return run


def find_runs(docs: DataFrame, text: str = "text", min_length: int = 6, min_exponent: int = 4
              ) -> DataFrame:
    """``docs`` with n_words, its ``runs`` (start, length, period; by start, then period) and the
    ``collapsed`` text: the words less those that a run holds beyond its first period, joined by
    one space.

    Words are maximal runs of other characters than 20, 09-0D (hex).  A null or empty text has
    no words, no runs (an empty list) and the empty text.  Every row is judged by itself, so
    repeated rows have equal results and a null id is a value like any other; overlapping runs
    are all listed, and a word dropped by any of them is gone.  An empty table gives an empty
    table.  Columns named n_words, runs or collapsed are replaced; all others pass through.  Memory
    follows the slice of a MB, or the longest single text.
    """
    if min_exponent < 2 or min_length < 1:
        raise ValueError("a run has two periods or more")
    docs = without(docs, "n_words", "runs", "collapsed")
    kind = "array<struct<start:bigint,length:bigint,period:bigint>>"
    return docs.mapInArrow(_find(text, min_length, min_exponent),
                           f"{ddl(docs)}, n_words long, runs {kind}, collapsed string")


def looped(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """What op13's contract makes of the texts: where h = crc32(decimal id) ends in 0, each word i
    from a = h // 10 % n on becomes word a + (i - a) % p, p = 1 + (n - a) // (3 + h // 10 % 8), joined by
    one space.  Other texts, also those of a null id, stay as they are."""
    h = F.crc32(F.col(ident).cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, g = F.size("__w").cast("long"), F.floor(F.col("__h") / 10).cast("long")
    d = (docs.withColumn("__h", h)
         .withColumn("__w", F.when(F.col("__h") % 10 == 0, words))
         .withColumn("__a", F.when(n > 0, g % n)))
    p = 1 + F.floor((n - F.col("__a")) / (3 + g % 8)).cast("int")
    a = F.col("__a").cast("int")
    at = F.transform(F.sequence(F.lit(0), F.size("__w") - 1), lambda i: F.get(
        F.col("__w"), F.when(i < F.col("__a"), i).otherwise(a + (i - a) % F.col("__p"))))
    return (d.withColumn("__p", p)
            .withColumn(text, F.when(F.col("__a").isNotNull(), F.array_join(at, " ")).otherwise(F.col(text)))
            .drop("__h", "__w", "__a", "__p"))


def runs_digest(docs: DataFrame) -> DataFrame:
    """What op13 returns for each document."""
    found = find_runs(looped(docs.select("doc_id", "text")))
    # longest, then smallest start, then smallest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in (
        "start", "length", "period")]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return found.withColumn("__b", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("__b.start")).alias("start"), F.col("__b.length").alias("length"),
        (-F.col("__b.period")).alias("period"),
        F.floor(1000 * F.col("__b.length") / -F.col("__b.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
