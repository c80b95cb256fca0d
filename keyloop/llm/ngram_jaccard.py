"""N-gram Jaccard join: which documents' shingle sets are similar, directly or by a chain of links.

Documents with equal sets are one node.  Two nodes of Jaccard similarity t must share one of
their first ``floor((1 - t) n) + 1`` shingles in any fixed order of all shingles (n: set size).
The order puts shingles first that a two-layer Bloom filter proves to be in one row only:
these need no tile, so text without copies leaves no trace.  Shingles of many rows come last, above all
those counted as the most frequent of all (slices give counts of what repeats in them).

1. Tiles: a shared prefix shingle and a size band (sizes of linked sets differ by at most t).  Shingles that
   a Bloom filter of all prefixes proves to be in one node's only are left out.
   Each node is paired with the smallest node of its tiles only.
2. A pair is dropped if its bitmap signatures exclude it: each shingle flips one bit, so the bits
   that differ bound the symmetric difference from below, hence the overlap from above.  What
   remains is intersected exactly as sorted arrays.
3. Nodes linked so far form components.  Only tiles that still hold several components (bands
   aside, sizes checked) are searched again under the same bound: first each node outside a
   tile's largest component with its nearest node of another component, then, with the
   components that gave, all pairs across components.  All are intersected exactly, so after that
   no link between components can exist.

So a group of copies of any size costs one pair a node, and no pair is skipped but those whose
ends are already connected.  The filter covers the shingles of the lowest quarter of the hash
range; the others rank between its rare and its frequent ones, which affects cost, not results.

Definitions: words are runs of bytes other than 20, 09-0D (hex), A-Z lower-cased.  The set: distinct
k-word shingles; of fewer words, the whole sequence as one; without words empty, and linked
with nothing.  Null and repeated ids are allowed: a component's id is the smallest non-null id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloop.llm.components import components
from keyloop.llm.frequency import BLOCKS, PAYLOAD, SeenFilter, _fill, payloads, seen_filter
from keyloop.llm.text import (Shared, ascii_lower_table, bucketed, inside, mix, ngram_hashes, owners,
                              release, slices, split_words, stored, word_hashes)

_LOWER = ascii_lower_table()
_FILTERED = np.uint64(1 << 62)  # hashes below are in the filter
#: Rows from which a shingle counts as frequent (it then comes last in the order).
FREQUENT = 64
#: Sightings in one slice from which a shingle is counted, and how many of the most frequent ones are known.
LOCAL = 3
HEAVY = 1 << 18
HEAVY_BLOCKS = 64
SIGNATURE_BITS = 1024
#: Nodes of a block; a cell of the open tiles compares two blocks.
CHUNK = 2048
#: Bytes of text that are hashed at once.
SLICE = 1 << 20
#: Pairs that a task holds before it drops repeated ones.
GATHER = 1 << 20


def shingle_sets(col: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(flat sorted distinct shingle hashes of each text, offsets)."""
    words, offsets = split_words(col, _LOWER)
    h = word_hashes(words)
    grams = ngram_hashes(h, k)
    ok = inside(offsets, k, len(grams))
    own = owners(offsets)
    size = np.diff(offsets)
    short = np.flatnonzero((size > 0) & (size < k))
    flat, text = grams[ok], own[:len(grams)][ok]
    if len(short):
        whole = np.concatenate([ngram_hashes(h[offsets[i]:offsets[i + 1]], int(size[i])) for i in short])
        order = np.argsort(np.concatenate([text, short]), kind="stable")
        flat, text = np.concatenate([flat, whole])[order], np.concatenate([text, short])[order]
    cut = np.searchsorted(text, np.arange(len(size) + 1))
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        flat[a:b].sort()
    new = np.ones(len(flat), bool)
    new[1:] = (flat[1:] != flat[:-1]) | (text[1:] != text[:-1])
    return flat[new], np.concatenate([[0], np.cumsum(new)])[cut]


def _sketch(text: str, k: int):
    """Payloads of the filtered hashes, and of (hash, count) for what a slice holds several times."""
    def run(batches):
        often, size = [], 0

        def hashes():
            nonlocal size
            for part in slices(batches, text, SLICE):
                flat, _ = shingle_sets(part.column(text), k)
                values, counts = np.unique(flat, return_counts=True)
                take = counts >= LOCAL
                often.append(np.stack([values[take], counts[take].astype(np.uint64)], axis=1))
                size += len(often[-1])
                if size > HEAVY:
                    often[:] = [_summed(often)[:HEAVY // 2]]
                    size = len(often[0])
                yield mix(flat[flat < _FILTERED])
        yield from payloads(hashes())
        if size:
            rows = _summed(often)
            block = (mix(rows[:, 0]) & np.uint64(HEAVY_BLOCKS - 1)).astype(np.int32)
            full = np.unique(block)
            yield pa.RecordBatch.from_arrays(
                [pa.array(full + BLOCKS, pa.int32()), pa.array([rows[block == b].tobytes() for b in full], pa.binary())],
                names=["block", "payload"])
    return run


def _summed(parts: list[np.ndarray]) -> np.ndarray:
    """(hash, count) rows with the counts of equal hashes added up, largest first."""
    rows = np.concatenate(parts)
    values, where = np.unique(rows[:, 0], return_inverse=True)
    counts = np.bincount(where, weights=rows[:, 1], minlength=len(values)).astype(np.uint64)
    order = np.lexsort((values, -counts.astype(np.int64)))
    return np.stack([values[order], counts[order]], axis=1)


def _layers(levels: tuple[int, ...]):
    """Task code: the filter's layers of each block; of the blocks behind them the most frequent hashes."""
    fill = _fill(levels)

    def run(batches):
        heavy: dict[int, list] = {}

        def plain():
            for batch in batches:
                behind = batch.column(0).to_numpy() >= BLOCKS
                for block, payload in zip(*(c.to_pylist() for c in batch.filter(pa.array(behind)).columns)):
                    own = heavy.setdefault(block, [])
                    own.append(np.frombuffer(payload, np.uint64).reshape(-1, 2))
                    if sum(map(len, own)) > HEAVY:
                        own[:] = [_summed(own)[:HEAVY // 2]]
                if not behind.all():
                    yield batch.filter(pa.array(~behind))
        yield from fill(plain())
        if heavy:
            top = {b: _summed(own)[:HEAVY // HEAVY_BLOCKS] for b, own in heavy.items()}
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(top), pa.int32()),
                 pa.array([[rows[rows[:, 1] >= FREQUENT, 0].tobytes()] for rows in top.values()], pa.list_(pa.binary()))],
                names=["block", "layers"])
    return run


def _order_of(slim: DataFrame, k: int):
    """Broadcast (filter, sorted heavy hashes): of these at most ``HEAVY``, 2 MB, reach the driver."""
    spark = slim.sparkSession
    n = min(BLOCKS, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    levels = (2, FREQUENT)
    rows = (slim.select("text").mapInArrow(_sketch("text", k), PAYLOAD)
            .repartition(n, "block").sortWithinPartitions("block")
            .mapInArrow(_layers(levels), "block int, layers array<binary>").collect())
    heavy = np.frombuffer(b"".join(bytes(r.layers[0]) for r in rows if r.block >= BLOCKS), np.uint64)
    return Shared(spark, (SeenFilter([r for r in rows if r.block < BLOCKS], len(levels)), np.sort(heavy)))


def signature(grams: np.ndarray) -> np.ndarray:
    """SIGNATURE_BITS parities as int64 words."""
    bits = np.bincount((mix(grams) & np.uint64(SIGNATURE_BITS - 1)).astype(np.int64),
                       minlength=SIGNATURE_BITS) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def _prefixes(text: str, k: int, num: int, den: int, order_of):
    """One row a text; prefix, signature and shingles only where a tile may need them."""
    def run(batches):
        filt, heavy = order_of.value
        for part in slices(batches, text, SLICE):
            flat, offsets = shingle_sets(part.column(text), k)
            size = np.diff(offsets)
            rank = np.full(len(flat), 2, np.uint8)
            known = np.flatnonzero(flat < _FILTERED)
            key = mix(flat[known])
            rank[known] = np.where(filt.seen(key, 1), 3, np.where(filt.seen(key, 0), 1, 0))
            if len(heavy):
                rank[heavy[np.minimum(np.searchsorted(heavy, flat), len(heavy) - 1)] == flat] = 4
            alone = np.concatenate([[0], np.cumsum(rank == 0)])[offsets]
            need = size - -(-num * size // den) + 1
            prefix, sigs, grams, digests = [], [], [], []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                own = flat[a:b]
                digests.append(xxhash.xxh3_128_digest(own.tobytes()) if b > a else None)
                if b == a or alone[i + 1] - alone[i] >= need[i]:
                    prefix.append(None), sigs.append(None), grams.append(None)
                    continue
                first = np.argsort(rank[a:b], kind="stable")[:need[i]]
                first = first[rank[a:b][first] > 0]
                prefix.append(own[first].view(np.int64))
                sigs.append(signature(own))
                grams.append(own.astype("<u8").tobytes())
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("fp"), pa.array(size), pa.array(digests, pa.binary()),
                 pa.array(prefix, longs), pa.array(sigs, longs), pa.array(grams, pa.binary())],
                names=["id", "fp", "n", "node", "prefix", "sig", "grams"])
    return run


def _may_link(num: int, den: int, differ):
    """Whether sizes na, nb and that many differing bits leave room for a link."""
    overlap = F.floor((F.col("na") + F.col("nb") - differ) / 2)
    return F.lit(den) * overlap >= F.lit(num) * (F.col("na") + F.col("nb") - overlap)


def _exact(num: int, den: int):
    def run(batches):
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column("xa"), batch.column("xb"))):   # no copy of the arrays
                x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                at = np.searchsorted(x, y)
                at[at == len(x)] = 0
                both = int((x[at] == y).sum())
                if den * both >= num * (len(x) + len(y) - both):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))
            del batch
            release()
    return run


def _keys(batches):
    """Payloads of the prefix shingles."""
    def hashes():
        for batch in batches:
            yield mix(pc.list_flatten(batch.column("prefix")).to_numpy(zero_copy_only=False).view(np.uint64))
    yield from payloads(hashes())


def _shared_keys(filt):
    """(key, node, n) of the prefix shingles that the filter saw in several nodes."""
    def run(batches):
        for batch in batches:
            prefix = batch.column("prefix")
            key = pc.list_flatten(prefix).to_numpy(zero_copy_only=False)
            of = pc.list_parent_indices(prefix).to_numpy(zero_copy_only=False)
            keep = np.flatnonzero(filt.value.seen(mix(key.view(np.uint64))))
            of = pa.array(of[keep])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[keep]), batch.column("node").take(of), batch.column("n").take(of)],
                names=["key", "node", "n"])
            release()
    return run


def _links(pairs: DataFrame, column, num: int, den: int, compared: bool = False) -> DataFrame:
    """Those of ``pairs(a, b, na, nb)`` that link: signatures first (unless ``compared``), then sorted arrays.

    ``column(name, *more)`` gives (node, ...) without moving the nodes.  Only the arrays of b
    travel, with their pair, to those of the few a; a hot a is split by adaptive execution."""
    if not compared:
        pairs = pairs.join(column("sig").toDF("a", "sa"), "a").join(column("sig").toDF("b", "sb"), "b").where(
            _may_link(num, den, F.aggregate(
                F.zip_with("sa", "sb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)))
    near = stored(pairs.select("a", "b"), "near")
    firsts = near.select(F.col("a").alias("node")).distinct().join(column("grams"), "node").toDF("a", "xa")
    both = near.join(column("grams").toDF("b", "xb"), "b").join(firsts, "a")
    return both.select("a", "b", "xa", "xb").mapInArrow(_exact(num, den), "a binary, b binary")


def _across(num: int, den: int, nearest: bool):
    """Distinct pairs across components within a cell's tiles that sizes and signatures allow;
    with ``nearest`` only the likeliest of each node outside the largest component.

    Rows come sorted by (most, x, y, key): the cell compares block x with block y (within one if
    they are the same); ``main`` rows are of the tiles' largest component."""
    def out(parts):
        rows = pa.Table.from_batches(parts).combine_chunks()
        names = rows.column("node").combine_chunks().dictionary_encode()
        node = names.indices.to_numpy().astype(np.int64)
        label = rows.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
        n, main, key = (rows.column(c).to_numpy() for c in ("n", "main", "key"))
        block, x, y = rows.column("block").to_numpy(), rows.column("x")[0].as_py(), rows.column("y")[0].as_py()
        where = np.zeros(len(names.dictionary), np.int64)
        where[node] = np.arange(len(node))
        sig = rows.column("sig").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(n), -1)

        def near(found):
            """Pairs of ``found`` that the signatures leave, and what overlap they allow."""
            pairs = np.unique(np.concatenate(found))
            i, j = where[pairs >> 32], where[pairs & 0xFFFFFFFF]
            keep, score = [np.zeros(0, np.int64)], [np.zeros(0)]
            for a in range(0, len(pairs), 1 << 16):
                p, q = i[a:a + (1 << 16)], j[a:a + (1 << 16)]
                over = (n[p] + n[q] - np.bitwise_count(sig[p] ^ sig[q]).sum(axis=1, dtype=np.int64)) // 2
                ok = np.flatnonzero(den * over >= num * (n[p] + n[q] - over))
                keep.append(a + ok)
                score.append(over[ok] / (n[p] + n[q] - over)[ok])
            return pairs[np.concatenate(keep)], np.concatenate(score)

        kept, scores, found, size = [np.zeros(0, np.int64)], [np.zeros(0)], [], 0
        cuts = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            at = np.arange(a, b)
            left, right = at[block[a:b] == x], at[block[a:b] == y]
            for some in np.array_split(left, max(1, len(left) * len(right) // GATHER)):
                to = (label[some][:, None] != label[right]) & (
                    den * np.minimum(n[some][:, None], n[right]) >= num * np.maximum(n[some][:, None], n[right]))
                if x == y:
                    to &= right > some[:, None]
                i, j = np.nonzero(to)
                p, q = node[some[i]], node[right[j]]
                found.append(np.minimum(p, q) << 32 | np.maximum(p, q))
                size += len(i)
                if size > GATHER:
                    for both, more in zip((kept, scores), near(found)):
                        both.append(more)
                    found, size = [], 0
        if found:
            for both, more in zip((kept, scores), near(found)):
                both.append(more)
        pairs, first = np.unique(np.concatenate(kept), return_index=True)
        score = np.concatenate(scores)[first]
        i, j = where[pairs >> 32], where[pairs & 0xFFFFFFFF]
        if nearest and len(i):
            outside = np.where(main[i], j, i)
            order = np.lexsort((-score, outside))
            first = order[np.append(True, outside[order][1:] != outside[order][:-1])]
            i, j = i[first], j[first]
        take = rows.column("node").combine_chunks().take
        return pa.RecordBatch.from_arrays(
            [take(pa.array(i)), take(pa.array(j)), pa.array(n[i]), pa.array(n[j])],
            names=["a", "b", "na", "nb"])

    def run(batches):
        now, parts = None, []
        for batch in batches:
            cells = list(zip(*(batch.column(c).to_pylist() for c in ("most", "x", "y"))))
            a = 0
            for i in range(batch.num_rows + 1):
                if i == batch.num_rows or cells[i] != now:
                    if i > a:
                        parts.append(batch.slice(a, i - a))
                    a = i
                    if i < batch.num_rows:
                        if parts:
                            yield out(parts)
                        now, parts = cells[i], []
        if parts:
            yield out(parts)
        release()
    return run


def _open_pairs(tiles: DataFrame, labels: DataFrame, column, num: int, den: int,
                nearest: bool) -> DataFrame:
    """(a, b, na, nb) of tiles that hold several components of ``labels(node, label)``.

    All tiles in which the same component is the most frequent are worked on together, so a pair that shares
    many tiles comes out once.  Their nodes are dealt into blocks of some ``CHUNK``, those of that
    component first, and every cell of two blocks is one piece of work: none holds more than two
    blocks, whatever links there are."""
    named = tiles.join(labels, "node", "left").select(
        "key", "node", "n", F.coalesce("label", "node").alias("label"))
    counts = named.groupBy("key", "label").agg(F.count("*").alias("c"))
    mixed = (counts.groupBy("key").agg(F.max(F.struct("c", "label")).alias("top"),
                                       F.count("*").alias("labels")).where("labels > 1")
             .select("key", F.col("top.label").alias("most")))
    rows = named.join(mixed, "key").withColumn("main", F.col("label") == F.col("most"))
    # how many blocks of the component and of other nodes; few nodes are one block
    many = lambda main: F.ceil(F.approx_count_distinct(
        F.when(F.col("main") == main, F.col("node"))) / CHUNK).cast("int")
    sizes = (rows.groupBy("most").agg(many(True).alias("c"), many(False).alias("g"))
             .select("most", F.when((F.col("c") == 1) & (F.col("g") == 1), 0).otherwise(F.col("c")).alias("c"),
                     F.greatest("g", F.lit(1)).alias("g")))
    at = F.xxhash64("node")
    block = F.when(F.col("main") & (F.col("c") > 0), F.pmod(at, F.col("c"))).otherwise(
        F.col("c") + F.pmod(at, F.col("g"))).cast("int")
    last = F.col("c") + F.col("g") - 1
    cell = lambda x, y: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"))
    own = F.col("block")
    cells = F.when(own < F.col("c"), F.transform(F.sequence(F.col("c"), last), lambda i: cell(own, i))).otherwise(
        F.transform(F.sequence(F.lit(0), last), lambda i: cell(F.least(i, own), F.greatest(i, own))))
    rows = (rows.join(sizes, "most").withColumn("block", block).withColumn("cell", F.explode(cells))
            .select("key", "node", "n", "label", "most", "main", "block", "cell.x", "cell.y")
            .join(column("sig"), "node"))
    swap = F.col("a") > F.col("b")
    return (rows.repartition("most", "x", "y").sortWithinPartitions("most", "x", "y", "key")
            .select("most", "x", "y", "key", "node", "n", "label", "main", "block", "sig")
            .mapInArrow(_across(num, den, nearest), "a binary, b binary, na long, nb long")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                    F.when(swap, F.col("nb")).otherwise(F.col("na")).alias("na"),
                    F.when(swap, F.col("na")).otherwise(F.col("nb")).alias("nb"))
            .distinct())


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100,
                       ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp, n_shingles, component_id, kept) for each row of ``docs``: the id column under its own name, a hash of
    the text, the set's size, the smallest id that links of ``den * intersection >= num * union``
    reach (the own id where there is no set), and whether (id, fp) is the component's first.

    Other columns of ``docs`` are not read; an empty table gives an empty table.
    """
    if not 0 < num <= den:
        raise ValueError("the similarity num / den must be over 0 and at most 1")
    kind = docs.schema[ident].dataType.simpleString()
    slim = docs.select(F.col(ident).alias("id"), F.col(text).alias("text"),
                       F.xxhash64(F.col(text)).alias("fp"))
    order_of = _order_of(slim, k)
    sets = bucketed(slim.mapInArrow(
        _prefixes("text", k, num, den, order_of),
        f"id {kind}, fp long, n long, node binary, prefix array<long>, sig array<long>, grams binary"),
        "sets", "node")

    def column(*names):
        """Each node once with these columns; the sets are dealt by node, so nothing moves."""
        return (sets.where("prefix IS NOT NULL").groupBy("node")
                .agg(*[F.first(c).alias(c) for c in names]))

    band = F.floor(F.log("n") / math.log(den / num)) if num < den else F.col("n")
    # prefix shingles of one node make no tile: most go without moving
    prefixes = column("n", "prefix").select("node", "n", "prefix")
    several = seen_filter(prefixes.select("prefix").mapInArrow(_keys, PAYLOAD))
    tiles = stored(prefixes.mapInArrow(_shared_keys(several), "key long, node binary, n long")
                   .select("key", "node", "n", band.cast("long").alias("band")), "tiles")

    # 1: each node with the smallest of its tile
    pivots = (tiles.groupBy("key", "band")
              .agg(F.min(F.struct("node", "n")).alias("p"), F.count("*").alias("m")).where("m > 1"))
    stars = (tiles.join(pivots, ["key", "band"]).where("node <> p.node")
             .groupBy(F.col("node").alias("b"), F.col("n").alias("nb")).agg(F.min("p").alias("p"))
             .select(F.col("p.node").alias("a"), "b", F.col("p.n").alias("na"), "nb"))
    labels = components(stored(_links(stars, column, num, den), "links"))

    # 2: pairs across components, in tiles that hold several
    for nearest in (True, False):
        late = stored(_links(_open_pairs(tiles, labels, column, num, den, nearest), column, num, den, True),
                      "links")
        if not late.isEmpty():
            labels = components(late.union(labels.toDF("a", "b")))

    placed = (sets.select("id", "fp", "n", "node").join(labels, "node", "left")
              .withColumn("label", F.coalesce("label", "node")))
    first = F.min(F.struct(F.col("id").isNull(), "id", "fp"))
    least = placed.where("label IS NOT NULL").groupBy("label").agg(first.alias("least"))
    return placed.join(least, "label", "left").select(
        F.col("id").alias(ident), "fp", F.col("n").alias("n_shingles"),
        F.coalesce("least.id", "id").alias("component_id"),
        (F.col("least").isNull() | (F.col("id").eqNullSafe(F.col("least.id"))
                                    & (F.col("fp") == F.col("least.fp")))).alias("kept"))


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, ident: str = "doc_id",
             text: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id (ties: by a hash of the
    text); rows without any word are linked with nothing and all stay.  Columns unchanged."""
    has_set = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    first = (jaccard_components(docs.where(has_set), k, num, den, ident, text).where("kept")
             .select(F.col(ident).alias("__id"), F.col("fp").alias("__fp")).distinct())
    keyed = docs.where(has_set).withColumn("__own", F.xxhash64(text))
    kept = (keyed.join(first, keyed[ident].eqNullSafe(first["__id"]) & (keyed["__own"] == first["__fp"]),
                       "left_semi").dropDuplicates([ident, "__own"]).drop("__own"))
    return kept.unionByName(docs.where(~has_set))


def jaccard_digest(docs: DataFrame) -> DataFrame:
    """What op6 returns."""
    return jaccard_components(docs, 4, 85, 100).select("doc_id", "n_shingles", "component_id")


#: The same in SQL (DuckDB).
ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
  FROM s AS a JOIN s AS b USING (t) WHERE a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM pair JOIN n AS nx ON x = nx.doc_id JOIN n AS ny ON y = ny.doc_id
  WHERE 100 * i >= 85 * (nx.n + ny.n - i)),
e AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT doc_id, y FROM reach JOIN e ON r = x)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""
