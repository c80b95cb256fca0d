"""Mixing sources to target weights, exact to the word.

Method: every document gets a hash-random key; the documents of each source are range-sorted by
it, distributed prefix sums of their word counts give each its place in the source's order, and
the order is cut where the source's budget ends.  A budget above the source's size repeats whole
epochs first.  Only ids, keys and counts are sorted; the cuts, one row a source, then go to the
documents, whose texts are never shuffled.

Targets: a share of all words is divided by weight; no source gives more than ``most`` times
its size, and what it cannot give is divided again among the others, until none is above.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloop.llm.ordering import RANGE, dealt, equal, running
from keyloop.llm.text import stored, without

#: Sources up to which the cuts (some 100 bytes each) are broadcast; more are joined, salted.
BROADCAST_SOURCES = 100_000
SALTS = 32
_SPACE = r"\x20\x09-\x0D"
_ADDED = ("size", "source_size", "target", "taken")


def word_count(text: str | Column) -> Column:
    """Maximal runs of characters other than 20, 09-0D (hex); 0 for a null."""
    bare = F.ltrim(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")),
                   F.lit(" \t\n\x0b\x0c\r"))
    return F.length(F.regexp_replace(bare, f"[^{_SPACE}]+[{_SPACE}]*", "w")).cast("long")


def shares(sources: DataFrame, share: float, most: float) -> DataFrame:
    """``sources`` (source_size, weight) with ``target``.

    Each step divides what is left by weight and fixes the sources that would be above
    their limit; one aggregate to one row a step, at most as many steps as sources (a few).
    """
    left = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    amount, weight, fixed, full = left, None, -1, F.lit(False)
    while True:
        now = sources.agg(F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("weight"))),
                          F.count(F.when(full, 1))).first()
        if now[2] == fixed:
            break
        fixed, left, weight = now[2], amount - most * (now[0] or 0), float(now[1] or 0)
        if not weight:
            break
        full = F.lit(left) * F.col("weight") / F.lit(weight) > most * F.col("source_size")
    own = F.lit(left) * F.col("weight") / F.lit(weight) if weight else F.lit(0.0)
    return sources.withColumn("target", F.when(full, most * F.col("source_size")).otherwise(own).cast("double"))


def mix_plan(docs: DataFrame, weights: Sequence[float] | Mapping[str | None, float] = (5, 2, 1),
             share: float = 1.5, most: float = 2.0, ident: str = "doc_id", source: str = "source",
             size: str = "size", seed: int = 0) -> DataFrame:
    """One row a source: source, source_size, target, epochs (times all its words are taken), rest
    (words of the last, partial epoch) and ``cut`` (key, id, size and words of the document in
    which it ends; null if there is no rest).

    ``weights``: by name (0 for others), or a sequence that repeats along the sources in code
    point order, null last.  Documents of one id and size in a source are one group: its part of
    the rest is divided evenly, rounded down.
    """
    slim = docs.select(F.col(source).alias("source"), F.col(ident).alias("id"), F.col(size).alias("size"),
                       mix_key(ident, seed).alias("key"))
    groups = slim.groupBy("source", "key", "id", "size").agg(F.count(F.lit(1)).alias("n"))
    order = [F.asc("key"), F.asc_nulls_first("id"), F.asc("size")]
    groups = dealt(groups, [F.col("source"), *order], "mix-order")
    sources = dealt(groups.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")),
                    [F.asc_nulls_last("source")], "mix-sources")
    if isinstance(weights, Mapping):
        weight = F.lit(0.0)
        for name, w in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(weight)
        sources = sources.withColumn("weight", weight)
    else:
        sources = running(sources, [], [F.asc_nulls_last("source")], F.lit(1), "__at").withColumn(
            "weight", F.array(*[F.lit(float(w)) for w in weights])[(F.col("__at") % len(weights)).cast("int")])
    plan = shares(stored(sources.select("source", "source_size", "weight"), "mix-weights"), share, most)
    budget = F.floor("target").cast("long")
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size")))
                           .otherwise(0).cast("long"))
    plan = stored(plan.withColumn("rest", budget - F.col("epochs") * F.col("source_size")).drop("weight"), "mix-targets")
    places = running(groups, ["source"], order, F.col("n") * F.col("size"), "begin")
    rest = plan.select(F.col("source").alias("__source"), "rest").where("rest > 0")
    cuts = (places.join(_small(rest, plan), places["source"].eqNullSafe(rest["__source"]))
            .where("begin < rest and rest <= begin + n * size")
            .select("__source", F.struct(
                "key", "id", "size", F.floor((F.col("rest") - F.col("begin")) / F.col("n")).cast("long").alias("words"))
                .alias("cut")))
    return stored(plan.join(cuts, plan["source"].eqNullSafe(cuts["__source"]), "left").drop("__source"), "mix-cuts")


def _small(part: DataFrame, plan: DataFrame) -> DataFrame:
    return F.broadcast(part) if plan.count() <= BROADCAST_SOURCES else part


def mix_key(ident: str, seed: int = 0) -> Column:
    """The hash-random key of an id (null: as the empty text)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(ident).cast("string"), F.lit(""))))


def mix(docs: DataFrame, weights: Sequence[float] | Mapping[str | None, float] = (5, 2, 1),
        share: float = 1.5, most: float = 2.0, ident: str = "doc_id", text: str = "text",
        source: str = "source", size: str | None = None, seed: int = 0,
        broadcast_sources: int = BROADCAST_SOURCES) -> DataFrame:
    """``docs`` with size (its words, or the column ``size``), source_size, target (its source's)
    and taken: how many of its words the mix takes, repeats counted.

    The taken words of a source add up to its target, rounded down (less the rounding of repeated
    rows that share the cut); a document is taken whole as often as its source has full epochs, once
    more where it lies before the cut, and in part (its first words) where the cut lies in it.
    A null source is a source of its own; null or empty texts have size 0 and take nothing; a null id
    is ordered as an empty one; ties are ordered by id, then size.  An empty table gives
    an empty table.  Columns of the added names are replaced, all others pass through.  The same input
    gives the same result, however it is split.
    """
    counted = F.col(size).cast("long") if size else word_count(text)
    docs = docs.withColumn("__size", counted).transform(lambda d: without(d, *_ADDED)).withColumnRenamed("__size", "size")
    plan = mix_plan(docs, weights, share, most, ident, source, "size", seed)
    plan = plan.select(F.col("source").alias("__source"), F.struct(
        "source_size", "target", "epochs", "cut").alias("__plan"))  # one name: docs may hold any other
    keyed = docs.withColumn("__key", mix_key(ident, seed))
    if plan.count() <= broadcast_sources:
        both = keyed.join(F.broadcast(plan), keyed[source].eqNullSafe(plan["__source"]), "left")
    else:
        keyed = keyed.withColumn("__salt", F.pmod(F.xxhash64("__key"), F.lit(SALTS)))
        plan = plan.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        both = keyed.join(plan, keyed[source].eqNullSafe(plan["__source"]) & (keyed["__salt"] == plan["__salt"]), "left")
    me = F.struct(F.col("__key").alias("key"), F.col(f"`{ident}`").alias("id"), F.col("size").alias("size"))
    cut = F.struct("__plan.cut.key", "__plan.cut.id", "__plan.cut.size")
    last = (F.when(F.col("__plan.cut").isNull(), 0).when(me < cut, F.col("size"))
            .when(me == cut, F.col("__plan.cut.words")).otherwise(0))
    taken = (F.col("__plan.epochs") * F.col("size") + last).cast("long")
    return both.select(*[F.col(f"`{c}`") for c in docs.columns], "__plan.source_size", "__plan.target",
                       taken.alias("taken"))


def mixed_texts(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix itself: a row for every time a document is taken, with ``epoch`` (from 0); a document
    that the cut divides ends after its last taken word.  Takes the options of ``mix``."""
    both = without(mix(docs, text=text, **options), "epoch").where("taken > 0")
    times = F.ceil(F.col("taken") / F.col("size")).cast("int")
    rows = both.withColumn("epoch", F.explode(F.sequence(F.lit(0), times - 1)))
    words = F.col("taken") - F.col("epoch") * F.col("size")
    # pieces end where a word does, so the first pieces are the text up to the last word taken
    pieces = F.split(F.col(text), f"(?<=[^{_SPACE}])(?=[{_SPACE}])", (words + 1).cast("int"))
    part = F.array_join(F.slice(pieces, F.lit(1), words.cast("int")), "")
    return rows.withColumn(text, F.when(words < F.col("size"), part).otherwise(F.col(text)))


def mix_digest(docs: DataFrame) -> DataFrame:
    """What op11 returns: weights 5, 2, 1 along the sources, 150 % of all words, twice at most."""
    sized = stored(docs.select("doc_id", "source", word_count("text").alias("size")), "mix-sizes")
    return mix(sized, size="size").select("doc_id", "size", "source_size", "target", "taken")


#: The same in SQL (DuckDB).
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('0:' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
  FROM sized GROUP BY source),
tried AS (
  SELECT *, 1.5::DOUBLE * (sum(source_size) OVER ())
            - 2 * coalesce(sum(source_size) OVER (ORDER BY source_size / w, source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
         sum(w) OVER (ORDER BY source_size / w, source NULLS LAST
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws,
         row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS nr
  FROM sources),
level AS (
  SELECT arg_min(lft, nr) AS lft, arg_min(ws, nr) AS ws, min(nr) AS nr
  FROM tried WHERE lft * w / ws <= 2 * source_size),
targets AS (
  SELECT source, source_size,
    CASE WHEN l.nr IS NULL OR t.nr < l.nr THEN 2.0::DOUBLE * source_size ELSE l.lft::DOUBLE * w / l.ws::DOUBLE END AS target
  FROM tried t, level l),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs FROM targets),
grouped AS (
  SELECT source, k, doc_id, size, count(*) AS n,
    coalesce(sum(count(*) * size) OVER (PARTITION BY source ORDER BY k, doc_id NULLS FIRST, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized GROUP BY source, k, doc_id, size)
SELECT s.doc_id, s.size::BIGINT AS size, b.source_size, b.target,
  (epochs * s.size + greatest(0, least(n * s.size, floor(target)::BIGINT - epochs * source_size - start)) // n)::BIGINT AS taken
FROM sized s
JOIN budgets b ON b.source IS NOT DISTINCT FROM s.source
JOIN grouped g ON g.source IS NOT DISTINCT FROM s.source AND g.k = s.k
  AND g.doc_id IS NOT DISTINCT FROM s.doc_id AND g.size = s.size
"""
