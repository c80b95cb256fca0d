"""The trie of all prefixes of conversations, with totals of every subtree.

Turns get their place by a range sort; a prefix is known by its depth and two 64-bit sums
(exclusive or) of hashes of its turns and their places, so prefixes are running sums and no
conversation is gathered into a row.  Totals of subtrees come from tree contraction (rake and
compress in join rounds, then re-expansion; ``tree_contraction``).  Texts never leave the
first scan: what moves are hashes, lengths and ids.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyloop.llm.ordering import RANGE, dealt, running
from keyloop.llm.text import stored
from keyloop.llm.tree_contraction import subtree_totals

#: First turns that a conversation may take over from its template at most.
SHARED = 5
#: Ids whose list is one row: those that agree but for the last 16 bits.
_CHUNK_BITS = 16
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def placed_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), role, mark (of the text), n_chars, and the number of the key range.

    Turns are ordered by turn (null first), then role, then the MD5 of the text; equal turns stay
    apart, each with a place of its own.  Rows without a conv_id belong to no conversation.
    """
    text = F.coalesce("text", F.lit(""))
    slim = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.md5(text.cast("binary")).alias("mark"), F.length(text).cast("long").alias("n_chars"))
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("mark")]
    ranges = dealt(slim, [F.col("conv_id"), *order], "trie-turns")
    return running(ranges, ["conv_id"], order, F.lit(1), "__before").select(
        "conv_id", (F.col("__before") + 1).cast("long").alias("pos"), "role", "mark", "n_chars", RANGE)


def _hashes(depth, role, mark):
    """Two hashes of a turn at its place."""
    return F.xxhash64(depth, mark, role), F.xxhash64(role, mark, depth, F.lit(1))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, members) after each conversation c has taken over the first h turns of
    conversation c - c % 100 (h = crc32(decimal c) % 6), followed by its own after the first h.

    conversations: c, last (its depth).  members: c, last, depth, the prefix (x1, x2), the prefix
    before it (p1, p2), n_chars of its last text; one row for each turn.
    """
    n = F.count(F.lit(1))
    parts = turns.groupBy("conv_id", RANGE).agg(n.alias("n"))
    convs = parts.groupBy("conv_id").agg(F.sum("n").alias("n"), n.alias("n_ranges")).select(
        "*", F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(SHARED + 1)).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % 100).alias("template"))
    heads = (turns.where((F.col("pos") <= SHARED) & (F.col("conv_id") % 100 == 0))
             .groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "role", "mark", "n_chars"))).alias("all"))
             .select(F.col("conv_id").alias("template"), "all"))   # at most five turns
    convs = convs.join(heads, "template", "left")
    head = F.when(F.col("all").isNull() | (F.col("h") == 0), F.array().cast(heads.schema["all"].dataType)).otherwise(
        F.slice("all", F.lit(1), F.col("h").cast("int")))
    xor = lambda which: F.transform(F.col("head"), lambda t: F.aggregate(
        F.slice("head", F.lit(1), t["pos"].cast("int")), F.lit(0).cast("long"),
        lambda acc, s: acc.bitwiseXOR(_hashes(s["pos"], s["role"], s["mark"])[which])))
    convs = (convs.withColumn("head", head).withColumn("k", F.size("head").cast("long"))
             .withColumn("last", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
             .withColumn("x1s", xor(0)).withColumn("x2s", xor(1)))
    convs = stored(convs.select("conv_id", "n_ranges", "h", "k", "last", "head", "x1s", "x2s"), "trie-conversations")
    zero = F.lit(0).cast("long")
    i = F.col("depth").cast("int")
    shared = (convs.where("k > 0").withColumn("depth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("k"))))
              .select("conv_id", "last", "depth", F.get("x1s", i - 1).alias("x1"), F.get("x2s", i - 1).alias("x2"),
                      F.coalesce(F.get("x1s", i - 2), zero).alias("p1"), F.coalesce(F.get("x2s", i - 2), zero).alias("p2"),
                      F.get("head", i - 1)["n_chars"].alias("n_chars")))
    # own turns: by conversation and key range, so that a long conversation stays in pieces
    own_x = [F.coalesce(F.get(c, F.col("k").cast("int") - 1), zero) for c in ("x1s", "x2s")]
    info = parts.select("conv_id", RANGE).join(
        convs.select("conv_id", "n_ranges", "h", "k", "last", own_x[0].alias("b1"), own_x[1].alias("b2")), "conv_id")
    own = turns.join(info, ["conv_id", RANGE]).where("pos > h").withColumn("depth", F.col("pos") - F.col("h") + F.col("k"))
    t1, t2 = _hashes(F.col("depth"), F.col("role"), F.col("mark"))
    own = own.withColumn("t1", t1).withColumn("t2", t2)
    w = Window.partitionBy("conv_id", RANGE).orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    along = Window.partitionBy("conv_id").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    # conversations in several ranges: at most one crosses each border of ranges
    before = (own.where("n_ranges > 1").groupBy("conv_id", RANGE).agg(
        F.bit_xor("t1").alias("o1"), F.bit_xor("t2").alias("o2"))
        .select("conv_id", RANGE, F.bit_xor("o1").over(along).alias("o1"), F.bit_xor("o2").over(along).alias("o2")))
    own = own.select("*", F.bit_xor("t1").over(w).alias("r1"), F.bit_xor("t2").over(w).alias("r2")).join(
        F.broadcast(before), ["conv_id", RANGE], "left")
    full = [F.col(f"b{j}").bitwiseXOR(F.col(f"r{j}")).bitwiseXOR(F.coalesce(f"o{j}", zero)) for j in (1, 2)]
    own = own.select("conv_id", "last", "depth", full[0].alias("x1"), full[1].alias("x2"),
                     full[0].bitwiseXOR(F.col("t1")).alias("p1"), full[1].bitwiseXOR(F.col("t2")).alias("p2"), "n_chars")
    return convs.select("conv_id", "last"), stored(shared.unionByName(own), "trie-members")


def _ends_hash(batches):
    """SHA-256 of the lists of one node after another, chunk by chunk; rows come sorted."""
    node, state = None, None
    names = ["depth", "x1", "x2", "ends_sha256"]

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(
            (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=names)

    for batch in batches:
        done = []
        for d, x1, x2, ids in zip(*[batch.column(c).to_pylist() for c in ("depth", "x1", "x2", "ids")]):
            if (d, x1, x2) != node:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (d, x1, x2), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield table(done)
    if node is not None:
        yield table([(*node, state.hexdigest())])


def _with_parent(nodes: DataFrame, hot_share: int = 1000) -> DataFrame:
    """``nodes`` with parent_conv_id.  Parents with very many children, fewer than ``hot_share`` by their
    definition, are broadcast, so that no join key has more rows than the bound."""
    limit = max(1000, nodes.count() // hot_share)
    names = {"depth": "q_depth", "x1": "p1", "x2": "p2", "conv_id": "parent_conv_id"}
    parents = nodes.where("n_children > 0").select("depth", "x1", "x2", "conv_id", "n_children").withColumnsRenamed(names)
    keyed = nodes.withColumn("q_depth", F.col("depth") - 1)
    on = ["q_depth", "p1", "p2"]
    hot = parents.where(F.col("n_children") > limit).drop("n_children").withColumnRenamed("parent_conv_id", "hot_parent")
    marked = keyed.join(F.broadcast(hot), on, "left")
    found = marked.where("hot_parent is not null").withColumnRenamed("hot_parent", "parent_conv_id")
    rest = marked.where("hot_parent is null").drop("hot_parent").join(
        parents.where(F.col("n_children") <= limit).drop("n_children"), on, "left")
    return found.unionByName(rest).drop(*on)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of the rebuilt conversations (``rebuilt``): conv_id (smallest member),
    depth, parent_conv_id (null for the root), n_convs (members), n_children, n_leaves and saved_tokens
    (sums over the subtree: childless nodes; code points of the node's last text for each member
    but one) and ends_sha256 (of the ids of the members that end here, ascending, comma-joined).

    Null roles and texts count as empty, null turns come first, equal turns of a conversation are turns
    of their own (see ``placed_turns``), rows with a null conv_id belong to no conversation and other
    columns play no part.  A conversation may be turnless after the exchange; it ends at the root.
    An empty table has no root: the result is empty.
    """
    convs, members = rebuilt(placed_turns(conversations))
    n = F.count(F.lit(1))
    key = ["depth", "x1", "x2"]
    inner = members.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), n.alias("n_convs"), F.max("n_chars").alias("n_chars"),
                                      F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), n.alias("n_convs")).where("n_convs > 0").select(
        *[zero.alias(c) for c in key], "conv_id", "n_convs", zero.alias("n_chars"),
        F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"))
    plain = stored(inner.unionByName(root), "trie-prefixes")
    kids = plain.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"),
                                            F.col("p2").alias("x2")).agg(n.alias("n_children"))
    nodes = stored(plain.join(kids, key, "left").withColumn("n_children", F.coalesce("n_children", zero)), "trie-nodes")
    nodes = stored(_with_parent(nodes), "trie-parents")

    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    ends = members.where("depth = last").select(*key, "conv_id").unionByName(
        convs.where("last = 0").select(*[zero.alias(c) for c in key], "conv_id"))
    chunks = (ends.groupBy(*key, F.shiftright("conv_id", _CHUNK_BITS).alias("chunk")).agg(ids.alias("ids"))
              .repartition(*key).sortWithinPartitions(*key, "chunk").select(*key, "ids"))
    hashed = chunks.mapInArrow(_ends_hash, "depth long, x1 long, x2 long, ends_sha256 string")

    saved = (F.col("n_convs") - 1) * F.col("n_chars")
    tree = nodes.select("conv_id", "depth", "parent_conv_id",
                        F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1).alias("parent_depth"),
                        "n_children", (F.col("n_children") == 0).cast("long").alias("n_leaves"), saved.alias("saved_tokens"))
    totals = subtree_totals(tree, ["conv_id", "depth"], ["parent_conv_id", "parent_depth"], "depth", "n_children",
                            ["n_leaves", "saved_tokens"])
    return (nodes.join(totals, ["conv_id", "depth"]).join(hashed, key, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256")))


#: The same in SQL (DuckDB): conversations as lists of turns; crc32 bit by bit.
ORACLE = r"""
WITH turns AS (
  SELECT conv_id AS c, role, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL)),
sizes AS (SELECT c, count(*) AS n FROM turns GROUP BY c),
convs AS (
  SELECT c, c - c % 100 AS template, xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda y, z: xor(y >> 1, (y & 1) * 3988292384)))) % 6 AS h
  FROM sizes),
built AS (
  SELECT v.c, t.pos AS d, t.role, t.text FROM convs v JOIN turns t ON t.c = v.template AND t.pos <= v.h
  UNION ALL
  SELECT v.c, t.pos - v.h + least(v.h, coalesce(s.n, 0)), t.role, t.text
  FROM convs v JOIN turns t ON t.c = v.c AND t.pos > v.h LEFT JOIN sizes s ON s.c = v.template),
paths AS (
  SELECT v.c, coalesce(p, []) AS p FROM convs v
  LEFT JOIN (SELECT c, list([role, text] ORDER BY d) AS p FROM built GROUP BY c) USING (c)),
members AS (SELECT c, len(p) AS n, d, list_slice(p, 1, d) AS k FROM paths, unnest(range(0, len(p) + 1)) AS u(d)),
nodes AS (
  SELECT k, d AS depth, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256,
    (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE length(k[d][2]) END AS own
  FROM members GROUP BY k, d),
kids AS (SELECT list_slice(k, 1, depth - 1) AS k, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (k)),
sums AS (
  SELECT list_slice(k, 1, e) AS k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(own)::BIGINT AS saved_tokens
  FROM full_nodes, unnest(range(0, depth + 1)) AS u(e) GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s USING (k)
LEFT JOIN nodes p ON n.depth > 0 AND p.k = list_slice(n.k, 1, n.depth - 1)
"""
