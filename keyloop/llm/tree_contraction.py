"""Subtree totals of a forest by parallel tree contraction, in join rounds.

Each round rakes all leaves (their totals go to their parents in one aggregate, partial before
the shuffle, so a node with very many children is no hot key) and compresses unary chains: of the
nodes with one child an independent set is spliced out, the child taking over the parent, and the
totals of what lies between wait on the child's edge.  When only roots are left, the rounds are
gone through backwards and every spliced node gets its total from the child it was spliced onto.
A chain of n nodes takes O(log n) rounds, as does a tree of any shape in expectation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloop.llm.ordering import equal
from keyloop.llm.text import stored


def _coin(round_: int, ident: Sequence[str], depth: str) -> Column:
    """Whether a unary node may be spliced: by a bit of its depth (every other node of an unbroken
    chain) in even rounds, by chance in odd ones."""
    if round_ % 2 == 0:
        return F.shiftright(F.col(depth), min(round_ // 2, 62)).bitwiseAND(F.lit(1).cast("long")) == 1
    return F.pmod(F.xxhash64(*ident, F.lit(round_)), F.lit(2)) == 1


def subtree_totals(nodes: DataFrame, ident: Sequence[str], parent: Sequence[str], depth: str,
                   kids: str, values: Sequence[str]) -> DataFrame:
    """(*ident, *values): for each node the sums of ``values`` over its subtree, itself included.

    ``nodes`` has one row a node: its id, its parent's id (null for a root), its depth (a bigint), its number of
    children and the values (bigint).  An empty table gives an empty table.
    """
    ident, parent, values = list(ident), list(parent), list(values)
    up = [f"__p_{c}" for c in ident]            # parent's id
    own, edge = [f"__a_{v}" for v in values], [f"__e_{v}" for v in values]
    child = [f"__u_{c}" for c in ident]
    active = nodes.select(*ident, *[F.col(p).alias(u) for p, u in zip(parent, up)],
                          F.col(depth).cast("long").alias("__d"), F.col(kids).cast("long").alias("__n"),
                          *[F.col(v).cast("long").alias(a) for v, a in zip(values, own)],
                          *[F.lit(0).cast("long").alias(e) for e in edge])
    is_root = F.col(up[0]).isNull()
    leaves, spliced, round_ = [], [], 0
    while True:
        active = stored(active, "contract-nodes")
        leaves.append(active.where("__n = 0").select(*ident, *[F.col(a).alias(v) for a, v in zip(own, values)]))
        if active.where("__n > 0").isEmpty():
            break
        # rake and look at the only child: one row to the node itself, one to its parent
        chosen = (F.col("__n") == 1) & ~is_root & _coin(round_, ident, "__d")
        none = F.lit(None).cast("long")
        state = [*up, "__d", "__n", *own, *edge]
        to_self = active.where("__n > 0").select(
            *ident, *state, chosen.alias("__chosen"), *[none.alias(f"__l_{v}") for v in values],
            *[F.lit(None).cast(active.schema[c].dataType).alias(u) for c, u in zip(ident, child)],
            *[none.alias(f"__ue_{v}") for v in values], F.lit(None).cast("boolean").alias("__kept"),
            F.lit(0).alias("__live"))
        leaf = F.col("__n") == 0
        to_parent = active.where(~is_root).select(
            *[F.col(u).alias(c) for u, c in zip(up, ident)],
            *[F.lit(None).cast(active.schema[c].dataType).alias(c) for c in state],
            F.lit(None).cast("boolean").alias("__chosen"),
            *[F.when(leaf, F.col(a) + F.col(e)).alias(f"__l_{v}") for v, a, e in zip(values, own, edge)],
            *[F.when(~leaf, F.col(c)).alias(u) for c, u in zip(ident, child)],
            *[F.when(~leaf, F.col(e)).alias(f"__ue_{v}") for v, e in zip(values, edge)],
            F.when(~leaf, ~chosen).alias("__kept"), F.when(leaf, 0).otherwise(1).alias("__live"))
        # of each maximum there is one value, or (children, if several are left) none is used
        once = [*state, "__chosen", *child, *[f"__ue_{v}" for v in values], "__kept"]
        seen = stored(
            to_self.unionByName(to_parent).groupBy(*ident).agg(
                *[F.max(c).alias(c) for c in once], *[F.sum(f"__l_{v}").alias(f"__l_{v}") for v in values],
                F.sum("__live").alias("__live")), "contract-round")
        out = F.col("__chosen") & (F.col("__live") == 1) & F.col("__kept")
        gone = seen.where(out)
        spliced.append(gone.select(*ident, *child, *[
            (F.col(a) + F.col(f"__ue_{v}")).alias(v) for v, a in zip(values, own)]))
        moved = gone.select(*[F.col(u).alias(f"__m_{c}") for u, c in zip(child, ident)],
                            F.struct(*up, *[(F.col(a) + F.col(e)).alias(e) for a, e in zip(own, edge)]).alias("__to"))
        rest = seen.where(~out)
        on = F.lit(True)
        for c in ident:
            on = on & (rest[c] == moved[f"__m_{c}"])
        to = F.col("__to")
        active = rest.join(moved, on, "left").select(
            *ident, *[F.when(to.isNotNull(), to[u]).otherwise(F.col(u)).alias(u) for u in up], "__d",
            F.col("__live").cast("long").alias("__n"),
            *[(F.col(a) + F.coalesce(F.col(f"__l_{v}"), F.lit(0))).alias(a) for v, a in zip(values, own)],
            *[(F.col(e) + F.coalesce(to[e], F.lit(0))).alias(e) for e in edge])
        round_ += 1
    known = leaves[-1]
    for r in range(round_ - 1, -1, -1):
        if not spliced[r].isEmpty():
            below = known.select(*[F.col(c).alias(f"__k_{c}") for c in ident],
                                 *[F.col(v).alias(f"__k_{v}") for v in values])
            on = F.lit(True)
            for c, u in zip(ident, child):
                on = on & (spliced[r][u] == below[f"__k_{c}"])
            known = known.unionByName(stored(spliced[r].join(below, on).select(
                *ident, *[(F.col(v) + F.col(f"__k_{v}")).alias(v) for v in values]), "expand-round"))
        known = known.unionByName(leaves[r])
    return known
