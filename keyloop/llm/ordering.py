"""Places and running sums in a total order, without any task that sees a whole group.

``dealt`` cuts the rows into key ranges and writes them with the number of their range;
``running`` adds up within each range of a group and adds what the group's earlier ranges hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyloop.llm.text import stored

RANGE = "__range"


def dealt(df: DataFrame, by: Sequence[Column], name: str) -> DataFrame:
    """The rows in ranges of ``by`` with the range's number as ``__range``, written to the shared
    folder: the ranges come from a sample of the keys, so they must not be drawn twice."""
    return stored(df.repartitionByRange(*by).withColumn(RANGE, F.spark_partition_id()), name)


def equal(a: DataFrame, b: DataFrame, names: Sequence[str]) -> Column:
    on = F.lit(True)
    for n in names:
        on = on & a[n].eqNullSafe(b[n])
    return on


def running(ranges: DataFrame, group: Sequence[str], order: Sequence[Column], value: Column,
            name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the group that lie before.

    ``ranges`` is ``dealt`` by the group's columns, then ``order``.  A group may fill any number of
    ranges; as at most one group crosses each border, the table of groups in more than one range
    has at most two rows a range, which is the bound of the broadcast.
    """
    group = list(group)
    own = Window.partitionBy(RANGE, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    total = ranges.groupBy(RANGE, *group).agg(F.sum(value).alias("__sum"))
    along = Window.partitionBy(*(group or [F.lit(0)]))
    before = (total.withColumn("__n", F.count(F.lit(1)).over(along))
              .withColumn("__before", F.sum("__sum").over(
                  along.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)))
              .where("__n > 1 and __before is not null").select(RANGE, *group, "__before"))
    inner = ranges.withColumn("__own", F.coalesce(F.sum(value).over(own), F.lit(0)))
    return inner.join(F.broadcast(before), equal(inner, before, [RANGE, *group]), "left").select(
        *[inner[c] for c in ranges.columns],
        (F.col("__own") + F.coalesce("__before", F.lit(0))).alias(name))
