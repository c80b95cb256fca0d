"""Live results maintained from streams: the alert queue (ST3) and daily counts (ST4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from keyloop.functions.rows import status_is
from keyloop.operators.history import CT, DELETE, POSTIMAGE, PREIMAGE, VER
from keyloop.operators.keyed import _all_not_null, join_dim
from keyloop.plans.metrics import actions_per_day
from keyloop.plans.queues import open_alerts
from keyloop.streaming.deltas import PUBLISHED, held_entries, start_deltas
from keyloop.streaming.state import AdditiveState, KeyedState

#: The ticket columns that the queue shows or decides by, and the columns of a queue row.
TICKET = ("machine_id", "priority", "description", "opened_at", "status")
#: Ticket ids that share an entry of the state.
CELL = 256
QUEUE = ("ticket_id", "machine_id", "model", "line", "priority", "description", "actioned_by", "action_status")


def live_open_alerts(tickets: DataFrame, machines: DataFrame, latest_actions: KeyedState,
                     sort: str = "priority", priority: str | None = None,
                     tie: Sequence[str] = ("line_no", "amount")) -> DataFrame:
    """The alert queue read over a maintained latest-action state, as of its last commit."""
    current = latest_actions.current(
        "ticket_id bigint, performed_at timestamp_ntz, performed_by string, status string, line_no int, amount double")
    return open_alerts(tickets, machines, current, sort=sort, priority=priority, tie=tie,
                       actions_are_latest=True)


# ------------------------------------------------------------------ ST3: changes of the queue
def _redecide():
    """The stateful processor of ``queue_changes``: what the rows of a micro-batch change in the queue.

    Tickets are handled in buckets, one call a bucket; the state is a map of cells of at most
    CELL tickets of neighbouring ids, of which a call reads and writes the cells it touches, once each and one
    after the other.  Of a ticket it holds the image and version and the latest action; they say which row
    stands in the queue.  The class is local, so it travels to executors by value.
    """
    size, entries, most = CELL, held_entries(), PUBLISHED

    class Redecide(StatefulProcessor):
        def init(self, handle):
            self.held = entries(handle.getMapState("held", "cell long", entries.FORMAT), "int64")

        def handleInputRows(self, key, rows, timerValues):
            import json

            import pandas as pd

            def standing(image, is_open, action):
                if image is None or not is_open or (action and action[2] == "completed"):
                    return None
                by, status = (action[1], action[2]) if action else (None, None)
                return f'{image[:-1]},"actioned_by":{json.dumps(by)},"action_status":{json.dumps(status)}}}'

            def changes(out):
                return pd.DataFrame(out, columns=["ticket_id", "body", "change"]).astype(
                    {"ticket_id": "int64", "change": "int32"})

            cells, out = {}, []
            for frame in rows:
                for row in zip(*(frame[c].tolist() for c in (
                        "ticket_id", "image", "is_open", "version", "gone", "first", "rank", "by", "status"))):
                    cells.setdefault(row[0] // size, {}).setdefault(row[0], []).append(row[1:])
            while cells:
                number, tickets = cells.popitem()
                cell = self.held.read((number,))
                for ticket, arrived in tickets.items():
                    old = cell.get(ticket)
                    image, is_open, version, action = json.loads(old) if old else (None, False, None, None)
                    before = standing(image, is_open, action)
                    for t, t_open, v, gone, first, rank, by, status in arrived:
                        if t is not None and (version is None or v >= version):
                            if first and version is None:   # it stands in the first image of the queue
                                before = standing(t, t_open, None)
                            image, is_open, version = (None if gone else t), t_open, v
                        if rank is not None:
                            rank = [*json.loads(rank).values(), by or "", status or ""]
                            if action is None or rank > action[0]:
                                action = [rank, by, status]
                    after = standing(image, is_open, action)
                    if before != after:
                        out += [(ticket, body, n) for body, n in ((before, -1), (after, 1)) if body is not None]
                    cell[ticket] = json.dumps([image, is_open, version, action])
                self.held.write((number,), cell)
                if len(out) > most:
                    yield changes(out)
                    out = []
            yield changes(out)

        def close(self):
            pass

    return Redecide()


def _ticket_image(df: DataFrame) -> F.Column:
    """The ticket's columns as text (null fields included), to be cast back where a row is published."""
    return F.struct(*[F.col(c).cast("string").alias(c) for c in TICKET])


def queue_changes(actions: DataFrame, tickets: DataFrame, tie: Sequence[str] = ("line_no", "amount"),
                  buckets: int = 64) -> DataFrame:
    """ST3: the stream of changes of the alert queue: rows (ticket_id, body, change), where only the
    tickets that a micro-batch touches are decided again and an unchanged row gives nothing.

    ``actions``: a stream (ticket_id, performed_at, performed_by, status and ``tie``).  ``tickets``: a table, of which
    the open tickets stand in ``first_queue`` before any action; or a stream of ticket changes with
    ``_change_type`` and ``_commit_version``, whose tickets enter, change and leave as it says.
    Of a ticket's actions the latest counts (null ``performed_at`` first), however late a row arrives.
    ``buckets`` of tickets are the units of work of a micro-batch: several a state partition even these out, and a
    task holds one bucket's rows; the number is fixed with the state.
    """
    # what orders as the columns do: a null time wins, null ties lose; a wall-clock time by its text
    at = F.col("performed_at")
    zoned = dict(actions.dtypes)["performed_at"] == "timestamp"
    order = [at.isNull(), F.unix_micros(at) if zoned else at.cast("string")]
    for c in tie:
        order += [F.col(c).isNotNull(), F.col(c)]
    action = F.struct(F.struct(*[x.alias(f"r{i}") for i, x in enumerate(order)]).alias("rank"),
                      F.col("performed_by").alias("by"), F.col("status").alias("status"))
    keep = {"ignoreNullFields": "false"}
    none = F.lit(None).cast("string")
    act = (F.to_json(action["rank"], keep).alias("rank"), action["by"].alias("by"), action["status"].alias("status"))
    image = F.to_json(_ticket_image(tickets), keep)
    is_open = F.col("status").cast("string").eqNullSafe("open")

    def row(image, is_open, version, gone, first, act):
        return ["ticket_id", image.alias("image"), is_open.alias("is_open"), version.alias("version"),
                gone.alias("gone"), F.lit(first).alias("first"), *act]
    acts = actions.filter(_all_not_null(["ticket_id"]))
    if tickets.isStreaming:
        version = F.coalesce(F.col(VER).cast("long"), F.lit(-1 << 63))      # none is below all
        images = tickets.filter(_all_not_null(["ticket_id"]) & ~F.col(CT).eqNullSafe(PREIMAGE)).select(
            row(image, is_open, version, F.col(CT).eqNullSafe(DELETE), False,
                [none.alias(c) for c in ("rank", "by", "status")]))
        rows = images.unionByName(acts.select(
            row(none, F.lit(False), F.lit(0).cast("long"), F.lit(False), False, act)))
    else:
        opened = tickets.filter(status_is("status", "open")).select(
            "ticket_id", image.alias("image"), is_open.alias("is_open"))
        rows = join_dim(acts.select("ticket_id", *act), opened, "ticket_id").select(
            row(F.col("image"), F.col("is_open"), F.lit(0).cast("long"), F.lit(False), True, ["rank", "by", "status"]))
    bucket = F.pmod(F.xxhash64(F.floor(F.col("ticket_id") / CELL)), F.lit(buckets))
    return (rows.withColumn("bucket", bucket).groupBy("bucket")
            .transformWithStateInPandas(_redecide(), "ticket_id long, body string, change int", "Update", "None"))


def _published(changes: DataFrame, tickets: DataFrame, machines: DataFrame) -> DataFrame:
    types = {f.name: f.dataType.simpleString() for f in tickets.schema.fields}
    fields = ", ".join(f"{c} string" for c in (*TICKET, "actioned_by", "action_status"))
    body = F.from_json("body", fields)
    rows = changes.select("ticket_id", *[body[c].cast(types[c]).alias(c) for c in TICKET[:4]],
                          body["actioned_by"].alias("actioned_by"), body["action_status"].alias("action_status"), "change")
    return join_dim(rows, machines.select("machine_id", "model", "line"), "machine_id").select(*QUEUE, "change")


def first_queue(tickets: DataFrame, machines: DataFrame) -> DataFrame:
    """What ``queue_changes`` over a table of tickets adds up from: all its open tickets, no action."""
    none = F.lit(None).cast("string")
    rows = tickets.filter(status_is("status", "open")).select(
        "ticket_id", *TICKET[:4], none.alias("actioned_by"), none.alias("action_status"), F.lit(1).alias("change"))
    return join_dim(rows, machines.select("machine_id", "model", "line"), "machine_id").select(*QUEUE, "change")


def live_queue(actions: DataFrame, tickets: DataFrame, machines: DataFrame, checkpoint: str, publish,
               available_now: bool = True, processing_time: str = "15 seconds",
               tie: Sequence[str] = ("line_no", "amount"), partitions: int = 8, buckets: int = 64):
    """ST3: ``publish(changes, batch_id)`` gets what each micro-batch changes in the alert queue (columns
    of the queue, and change: +1 added, -1 removed).  Where ``tickets`` is a table, its ``first_queue`` is published
    first, as batch -1.  A batch that is run again publishes the same changes under the same id, so
    a sink that replaces a batch by its id (``deltas.delta_sink``) holds each exactly once; ``deltas.summed``
    is the queue.
    """
    if not tickets.isStreaming:
        publish(first_queue(tickets, machines), -1)
    stream = queue_changes(actions, tickets, tie, buckets)
    return start_deltas(stream, checkpoint, lambda df, b: publish(_published(df, tickets, machines), b),
                        available_now, processing_time, partitions)


# ------------------------------------------------------------------ ST4: counts
class DailyCounts(AdditiveState):
    """ST4: rows per day of ``ts_col`` (null excluded).  The counts equal those of one pass over all
    rows however late or out of order a row arrives; ``day`` is the wall-clock midnight, as in the
    batch query."""

    def __init__(self, spark, root: str, ts_col: str, partitions: int = 4):
        super().__init__(spark, root, ["day"], ["n_actions"], partitions)
        self.ts_col = ts_col

    def aggregate(self, stream: DataFrame) -> DataFrame:
        return actions_per_day(stream, self.ts_col)


class SignedAverages(AdditiveState):
    """ST4 / A4 with retractions: count, sum and average of ``value`` per ``pk`` over a change log whose rows
    carry their images: inserts and postimages add, preimages and deletes take away, so the
    averages are those of the net table after every batch, in whatever order the rows come.
    Values are rounded to ``scale`` places, their sums are exact; null values count in neither, groups whose rows are all gone
    are left out."""

    def __init__(self, spark, root: str, pk: Sequence[str], value: str, scale: int = 6, partitions: int = 8):
        super().__init__(spark, root, pk, ["n", "total"], partitions)
        self.value, self.scale = value, scale

    def aggregate(self, stream: DataFrame) -> DataFrame:
        taken = F.coalesce(F.col(CT).isin(PREIMAGE, DELETE), F.lit(False))
        sign = F.when(F.col(self.value).isNull(), 0).when(taken, -1).otherwise(1)
        # whole units of 10**-scale: sums of longs do not depend on the order of the rows
        units = F.coalesce(F.round(F.col(self.value) * F.lit(10 ** self.scale)), F.lit(0)).cast("long")
        return (stream.select(*self.pk, sign.cast("long").alias("__n"), (sign * units).alias("__u"))
                .groupBy(*self.pk).agg(F.sum("__n").alias("n"), F.sum("__u").alias("total")))

    def averages(self, batch_id: int | None = None) -> DataFrame | None:
        """(*pk, n, total, average) of the groups that have rows."""
        df = self.read(batch_id)
        if df is None:
            return None
        total = F.col("total") / F.lit(float(10 ** self.scale))
        return df.filter("n > 0").select(*self.pk, "n", total.alias("total"), (total / F.col("n")).alias("average"))


def live_daily_counts(stream: DataFrame, state: DailyCounts, available_now: bool = True,
                      processing_time: str = "15 seconds"):
    """ST4: keep the daily counts current; a day's new count is what a micro-batch updates."""
    return state.start(stream, None, available_now, processing_time)
