"""Streaming = batch, also out of order, replayed and restarted."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from keyloop.operators import history as H
from keyloop.plans import queues as Q
from keyloop.sources import tables as V
from keyloop.streaming import capture as SC
from keyloop.streaming import deltas as SD
from keyloop.streaming import history as SH
from keyloop.streaming import live as SL
from keyloop.streaming.state import AdditiveState, KeyedState, continuous_sync, suggest_partitions

LOG = "entity_id long, v string, _change_type string, _commit_version long, _commit_timestamp timestamp_ntz"


def folder(name):
    return tempfile.mkdtemp(prefix=f"keyloop-{name}-")


def stream_of(spark, schema, path):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def in_files(df, path, parts, order=None):
    """The rows in ``parts`` files, written one after the other."""
    for i in parts:
        df.filter(F.col(order or "_commit_version") % len(parts) == i).coalesce(1).write.mode("append").parquet(path)


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def test_stream_equals_batch_out_of_order(spark, sf_small):
    log = V.change_log(spark, sf_small)
    root = folder("state")
    in_files(log, f"{root}/in", [3, 1, 0, 2])
    state = KeyedState(spark, f"{root}/state", ["entity_id"], partitions=4)
    reader = KeyedState(spark, f"{root}/state", ["entity_id"])      # opened before anything was written
    assert reader.current() is None
    seen = []
    src = stream_of(spark, log.schema, f"{root}/in")
    continuous_sync(src, state, publish=lambda df, b: seen.append((b, df.count()))).awaitTermination()
    cols = ["entity_id", "value", "props"]
    want = rows(H.current_state(log, ["entity_id"]), *cols)
    assert rows(reader.current(), *cols) == want
    keys = log.select("entity_id").distinct().count()
    assert [b for b, _ in seen] == [0, 1, 2, 3] and all(0 < n <= keys for _, n in seen)
    # every batch again through the same query: replays change nothing
    in_files(log, f"{root}/in", [1, 2, 0, 3])
    continuous_sync(stream_of(spark, log.schema, f"{root}/in"), state).awaitTermination()
    assert rows(reader.current(), *cols) == want
    # an earlier batch is still there to read
    first = H.current_state(log.filter("_commit_version % 4 = 3"), ["entity_id"])
    assert rows(reader.current(batch_id=0), *cols) == rows(first, *cols)


def test_late_changes_and_deletes(spark):
    """Older changes after newer ones, a delete and what comes late for its key, nulls, empty batches."""
    log = [(1, "new", "update_postimage", 5, None), (1, "old", "insert", 1, None),
           (2, "x", "insert", 1, None), (2, "x", "delete", 4, None), (2, "late", "update_postimage", 3, None),
           (3, "pre", "update_preimage", 9, None), (3, None, "insert", 2, None), (None, "no key", "insert", 7, None),
           (4, "a", "insert", 1, None), (4, "b", "insert", 1, None)]
    root = folder("late")
    for i, one in enumerate([*log, log[1]]):
        spark.createDataFrame([one], LOG).coalesce(1).write.mode("append").parquet(f"{root}/in")
        if i % 4 == 0:
            spark.createDataFrame([], LOG).coalesce(1).write.mode("append").parquet(f"{root}/in")
    state = KeyedState(spark, f"{root}/state", ["entity_id"], partitions=2)
    continuous_sync(stream_of(spark, LOG, f"{root}/in"), state).awaitTermination()
    assert rows(state.current(), "entity_id", "v") == [(1, "new"), (3, None), (4, "b")]
    assert (2, "delete") in rows(state.read(include_tombstones=True), "entity_id", "_change_type")


def test_state_survives_a_failing_batch(spark, sf_small):
    log = V.change_log(spark, sf_small)
    root = folder("crash")
    in_files(log, f"{root}/in", [0, 1, 2])
    state = KeyedState(spark, f"{root}/state", ["entity_id"], partitions=2)
    added = AdditiveState(spark, f"{root}/sums", ["entity_id"], ["one"], partitions=2)
    numbered = log.withColumn("one", F.lit(1).cast("long"))

    def boom(df, batch_id):
        df.count()
        if batch_id == 1:
            raise RuntimeError("lost the driver before the batch was committed")
    for table, frame in ((state, log), (added, numbered)):
        stream = stream_of(spark, log.schema, f"{root}/in")
        stream = stream.withColumn("one", F.lit(1).cast("long")) if table is added else stream
        with pytest.raises(Exception):  # noqa: B017 - whatever the query is ended by
            table.start(stream, boom).awaitTermination()
        table.start(stream).awaitTermination()          # goes on from the last commit
    assert rows(state.current(), "entity_id", "value") == rows(H.current_state(log, ["entity_id"]), "entity_id", "value")
    want = numbered.groupBy("entity_id").agg(F.sum("one").alias("one"))
    assert rows(added.current(), "entity_id", "one") == rows(want, "entity_id", "one")


def test_continuous_trigger_mode(spark, sf_small):
    """S7 with a processing-time trigger: run, drain what is there, stop."""
    state = KeyedState(spark, folder("cont"), ["entity_id"], partitions=2)
    src = V.change_log_of(SC.file_stream(spark, sf_small, "events.parquet"))
    q = continuous_sync(src, state, available_now=False, processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    want = H.current_state(V.change_log(spark, sf_small), ["entity_id"])
    assert rows(state.current(), "entity_id", "value") == rows(want, "entity_id", "value")


def test_settings_are_those_of_the_session_again(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    root = folder("conf")
    spark.createDataFrame([(1, "a", "insert", 1, None)], LOG).write.parquet(f"{root}/in")
    state = KeyedState(spark, f"{root}/state", ["entity_id"], partitions=3)
    continuous_sync(stream_of(spark, LOG, f"{root}/in"), state).awaitTermination()
    assert spark.conf.get(name, None) == before and spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert KeyedState(spark, folder("none"), ["k"]).current("k long, v string").columns == ["k", "v"]


def test_suggest_partitions_bounds():
    assert suggest_partitions(None) == 4 and suggest_partitions(10 << 20) == 4
    assert suggest_partitions(1 << 40) == 8192 and suggest_partitions(1 << 60) == 1 << 16


def test_capture_is_exactly_once(spark, sf_small):
    root = folder("cap")
    for _ in range(2):      # restarting with the same checkpoint appends nothing
        src = V.change_log_of(SC.file_stream(spark, sf_small, "events.parquet"))
        SC.capture_changes(src, f"{root}/h", f"{root}/c").awaitTermination()
    assert spark.read.parquet(f"{root}/h").count() == 1000


# ---------------------------------------------------------------- ST3
ACTION = "ticket_id long, performed_at timestamp_ntz, performed_by string, status string, line_no int, amount double"


def some_actions(spark, seed, n, tickets):
    rng = random.Random(seed)
    rows_ = [(rng.choice([None, *range(tickets)]), rng.choice([None] + [f"2024-01-{d:02d} 00:00:00.{d:03d}" for d in range(1, 9)]),
              rng.choice(["ann", "bob", None]), rng.choice(["completed", "in_progress", None]),
              rng.choice([None, 1, 2, 3]), rng.choice([None, 0.5, 2.25])) for _ in range(n)]
    # one row for each (ticket, time, place), so that the latest is one row
    rows_ = list({(r[0], r[1], r[4], r[5]): r for r in rows_}.values())
    return spark.createDataFrame(rows_, ACTION.replace("timestamp_ntz", "string")).withColumn(
        "performed_at", F.col("performed_at").cast("timestamp_ntz"))


def test_queue_changes_add_up_after_every_batch(spark, sf_small):
    """On the driver tables: sums of changes equal the queue over the rows so far; a batch touches its own
    tickets only, and rows that come again change nothing."""
    tickets, machines = V.tickets(spark, sf_small), V.machines(spark, sf_small)
    actions = V.actions(spark, sf_small).select("ticket_id", "performed_at", "performed_by", "status", "line_no", "amount")
    root = folder("queue")
    in_files(actions, f"{root}/in", [4, 2, 0, 3, 1], order="line_no")
    parts = [4, 2, 0, 3, 1]
    sizes = {}
    sink = SD.delta_sink(f"{root}/changes")

    def publish(df, b):
        sink(df, b)
        sizes[b] = spark.read.parquet(f"{root}/changes/batch={b}").count()
    run = lambda: SL.live_queue(stream_of(spark, actions.schema, f"{root}/in"), tickets, machines,
                                f"{root}/_c", publish, partitions=4).awaitTermination()
    run()
    changes = spark.read.parquet(f"{root}/changes")
    assert changes.groupBy("batch", *SL.QUEUE).agg(F.sum("change").alias("n")).filter("abs(n) > 1").isEmpty()
    for b in range(-1, 5):
        so_far = actions.filter((F.col("line_no") % 5).isin(parts[:b + 1]))
        want = Q.open_alerts(tickets, machines, so_far)
        assert rows(SD.summed(changes.filter(f"batch <= {b}")), *SL.QUEUE) == rows(want, *SL.QUEUE)
        if b >= 0:
            touched = actions.filter(F.col("line_no") % 5 == parts[b]).select("ticket_id").distinct().count()
            assert 0 < sizes[b] <= 2 * touched
    in_files(actions, f"{root}/in", [2], order="line_no")
    actions.filter("line_no = 2").coalesce(1).write.mode("append").parquet(f"{root}/in")
    run()
    assert sizes[5] == sizes[6] == 0


def test_queue_of_changing_tickets(spark):
    """Tickets as a stream of changes: opened, closed, moved, deleted, late and repeated."""
    machines = spark.createDataFrame([(1, "A", 10), (2, "B", 20)], "machine_id long, model string, line int")
    schema = ("ticket_id long, machine_id long, priority string, description string, opened_at timestamp_ntz, status string, "
              "_change_type string, _commit_version long")
    image = lambda t, m, p, s, ct, v: (t, m, p, "d", None, s, ct, v)
    feeds = [[image(1, 1, "high", "open", "insert", 1), image(2, 2, "low", "open", "insert", 2),
              image(3, 9, "low", "open", "insert", 3), image(4, None, None, "open", "insert", 4)],
             [image(1, 1, "high", "open", "update_preimage", 5), image(1, 2, "high", "open", "update_postimage", 5),
              image(2, 2, "low", "open", "delete", 6), image(None, 1, "low", "open", "insert", 7)],
             [image(1, 1, "low", "closed", "update_postimage", 4), image(5, 1, "low", "closed", "insert", 8)],
             [image(2, 2, "low", "open", "insert", 9), image(1, 2, "high", "closed", "update_postimage", 10)],
             [image(5, 1, "low", "open", "update_postimage", 11), image(1, 2, "high", "open", "update_postimage", 12)]]
    actions = some_actions(spark, 2, 60, 7)
    root = folder("tickets")
    in_files(actions.withColumn("g", F.pmod(F.xxhash64(*actions.columns), F.lit(5))), f"{root}/a", [0, 1, 2, 3, 4], "g")
    for f in feeds:
        spark.createDataFrame(f, schema).coalesce(1).write.mode("append").parquet(f"{root}/t")
    SL.live_queue(stream_of(spark, actions.schema, f"{root}/a"), stream_of(spark, schema, f"{root}/t"), machines,
                  f"{root}/_c", SD.delta_sink(f"{root}/changes"), partitions=2, buckets=3).awaitTermination()
    log = spark.createDataFrame([r for f in feeds for r in f], schema).withColumn(
        "_commit_timestamp", F.lit(None).cast("timestamp_ntz"))
    want = Q.open_alerts(H.current_state(log, ["ticket_id"]), machines, actions)
    got = SD.summed(spark.read.parquet(f"{root}/changes"))
    assert rows(got, *SL.QUEUE) == rows(want, *SL.QUEUE)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_queue_of_odd_actions(spark, zone):
    """Null times win, null ties lose, unknown tickets and machines give no row."""
    tickets = spark.createDataFrame(
        [(i, 1 + i % 3, "low", f'say "{i}"', None, "open" if i % 4 else "closed") for i in range(9)],
        "ticket_id long, machine_id long, priority string, description string, opened_at timestamp_ntz, status string")
    machines = spark.createDataFrame([(1, "A", 10), (2, None, None)], "machine_id long, model string, line int")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        actions = some_actions(spark, 5, 200, 12).cache()
        root = folder("odd")
        in_files(actions.withColumn("g", F.pmod(F.xxhash64(*actions.columns), F.lit(3))), f"{root}/a", [0, 1, 2], "g")
        SL.live_queue(stream_of(spark, actions.schema, f"{root}/a"), tickets, machines, f"{root}/_c",
                      SD.delta_sink(f"{root}/changes"), partitions=2).awaitTermination()
        want = Q.open_alerts(tickets, machines, actions)
        assert rows(SD.summed(spark.read.parquet(f"{root}/changes")), *SL.QUEUE) == rows(want, *SL.QUEUE)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


# ---------------------------------------------------------------- H4, S8
@pytest.mark.parametrize("width", [1, 7, 1 << 16])
def test_intervals_are_spliced_in_any_order(spark, width):
    """New, late and repeated changes, deletes, null times: the sums equal the batch result after every batch."""
    rng = random.Random(width)
    log = [(rng.choice(["a", "b", "hot", "hot", "hot", None]), str(v), rng.choice(
        ["insert", "update_postimage", "update_postimage", "delete"]), v, rng.choice([None, f"2024-01-{1 + v % 28:02d} 01:02:03.000{abs(v):03d}"]))
        for v in range(-20, 90)]
    log += [(k, x, "update_preimage", v, t) for k, x, ct, v, t in log if ct == "update_postimage"]
    schema = LOG.replace("entity_id long", "entity_id string").replace("timestamp_ntz", "string")
    df = spark.createDataFrame(log, schema).withColumn("_commit_timestamp", F.col("_commit_timestamp").cast("timestamp_ntz"))
    root, order = folder("splice"), [2, 0, 3, 1, 0]
    for i in order:
        df.filter(F.pmod(F.xxhash64("_commit_version"), F.lit(4)) == i).coalesce(1).write.mode("append").parquet(f"{root}/in")
    SD.start_deltas(SH.interval_changes(stream_of(spark, df.schema, f"{root}/in"), ["entity_id"], width=width),
                    f"{root}/c", SD.delta_sink(f"{root}/changes"), partitions=2).awaitTermination()
    changes = spark.read.parquet(f"{root}/changes")
    cols = ["entity_id", "v", "_change_type", "_commit_version", "valid_from", "valid_to", "is_current"]
    for b in range(5):
        so_far = df.filter(F.pmod(F.xxhash64("_commit_version"), F.lit(4)).isin(order[:b + 1]))
        want = H.validity_intervals(so_far, ["entity_id"])
        got = SH.intervals_of(so_far, SD.summed(changes.filter(f"batch <= {b}")), ["entity_id"])
        assert rows(got, *cols) == rows(want, *cols), b
    assert changes.filter("batch = 4").isEmpty()         # replays


def test_capture_from_states(spark):
    """States without change types: inserts, updates with both images, deletes; equal, late and repeated ones give nothing."""
    schema = "a long, b string, x double, y string, ver long, gone boolean"
    batches = [[(1, "k", 1.5, None, 1, False), (1, "k", 2.5, "q", 3, None), (2, "k", None, None, 2, False), (3, "k", 1.0, "", 2, True)],
               [(1, "k", 2.5, "q", 4, False), (2, "k", 0.1, 'say "x"', 5, False), (1, "k", 9.0, "late", 2, False), (None, "k", 1.0, "", 6, False)],
               [(1, "k", None, None, 7, True), (2, "k", 0.1, 'say "x"', 5, False), (3, "k", 1.0, "", 7, False)],
               [(1, "k", 3.5, "again", 8, False), (2, "k", None, None, 8, True), (2, "k", None, None, 9, True)]]
    root = folder("states")
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
    changes = SH.captured_changes(stream_of(spark, schema, f"{root}/in"), ["a", "b"], "ver", F.col("gone"), ["x", "y"], buckets=3)
    SD.start_deltas(changes, f"{root}/c", SD.delta_sink(f"{root}/log"), partitions=2).awaitTermination()
    got = rows(spark.read.parquet(f"{root}/log"), "batch", "a", "x", "y", H.CT, H.VER)
    assert got == sorted([
        (0, 1, 1.5, None, "insert", 1), (0, 1, 1.5, None, "update_preimage", 3), (0, 1, 2.5, "q", "update_postimage", 3),
        (0, 2, None, None, "insert", 2), (1, 2, None, None, "update_preimage", 5), (1, 2, 0.1, 'say "x"', "update_postimage", 5),
        (2, 1, 2.5, "q", "delete", 7), (2, 3, 1.0, "", "insert", 7), (3, 1, 3.5, "again", "insert", 8),
        (3, 2, 0.1, 'say "x"', "delete", 8)], key=str)


# ---------------------------------------------------------------- ST4
def test_daily_counts_independent_of_session_zone(spark, sf_small):
    from keyloop.plans import metrics as M
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        state = SL.DailyCounts(spark, folder("daily"), "completed_at")
        src = V.actions_of(SC.file_stream(spark, sf_small, "lineitem.parquet"))
        SL.live_daily_counts(src, state).awaitTermination()
        got = rows(state.current(), F.col("day").cast("string"), "n_actions")
        assert got == rows(M.actions_per_day(V.actions(spark, sf_small)), F.col("day").cast("string"), "n_actions")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_signed_averages_follow_updates_and_deletes(spark):
    """After every batch the averages are those of the net table, whatever order the changes come in."""
    rng = random.Random(9)
    live, log = {}, []
    for v in range(120):
        k = rng.randrange(15)
        value = rng.choice([None, 1.25, -3.5, 40.0, 0.1])
        group = rng.choice(["a", "b", None])
        if k in live and rng.random() < 0.3:
            log.append((k, *live.pop(k), "delete", v))
        elif k in live:
            log += [(k, *live[k], "update_preimage", v), (k, group, value, "update_postimage", v)]
            live[k] = (group, value)
        else:
            log.append((k, group, value, "insert", v))
            live[k] = (group, value)
    schema = "k long, g string, x double, _change_type string, _commit_version long"
    root = folder("signed")
    for i in range(0, 120, 30):
        part = [r for r in log if i <= r[4] < i + 30]
        rng.shuffle(part)
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
    state = SL.SignedAverages(spark, f"{root}/state", ["g"], "x", partitions=2)
    state.start(stream_of(spark, schema, f"{root}/in")).awaitTermination()
    full = spark.createDataFrame(log, schema).withColumn("_commit_timestamp", F.lit(None).cast("timestamp_ntz"))
    for batch, upto in enumerate((30, 60, 90, 120)):
        net = H.current_state(full.filter(f"_commit_version < {upto}"), ["k"])
        want = net.filter("x is not null").groupBy("g").agg(F.count("x").alias("n"), F.round(F.avg("x"), 9).alias("a"))
        assert rows(state.averages(batch), "g", "n", F.round("average", 9)) == rows(want, "g", "n", "a")


# ---------------------------------------------------------------- what a batch asks of the state store
def entries(spark, checkpoint, name):
    return spark.read.format("statestore").option("stateVarName", name).load(checkpoint).count()


def test_neighbours_share_entries_of_the_state(spark):
    """A call to the state store a key and batch is what took the time: keys and tickets go many to an entry."""
    root, n = folder("entries"), 1500
    machines = spark.createDataFrame([(1, "A", 10)], "machine_id long, model string, line int")
    tickets = spark.range(n).selectExpr(
        "id AS ticket_id", "1L AS machine_id", "'low' AS priority", "'d' AS description",
        "timestamp_ntz'2024-01-01 00:00:00' AS opened_at", "'open' AS status")
    acts = spark.range(n).selectExpr(
        "id AS ticket_id", "timestamp_ntz'2024-01-02 00:00:00' AS performed_at", "'ann' AS performed_by",
        "IF(id % 3 = 0, 'completed', 'in_progress') AS status", "1 AS line_no", "0.5D AS amount")
    in_files(acts, f"{root}/a", [1, 0], "ticket_id")
    SL.live_queue(stream_of(spark, acts.schema, f"{root}/a"), tickets, machines, f"{root}/ac",
                  SD.delta_sink(f"{root}/ach"), partitions=2, buckets=2).awaitTermination()
    assert rows(SD.summed(spark.read.parquet(f"{root}/ach")), *SL.QUEUE) == rows(
        Q.open_alerts(tickets, machines, acts), *SL.QUEUE)
    assert entries(spark, f"{root}/ac", "held") <= 10

    log = spark.range(2 * n).selectExpr(
        f"id % {n} AS entity_id", "string(id) AS v", "'insert' AS _change_type", "id AS _commit_version",
        "timestamp_ntz'2024-01-02 00:00:00' AS _commit_timestamp")
    in_files(log, f"{root}/h", [1, 0])
    SD.start_deltas(SH.interval_changes(stream_of(spark, log.schema, f"{root}/h"), ["entity_id"], buckets=2),
                    f"{root}/hc", SD.delta_sink(f"{root}/hch"), partitions=2).awaitTermination()
    got = SH.intervals_of(log, SD.summed(spark.read.parquet(f"{root}/hch")), ["entity_id"])
    cols = ["entity_id", "v", "valid_from", "valid_to", "is_current"]
    assert rows(got, *cols) == rows(H.validity_intervals(log, ["entity_id"]), *cols)
    assert entries(spark, f"{root}/hc", "windows") <= 32 and entries(spark, f"{root}/hc", "cells") <= 32

    changes = SH.captured_changes(stream_of(spark, log.schema, f"{root}/h"), ["entity_id"], "_commit_version",
                                  F.lit(False), ["v"], buckets=2)
    SD.start_deltas(changes, f"{root}/cc", SD.delta_sink(f"{root}/cch"), partitions=2).awaitTermination()
    assert entries(spark, f"{root}/cc", "images") <= 32


def test_live_queue_state_grows_with_the_table(spark, sf_small, monkeypatch):
    """A task holds the rows of one state partition, so their number follows the table."""
    from keyloop.plans import catalog

    seen = []

    class Seen(KeyedState):
        def __init__(self, *args, partitions, **kwargs):
            seen.append(partitions)
            super().__init__(*args, partitions=4, **kwargs)
    monkeypatch.setattr(catalog, "KeyedState", Seen)
    for size in (100 << 20, 800 << 20):
        monkeypatch.setattr(catalog, "estimated_bytes", lambda df, size=size: size)
        catalog.QUERIES["stream_live_queue"](spark, sf_small)
    assert 7 <= seen[0] and 8 * seen[0] - 8 <= seen[1]
