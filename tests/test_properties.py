"""Randomised properties of the change-history algebra (hypothesis, few examples: each one
runs Spark jobs)."""

import tempfile
from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from keyloop.operators import history as H
from keyloop.streaming.state import KeyedState

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
LOG_SCHEMA = ("k long, v string, _change_type string, _commit_version long, "
              "_commit_timestamp timestamp")
TYPES = ["insert", "update_preimage", "update_postimage", "delete"]


@st.composite
def histories(draw):
    n = draw(st.integers(1, 40))
    versions = draw(st.lists(st.integers(0, 10_000), min_size=n, max_size=n, unique=True))
    rows = []
    for ver in versions:
        k = draw(st.integers(0, 5))
        v = draw(st.one_of(st.none(), st.sampled_from(["a", "b", "c"])))
        t = draw(st.sampled_from(TYPES))
        rows.append((k, v, t, ver, None))
    return rows


@st.composite
def snapshots(draw):
    keys = draw(st.sets(st.integers(0, 30), max_size=20))
    return [(k, draw(st.one_of(st.none(), st.sampled_from(["x", "y"]))),
             draw(st.one_of(st.none(), st.integers(0, 3)))) for k in sorted(keys)]


@SETTINGS
@given(rows=histories(), cut=st.integers(0, 10_000))
def test_sync_from_any_version_equals_current_state(spark, rows, cut):
    log = spark.createDataFrame(rows, LOG_SCHEMA)
    want = sorted(H.current_state(log, ["k"]).collect())
    replica = H.as_of(log, ["k"], version=cut)
    got = sorted(H.apply_changes(replica, log, ["k"], since_version=cut).collect())
    assert got == want
    # the same over a replica whose key is vouched for, with and without a broadcast (the
    # frames are files, so that sizes are known)
    log, replica = on_disk(spark, log), on_disk(spark, replica)
    for bound in (1 << 30, -1):
        keyed = H.apply_changes(replica, log, ["k"], since_version=cut, snapshot_is_keyed=True,
                                max_broadcast_bytes=bound)
        assert ("BroadcastHashJoin" in keyed._jdf.queryExecution().executedPlan().toString()) or bound < 0
        assert sorted(keyed.collect()) == want


def on_disk(spark, df):
    path = tempfile.mkdtemp(prefix="keyloop-disk-") + "/t"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@st.composite
def messy_histories(draw):
    """Null keys, several changes of one version (told apart by ``line``), null commit times."""
    rows = []
    for line in range(draw(st.integers(1, 30))):
        at = draw(st.one_of(st.none(), st.integers(0, 9)))
        rows.append((draw(st.one_of(st.none(), st.integers(0, 3))), draw(st.sampled_from(["a", "b", None])),
                     draw(st.sampled_from(["insert", "update_postimage", "delete"])),
                     draw(st.integers(0, 200)), None if at is None else datetime(2024, 1, 1 + at), line))
    return rows


@SETTINGS
@given(rows=messy_histories())
def test_intervals_and_trail_do_not_depend_on_the_buckets(spark, rows):
    log = on_disk(spark, spark.createDataFrame(rows, LOG_SCHEMA + ", line long"))
    by_key = {}
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[3], r[5])):
        by_key.setdefault(r[0], []).append(r)
    intervals, trail = [], []
    for k, own in by_key.items():
        for i, r in enumerate(own):
            nxt = own[i + 1] if i + 1 < len(own) else None
            if r[2] != "delete":
                intervals.append((k, r[5], r[4], nxt[4] if nxt else None, nxt is None))
            old = own[i - 1][1] if i and own[i - 1][2] != "delete" else None
            trail.append((k, r[3], r[2], old, None if r[2] == "delete" else r[1]))
    for width in (1, 7, 64, 1 << 16, 1 << 40):
        got = H.validity_intervals(log, ["k"], bucket_width=width, tie=["line"])
        assert sorted(((r.k, r.line, r.valid_from, r.valid_to, r.is_current) for r in got.collect()),
                      key=repr) == sorted(intervals, key=repr)
        got = H.audit_trail(log, ["k"], ["v"], bucket_width=width, tie=["line"])
        assert sorted(((r.k, r._commit_version, r._change_type, r.old_v, r.new_v) for r in got.collect()),
                      key=repr) == sorted(trail, key=repr)


def test_repeated_and_null_keys_of_a_snapshot(spark):
    snapshot = on_disk(spark, spark.createDataFrame(
        [(1, "a"), (1, "a"), (None, "b"), (2, "c")], "k long, v string"))
    change = spark.createDataFrame([(2, "d", "update_postimage", 9, None)], LOG_SCHEMA)
    got = H.apply_changes(snapshot, on_disk(spark, change), ["k"], since_version=1)
    assert sorted(got.collect()) == [(1, "a"), (2, "d")]


@SETTINGS
@given(old=snapshots(), new=snapshots())
def test_diff_then_apply_gives_new(spark, old, new):
    schema = "k long, s string, n int"
    o, n = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    d = H.diff_snapshots(o, n, ["k"], version=1)
    got = sorted(H.apply_changes(o, d, ["k"], since_version=0).collect())
    assert got == sorted(n.collect())
    # unchanged rows produce no change rows
    same = {r.k for r in o.intersect(n).collect()}
    assert not {r.k for r in d.collect()} & same


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=histories(), order=st.permutations([0, 1, 2]))
def test_state_batches_in_any_order(spark, rows, order):
    log = spark.createDataFrame(rows, LOG_SCHEMA)
    root = tempfile.mkdtemp(prefix="keyloop-prop-")
    for i in [*order, order[0]]:                      # the last one: a late replay of old changes
        log.filter(f"_commit_version % 3 = {i}").coalesce(1).write.mode("append").parquet(f"{root}/in")
    state = KeyedState(spark, f"{root}/state", ["k"], partitions=2)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    state.start(stream).awaitTermination()
    cur = state.current()
    got = sorted(cur.select("k", "v").collect()) if cur is not None else []
    assert got == sorted(H.current_state(log, ["k"]).select("k", "v").collect())


@st.composite
def feeds_with_preimages(draw):
    """Change feeds in the CDF style: an update is a preimage + postimage at one version."""
    rows, ver = [], 0
    for _ in range(draw(st.integers(1, 25))):
        ver += draw(st.integers(1, 3))
        k = draw(st.integers(0, 3))
        v = draw(st.one_of(st.none(), st.sampled_from(["a", "b", "c"])))
        kind = draw(st.sampled_from(["insert", "update", "delete", "lone_post"]))
        if kind == "update":
            rows.append((k, draw(st.sampled_from(["p", "q"])), "update_preimage", ver, None))
            rows.append((k, v, "update_postimage", ver, None))
        elif kind == "lone_post":
            rows.append((k, v, "update_postimage", ver, None))
        else:
            rows.append((k, v, kind, ver, None))
    return rows


def _audit_brute(rows):
    out = set()
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: r[3])
        pre = {r[3]: r[1] for r in mine if r[2] == "update_preimage"}
        prev = None
        for r in (r for r in mine if r[2] != "update_preimage"):
            if r[3] in pre:
                old = pre[r[3]]
            elif prev is None or prev[2] == "delete":
                old = None
            else:
                old = prev[1]
            out.add((k, r[3], r[2], old, None if r[2] == "delete" else r[1]))
            prev = r
    return out


@SETTINGS
@given(rows=feeds_with_preimages(), width=st.sampled_from([2, 5, 1 << 40]))
def test_audit_trail_matches_brute_force(spark, rows, width):
    log = spark.createDataFrame(rows, LOG_SCHEMA)
    got = {(r.k, r._commit_version, r._change_type, r.old_v, r.new_v)
           for r in H.audit_trail(log, ["k"], ["v"], bucket_width=width).collect()}
    assert got == _audit_brute(rows)


def _with_ts(rows):
    from datetime import datetime, timedelta
    return [(k, v, t, ver, datetime(2024, 1, 1) + timedelta(seconds=ver))
            for k, v, t, ver, _ in rows]


def _intervals_brute(rows):
    out = set()
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k and r[2] != "update_preimage"),
                      key=lambda r: r[3])
        for i, r in enumerate(mine):
            if r[2] == "delete":
                continue
            nxt = mine[i + 1][4] if i + 1 < len(mine) else None
            out.add((k, r[3], r[4], nxt, nxt is None))
    return out


@SETTINGS
@given(rows=histories(), width=st.sampled_from([3, 64, 1 << 40]))
def test_validity_intervals_match_brute_force(spark, rows, width):
    rows = _with_ts(rows)
    log = spark.createDataFrame(rows, LOG_SCHEMA)
    got = {(r.k, r._commit_version, r.valid_from, r.valid_to, r.is_current)
           for r in H.validity_intervals(log, ["k"], bucket_width=width).collect()}
    assert got == _intervals_brute(rows)
