"""Line dedup, decontamination, near copies and substrings against brute force."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from llm_data import (brute_components, brute_hits, brute_lines, brute_substrings, docs, empty)
from pyspark.sql import functions as F

from keyloop.llm import ngram_jaccard
from keyloop.llm.components import components
from keyloop.llm.decontaminate import _WORD_BYTES, Suffixes, _longest, decontaminate, find_matches
from keyloop.llm.frequency import PAYLOAD, payloads, seen_filter
from keyloop.llm.line_dedup import dedup_lines
from keyloop.llm.ngram_jaccard import _order_of, _prefixes, jaccard_components, keep_one, shingle_sets
from keyloop.llm.substring_dedup import dedup_substrings
from keyloop.llm.text import split_words, stored


def _pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def _same(got, want):
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("bound", [1 << 20, 0])  # broadcast and join give the same
def test_lines(spark, keep, bound):
    df = docs(spark)
    rows = _pairs(df)
    got = dedup_lines(df, min_docs=3, keep=keep, broadcast_lines=bound)
    assert got.columns == df.columns + ["n_lines", "n_dropped"]
    _same([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()],
          [(r[0], *w) for r, w in zip(rows, brute_lines(rows, 3, keep == "first"))])


def test_lines_refuses_bad_settings(spark):
    with pytest.raises(ValueError):
        dedup_lines(docs(spark), keep="last")
    with pytest.raises(ValueError):
        dedup_lines(docs(spark), min_docs=1)


ITEMS = [(1, None), (2, ""), (3, "shared LINE"), (3, "shared LINE"), (None, "one two three"), (10, "Naïve")]


@pytest.mark.parametrize("block", [1 << 20, 40])  # one block, several blocks
@pytest.mark.parametrize("window", [3, 10])
def test_decontaminate(spark, window, block):
    df = docs(spark)
    rows = _pairs(df)
    own = [t for _, t in rows if t and len(t) > 200]
    items = ITEMS + [(20, own[0][20:180]), (21, own[3][:150] + " unseen words " + own[4][30:120])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = find_matches(df, bench, window=window, block_chars=block).collect()
    want = [brute_hits(t, items, window) for _, t in rows]
    _same([(r.doc_id, r.n_words, r.n_hit, sorted({m.item_id for m in r.matches} - {None})) for r in got],
          [(r[0], n, h, sorted(i)) for r, (n, h, i) in zip(rows, want)])
    clean = decontaminate(df, bench, window=window, block_chars=block)
    assert clean.columns == df.columns
    _same(_pairs(clean), [r for r, w in zip(rows, want) if not w[1]])


def test_matches_are_the_longest_with_their_places(spark):
    item = " ".join(f"w{i}" for i in range(30))
    text = "before " + " ".join(f"w{i}" for i in range(5, 25)) + " after"
    row = find_matches(spark.createDataFrame([(1, text)], "doc_id long, text string"),
                       spark.createDataFrame([("q", item)], "item_id string, text string")).first()
    assert [(m.item_id, m.start, m.length, m.item_start) for m in row.matches] == [("q", 1, 20, 5)]
    assert row.n_hit == 20


@pytest.mark.parametrize("k, num, den", [(4, 85, 100), (5, 80, 100), (1, 50, 100), (2, 100, 100)])
def test_near_copies(spark, k, num, den):
    df = docs(spark)
    rows = _pairs(df)
    got = jaccard_components(df, k, num, den).collect()
    want = brute_components(rows, k, num, den)
    _same([(r.doc_id, r.n_shingles, r.component_id) for r in got],
          [(r[0], *w) for r, w in zip(rows, want)])


def test_chains_of_near_copies(spark):
    """Each text shifts by a few words: ends of a chain are not similar, neighbours are."""
    stream = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(stream[5 * i:5 * i + 100])) for i in range(40)]
    rows += [(100 + i, " ".join(stream[200:300] + [f"own{i}"] * 3)) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for num in (80, 88, 95):
        got = {r.doc_id: r.component_id for r in jaccard_components(df, 4, num, 100).collect()}
        want = brute_components(rows, 4, num, 100)
        assert got == {r[0]: w[1] for r, w in zip(rows, want)}


def test_keep_one(spark):
    df = docs(spark)
    rows = _pairs(df)
    want = brute_components(rows, 5, 80, 100)
    kept = _pairs(keep_one(df))
    assert keep_one(df).columns == df.columns
    assert {w[1] for w in want if w[0]} == {i for i, t in kept if t and t.split()}
    assert len([1 for i, t in kept if t and t.strip(" \t\n\x0b\x0c\r")]) == len({w[1] for w in want if w[0]})
    _same([r for r in kept if not (r[1] or "").split()], [r for r, w in zip(rows, want) if not w[0]])


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 1), (7, 7), (9, 8), (8, 10), (5, 4), (20, 21), (21, 22), (22, 23), (23, 24)]
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {(r.node, r.label) for r in got.collect()} == {
        (1, 1), (2, 1), (3, 1), (8, 8), (9, 8), (10, 8), (4, 4), (5, 4),
        (20, 20), (21, 20), (22, 20), (23, 20), (24, 20)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_spend_no_round_on_stars(spark, monkeypatch):
    """Each round costs the driver jobs, threads and memory."""
    import keyloop.llm.components as module

    rounds = []
    monkeypatch.setattr(module, "stored", lambda df, name: rounds.append(name) or stored(df, name))
    star = [(5, 1), (1, 6), (1, 7), (7, 1), (9, 8), (8, 8), (None, 1), (3, None)]
    got = components(spark.createDataFrame(star, "a long, b long"))
    assert {(r.node, r.label) for r in got.collect()} == {(1, 1), (5, 1), (6, 1), (7, 1), (8, 8), (9, 8)}
    assert len(rounds) == 1
    plan = module._small_star(spark.createDataFrame([(2, 1)], "a long, b long"))._jdf.queryExecution()
    assert "Join" not in plan.optimizedPlan().toString()


def test_components_of_random_graphs(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(75)] + [(200 + i, 201 + i) for i in range(20)]
    edges += edges[:9] + [(b, a) for a, b in edges[:9]]
    low = {v: v for e in edges for v in e}
    for _ in low:
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    linked = {v for a, b in edges if a != b for v in (a, b)}
    rows = [(b"%03d" % a, b"%03d" % b) for a, b in edges]
    got = components(spark.createDataFrame(rows, "a binary, b binary")).collect()
    assert sorted((bytes(r.node), bytes(r.label)) for r in got) == sorted((b"%03d" % v, b"%03d" % low[v]) for v in linked)


@pytest.mark.parametrize("window", [13, 3])
def test_substrings(spark, window):
    df = docs(spark)
    rows = _pairs(df)
    got = dedup_substrings(df, window)
    # the clashing column n_words is replaced
    assert sorted(got.columns) == sorted([*df.columns, "n_removed"])
    _same([(r.doc_id, r.text, r.n_words, r.n_removed) for r in got.collect()],
          [(r[0], *w) for r, w in zip(rows, brute_substrings(rows, window))])


def test_substrings_with_text_ids(spark):
    df = docs(spark, 5, odd_ids=False).withColumn("doc_id", F.format_string("d%04d", "doc_id"))
    rows = _pairs(df)
    _same([(r.doc_id, r.text) for r in dedup_substrings(df, 5).collect()],
          [(r[0], w[0]) for r, w in zip(rows, brute_substrings(rows, 5))])


def test_empty_tables(spark):
    none = empty(spark)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert dedup_lines(none).count() == 0
    assert find_matches(none, bench).count() == 0
    assert find_matches(docs(spark), bench).where("n_hit > 0").count() == 0
    assert jaccard_components(none).count() == 0
    assert keep_one(none).count() == 0
    assert dedup_substrings(none).count() == 0


def test_filter_never_misses(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    once, twice = (rng.integers(0, 1 << 63, 20_000).astype(np.uint64) * np.uint64(2) for _ in range(2))

    def rows(batches):
        for _ in batches:
            yield from payloads([once, twice, twice])

    filt = seen_filter(spark.range(1, numPartitions=1).mapInArrow(rows, PAYLOAD), (1, 2, 3)).value
    assert filt.seen(once, 0).all() and filt.seen(twice, 1).all()
    assert filt.seen(once, 1).mean() < 0.05 and filt.seen(twice, 2).mean() < 0.05


def test_repeated_words_in_items_and_texts(spark):
    """Items and texts of few words that repeat: hits as in brute force, matches verbatim and the
    longest from their start."""
    rng = random.Random(5)
    text = lambda n, letters: " ".join(rng.choice(letters) for _ in range(n))
    items = [(1, "a " * 40), (2, "a b " * 15), (3, text(60, "ab")), (4, text(80, "abc")), (5, "b"), (6, "a " * 12 + "c")]
    rows = [(i, text(rng.randrange(60), letters)) for i in range(60) for letters in ("ab", "abc")]
    rows += [(900, "a " * 200), (901, "a b " * 100), (902, "c " + "a " * 13 + "c c"), (903, items[3][1] * 2)]
    found = find_matches(spark.createDataFrame(rows, "doc_id long, text string"),
                         spark.createDataFrame(items, "item_id long, text string"), window=4).collect()
    want = {(i, t): brute_hits(t, items, 4) for i, t in rows}
    assert len(found) == len(rows)
    item_words = {i: t.split() for i, t in items}
    for r in found:
        n, hit, ids = want[r.doc_id, r.text]
        assert (r.n_words, r.n_hit, {m.item_id for m in r.matches}) == (n, hit, set(ids))
        words = r.text.split()
        for m in r.matches:
            whole = item_words[m.item_id]
            assert words[m.start:m.start + m.length] == whole[m.item_start:m.item_start + m.length]
            longer = words[m.start:m.start + m.length + 1]
            assert len(longer) == m.length or not any(
                whole[p:p + len(longer)] == longer for p in range(len(whole)))


def test_equal_words_take_little_memory():
    test = Suffixes(pa.array([1]), pa.array(["the " * 2_000]), 10)
    tracemalloc.start()
    words, offsets = split_words(pa.array(["the " * 200_000]), _WORD_BYTES)
    which, at = test.search(test.code(words), offsets)
    text, item, start, length, place = _longest(test, which, at, np.zeros(200_000, np.int64))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(which) == 200_000 - 9 and peak < 300 << 20
    assert length.tolist()[:-1] == [2_000] * (len(length) - 1) and start[0] == 0 and place[0] == 0


def _common_head(spark, n, own=40):
    head = F.lit(" ".join(f"head{i}" for i in range(60)))
    return spark.range(n).select(F.col("id").alias("doc_id"), F.concat_ws(
        " ", head, F.transform(F.sequence(F.lit(0), F.lit(own - 1)),
                               lambda i: F.concat(F.lit("own"), F.col("id"), F.lit("x"), i))).alias("text"))


def test_frequent_shingles_rank_last_and_make_no_tile(spark):
    """Texts of a common head, none linked: the head's shingles are in nobody's prefix."""
    slim = _common_head(spark, 500).withColumnRenamed("doc_id", "id").withColumn("fp", F.xxhash64("text"))
    order_of = _order_of(slim, 4)
    heavy = set(order_of.value[1].tolist())
    head, _ = shingle_sets(pa.array([" ".join(f"head{i}" for i in range(60))]), 4)
    assert heavy == set(head.tolist())
    prefixes = slim.mapInArrow(
        _prefixes("text", 4, 85, 100, order_of),
        "id long, fp long, n long, node binary, prefix array<long>, sig array<long>, grams binary").collect()
    assert len(prefixes) == 500
    assert not any(heavy & {x & (1 << 64) - 1 for x in r.prefix or []} for r in prefixes)


@pytest.mark.parametrize("chunk", [2, 5, 2048])
def test_many_unlinked_members_of_a_tile(spark, monkeypatch, chunk):
    """Texts of few frequent passages: most are linked with nothing, some in chains, whatever the blocks."""
    monkeypatch.setattr(ngram_jaccard, "CHUNK", chunk)
    rng = random.Random(9)
    passages = [" ".join(f"p{i}w{j}" for j in range(8)) for i in range(7)]
    rows = []
    for i in range(120):
        text = rng.sample(passages, 4) + [" ".join(f"own{rng.randrange(40)}" for _ in range(rng.randrange(8)))]
        rows.append((i, " ".join(text)))
        if i % 4 == 0:
            rows.append((1_000 + i, rows[-1][1] + " tail"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_components(df, 2, 60, 100).collect()
    want = brute_components(rows, 2, 60, 100)
    _same([(r.doc_id, r.n_shingles, r.component_id) for r in got], [(r[0], *w) for r, w in zip(rows, want)])


def test_decontaminate_is_one_pass_with_the_text_once(spark):
    """One Python worker a task; only columns that the operator would replace are copied."""
    rows = [(1, "a b c d", 5, "x"), (2, "a b", 6, None), (3, None, None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, N_words int, `own col` string")
    items = spark.createDataFrame([("i", "b c d")], "item_id string, text string")
    out = decontaminate(df, items, window=3)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    assert sorted(map(tuple, out.collect())) == rows[1:]
    plan = out._jdf.queryExecution().executedPlan()
    assert plan.toString().count("MapInArrow") == 1
    lines = [x for x in plan.toString().split("\n") if "Project" in x and "__own" in x]
    assert all(x.count("text#") == 1 for x in lines)
