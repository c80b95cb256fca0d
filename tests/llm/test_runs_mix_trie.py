"""Periodic runs, mixing to weights and the conversation trie against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import llm_data as D
from keyloop.llm import periodic_runs as P


@pytest.fixture
def many_ranges(spark):
    """Small tables in as many partitions as large ones."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- periodic runs
def brute_runs(words, min_length=6, min_exponent=4):
    """All maximal stretches of each period, the smallest period of each stretch."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        at = 0
        while at < n - q:
            if words[at] != words[at + q]:
                at += 1
                continue
            to = at
            while to < n - q and words[to] == words[to + q]:
                to += 1
            if to + q - at >= max(min_length, min_exponent * q):
                found.setdefault((at, to + q - at), q)
            at = to + 1
    return sorted((s, x, q) for (s, x), q in found.items())


def collapse(words, runs):
    gone = {i for s, x, q in runs for i in range(s + q, s + x)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def brute_digest(doc_id, text):
    words = D.words(text)
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    s, x, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), s, x, q, 1000 * x // q if runs else None,
            sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(collapse(words, runs)))


@pytest.mark.parametrize("least, times", [(6, 4), (2, 2), (5, 3)])
def test_runs_of_random_words(least, times):
    rng = random.Random(least)
    texts = [[rng.randrange(rng.choice([1, 2, 3, 8])) for _ in range(rng.randrange(40))] for _ in range(400)]
    for _ in range(60):  # repeated phrases, phrases within phrases, runs that overlap
        phrase = [rng.randrange(3) for _ in range(rng.randint(1, 9))] * rng.randint(1, 7)
        texts.append(([rng.randrange(3) for _ in range(rng.randrange(5))] + phrase) * rng.randint(1, 5)
                     + phrase[:rng.randrange(4)])
    offsets = np.cumsum([0, *map(len, texts)])
    flat = np.array([w for t in texts for w in t], np.int64)
    start, length, period = P.runs_of(flat, offsets, least, times)
    got = [[] for _ in texts]
    for s, x, q in zip(start, length, period):
        i = int(np.searchsorted(offsets, s, "right")) - 1
        got[i].append((int(s - offsets[i]), int(x), int(q)))
    assert got == [brute_runs(t, least, times) for t in texts]


def test_runs_query_against_brute_force(spark):
    docs = D.docs(spark)
    rng = random.Random(5)
    loops = [(1000 + i, " ".join(["pre"] * rng.randrange(3) + [rng.choice("abc") for _ in range(rng.randint(1, 4))]
              * rng.randint(3, 9) + ["post"])) for i in range(40)]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(loops, "doc_id long, text string"))
    got = P.runs_digest(docs)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    want = [brute_digest(r.doc_id, r.text) for r in docs.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[-1])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert sum(r[1] for r in want) > 30


def test_runs_output_and_clashing_names(spark):
    text = "so so so so so so on and on and on and on and\n on\tthen"
    row = P.find_runs(spark.createDataFrame([(1, text, "own", 2)], "doc_id long, text string, Runs string, extra int")
                      ).first()
    assert [tuple(r) for r in row.runs] == [(0, 6, 1), (6, 9, 2)]
    assert row.collapsed == "so on and then" and row.n_words == 16 and row.extra == 2
    out = P.find_runs(D.empty(spark))
    assert out.count() == 0 and {"runs", "collapsed", "lang"} <= set(out.columns)
    with pytest.raises(ValueError):
        P.find_runs(D.empty(spark), min_exponent=1)


def test_runs_of_long_texts(spark):
    """20,000 words: all equal, one phrase throughout, and a phrase of 5,000 words four times."""
    rng = random.Random(3)
    phrase = [str(rng.randrange(50)) for _ in range(5000)]
    rows = [(1, " ".join(["w"] * 20_000)), (2, " ".join(phrase[:7] * 2858)[:60_000]), (3, " ".join(phrase * 4))]
    got = {r.doc_id: r for r in P.find_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(r) for r in got[1].runs] == [(0, 20_000, 1)] and got[1].collapsed == "w"
    assert (0, 20_000, 5000) in [tuple(r) for r in got[3].runs]
    assert max(r.length for r in got[2].runs) >= got[2].n_words - 1


# ---------------------------------------------------------------- mixing
def brute_shares(sizes, weights, share=1.5, most=2):
    """{source: target} by dividing again what full sources leave."""
    left, full = share * sum(sizes.values()), set()
    while True:
        own = [s for s in sizes if s not in full]
        total = sum(weights[s] for s in own)
        rest = left - most * sum(sizes[s] for s in full)
        above = {s for s in own if total and rest * weights[s] / total > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in full else rest * weights[s] / total if total else 0.0 for s in sizes}
        full |= above


def brute_mix(rows):
    """[(doc_id, size, source_size, target, taken)] of (doc_id, text, source) rows."""
    sized = [(i, len(D.words(t)), s) for i, t, s in rows]
    names = sorted({s for _, _, s in sized}, key=lambda s: (s is None, (s or "").encode()))
    sizes = {s: sum(n for _, n, x in sized if x == s) for s in names}
    target = brute_shares(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)})
    out = []
    for s in names:
        key = lambda r: (hashlib.md5(f"0:{'' if r[0] is None else r[0]}".encode()).hexdigest(),
                         r[0] is not None, r[0] or 0, r[1])
        own = sorted((r for r in sized if r[2] == s), key=key)
        epochs = int(target[s]) // sizes[s] if sizes[s] else 0
        rest = int(target[s]) - epochs * sizes[s]
        while own:
            alike = [r for r in own if key(r) == key(own[0])]
            own = own[len(alike):]
            all_words = sum(r[1] for r in alike)
            part = max(0, min(all_words, rest)) // len(alike)
            rest -= all_words
            out += [(r[0], r[1], sizes[s], target[s], epochs * r[1] + part) for r in alike]
    return out


def mixed_docs(spark, seed=1):
    rng = random.Random(seed)
    rows = [(i, t, rng.choice(["a", "a", "a", "a", "b", "ä", "Z", "c", None, "tiny"] if i % 7 else ["b"]))
            for i, t in enumerate(D.texts(seed))]
    rows += [rows[20]] * 5 + [(None, "null id here", "b"), (None, "null id here", "b"), (9999, None, "empty")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {"Size": F.lit("own"), "taken": F.lit("own"), "rest": F.lit(1), "key": F.lit(2)})


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_against_brute_force(spark, seed, many_ranges):
    from keyloop.llm import source_mix as M
    rows, docs = mixed_docs(spark, seed)
    want = sorted(brute_mix(rows), key=str)
    got = M.mix_digest(docs)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert sorted(map(tuple, got.collect()), key=str) == want
    for n, parts in ((0, 1), (0, 7)):  # the salted join; other splits
        again = M.mix(docs.repartition(parts), broadcast_sources=n).select("doc_id", "size", "source_size",
                                                                           "target", "taken")
        assert sorted(map(tuple, again.collect()), key=str) == want
    by = {}
    for r in got.collect():
        assert r.taken <= 2 * r.size
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    assert all(abs(sum(t) - target) < 7 for (_, target), t in by.items())


def test_mixed_texts_hold_the_words_taken(spark):
    from keyloop.llm import source_mix as M
    rows, docs = mixed_docs(spark)
    taken = {}
    for r in M.mix(docs).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    whole = {}
    for i, t, _ in rows:
        whole.setdefault(i, t)
    held = {}
    for r in M.mixed_texts(docs).collect():
        held[r.doc_id] = held.get(r.doc_id, 0) + len(D.words(r.text))
        assert whole[r.doc_id].startswith(r.text)
    assert held == {k: v for k, v in taken.items() if v}


def test_mix_with_named_weights_and_empty(spark):
    from keyloop.llm import source_mix as M
    _, docs = mixed_docs(spark)
    got = M.mix(docs, weights={"a": 1, None: 1}, share=0.2, most=3.0)
    assert {r.source for r in got.where("taken > 0").collect()} == {"a", None}
    assert M.mix(docs.limit(0)).count() == 0 and M.mixed_texts(docs.limit(0)).count() == 0
    assert M.mix(docs.withColumn("text", F.lit(" "))).agg(F.sum("taken")).first()[0] == 0


def test_running_sums_over_many_ranges(spark, many_ranges):
    """One group in all ranges, small groups, ties and null keys."""
    from keyloop.llm import ordering as O
    rng = random.Random(4)
    rows = [(rng.choice(["hot"] * 9 + ["x", None]), rng.randrange(40), i, rng.randrange(5)) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, k int, i int, v int")
    order = [F.asc("k"), F.asc("i")]
    got = O.running(O.dealt(df, [F.col("g"), *order], "test-order"), ["g"], order, F.col("v"), "before").collect()
    sums = {}
    for g, k, i, v in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        sums[(g, i)] = sums.get(g, 0)
        sums[g] = sums.get(g, 0) + v
    assert len(got) == 900 and all(r.before == sums[(r.g, r.i)] for r in got)
    assert len({r["__range"] for r in got if r.g == "hot"}) > 1


# ---------------------------------------------------------------- prefix trie
def brute_trie(rows):
    """The nodes of op12's contract, by plain dictionaries, of (conv_id, turn, role, text) rows."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", hashlib.md5(
                (text or "").encode()).hexdigest(), text or ""))
    convs = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(convs.get(c - int(np.fmod(c, 100)), [])[:h] + own[h:])
    members, ends = {}, {}
    for c, p in built.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
        ends.setdefault(p, []).append(c)
    leaves, saved, kids = {}, {}, {}
    for k in members:
        kids.setdefault(k, 0)
        if k:
            kids[k[:-1]] = kids.get(k[:-1], 0) + 1
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = leaves.get(k, 0) or 1
        saved[k] = saved.get(k, 0) + ((len(members[k]) - 1) * len(k[-1][1]) if k else 0)
        if k:
            leaves[k[:-1]] = leaves.get(k[:-1], 0) + leaves[k]
            saved[k[:-1]] = saved.get(k[:-1], 0) + saved[k]
    return [(min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
             sha(",".join(map(str, sorted(ends.get(k, [])))))) for k, m in members.items()]


def conversations(seed=1, n=400):
    rng = random.Random(seed)
    rows = []
    for c in range(-20, n):
        if c % 100 == 0 and rng.random() < 0.3:
            continue                                       # no template
        for turn in range(rng.choice([1, 1, 2, 3, 5, 8])):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "", None, "naïve 漢", "hello"])))
    rows += [(350, None, "user", "first"), (350, None, "user", "first"), (350, 0, None, None)]
    rows += [(None, 1, "user", "nobody"), (None, None, None, None)]
    rows += [(1 << 40, i, "user", f"turn {i % 3}") for i in range(700)]     # one long chain
    rows += [((1 << 40) + 7, i, "user", f"turn {i % 3}") for i in range(650)]
    rows += [(5_000_000 + i * 70_000, 0, "user", "the same") for i in range(60)]   # ids of many chunks
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_against_brute_force(spark, seed, many_ranges):
    from keyloop.llm import prefix_trie as T
    rows = conversations(seed)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {"depth": F.lit("own"), "n_convs": F.lit(0)})
    got = T.prefix_trie(df)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                           "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute_trie(rows), key=str)


def test_trie_of_empty_and_turnless(spark):
    from keyloop.llm import prefix_trie as T
    schema = "conv_id long, turn long, role string, text string"
    assert T.prefix_trie(spark.createDataFrame([], schema)).count() == 0
    assert T.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], schema)).count() == 0
    rows = [(c, 0, "user", "x") for c in range(101, 111)]     # no template; most lose their only turn
    assert sorted(map(tuple, T.prefix_trie(spark.createDataFrame(rows, schema)).collect()), key=str) == sorted(
        brute_trie(rows), key=str)


def test_tree_contraction_of_chains_stars_and_random_trees(spark):
    from keyloop.llm.tree_contraction import subtree_totals
    rng = random.Random(8)
    parent = {0: None}
    parent |= {i: i - 1 for i in range(1, 600)}                       # a chain, and a star at its middle
    parent |= {i: 300 for i in range(600, 1500)}
    parent |= {i: rng.randrange(1500, i) if i > 1500 else None for i in range(1500, 2200)}   # another tree
    depth, kids = {}, dict.fromkeys(parent, 0)
    for v in sorted(parent):
        depth[v] = 0 if parent[v] is None else depth[parent[v]] + 1
        if parent[v] is not None:
            kids[parent[v]] += 1
    total = {v: [1, v] for v in parent}
    for v in sorted(parent, reverse=True):
        if parent[v] is not None:
            total[parent[v]] = [a + b for a, b in zip(total[parent[v]], total[v])]
    df = spark.createDataFrame([(v, p, depth[v], kids[v], 1, v) for v, p in parent.items()],
                               "v long, p long, d long, k long, one long, w long")
    got = subtree_totals(df, ["v"], ["p"], "d", "k", ["one", "w"])
    assert {r.v: [r.one, r.w] for r in got.collect()} == total
    assert subtree_totals(df.limit(0), ["v"], ["p"], "d", "k", ["one"]).count() == 0
