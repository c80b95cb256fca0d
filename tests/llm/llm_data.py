"""Small tables with the awkward cases, and plain brute-force versions of the operators."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=False):
    return WORD.findall((text or "").translate(LOWER) if lower else text or "")


def texts(seed: int, n: int = 60) -> list[str | None]:
    """Texts with shared lines and passages, near and exact copies, and odd characters."""
    rng = random.Random(seed)
    vocabulary = ["the", "of", "And", "é", "naïve", "x.", "|", "!!", "a1", "漢字", " nb", "zz\x1fy"] + [
        "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 6))) for _ in range(60)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    out: list[str | None] = [None, "", " \t\x0b ", "\n\n", "one", "one", "One two three", "one two Three"]
    for _ in range(n):
        lines = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 25)))
                 for _ in range(rng.randint(1, 5))]
        if rng.random() < 0.4:
            lines.insert(rng.randrange(len(lines) + 1), rng.choice(["Shared Line", "  shared line\t", passage]))
        text = "\n".join(lines)
        out.append(text)
        if rng.random() < 0.3:
            own = text.split(" ")
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            out.append(" ".join(own))
    out.append(" ".join(rng.choice(vocabulary) for _ in range(6000)) + "\n" + passage)  # a long one
    return out


def docs(spark, seed: int = 1, odd_ids: bool = True):
    """doc_id, text and columns whose names the operators use themselves."""
    rows = [(i, t) for i, t in enumerate(texts(seed))]
    if odd_ids:
        rows += [rows[12], rows[12], (None, rows[14][1]), (None, None)]  # repeated rows, null ids
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_words": F.lit("own"),
         "Kept": F.lit(0), "ids": F.lit("own"), "score": F.lit(1), "extra": F.array(F.lit(1))})


def empty(spark):
    return docs(spark, odd_ids=False).limit(0)


def brute_lines(rows, least, first):
    """[(kept text, lines, dropped)] of (id, text) rows."""
    seen = Counter()
    where = {}
    for ident, text in rows:
        keys = [x.strip(" \t\n\x0b\x0c\r").translate(LOWER) for x in (text or "").split("\n")]
        for k in set(keys) - {""}:
            seen[k] += 1
            place = (ident is None, ident, keys.index(k))
            if k not in where or place[:1] < where[k][:1] or (
                    place[:1] == where[k][:1] and not place[0] and place < where[k]):
                where[k] = place
    out = []
    for ident, text in rows:
        lines, kept = (text or "").split("\n"), []
        for at, x in enumerate(lines):
            k = x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
            bad = k and seen[k] >= least
            if bad and first and ident is not None and where[k] == (False, ident, at):
                bad = False
            if not bad:
                kept.append(x)
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def brute_hits(text, items, window):
    """(words, hit words, item ids) of a text."""
    w = BENCH_WORD.findall((text or "").translate(LOWER))
    hit, ids = set(), set()
    for ident, item in items:
        own = BENCH_WORD.findall((item or "").translate(LOWER))
        k = min(window, len(own))
        wins = {tuple(own[j:j + k]) for j in range(len(own) - k + 1)} if own else set()
        for i in range(len(w) - k + 1 if k else 0):
            if tuple(w[i:i + k]) in wins:
                hit.update(range(i, i + k))
                if ident is not None:
                    ids.add(ident)
    return len(w), len(hit), ids


def shingles(text, k):
    w = words(text, lower=True)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute_components(rows, k, num, den):
    """Smallest non-null id of each row's component (the own id without a set), by all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                label[root(i)] = root(j)
    members = defaultdict(list)
    for i, (ident, _) in enumerate(rows):
        if ident is not None:
            members[root(i)].append(ident)
    return [(len(sets[i]), min(members[root(i)], default=None) if sets[i] else rows[i][0])
            for i in range(len(rows))]


def brute_substrings(rows, window):
    """[(kept words, words, removed)]."""
    first = {}
    for ident, text in rows:
        if ident is not None:
            w = words(text)
            for i in range(len(w) - window + 1):
                t = tuple(w[i:i + window])
                first[t] = min(first.get(t, ident), ident)
    out = []
    for ident, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if ident is not None and first[tuple(w[i:i + window])] < ident:
                gone.update(range(i, i + window))
        out.append((" ".join(x for i, x in enumerate(w) if i not in gone), len(w), len(gone)))
    return out
