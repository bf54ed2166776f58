"""The join against brute force on hand-made and random sets."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from llm_frames import frame  # noqa: F401

from tidemill.llm import jaccard_join as J


def shingles(text, k):
    up = {c: c + 32 for c in range(65, 91)}
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(up))
    return frozenset(zip(*(w[j:] for j in range(k))) if len(w) >= k else [tuple(w)] if w else [])


def brute(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, s), (j, r) in combinations(sets, 2):
        if s and r and 100 * len(s & r) >= percent * len(s | r):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return sorted(((i, len(shingles(t, k)), None if i is None else find(i)) for i, t in rows), key=repr)


def corpus(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [r.choice(words) for _ in range(30)]
    base = [r.choice(words) for _ in range(90)]
    rows = []
    for i in range(260):
        kind = i % 4
        if kind == 0:
            text = [r.choice(words) for _ in range(r.randint(1, 60))]
        elif kind == 1:
            text = passage + [r.choice(words) for _ in range(r.randint(0, 50))]
        else:  # one large group of near copies
            text = list(base)
            for _ in range(r.randint(0, 4)):
                text[r.randrange(len(text))] = r.choice(words)
        rows.append((i, " ".join(text)))
    rows += [(300 + i, t) for i, t in rows[:40]]
    return rows


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_like_brute_force(frame, monkeypatch, k, percent):
    monkeypatch.setattr(J, "BLOCK", 20)
    rows = corpus(k)
    got = [tuple(x) for x in J.jaccard_components(frame(rows), k, percent).collect()]
    assert sorted(got, key=repr) == brute(rows, k, percent)


def test_common_hashes_in_any_form():
    r = random.Random(1)
    sides = [sorted(r.sample(range(900), n)) for n in (0, 5, 100, 300, 700)]
    forms = [J._hashes_of(J.np.array(x, J.np.int64).tobytes()) for x in sides]
    for x, a in zip(sides, forms):
        for y, b in zip(sides, forms):
            assert J._common(a, b) == len(set(x) & set(y))


@pytest.mark.parametrize("most", [0, 20])
def test_large_differences_are_compared_whole(frame, monkeypatch, most):
    monkeypatch.setattr(J, "DIFFERENCES", most)
    rows = corpus(9)
    got = [tuple(x) for x in J.jaccard_components(frame(rows)).collect()]
    assert sorted(got, key=repr) == brute(rows, 3, 90)


def test_edges_of_the_input(frame):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One two"), (9, "one  TWO"), (6, "one two three"), (7, "x"), (7, "x"),
        (None, "one two"), (8, "é é é"), (10, "É É É"), (11, "long " * 50_000),
    ]
    got = sorted((tuple(x) for x in J.jaccard_components(frame(rows)).collect()), key=repr)
    assert got == sorted(
        [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (9, 1, 4), (6, 1, 6), (7, 1, 7), (7, 1, 7), (None, 1, None), (8, 1, 8), (10, 1, 10), (11, 1, 11)],
        key=repr,
    )


def test_empty_table(frame):
    assert J.jaccard_components(frame([(1, "a")]).where("doc_id = 2")).count() == 0


def test_keep_one(frame):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (3, text + " more"), (3, text + " more"), (4, "other words"), (6, None), (None, text), (7, "")]
    kept = J.keep_one(frame(rows))
    assert kept.columns == frame(rows).columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([3, 4, 6, 7, None], key=repr)


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("x"), (F.col("id") + 1).alias("y"))
    roots = J.components(edges)
    assert roots.count() == 201 and roots.select("root").distinct().count() == 1


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_places_are_the_pairs_that_size_and_place_allow(percent):
    r = random.Random(percent)
    rows = []
    for t in range(60):
        for _ in range(r.choice([1, 2, 5, 32])):
            n = r.choice([1, 2, 10, r.randint(1, 60)])
            rows.append((t, n, r.randrange(J.prefix_length(n, percent))))
    r.shuffle(rows)
    t, n, pos = (np.array(c, np.int64) for c in zip(*rows))
    found = [tuple(sorted(p)) for i, j in J._places(t, n, pos, np.lexsort((pos, n, t)), percent) for p in zip(i.tolist(), j.tolist())]

    def allowed(a, b):
        (ta, na, place_a), (tb, nb, place_b) = rows[a], rows[b]
        need = -(-(na + nb) * percent // (100 + percent))
        return ta == tb and 100 * min(na, nb) >= percent * max(na, nb) and min(na - place_a, nb - place_b) >= need

    assert sorted(found) == [p for p in combinations(range(len(rows)), 2) if allowed(*p)]


def test_places_look_at_no_pair_of_blocks_ruled_out(monkeypatch):
    """Sets of very unlike sizes in one list: the ranges handed out hold possible pairs only."""
    n = np.array([10, 12, 1000, 1100, 90000], np.int64)
    zero = np.zeros(5, np.int64)
    looked, ranges = [], J._ranges
    monkeypatch.setattr(J, "_ranges", lambda a, b: looked.append(int(np.maximum(b - a, 0).sum())) or ranges(a, b))
    pairs = [(int(i), int(j)) for x, y in J._places(zero, n, zero, np.arange(5), 80) for i, j in zip(x, y)]
    # Blocks: each its own, and two partners; entries: the two partners.
    assert pairs == [(0, 1), (2, 3)] and looked == [7, 2]


def test_places_of_an_empty_list():
    none = np.empty(0, np.int64)
    assert list(J._places(none, none, none, none, 90)) == []
