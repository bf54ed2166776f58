"""Periodic runs against brute force over all starts and periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from llm_frames import frame  # noqa: F401

from tidemill.llm import periodic_runs as R

FOLDER = "/root/testdata/sf0.001"


def brute(words):
    """Every run as (start, length, period): for each period the stretches of equal words that far apart."""
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((i, e - i, q) for (i, e), q in found.items())


def edited(doc_id, words):
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def expected(doc_id, text):
    words = edited(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = None
    for run in runs:
        if top is None or run[1] * top[2] > top[1] * run[2]:
            top = run
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    four = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(runs), *four, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def hard(seed):
    r = random.Random(seed)
    kind = seed % 6
    if kind == 0:
        return [r.choice("ab") for _ in range(r.randrange(120))]
    if kind == 1:  # runs of all sizes side by side, some overlapping
        return [w for _ in range(6) for w in [r.choice("abc") for _ in range(r.randrange(1, 30))] * r.randrange(1, 9)]
    if kind == 2:
        return ["a"] * r.randrange(200)
    if kind == 3:
        return fibonacci(300)
    if kind == 4:  # runs of runs
        inner = ["a"] * r.randrange(3, 9) + ["b"]
        return (inner * r.randrange(3, 7) + ["c"]) * r.randrange(2, 7)
    return [str(r.randrange(40)) for _ in range(r.randrange(50))] * r.randrange(1, 12)


@pytest.mark.parametrize("first", range(0, 300, 50))
def test_runs_of_many_texts_at_once(first):
    texts = [hard(s) for s in range(first, first + 50)]
    names = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    word = np.array([names[w] for t in texts for w in t])
    of = np.repeat(np.arange(50), [len(t) for t in texts])
    start, length, period = (c.tolist() for c in R.find_runs(word, of))
    got, base = list(zip(start, length, period)), 0
    want = []
    for t in texts:
        want += [(s + base, n, q) for s, n, q in brute(t)]
        base += len(t)
    assert got == want


def test_transform_and_its_inverse():
    r = np.random.default_rng(1)
    for size in (2, 4, 32, 1024):
        a = r.integers(0, R.PRIME, (3, size)).astype(np.uint64)
        assert (R.inverse(R.transform(a)) == a).all()


@pytest.mark.parametrize("most, block", [(1, 4), (255, 64), (5000, 4096), (10**6, 1 << 16)])
def test_sums_stay_below_the_prime(most, block):
    planes, bits = R.digits(most, block)
    assert planes * bits >= most.bit_length() and planes * block * (2**bits - 1) ** 2 < R.PRIME


def test_many_distinct_words_need_several_digits():
    words = [i for _ in range(5) for i in range(3000)]
    start, length, period = R.find_runs(np.array(words), np.zeros(len(words), np.int64))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [15000], [3000])


def test_query_against_brute_force(frame):
    r = random.Random(2)
    rows = [(i, " ".join(hard(i))) for i in range(240)]
    rows += [(1000, None), (1001, ""), (1002, " \t\n "), (None, "a a a a a a a"), (1003, "a b " * 30), (1003, "a b " * 30)]
    rows += [(1004, "  " * 9), (1005, "x y " * 8), (1006, "\x1c \x1c \x1c \x1c \x1c \x1c")]
    rows += [(1007, " ".join(str(r.randrange(9)) for _ in range(3000))), (1008, "z " * 4000)]
    got = sorted(map(tuple, R.digests(frame(rows)).collect()), key=repr)
    assert got == sorted((expected(*row) for row in rows), key=repr)


def test_documents_and_an_empty_table(spark, frame):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = sorted(map(tuple, R.digests(docs).collect()))
    assert got == sorted(expected(d.doc_id, d.text) for d in docs.collect())
    assert sum(row[1] for row in got) > 10
    assert R.digests(frame([(1, "a")]).limit(0)).collect() == []


def test_collapsed_text_keeps_one_period(frame):
    row = R.periodic_runs(frame([(1, "so it goes it goes it goes it goes on")])).first()
    assert row.collapsed == "so it goes on" and [tuple(x) for x in row.runs] == [(1, 8, 2)] and row.n_words == 10
