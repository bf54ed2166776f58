"""SimHash near-duplicates against brute force over all pairs."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from llm_frames import frame  # noqa: F401

from tidemill.llm import simhash_vp as S

FOLDER = "/root/testdata/sf0.01"
UP = {c: c + 32 for c in range(65, 91)}


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(prints, least):
    """The least id reached from each fingerprint, by all pairs."""
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(prints, 2):
        if (a ^ b).bit_count() <= 4:
            root[find(a)] = find(b)
    ids = {}
    for p in prints:
        ids[find(p)] = min(ids.get(find(p), least[p]), least[p])
    return {p: ids[find(p)] for p in prints}


def brute(rows):
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    least = {}
    for i, p in prints:
        if i is not None:
            least[p] = min(i, least.get(p, i))
    named = components_of(list(least), least)
    return sorted(((i, f"{p:016x}", named[p] if i is not None else None) for i, p in prints), key=repr)


def family(r, size, spread):
    """Values around a centre, each a few bits away from one before it."""
    found = [r.getrandbits(64)]
    for _ in range(size):
        value = r.choice(found[-spread:])
        for b in r.sample(range(64), r.randrange(1, 6)):
            value ^= 1 << b
        found.append(value)
    return found


def test_bands_lose_no_pair():
    for radius in range(1, 8):
        bands = S.bands(radius)
        assert sum(t + 1 for _, t in bands) == radius + 1 or radius < 2
        assert sum(m for m, _ in bands) == S.ALL or radius < 2


@pytest.mark.parametrize("shard, block", [(8, 1 << 18), (64, 1 << 18), (64, 40), (10_000, 100)])
def test_links_join_what_all_pairs_join(spark, shard, block):
    r = random.Random(shard + block)
    values = {r.getrandbits(64) for _ in range(600)}
    values |= {v for _ in range(30) for v in family(r, 10, 3)} | set(family(r, 300, 300))
    values |= {1 << b for b in range(64)} | {0, S.ALL}
    values |= {v ^ (r.getrandbits(12) << 52) for v in [r.getrandbits(64)] for _ in range(300)}  # alike on two bands
    values = sorted(values)
    nodes = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp bigint")
    pairs = S.links(nodes, 4, shard=shard, block=block).collect()
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = a % (1 << 64), b % (1 << 64)
        assert (a ^ b).bit_count() <= 4
        root[find(a)] = find(b)
    least = {v: i for i, v in enumerate(values)}
    want = components_of(values, least)
    groups = {}
    for v in values:
        groups.setdefault(find(v), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(
        sorted(v for v in values if want[v] == c) for c in set(want.values())
    )


def test_few_links_from_a_family_of_near_copies():
    values = np.array([1 << b for b in range(64)] + [(1 << a) | (1 << b) for a, b in combinations(range(64), 2)], np.uint64)
    x, y = S.search(values, np.empty(0, np.uint64), True, 4)
    assert len(x) < 2 * len(values)


def test_every_pair_meets_in_a_shard():
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, 500).astype(np.uint64)
    near = base ^ (np.uint64(1) << r.integers(0, 64, 500).astype(np.uint64)) ^ (np.uint64(1) << r.integers(0, 64, 500).astype(np.uint64))
    values = np.concatenate((base, near))
    at, shard, home = S.route(values, S.grow(values, 4, 16))
    homes, all_ = {}, {}
    for i, s, h in zip(at.tolist(), shard.tolist(), home.tolist()):
        all_.setdefault(s, set()).add(i)
        if h:
            homes.setdefault(i, set()).add(s)
    assert len(all_) > 50 and all(len(s) == 3 for s in homes.values())
    for i in range(500):
        assert any(500 + i in all_[s] for s in homes[i]) or any(i in all_[s] for s in homes[500 + i])


def test_query_against_brute_force(frame):
    r = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "a B c"), (None, "one"), (7, "É é É é x"), (8, "x y")]
    for i in range(10, 130):
        text = [r.choice(words) for _ in range(r.choice([3, 4, 30, 400]))]
        rows += [(2 * i, " ".join(text)), (2 * i, " ".join(text))]
        text[r.randrange(len(text))] = "changed"
        rows.append((2 * i + 1, "  ".join(text).upper()))
    got = S.digests(frame(rows))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
    assert S.digests(frame(rows).limit(0)).collect() == []


def test_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    got = sorted(map(tuple, S.digests(docs).collect()), key=repr)
    assert got == brute([tuple(x) for x in docs.collect()])
    assert any(i != c for i, _, c in got)
