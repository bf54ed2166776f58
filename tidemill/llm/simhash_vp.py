"""SimHash near-duplicates by vantage-point trees.

Equal fingerprints are one entry. Two fingerprints within 4 of 64 bits are within 1, 1 or 0 bits on one of three bands of
bits at least. For each band there is a vantage-point tree: an inner node holds a fingerprint and a radius and sends an
entry by its distance from it, on the band's bits, to the near or the far side. By the triangle inequality a partner is on the
other side only if the entry is close to the boundary, so an entry has one home shard and is a query in those beyond the
boundaries it is close to. In a shard its home entries are compared with each other and with the queries. (One tree
over all 64 bits gives the same pairs, but distances of unlike fingerprints lie within a few bits of 32, so at radius 4
two thirds of all entries are close to each boundary. A shard that a band cannot divide is divided so.)

The trees are grown from a sample of fingerprints, which decides only how even the shards are; all are searched. A shard
that is still too large is dealt as pairs of blocks. A task reports no more links than are needed to hang together
what hangs together within its shard, so a shard of one large family does not yield all its pairs.

Defined results: NULL texts and texts without words have the fingerprint zero, which links like any other. A row without id
has a fingerprint, joins no component and gets NULL. Repeated rows get a row each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import pieces, written
from tidemill.llm.jaccard_join import LOWER, components

# Fixed values of the fingerprint.
SHINGLE, SEED = 4, 42
ALL = (1 << 64) - 1
# Shingles that are unpacked to bits at once.
SHINGLES = 1 << 15
# About as many fingerprints decide the trees; what is broadcast has at most one node for a few of them.
SAMPLE = 1 << 17
# Fingerprints that a shard shall hold, and how many of a shard one task may get on either side.
SHARD, BLOCK = 1024, 1 << 18
# Entries compared at once.
CELLS = 1 << 20
# A division that leaves more than this share on a side is none.
WORTH = 0.9


# -- fingerprints ------------------------------------------------------------------------------------


def fingerprint(text: str | None) -> int:
    """64 bits of one whole text; a bit is set if it is set in over half of the shingles' hashes."""
    words = text.encode("utf-8").translate(LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(SHINGLE, len(words))
    starts = np.concatenate(([0], ends[: len(words) - width] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), SHINGLES):
        some = hashes[i : i + SHINGLES]
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        values = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """`doc_id, fp` for every row."""
    return docs.select("doc_id", "text").mapInArrow(_fingerprints, "doc_id bigint, fp bigint")


# -- trees -------------------------------------------------------------------------------------------


def bands(radius: int) -> list[tuple[int, int]]:
    """Three masks and how far partners may be apart on one of them: with each a bit more, they were too far apart."""
    edges = (0, 22, 43, 64)
    reach = [(radius + 1) // 3 - 1 + (i < (radius + 1) % 3) for i in range(3)]
    return [((1 << hi) - (1 << lo), t) for lo, hi, t in zip(edges, edges[1:], reach) if t >= 0]


# Nodes as a table of arrays. `low` and `high` are the sides, -1 at a shard; `roots` lists the trees.
NODE = ("vantage", "mask", "radius", "reach", "low", "high")
Forest = dict[str, np.ndarray]


def _division(values: np.ndarray, mask: int, reach: int) -> tuple[float, int, int]:
    """Cost, vantage point and radius of the best division that a few vantage points offer."""
    found = (float("inf"), 0, 0)
    for vantage in values[:: max(1, len(values) // 5)][:5]:
        upto = np.cumsum(np.bincount(np.bitwise_count((values ^ vantage) & np.uint64(mask)), minlength=65))
        near = upto[:64]
        close = near - np.concatenate((np.zeros(min(reach, 64), np.int64), near[: 64 - reach])) if reach else np.zeros(64, np.int64)
        cost = np.maximum(near, len(values) - near + close) + close
        r = int(np.argmin(cost))
        found = min(found, (float(cost[r]) / len(values), int(vantage), r))
    return found


def grow(sample: np.ndarray, radius: int, shard: int) -> Forest:
    """A tree for each band, from a sample; shards hold about `shard` values of it."""
    nodes: list[list[int]] = []

    def node() -> int:
        nodes.append([0, 0, 0, 0, -1, -1])
        return len(nodes) - 1

    roots = []
    for band in bands(radius):
        roots.append(node())
        stack = [(roots[-1], sample)]
        while stack:
            at, values = stack.pop()
            if len(values) <= shard:
                continue
            mask, reach = band
            cost, vantage, r = _division(values, mask, reach)
            if cost > WORTH:
                mask, reach = ALL, radius
                cost, vantage, r = _division(values, mask, reach)
            if cost > WORTH:
                continue
            near = np.bitwise_count((values ^ np.uint64(vantage)) & np.uint64(mask)) <= r
            low, high = node(), node()
            nodes[at] = [vantage, mask, r, reach, low, high]
            stack += [(low, values[near]), (high, values[~near])]
    forest = {name: np.array(c, np.uint64 if name in ("vantage", "mask") else np.int64) for name, c in zip(NODE, zip(*nodes))}
    return forest | {"roots": np.array(roots)}


def route(values: np.ndarray, forest: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position, shard and whether it is at home there, for every shard that an entry belongs to or asks."""
    vantage, mask, radius, reach, low_side, high_side = (forest[name] for name in NODE)
    at = np.tile(np.arange(len(values)), len(forest["roots"]))
    node = np.repeat(forest["roots"], len(values))
    home = np.ones(len(at), bool)
    done = []
    while len(at):
        inner = low_side[node] >= 0
        done.append((at[~inner], node[~inner], home[~inner]))
        at, node, home = at[inner], node[inner], home[inner]
        d = np.bitwise_count((values[at] ^ vantage[node]) & mask[node]).astype(np.int64)
        r, t = radius[node], reach[node]
        # A pair of home entries meets on the far side, where the near one is a query. Queries go both ways.
        low = np.where(home, d <= r, d <= r + t)
        high = d > r - t
        at = np.concatenate((at[low], at[high]))
        home = np.concatenate((home[low], (home & (d > r))[high]))
        node = np.concatenate((low_side[node][low], high_side[node][high]))
    return tuple(np.concatenate(c) for c in zip(*done)) if done else (np.empty(0, np.int64),) * 3


ENTRY = "shard int, fp bigint, home boolean"


def _routed(batches: Iterator[pa.RecordBatch], forest) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            values = batch.column("fp").slice(start, 4096).to_numpy()
            at, shard, home = route(values.view(np.uint64), forest.value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), pa.array(values[at]), pa.array(home.astype(bool))], names=["shard", "fp", "home"]
            )


# -- shards ------------------------------------------------------------------------------------------


def search(home: np.ndarray, query: np.ndarray, own: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all home entries and queries that linked pairs join; with `own`, home entries meet each other.

    Pairs of queries are not looked at: they meet where one of them is at home.
    """
    entries = np.concatenate((home, query))
    label = np.arange(len(entries))
    x, y = [], []
    step = max(1, CELLS // max(1, len(entries)))
    for first in range(0, len(home), step):
        part = home[first : first + step, None]
        if own:
            near = np.bitwise_count(part ^ entries[None, first:]) <= radius
            offset = first
        else:
            near = np.bitwise_count(part ^ query[None, :]) <= radius
            offset = len(home)
        row, col = np.nonzero(near)
        row, col = row + first, col + offset
        fresh = label[row] != label[col]
        row, col = row[fresh], col[fresh]
        cuts = np.flatnonzero(np.concatenate(([True], np.diff(row) != 0, [True]))) if len(row) else ()
        for a, b in zip(cuts[:-1], cuts[1:]):
            i, others = row[a], col[a:b]
            others = others[label[others] != label[i]]
            if not len(others):
                continue
            labels, one = np.unique(label[others], return_index=True)
            x.append(np.full(len(one), entries[i]))
            y.append(entries[others[one]])
            if len(labels) == 1:
                label[label == labels[0]] = label[i]
            else:
                label[np.isin(label, labels)] = label[i]
    if not x:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(x), np.concatenate(y)


def _searched(rows: pd.DataFrame, radius: int) -> pd.DataFrame:
    values, home = rows["fp"].to_numpy().view(np.uint64), rows["home"].to_numpy(bool)
    x, y = search(values[home], values[~home], bool((rows["i"] == rows["j"]).iloc[0]), radius)
    return pd.DataFrame({"x": x.view(np.int64), "y": y.view(np.int64)})


def links(nodes: DataFrame, radius: int = 4, sample: int = SAMPLE, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """`x, y`: links between the distinct fingerprints `fp`, enough to join all that are joined by pairs within `radius`."""
    spark = nodes.sparkSession
    step = -(-nodes.count() // sample) or 1
    chosen = nodes.where(F.pmod(F.xxhash64("fp"), F.lit(step)) == 0).select("fp").toArrow()["fp"].to_numpy()
    forest = grow(np.sort(chosen).view(np.uint64), radius, max(8, shard // step))
    sent = spark.sparkContext.broadcast(forest)
    routed = nodes.select("fp").mapInArrow(partial(_routed, forest=sent), ENTRY)
    # Both sides of a pair of blocks have at most about `block` entries. Home entries meet those of later blocks as queries.
    large = routed.groupBy("shard").count().where(F.col("count") > block).select("shard", F.ceil(F.col("count") / block).cast("int").alias("parts"))
    parts = F.coalesce("parts", F.lit(1))
    dealt = routed.join(F.broadcast(large), "shard", "left").select(
        "shard", "fp", "home", parts.alias("parts"), F.pmod(F.xxhash64("fp"), parts).cast("int").alias("b")
    )
    place = lambda i, j, home: F.struct(i.alias("i"), j.alias("j"), home.alias("home"))
    blocks = F.sequence(F.lit(0), F.col("parts") - 1)
    asks = F.transform(blocks, lambda k: place(k, F.col("b"), F.lit(False)))
    is_home = F.transform(blocks, lambda k: place(F.col("b"), k, F.lit(True)))
    # A home entry is a query in the blocks before its own only, and in its own it is no query.
    meets = F.when(F.col("home"), F.concat(is_home, F.filter(asks, lambda p: p["i"] < F.col("b")))).otherwise(asks)
    entries = dealt.select("shard", "fp", F.explode(meets).alias("p")).select("shard", "p.i", "p.j", "p.home", "fp")
    return entries.groupBy("shard", "i", "j").applyInPandas(partial(_searched, radius=radius), "x bigint, y bigint")


def near_duplicates(docs: DataFrame, radius: int = 4, **sizes: int) -> DataFrame:
    """`doc_id, fp, component_id` for every row: the least id that is reached by links."""
    prints = written(fingerprints(docs), "simhash-prints")
    nodes = written(prints.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = components(links(nodes, radius, **sizes), "simhash").select(F.col("id").alias("fp"), "root")
    rooted = written(nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.join(named, "root").select("fp", "component_id")
    return prints.join(of, "fp", "left").select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )


def digests(docs: DataFrame) -> DataFrame:
    """`doc_id, fingerprint, component_id`, with the fingerprint in 16 hexadecimal digits."""
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
