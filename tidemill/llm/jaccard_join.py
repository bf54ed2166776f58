"""N-gram Jaccard join: which documents have nearly the same set of word shingles, exactly.

Index lists with set relations. A set's shingles are ordered with frequent ones last, otherwise by
hash. Two sets as similar as asked share a shingle among the first few of both (the prefix), and the
places of their first common shingle bound their overlap. A list is laid out in blocks of one set size,
by place within: blocks of sizes that an entry's place rules out are skipped, and of the others all from
the first place on that leaves too little to share. Equal sets are one entry.
In long lists no set is compared with all others: a list's first set is compared with each member,
and from its answers follow those of the members: members that it joins need no test among
themselves, and the overlap of two others follows from what each has lost and gained against it.
Candidates must pass an upper bound from histograms, which have a bucket for four to eight shingles, before whole sets are
compared, and sets that other links have joined meanwhile are not compared any more: of the pairs that stay open, each set
first meets one partner, then what is left.

Defined results: a NULL text, a text without words and a document without id link with nothing (a
component_id is the own id then, NULL without one). Fewer words than `k` form one shingle. Repeated
rows are one set and each gets a row.
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

from tidemill.llm.common import Membership, holds, pieces, without, written

# ASCII letters to lower case; odd multipliers of the hash.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
MULTIPLY, MIX_1, MIX_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

# A shingle is frequent from this many sets on, and the table of frequent ones stays within 2 ** 17 rows:
# the limit rises with the number of counted shingles.
FREQUENT = 16
FREQUENT_ROWS = 1 << 17
# Lists up to this length are compared pair by pair, longer ones by a pivot first.
SHORT = 32
# Members of a long list that are compared at once.
BLOCK = 1000
# Differences to a pivot up to this size are kept; members with larger ones are compared as whole sets.
DIFFERENCES = 4096
# Buckets of the histogram of a set: from 64 on, one for at least four shingles. Differences have a smaller one.
BUCKETS, MOST_BUCKETS, FULL = 64, 1 << 14, 255
DIFFERENCE_BUCKETS = 32
# Pairs whose histograms are looked at together.
PAIRS_AT_ONCE = 20_000
# Entries of short lists whose partners are looked up together.
ENTRIES_AT_ONCE = 50_000
WORD_CACHE = 100_000
# Sets that a task remembers to have described; it describes a forgotten one again.
SEEN = 100_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return (x ^ (x >> np.uint64(31))) >> np.uint64(1)


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes (63 bits) of one whole text."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []
    if not words:
        return np.empty(0, np.int64)
    if len(_hashes) > WORD_CACHE:
        _hashes.clear()
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    width = min(k, len(words))
    acc = h[: len(h) - width + 1].copy()
    for j in range(1, width):
        acc = acc * MULTIPLY + h[j : len(h) - width + 1 + j]
    s = np.sort(_mixed(acc + np.uint64(width)).view(np.int64))
    return s[np.concatenate(([True], s[1:] != s[:-1]))]


def set_hash(s: bytes) -> int:
    """With the size, the name of a set: two sets of one size share it once in 2 ** 64 pairs."""
    return xxhash.xxh3_64_intdigest(s) - (1 << 63)


def needed(n: int | np.ndarray, tenths: int):
    """Least size of a partner, and of the overlap with it: ceil(n * t)."""
    return -((-n * tenths) // 100)


def prefix_length(n, percent: int):
    return n - needed(n, percent) + 1


def overlap_needed(x, y, percent: int):
    """Least overlap of two sets of these sizes: ceil(t / (1 + t) * (x + y))."""
    return -((-(x + y) * percent) // (100 + percent))


def linked(x, y, overlap, percent: int):
    return 100 * overlap >= percent * (x + y - overlap)


def histogram(s: np.ndarray) -> bytes:
    """How many shingles fall into each bucket; a full bucket holds FULL or more."""
    size = min(MOST_BUCKETS, 1 << max(6, (len(s) // 4).bit_length() - 1))
    return np.minimum(np.bincount(s & (size - 1), minlength=size), FULL).astype(np.uint8).tobytes()


def folded(raw: bytes, size: int) -> np.ndarray:
    """A histogram brought to fewer buckets."""
    return np.frombuffer(raw, np.uint8).reshape(-1, size).sum(0, dtype=np.int64)


def most_common(a: bytes, b: bytes) -> int | None:
    """Upper bound of the overlap of two sets, None if a full bucket hides it."""
    if max(a) == FULL or max(b) == FULL:
        return None
    size = min(len(a), len(b))
    return int(np.minimum(folded(a, size), folded(b, size)).sum())


# -- sets --------------------------------------------------------------------------------------

SETS = "doc_id bigint, n int, sid bigint, low array<bigint>, hist binary"


def _list_array(parts: list[np.ndarray | None]) -> pa.Array:
    sizes = [0 if p is None else len(p) for p in parts]
    offsets = pa.array(
        [None if p is None else int(o) for p, o in zip(parts, np.cumsum([0, *sizes[:-1]]))] + [int(sum(sizes))], pa.int32()
    )
    flat = np.concatenate([p for p in parts if p is not None] or [np.empty(0, np.int64)])
    return pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int64()))


def _describe(batches: Iterator[pa.RecordBatch], k: int, percent: int, window: int) -> Iterator[pa.RecordBatch]:
    """Size and hash of each set; its lowest shingles and its histogram where the task meets it first."""
    seen: set[tuple[int, int]] = set()
    for batch in pieces(batches):
        n, sid, low, hist = [], [], [], []
        for text, named in zip(batch.column("text").to_pylist(), batch.column("doc_id").is_valid().to_pylist()):
            s = shingle_set(text, k)
            key = (len(s), set_hash(s.tobytes()))
            n.append(key[0])
            sid.append(key[1])
            if key in seen or not len(s) or not named:
                low.append(None)
                hist.append(None)
                continue
            if len(seen) > SEEN:
                seen.clear()
            seen.add(key)
            low.append(s[: window * prefix_length(len(s), percent) // 4 + 2])
            hist.append(histogram(s))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int32()), pa.array(sid, pa.int64()), _list_array(low), pa.array(hist, pa.binary())],
            names=["doc_id", "n", "sid", "low", "hist"],
        )


def _whole_sets(batches, k: int, bits):
    """The sets of the documents that the filter names."""
    for batch in batches:
        hit = np.flatnonzero(holds(bits.value, batch.column("bit").to_numpy(zero_copy_only=False)))
        if not len(hit):
            continue
        for part in pieces([batch.take(pa.array(hit))]):
            sets = [s for t in part.column("text").to_pylist() if len(s := shingle_set(t, k))]
            raw = [s.tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_hash(s) for s in raw], pa.int64()), pa.array([len(s) for s in sets], pa.int32()), pa.array(raw, pa.binary())],
                names=["sid", "n", "s"],
            )


def _sets_of(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """`sid, n, s` for (at least) the documents in `ids`; all texts are read, few are shuffled."""
    found = Membership.of(ids, "doc_id")
    return docs.where("doc_id IS NOT NULL").select("text", Membership.bit("doc_id").alias("bit")).mapInArrow(
        partial(_whole_sets, k=k, bits=found.bits), "sid bigint, n int, s binary"
    )


# -- the order of shingles ---------------------------------------------------------------------


def _frequent(tokens: DataFrame, limit: int) -> np.ndarray:
    """At most FREQUENT_ROWS shingles, as `limit` is at least that share of all rows."""
    rows = tokens.groupBy("t").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= limit).select("t").toArrow()
    return np.sort(rows["t"].to_numpy())


def _is_in(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


def _is_short(low: np.ndarray, n: int, percent: int, frequent: np.ndarray) -> bool:
    """Whether the lowest shingles do not hold a whole prefix of rare ones."""
    return len(low) < n and int((~_is_in(frequent, low)).sum()) < prefix_length(n, percent)


def _needy(batches, percent: int, frequent):
    for batch in batches:
        low, n = batch.column("low"), batch.column("n").to_numpy()
        values, offsets = low.values.to_numpy(), low.offsets.to_numpy()
        keep = [_is_short(values[offsets[i] : offsets[i + 1]], n[i], percent, frequent.value) for i in range(len(n))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").filter(pa.array(keep))], names=["doc_id"])


def _tokens(batches):
    for batch in batches:
        for s in batch.column("s").to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(s, np.int64))], names=["t"])


# -- index lists -------------------------------------------------------------------------------

# `rare`: how many of the set's shingles are not frequent; all of them, where a frequent one is in the prefix.
ENTRY = "t bigint, sid bigint, n int, pos int, rare int, frequent boolean"
ENTRY_NAMES = ["t", "sid", "n", "pos", "rare", "frequent"]


def _entries(sets: Iterator[tuple[np.ndarray, int, int]], percent: int, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    rows: list[list[np.ndarray]] = [[] for _ in ENTRY_NAMES]
    held = 0

    def out():
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in rows], names=ENTRY_NAMES)

    for low, n, sid in sets:
        often = _is_in(frequent, low)
        first = np.concatenate((low[~often], low[often]))[: prefix_length(n, percent)]
        rare, place = int((~often).sum()), np.arange(len(first), dtype=np.int32)
        count = lambda v, kind: np.full(len(first), v, kind)
        for column, values in zip(rows, (first, count(sid, np.int64), count(n, np.int32), place, count(rare, np.int32), place >= rare)):
            column.append(values)
        held += len(first)
        if held > 200_000:
            yield out()
            rows, held = [[] for _ in ENTRY_NAMES], 0
    if held:
        yield out()


def _entries_of_low(batches, percent: int, frequent):
    def sets():
        for batch in batches:
            low, n, sid = batch.column("low"), batch.column("n").to_pylist(), batch.column("sid").to_pylist()
            values, offsets = low.values.to_numpy(), low.offsets.to_numpy()
            for i in range(len(n)):
                part = values[offsets[i] : offsets[i + 1]]
                if not _is_short(part, n[i], percent, frequent.value):
                    yield part, n[i], sid[i]

    return _entries(sets(), percent, frequent.value)


def _entries_of_sets(batches, percent: int, frequent):
    def sets():
        for batch in batches:
            for s in batch.column("s").to_pylist():
                yield np.frombuffer(s, np.int64), len(s) // 8, set_hash(s)

    return _entries(sets(), percent, frequent.value)


PAIR = "t bigint, xs bigint, xn int, xp int, ys bigint, yn int, yp int, xr int, yr int"
PAIR_NAMES = ["t", "xs", "xn", "xp", "ys", "yn", "yp", "xr", "yr"]


def _ranges(first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges one after the other, and the range each comes from."""
    size = np.maximum(stop - first, 0)
    owner = np.repeat(np.arange(len(size)), size)
    return np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + first[owner], owner


def _places(t, n, pos, order, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows whose sets can be linked if the list they share, `t`, is of their first common shingle.

    `order` sorts the rows by list, size and place, so a list is a row of blocks of one size. An entry
    with `pos` shingles before this one has n - pos left to share. That and its size give the largest
    partner: blocks beyond are skipped. In a block that is left the partner's place bounds the overlap
    as well, and with it the block's entries up to a place that one search finds.
    """
    t, n, pos = t[order], n[order], pos[order]
    if not len(t):
        return
    heads = np.flatnonzero(np.concatenate(([True], (t[1:] != t[:-1]) | (n[1:] != n[:-1]))))
    ends = np.append(heads[1:], len(t))
    block = np.repeat(np.arange(len(heads)), ends - heads)
    # Lists by number, so that list and size, or block and place, are one sortable value.
    number = np.cumsum(np.concatenate(([0], t[1:] != t[:-1])))
    wide = int(max(n.max(), pos.max())) + 2
    largest = np.minimum(n * 100 // percent, (n - pos) * (100 + percent) // percent - n)
    last = np.searchsorted((number * wide + n)[heads], number * wide + np.minimum(largest, wide - 1), side="right")
    in_place = block * wide + pos
    at = np.arange(len(t))
    for low in range(0, len(t), ENTRIES_AT_ONCE):
        mine = at[low : low + ENTRIES_AT_ONCE]
        other, x = _ranges(block[mine], last[mine])
        x = mine[x]
        size = n[heads[other]]
        end = np.searchsorted(in_place, other * wide + size - overlap_needed(n[x], size, percent), side="right")
        y, pair = _ranges(np.maximum(heads[other], x + 1), end)
        if len(y):
            yield order[x[pair]], order[y]


def _pairs(batches, percent: int):
    """Pairs of short lists, and a pivot with each member of long ones (`t` is set for those only).

    Rows come sorted by shingle and place. At most one list is held over, and of a long list only its
    first entry.
    """
    names = ("t", "sid", "n", "pos")
    rest = {c: np.empty(0, np.int64) for c in names}
    pivot = None  # of a long list that goes on

    def out(t, x, y):
        kinds = (pa.int64(), pa.int32(), pa.int32())
        nothing = pa.array(np.zeros(len(t), np.int32))  # shingles before a rare one may be shared with any set
        return pa.RecordBatch.from_arrays(
            [pa.array(t, pa.int64()), *(pa.array(v).cast(kind) for e in (x, y) for v, kind in zip(e, kinds)), nothing, nothing],
            names=PAIR_NAMES,
        )

    def work(rows, last: bool):
        nonlocal pivot, rest
        t = rows["t"]
        if not len(t):
            return
        if pivot is not None:  # the rest of a long list
            mine = int(np.searchsorted(t, pivot[0], side="right"))
            if mine:
                x = tuple(np.full(mine, v) for v in pivot[1:])
                yield out(t[:mine], x, tuple(rows[c][:mine] for c in names[1:]))
            if mine == len(t) and not last:
                return
            rows = {c: v[mine:] for c, v in rows.items()}
            t, pivot = rows["t"], None
            if not len(t):
                return
        starts = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
        lengths = np.diff(np.append(starts, len(t)))
        if not last:
            cut = starts[-1]
            if lengths[-1] <= SHORT:
                rest = {c: v[cut:] for c, v in rows.items()}
                rows = {c: v[:cut] for c, v in rows.items()}
                t, starts, lengths = rows["t"], starts[:-1], lengths[:-1]
            else:
                pivot = (t[cut], rows["sid"][cut], rows["n"][cut], rows["pos"][cut])
        length = np.repeat(lengths, lengths)
        long = np.flatnonzero(length > SHORT)
        if len(long):
            at = np.repeat(starts, lengths)[long]
            other = long != at
            yield out(t[long][other], tuple(rows[c][at][other] for c in names[1:]), tuple(rows[c][long][other] for c in names[1:]))
        few = np.flatnonzero((length > 1) & (length <= SHORT))
        e = {c: rows[c][few].astype(np.int64) for c in names}
        for i, j in _places(e["t"], e["n"], e["pos"], np.lexsort((e["pos"], e["n"], e["t"])), percent):
            other = (e["sid"][i] != e["sid"][j]) | (e["n"][i] != e["n"][j])
            i, j = i[other], j[other]
            swap = e["sid"][i] > e["sid"][j]
            a, b = np.where(swap, j, i), np.where(swap, i, j)
            yield out(pa.nulls(len(i), pa.int64()), *([e[c][at] for c in names[1:]] for at in (a, b)))

    for batch in batches:
        rows = {c: np.concatenate((rest[c], batch.column(c).to_numpy())) for c in names}
        rest = {c: np.empty(0, np.int64) for c in names}
        yield from work(rows, False)
    yield from work(rest, True)


# -- tests of pairs ----------------------------------------------------------------------------

KEYS = ["xs", "xn", "ys", "yn"]
KEY = "xs bigint, xn int, ys bigint, yn int"


def _bounded(batches):
    """Adds the overlap that the histograms allow."""
    for batch in batches:
        sizes = zip(batch.column("xn").to_pylist(), batch.column("yn").to_pylist())
        most = [
            min(xn, yn) if (bound := most_common(a, b)) is None else bound
            for (xn, yn), a, b in zip(sizes, batch.column("xh").to_pylist(), batch.column("yh").to_pylist())
        ]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in KEYS), batch.column("star"), pa.array(most, pa.int64())], names=[*KEYS, "star", "most"])


def _compared(batches):
    """Overlap of the two sets of each row, and for pairs with a pivot what either has alone, if that is little."""
    for batch in batches:
        got, only_x, only_y = [], [], []
        for i in range(batch.num_rows):
            x, y = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in ("x", "y"))
            x_in = _is_in(y, x)
            overlap = int(x_in.sum())
            few = batch.column("star")[i].as_py() and max(len(x), len(y)) - overlap <= DIFFERENCES
            got.append(overlap)
            only_x.append(x[~x_in].tobytes() if few else None)
            only_y.append(y[~_is_in(x, y)].tobytes() if few else None)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in (*KEYS, "star")), pa.array(got, pa.int64()), pa.array(only_x, pa.binary()), pa.array(only_y, pa.binary())],
            names=[*KEYS, "star", "overlap", "only_x", "only_y"],
        )


def _side(df: DataFrame, side: str, **columns: str) -> DataFrame:
    """Classes or sets under the column names of one side of a pair."""
    return df.select(F.col("sid").alias(f"{side}s"), F.col("n").alias(f"{side}n"), *(F.col(c).alias(name) for name, c in columns.items()))


def _sized() -> tuple:
    return F.col("xn").cast("bigint"), F.col("yn").cast("bigint")


def _bounds(pairs: DataFrame, classes: DataFrame, label: str) -> DataFrame:
    """`xs, xn, ys, yn, star, most` of distinct pairs; `most` bounds the overlap."""
    return written(
        pairs.join(_side(classes, "x", xh="hist"), ["xs", "xn"])
        .join(_side(classes, "y", yh="hist"), ["ys", "yn"])
        .select(*KEYS, "star", "xh", "yh")
        .mapInArrow(_bounded, f"{KEY}, star boolean, most bigint"),
        f"{label}-bounded",
    )


def _whole(docs: DataFrame, pairs: DataFrame, classes: DataFrame, k: int, percent: int, label: str) -> DataFrame:
    """`xs, xn, ys, yn, star, overlap, only_x, only_y, linked` of pairs whose sets are compared as wholes.

    `only_x` and `only_y` are there if one set is a pivot (`star`) and the differences are few.
    """
    named = pairs.select(F.col("xs").alias("sid"), F.col("xn").alias("n")).union(pairs.select("ys", "yn")).distinct()
    ids = named.join(classes, ["sid", "n"]).select("doc_id")
    sets = written(_sets_of(docs, ids, k), f"{label}-sets").dropDuplicates(["sid", "n"])
    compared = (
        pairs.select(*KEYS, "star").join(_side(sets, "y", y="s"), ["ys", "yn"])
        .join(_side(sets, "x", x="s"), ["xs", "xn"])
        .select(*KEYS, "star", "x", "y")
        .mapInArrow(_compared, f"{KEY}, star boolean, overlap bigint, only_x binary, only_y binary")
    )
    return written(compared.withColumn("linked", linked(*_sized(), F.col("overlap"), percent)), f"{label}-tested")


def _first_partners(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One pair for each second set, with its least partner, and the other pairs."""
    x = F.struct("xs", "xn")
    least = pairs.groupBy("ys", "yn").agg(F.min(x).alias("_least"))
    marked = pairs.join(least, ["ys", "yn"])
    return marked.where(x == F.col("_least")).drop("_least"), marked.where(x != F.col("_least")).drop("_least")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs that do not hang together yet."""
    root = lambda c: roots.select("id.*", "root").toDF(f"{c}s", f"{c}n", f"_{c}root")
    own = lambda c: F.coalesce(F.col(f"_{c}root"), F.struct(F.col(f"{c}s").alias("sid"), F.col(f"{c}n").alias("n")))
    both = pairs.join(root("x"), ["xs", "xn"], "left").join(root("y"), ["ys", "yn"], "left")
    return both.where(own("x") != own("y")).drop("_xroot", "_yroot")


def _edges(tested: DataFrame) -> DataFrame:
    end = lambda c: F.struct(F.col(f"{c}s").alias("sid"), F.col(f"{c}n").alias("n")).alias(c)
    return tested.where("linked").select(end("x"), end("y"))


# -- components --------------------------------------------------------------------------------


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """`id, root` of every end of an edge `x, y`. Each round maps a node to its least neighbour.

    "Least" is by hash, so chains shrink by a constant factor a round whatever the ids are. All steps
    are aggregates that combine before the shuffle, so a node with very many edges is no hot spot.
    """
    key = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
    edges = written(edges.where("x != y").distinct(), f"{label}-edges")
    roots = None
    while not edges.isEmpty():
        both = edges.union(edges.select("y", "x"))
        near = both.groupBy("x").agg(F.min(key("y")).alias("m"))
        parent = written(
            near.select(F.col("x").alias("id"), F.least(key("x"), F.col("m")).getField("v").alias("up")), f"{label}-parents"
        )
        if roots is None:
            roots = parent.withColumnRenamed("up", "root")
        else:
            up = parent.select(F.col("id").alias("root"), "up")
            roots = written(roots.join(up, "root", "left").select("id", F.coalesce("up", "root").alias("root")), f"{label}-roots")
        p, q = (parent.select(F.col("id").alias(c), F.col("up").alias(f"{c}_up")) for c in ("x", "y"))
        edges = written(
            edges.join(p, "x").join(q, "y").select(F.col("x_up").alias("x"), F.col("y_up").alias("y")).where("x != y").distinct(),
            f"{label}-edges",
        )
    if roots is None:
        return edges.select(F.col("x").alias("id"), F.col("y").alias("root"))
    return roots


# -- long lists: what follows from the pivot's answers -----------------------------------------

FOUND = f"{KEY}, linked boolean"


def _hashes_of(raw: bytes) -> frozenset | np.ndarray:
    """Few hashes as a set, which is fast to compare, many as a sorted array, which is small."""
    x = np.frombuffer(raw, np.int64)
    return frozenset(x.tolist()) if len(x) <= 128 else x


def _common(a: frozenset | np.ndarray, b: frozenset | np.ndarray) -> int:
    if isinstance(a, frozenset):
        if isinstance(b, frozenset):
            return len(a & b)
        a, b = b, a
    if isinstance(b, frozenset):
        b = np.fromiter(b, np.int64, len(b))
    return int(_is_in(a, b).sum())


class _Joined(dict):
    """Components that a task has joined so far, by their roots."""

    def find(self, x):
        while (up := self.get(x, x)) != x:
            self[x] = x = self.get(up, up)
        return x


GROUP = ["ps", "pn", "kind", "i", "j"]
NUMBERS = ("sid", "n", "up", "out", "rs", "rn", "pn")


class _Member:
    """What a member's payload says, unpacked when it is asked for."""

    def __init__(self, gone: bytes | None, new: bytes | None, hist: bytes):
        self.known, self.hist, self.full = gone is not None, hist, max(hist) == FULL
        self.coarse = folded(hist, BUCKETS)
        raw = [np.frombuffer(d or b"", np.int64) for d in (gone, new)]
        self.small = np.concatenate([np.bincount(d & (DIFFERENCE_BUCKETS - 1), minlength=DIFFERENCE_BUCKETS) for d in raw])
        self.raw, self.sets = raw, None

    def hashes(self):
        if self.sets is None:
            self.sets = [_hashes_of(d) for d in self.raw]
        return self.sets


def _block_links(x: dict, y: dict, same: bool, percent: int, found: list) -> None:
    """Adds the links between two blocks of members of one pivot, and pairs left open with None.

    Where both were compared with the pivot p, |x & y| = |x & p| + |y & p| - |p| + |(p - x) & (p - y)| +
    |(x - p) & (y - p)|: only the differences are looked at, their histograms first, and only where bounds leave the pair
    open. Rare shingles of x come before those of the lists they share and so are in x alone. Else the histograms of the sets
    decide. Members that links found here join need no test.
    """
    joined = _Joined()
    members: tuple[dict, dict] = ({}, {})
    if same:
        members = (members[0], members[0])

    def arrays(side: int, rows: dict, at: np.ndarray):
        """Payloads of these members as tables, and the row of each."""
        distinct, row = np.unique(at, return_inverse=True)
        kept = members[side]
        for m in distinct.tolist():
            if m not in kept:
                kept[m] = _Member(rows["gone"][m], rows["new"][m], rows["hist"][m])
        mine = [kept[m] for m in distinct.tolist()]
        return row, *(np.array([getattr(m, c) for m in mine]) for c in ("coarse", "small", "known", "full"))

    for first in range(0, len(x["n"]), 256):
        sid, n, up, out, rs, rn, pn = (x[c][first : first + 256, None] for c in NUMBERS)
        ys, yn, yu, yo, yrs, yrn, _ = (y[c][None, :] for c in NUMBERS)
        need = overlap_needed(n, yn, percent)
        ok = (np.minimum(n, yn) * 100 >= np.maximum(n, yn) * percent) & ((yrs != rs) | (yrn != rn))
        ok &= np.minimum(up, yu) + np.minimum(out, yo) >= need
        if same:
            ok &= np.arange(first, first + len(n))[:, None] < np.arange(len(y["n"]))[None, :]
        all_i, all_j = np.nonzero(ok)
        for at in range(0, len(all_i), PAIRS_AT_ONCE):
            i, j = all_i[at : at + PAIRS_AT_ONCE] + first, all_j[at : at + PAIRS_AT_ONCE]
            least = need[i - first, j]
            (p, coarse, small, known, full), (q, coarse_y, small_y, known_y, full_y) = arrays(0, x, i), arrays(1, y, j)
            fine = (np.minimum(coarse[p], coarse_y[q]).sum(1) >= least) | full[p] | full_y[q]
            both = known[p] & known_y[q]
            shared = x["up"][i] + y["up"][j] - x["pn"][i]
            fine &= ~both | (shared + np.minimum(small[p], small_y[q]).sum(1) >= least)
            for i_, j_, least_, shared_, both_ in zip(*(c[fine].tolist() for c in (i, j, least, shared, both))):
                root, other = joined.find((x["rs"][i_], x["rn"][i_])), joined.find((y["rs"][j_], y["rn"][j_]))
                if root == other:
                    continue
                a, b = members[0][i_], members[1][j_]
                if both_:
                    (gone, new), (gone_y, new_y) = a.hashes(), b.hashes()
                    if shared_ + _common(gone, gone_y) + _common(new, new_y) < least_:
                        continue
                    joined[root] = other
                else:
                    bound = most_common(a.hist, b.hist)
                    if bound is not None and bound < least_:
                        continue
                found.append((x["sid"][i_], x["n"][i_], y["sid"][j_], y["n"][j_], True if both_ else None))


def _derived(frames: Iterator[pd.DataFrame], percent: int) -> Iterator[pd.DataFrame]:
    """Links of pairs of blocks; rows come sorted by pair of blocks and side, and at most one pair is held over."""
    rest = None

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        key = rows[GROUP].to_numpy(np.int64)
        cuts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(1), [True])))
        columns = {c: rows[c].to_numpy(np.int64) for c in NUMBERS} | {c: rows[c].to_numpy() for c in ("gone", "new", "hist")}
        side, found = rows["side"].to_numpy(), []
        for a, b in zip(cuts[:-1], cuts[1:]):
            middle = a + int(np.searchsorted(side[a:b], 1))
            same = key[a, 2] == 1 and key[a, 3] == key[a, 4]
            x = {c: v[a:middle] for c, v in columns.items()}
            _block_links(x, x if same else {c: v[middle:b] for c, v in columns.items()}, same, percent, found)
        return pd.DataFrame(found, columns=[*KEYS, "linked"]).astype({"linked": object})

    for frame in frames:
        rows = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        key = rows[GROUP].to_numpy(np.int64)
        last = int(np.argmax((key == key[-1]).all(1))) if len(rows) else 0
        rest = rows.iloc[last:]
        if last:
            yield work(rows.iloc[:last])
    if rest is not None and len(rest):
        yield work(rest)


def _from_pivots(stars: DataFrame, tested: DataFrame, roots: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """`xs, xn, ys, yn, linked` of members of long lists; `linked` is NULL where the sets are still to be compared.

    Only pairs of different components matter: members that hang together with their pivot meet the others, not one
    another, and both come in blocks of bounded size.
    """
    back = tested.select("ys", "yn", "xs", "xn", "up", "known", F.col("only_y").alias("gone"), F.col("only_x").alias("new"))
    answers = tested.select(*KEYS, "up", "known", F.col("only_x").alias("gone"), F.col("only_y").alias("new")).union(back)
    own = (F.col("xs") == F.col("ys")) & (F.col("xn") == F.col("yn"))
    size = F.col("yn").cast("bigint")
    empty = F.lit(b"")
    # one row per pivot and member; rare shingles count only if all their common lists are of frequent ones
    members = stars.groupBy(*KEYS).agg(F.min(F.greatest(F.lit(0), F.col("yr") - F.col("xr"))).alias("rare")).join(answers, KEYS, "left")
    up = F.when(own, size).otherwise(F.coalesce("up", F.least(size, "xn")))
    gone, new = (F.when(own, empty).otherwise(F.col(c)) for c in ("gone", "new"))
    root = lambda c: roots.select("id.*", "root").toDF(f"{c}s", f"{c}n", f"{c}root")
    members = members.join(root("y"), ["ys", "yn"], "left").join(root("x"), ["xs", "xn"], "left").join(
        _side(classes, "y", hist="hist"), ["ys", "yn"]
    ).select(
        F.col("xs").alias("ps"), F.col("xn").alias("pn"), F.col("ys").alias("sid"), F.col("yn").alias("n"), up.alias("up"), gone.alias("gone"), new.alias("new"),
        # outside the pivot; without an answer all of the member may be there
        F.greatest(F.lit(0), F.when(own | F.coalesce("known", F.lit(False)), size - up).otherwise(size) - F.col("rare")).alias("out"),
        F.coalesce("yroot.sid", "ys").alias("rs"), F.coalesce("yroot.n", "yn").alias("rn"), "hist",
        (F.coalesce(F.col("yroot.sid"), F.col("ys")) == F.coalesce(F.col("xroot.sid"), F.col("xs"))).alias("inside"),
    )
    members = written(members, "jaccard-members")
    # Names and bounds first: members inside travel only if some member outside can be like them by sizes and overlaps.
    outside = lambda c: F.when(~F.col("inside"), F.col(c))
    beyond = members.groupBy("ps", "pn").agg(
        F.max(outside("up")).alias("o_up"), F.max(outside("out")).alias("o_out"), F.min(outside("n")).alias("o_low"), F.max(outside("n")).alias("o_high")
    ).where("o_low IS NOT NULL")
    n = F.col("n").cast("bigint")
    smallest = F.greatest(F.col("o_low").cast("bigint"), F.ceil(n * percent / 100))
    fits = (
        (smallest <= F.col("o_high")) & (n * 100 >= smallest * percent)
        & ((F.least("up", "o_up") + F.least("out", "o_out")) * (100 + percent) >= (n + smallest) * percent)
    )
    members = members.join(beyond, ["ps", "pn"]).where(~F.col("inside") | fits).drop("o_up", "o_out", "o_low", "o_high")
    size = lambda inside: F.sum((F.col("inside") == inside).cast("int"))
    counts = members.groupBy("ps", "pn").agg(
        F.ceil(size(True) / BLOCK).cast("int").alias("in_"), F.ceil(size(False) / BLOCK).cast("int").alias("out_"), F.count(F.lit(1)).alias("all_")
    ).where("all_ > 1").drop("all_")
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    block = F.pmod(F.xxhash64("sid", "n"), F.when(F.col("inside"), F.col("in_")).otherwise(F.col("out_"))).cast("int")
    dealt = members.join(counts, ["ps", "pn"]).withColumn("b", block)
    place = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.alias("side"))
    b = F.col("b")
    meets = F.when(F.col("inside"), F.transform(upto("out_"), lambda k: place(0, b, k, F.lit(0)))).otherwise(
        F.concat(
            F.when(F.col("in_") > 0, F.transform(upto("in_"), lambda k: place(0, k, b, F.lit(1)))).otherwise(F.array().cast("array<struct<kind:int,i:int,j:int,side:int>>")),
            F.transform(upto("out_"), lambda k: place(1, F.least(b, k), F.greatest(b, k), (b > k).cast("int"))),
        )
    )
    dealt = dealt.withColumn("place", F.explode(meets)).select("ps", "pn", "place.*", "sid", "n", "up", "out", "gone", "new", "rs", "rn", "hist")
    sorted_ = dealt.repartition(*GROUP).sortWithinPartitions(*GROUP, "side", "sid", "n")
    return sorted_.mapInPandas(partial(_derived, percent=percent), FOUND).distinct()


def jaccard_links(docs: DataFrame, k: int = 3, percent: int = 90) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sets, classes of equal sets, and links between classes, for documents `doc_id, text`.

    Sets: `doc_id, n, sid` per row. Classes: `sid, n, doc_id` (the least). Links: `x, y`, each the
    `sid, n` of a class; pairs that already hang together through other links are not listed.
    """
    if not 50 <= percent < 100 or k < 1:
        raise ValueError("percent is from 50 to 99 and k at least 1")
    spark = docs.sparkSession
    # The tighter the threshold, the shorter the prefix and the more of it is counted.
    window = 8 if percent >= 90 else 5
    sets = written(docs.select("doc_id", "text").mapInArrow(partial(_describe, k=k, percent=percent, window=window), SETS), "jaccard-sets")
    first = sets.where("low IS NOT NULL AND doc_id IS NOT NULL")
    classes = written(
        sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("sid", "n").agg(F.min("doc_id").alias("doc_id"))
        .join(first.groupBy("sid", "n").agg(F.first("hist").alias("hist")), ["sid", "n"]),
        "jaccard-classes",
    )
    rows = first.agg(F.sum(F.size("low"))).first()[0] or 0
    limit = max(FREQUENT, -(-rows // FREQUENT_ROWS))
    frequent = _frequent(first.select(F.explode("low").alias("t")), limit)
    sent = spark.sparkContext.broadcast(frequent)
    needy = written(first.select("doc_id", "n", "low").mapInArrow(partial(_needy, percent=percent, frequent=sent), "doc_id bigint"), "jaccard-needy")
    lists = first.select("n", "sid", "low")
    if needy.isEmpty():
        entries = lists.mapInArrow(partial(_entries_of_low, percent=percent, frequent=sent), ENTRY)
    else:
        # Documents made of frequent shingles: all of their shingles are counted, too.
        whole = written(_sets_of(docs, needy, k), "jaccard-whole")
        more = whole.agg(F.sum(F.length("s") / 8)).first()[0] or 0
        again = _frequent(whole.mapInArrow(_tokens, "t bigint"), max(FREQUENT, -(-int(more) // FREQUENT_ROWS)))
        both = spark.sparkContext.broadcast(np.union1d(frequent, again))
        short = written(first.select("doc_id", "n", "low").mapInArrow(partial(_needy, percent=percent, frequent=both), "doc_id bigint"), "jaccard-short")
        entries = lists.mapInArrow(partial(_entries_of_low, percent=percent, frequent=both), ENTRY).union(
            written(_sets_of(docs, short, k), "jaccard-short-sets").mapInArrow(partial(_entries_of_sets, percent=percent, frequent=both), ENTRY)
        )
    return sets, classes, _links(docs, entries, classes, k, percent)


def _links(docs: DataFrame, entries: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    rare = entries.where("NOT frequent").select("t", "sid", "n", "pos")
    often = entries.where("frequent").select("t", "sid", "n", "pos", "rare").distinct()
    # Rare shingles: one task walks whole lists. Frequent ones: each member meets the pivot of its list,
    # the set with the least place, in a join with a table of at most 2 * FREQUENT_ROWS rows.
    listed = rare.repartition("t").sortWithinPartitions("t", "pos", "n", "sid").mapInArrow(partial(_pairs, percent=percent), PAIR)
    pivots = often.groupBy("t").agg(F.min(F.struct("pos", "n", "sid", "rare")).alias("p")).select(
        "t", F.col("p.sid").alias("xs"), F.col("p.n").alias("xn"), F.col("p.pos").alias("xp"), F.col("p.rare").alias("xr")
    )
    starred = often.toDF("t", "ys", "yn", "yp", "yr").join(F.broadcast(pivots), "t").select(*PAIR_NAMES)
    found = written(listed.union(starred), "jaccard-found")
    x, y = F.struct("xs", "xn"), F.struct("ys", "yn")
    pick = lambda a, b: F.when(x < y, F.col(a)).otherwise(F.col(b))
    near = (F.least("xn", "yn") * 100 >= F.greatest("xn", "yn") * percent) & (x != y)
    pairs = found.where(near).groupBy(
        pick("xs", "ys").alias("xs"), pick("xn", "yn").alias("xn"), pick("ys", "xs").alias("ys"), pick("yn", "xn").alias("yn")
    ).agg(F.max(F.col("t").isNotNull()).alias("star"))
    bounded = _bounds(pairs, classes, "jaccard")
    hope = linked(*_sized(), F.col("most"), percent)
    # Pairs with a pivot are all compared; of the others each set meets one partner before the links so far are drawn.
    now, open_ = _first_partners(bounded.where(hope & ~F.col("star")).select(*KEYS, "star"))
    tested = _whole(docs, bounded.where(hope & F.col("star")).select(*KEYS, "star").union(now.select(*KEYS, "star")), classes, k, percent, "jaccard")
    links = _edges(tested)
    open_ = open_.select(*KEYS, "star")
    stars = found.where("t IS NOT NULL")
    roots = components(links, "jaccard-first")
    if not stars.isEmpty():
        # A pivot is a member of its list, too.
        own = stars.select("t", "xs", "xn", "xp", "xs", "xn", "xp", "xr", "xr").distinct().toDF(*PAIR_NAMES)
        nothing = F.lit(None).cast("binary")
        answers = tested.where("star").select(*KEYS, F.col("overlap").alias("up"), F.lit(True).alias("known"), "only_x", "only_y").union(
            bounded.where(~hope & F.col("star")).select(*KEYS, "most", F.lit(False), nothing, nothing)
        )
        derived = written(_from_pivots(stars.union(own), answers, roots, classes, percent), "jaccard-derived")
        links = links.union(_edges(derived))
        left = derived.where("linked IS NULL")
        if not left.isEmpty():
            ordered = left.select(*(pick(a, b).alias(a) for a, b in (("xs", "ys"), ("xn", "yn"), ("ys", "xs"), ("yn", "xn"))))
            open_ = open_.union(ordered.withColumn("star", F.lit(False))).distinct()
        roots = components(links, "jaccard-second")
    open_ = written(_apart(open_, roots), "jaccard-open")
    if open_.isEmpty():
        return links
    now, open_ = _first_partners(open_)
    links = links.union(_edges(_whole(docs, now, classes, k, percent, "jaccard-again")))
    open_ = written(_apart(open_, components(links, "jaccard-third")), "jaccard-left")
    if open_.isEmpty():
        return links
    return links.union(_edges(_whole(docs, open_, classes, k, percent, "jaccard-last")))


def jaccard_components(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """`doc_id, n_shingles, component_id` for every row of documents `doc_id, text`."""
    sets, classes, links = jaccard_links(docs, k, percent)
    roots = components(links).select("id.*", "root").toDF("sid", "n", "root")
    rooted = classes.select("sid", "n", "doc_id").join(roots, ["sid", "n"], "left")
    rooted = written(rooted.withColumn("root", F.coalesce("root", F.struct("sid", "n"))), "jaccard-rooted")
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(least, "root").select("sid", "n", "component_id")
    return sets.join(named, ["sid", "n"], "left").select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, that of the least id, with all its columns.

    Documents without words or id stay. Repeated rows with one id and text stay once.
    """
    named = written(jaccard_components(docs, k, percent), "jaccard-named")
    repeated = named.where("n_shingles > 0").groupBy("doc_id").count().where("count > 1")
    return without(docs, named.where("component_id != doc_id"), repeated)
