"""Periodic runs in the words of a text, found by block convolution.

A run is a stretch that repeats its first q words at least `EXPONENT` times and cannot be made longer. At the scale
B = 1, 2, 4, ... texts are cut into blocks of B words. A run with a period from B to 2B - 1 holds whole blocks, and each
occurs again one period further, in the window of 2B words that follows it. The sum of squared differences of
a block and each place of its window comes from one cyclic convolution by number-theoretic transform: exact integers, so zero
is a match. Blocks in a row that match at one distance are a seed; the words beside them say where
its stretch ends. Matches inside a run of a smaller period tell nothing new and are left out.

Words rarer than `EXPONENT` in a stretch cannot be in a run, so they cut it, before the convolution. Words are numbered within a
stretch and split into digits so small that the sums stay below the modulus.

All texts of a slice are worked on together as arrays, of bounded size; the work grows with n log n.

Defined results: NULL or an empty text has no words and no run. Repeated rows get the same runs. Runs are
those of all smallest periods, sorted by start and period.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import SPACE, pieces

# A run has this many periods and words at least; the search relies on four periods or more.
EXPONENT, LEAST = 4, 6
# A prime 15 * 2 ** 27 + 1 and a generator of its residues.
PRIME, GENERATOR = 2013265921, 31
P = np.uint64(PRIME)
# Numbers that a transform works on at once.
CELLS = 1 << 17
# Word counts are kept by hash, in about this many cells a word.
SPARE = 4

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


# -- exact convolution ---------------------------------------------------------------------------


@cache
def _powers(half: int, back: bool) -> np.ndarray:
    """Powers of a root of unity of order `2 * half`."""
    root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
    if back:
        root = pow(root, PRIME - 2, PRIME)
    found = np.ones(half, np.uint64)
    done = 1
    while done < half:  # doubles what is known
        more = min(done, half - done)
        found[done : done + more] = found[:more] * np.uint64(pow(root, done, PRIME)) % P
        done += more
    return found


def transform(a: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of each row; the result is in bit-reversed order."""
    rows, size = a.shape
    half = size // 2
    while half:
        pair = a.reshape(rows, -1, 2, half)
        u, v = pair[:, :, 0], pair[:, :, 1]
        out = np.empty_like(pair)
        out[:, :, 0] = (u + v) % P
        out[:, :, 1] = (u + (P - v)) * _powers(half, False) % P
        a = out.reshape(rows, size)
        half //= 2
    return a


def inverse(a: np.ndarray) -> np.ndarray:
    """What `transform` was given."""
    rows, size = a.shape
    half = 1
    while half < size:
        pair = a.reshape(rows, -1, 2, half)
        u, v = pair[:, :, 0], pair[:, :, 1] * _powers(half, True) % P
        out = np.empty_like(pair)
        out[:, :, 0] = (u + v) % P
        out[:, :, 1] = (u + (P - v)) % P
        a = out.reshape(rows, size)
        half *= 2
    return a * np.uint64(pow(size, PRIME - 2, PRIME)) % P


def digits(most: int, block: int) -> tuple[int, int]:
    """Number and bits of the digits of word numbers up to `most`, so that sums over a block stay below the prime."""
    planes = 1
    while True:
        bits = -(-most.bit_length() // planes)
        if planes * block * (2**bits - 1) ** 2 < PRIME:
            return planes, bits
        if bits == 1:
            raise ValueError("blocks of so many words cannot be compared exactly")
        planes += 1


def matches(w: np.ndarray, starts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks and distances, from `block` to `2 * block - 1`, at which a block occurs again.

    `w` goes on for three blocks after every start.
    """
    planes, bits = digits(int(w.max()), block)
    mask = (1 << bits) - 1
    found_s, found_d = [], []
    step = max(1, CELLS // (2 * block))
    for first in range(0, len(starts), step):
        s = starts[first : first + step, None]
        blocks, windows = w[s + np.arange(block)], w[s + np.arange(block, 3 * block)]
        product = np.zeros(windows.shape, np.uint64)
        squares = np.zeros((len(s), block), np.int64)
        for plane in range(planes):
            x = ((blocks >> (plane * bits)) & mask).astype(np.int64)
            y = ((windows >> (plane * bits)) & mask).astype(np.int64)
            turned = np.zeros(windows.shape, np.uint64)  # index -j holds word j
            turned[:, 0] = x[:, 0]
            turned[:, : -block : -1] = x[:, 1:]
            product = (product + transform(turned) * transform(y.astype(np.uint64)) % P) % P
            upto = np.concatenate((np.zeros((len(s), 1), np.int64), np.cumsum(y * y, axis=1)), axis=1)
            squares += (x * x).sum(1)[:, None] + upto[:, block : 2 * block] - upto[:, :block]
        both = inverse(product)[:, :block].astype(np.int64)
        row, lag = np.nonzero(squares == 2 * both)
        found_s.append(s[row, 0])
        found_d.append(lag + block)
    return np.concatenate(found_s), np.concatenate(found_d)


# -- stretches that may hold runs ------------------------------------------------------------------


def _stretches(word: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that may be in a run, and the stretch of each, until no more of them fall away."""
    place = np.arange(len(word))
    while len(place):
        size = 1 << int(len(place) * SPARE).bit_length()
        key = (word[place].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + group.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(
            64 - size.bit_length() + 1
        )
        cell = key.astype(np.int64)
        often = np.bincount(cell, minlength=size)[cell] >= EXPONENT  # cells that words share only keep too much
        kept, of = place[often], group[often]
        if not len(kept):
            return kept, of
        new = np.concatenate(([True], (np.diff(kept) != 1) | (np.diff(of) != 0)))
        stretch = np.cumsum(new) - 1
        long = np.bincount(stretch)[stretch] >= LEAST
        before = len(place)
        place, group = kept[long], stretch[long]
        if len(place) > 0.98 * before:
            break
    return place, group


def find_runs(word: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of every run of the words of documents, numbers in one array; sorted by start, period."""
    nothing = np.empty(0, np.int64)
    place, stretch = _stretches(word, document)
    if not len(place):
        return nothing, nothing, nothing
    first = np.flatnonzero(np.concatenate(([True], np.diff(stretch) != 0)))
    sizes = np.diff(np.append(first, len(place)))
    number = np.repeat(np.arange(len(first)), sizes)
    # numbers from 1 within a stretch; 0 stands before, between and after the stretches
    pairs, which = np.unique(number * (int(word.max()) + 1) + word[place], return_inverse=True)
    lowest = np.searchsorted(pairs, np.arange(len(first)) * (int(word.max()) + 1))
    at = np.arange(len(place)) + number + 1
    tail = 3 * int(sizes.max())
    w = np.zeros(len(place) + len(first) + 1 + tail, np.int64)
    w[at] = which - lowest[number] + 1
    ends = np.zeros(len(w), np.int64)  # where the stretch of a place ends; 0 between stretches
    ends[at] = np.repeat(at[first] + sizes, sizes)
    length = np.zeros(len(w), np.int64)
    length[at] = np.repeat(sizes, sizes)
    runs = [(nothing, nothing, nothing)]
    block = 1
    while EXPONENT * block <= sizes.max():
        s = np.arange(0, len(w) - tail, block)
        s = s[(ends[s] >= s + 2 * block) & (length[s] >= EXPONENT * block)]
        if len(s):
            s, d = matches(w, s, block)
            inside = s + d + block <= ends[s]
            runs.append(_extended(w, *_unexplained(s[inside], d[inside], block, runs), block))
        block *= 2
    start, end, period = (np.concatenate(c) for c in zip(*runs))
    origin = np.zeros(len(w), np.int64)
    origin[at] = place
    start, length = origin[start], end - start
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _unexplained(s, d, block: int, runs) -> tuple[np.ndarray, np.ndarray]:
    """Matches that lie in no run of a smaller period: there the distance is a multiple of that period."""
    start, end, _ = (np.concatenate(c) for c in zip(*runs))
    if not len(start):
        return s, d
    order = np.argsort(start)
    furthest = np.maximum.accumulate(end[order])
    known = np.searchsorted(start[order], s, side="right") - 1
    free = (known < 0) | (furthest[np.maximum(known, 0)] < s + d + block)
    return s[free], d[free]


def _extended(w, s, d, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs from blocks in a row that match at one distance; neither side goes on for a whole block more."""
    order = np.lexsort((s, d))
    s, d = s[order], d[order]
    new = np.concatenate(([True], (np.diff(d) != 0) | (np.diff(s) != block))) if len(s) else np.empty(0, bool)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(s)))
    s, d = s[first], d[first]
    least = np.maximum(LEAST, EXPONENT * d) - d
    able = (count + 2) * block - 2 >= least
    s, d, end = s[able], d[able], (s + count * block)[able]
    left, right = np.zeros(len(s), np.int64), np.zeros(len(s), np.int64)
    step = max(1, CELLS // block)
    for i in range(0, len(s), step):
        part = slice(i, i + step)
        back = s[part, None] - 1 - np.arange(block)
        on = end[part, None] + np.arange(block)
        far = d[part, None]
        left[part] = np.argmax(w[np.maximum(back, 0)] != w[np.maximum(back + far, 0)], axis=1)
        right[part] = np.argmax(w[on] != w[on + far], axis=1)
    start, end = s - left, end + right + d
    good = end - start >= np.maximum(LEAST, EXPONENT * d)
    return start[good], end[good], d[good]


# -- texts -----------------------------------------------------------------------------------------


class _Numbers(dict):
    """A number for each word, in the order of meeting."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = len(self)
        return value


def best(start: list[int], length: list[int], period: list[int]) -> int | None:
    """Which run has the most periods, of equal ones the first."""
    top = None
    for i in range(len(start)):
        if top is None or length[i] * period[top] > length[top] * period[i]:
            top = i
    return top


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        texts = [(t or "").encode("utf-8").split() for t in batch.column("text").to_pylist()]
        sizes = np.array([len(t) for t in texts])
        base = np.concatenate(([0], np.cumsum(sizes)))
        numbers = _Numbers()
        word = np.fromiter(map(numbers.__getitem__, chain.from_iterable(texts)), np.int64, int(base[-1]))
        start, length, period = find_runs(word, np.repeat(np.arange(len(texts)), sizes))
        cut = np.searchsorted(start, base)
        drop = np.zeros(len(word) + 1, np.int64)
        np.add.at(drop, start + period, 1)
        np.add.at(drop, start + length, -1)
        dropped = np.cumsum(drop) > 0
        tops, collapsed = [], []
        for i, words in enumerate(texts):
            a, b = cut[i], cut[i + 1]
            if a < b:
                top = best(*(c[a:b].tolist() for c in (start, length, period)))
                tops.append(dict(start=int(start[a + top] - base[i]), length=int(length[a + top]), period=int(period[a + top])))
                gone = dropped[base[i] : base[i + 1]].tolist()
                words = [w for w, out in zip(words, gone) if not out]
            else:
                tops.append(None)
            collapsed.append(b" ".join(words).decode("utf-8"))
        which = np.repeat(np.arange(len(texts)), np.diff(cut))
        rows = pa.StructArray.from_arrays([pa.array(start - base[which]), pa.array(length), pa.array(period)], names=["start", "length", "period"])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), rows),
                pa.array(tops, rows.type), pa.array(collapsed, pa.string()),
            ],
            names=["doc_id", "n_words", "runs", "best", "collapsed"],
        )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """`doc_id, n_words, runs, best, collapsed` for every row: all runs, the one with most periods, the text without repeats.

    `collapsed` keeps of each run its first period, and one space between words.
    """
    one = RUNS.removeprefix("array<").removesuffix(">")
    return docs.select("doc_id", "text").mapInArrow(
        _run_rows, f"doc_id bigint, n_words bigint, runs {RUNS}, best {one}, collapsed string"
    )


def repeating(docs: DataFrame) -> DataFrame:
    """`doc_id, text` in which a tenth of the texts, by a hash of the id, ends in repeats of some of its words."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), rf"^{SPACE}|{SPACE}$", "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce((h % 10 == 0) & (text != ""), F.lit(False))
    cut = docs.select("doc_id", "text", F.when(chosen, F.split(text, SPACE)).alias("w"), F.floor(h / 10).cast("bigint").alias("g"))
    sized = cut.select("doc_id", "text", "w", "g", (F.col("g") % F.size("w")).alias("a"))
    p = 1 + F.floor((F.size("w") - F.col("a")) / (3 + F.col("g") % 8)).cast("bigint")
    planned = sized.select("doc_id", "text", "w", "a", p.alias("p"))
    word = lambda i: F.col("w")[F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")]
    edited = F.array_join(F.transform(F.sequence(F.lit(0), F.size("w") - 1), word), " ")
    return planned.select("doc_id", F.when(F.col("w").isNotNull(), edited).otherwise(F.col("text")).alias("text"))


def digests(docs: DataFrame) -> DataFrame:
    """The runs of the texts of `repeating` as numbers and digests."""
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    top: Column = F.col("best")
    return periodic_runs(repeating(docs)).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        top["start"].alias("start"),
        top["length"].alias("length"),
        top["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        sha(F.array_join(F.transform("runs", line), "")).alias("runs_sha256"),
        sha(F.col("collapsed")).alias("collapsed_sha256"),
    )
