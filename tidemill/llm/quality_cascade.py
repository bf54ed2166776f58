"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

Every rule measures something about a text and rejects it beyond a limit. On a bounded sample each rule
is run on every text, which gives its cost (seconds a text) and its selectivity (share rejected). The
rules then run in the order of rejection per cost, and the first that rejects a text ends its turn: cheap
rules that reject much spare the dear ones their work. A text is kept if no rule rejects it, so the verdict
does not depend on the order, nor on the clock that set it.

A text's measures are computed when a rule first asks for them and shared by the rules after it.

Defined results: NULL counts as an empty text, with no words. Rows with the same id are separate.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import pieces

# Texts that costs and selectivities are estimated on, and how much of them at most.
SAMPLE_DOCS, SAMPLE_CHARS = 400, 4_000_000
WINDOW = 5

# The symbols of the base measures.
SYMBOLS = "#*$%&|<>"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTER = re.compile(r"[^\W\d_]")


class Text:
    """A text and its measures, each computed once and only if asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode("utf-8", "surrogatepass").split()  # splits at just the contract's white space

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def spaces(self) -> int:
        return sum(map(self.text.count, "\t\n\v\f\r "))

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - self.spaces

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if WORD.search(line)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        w = self.words
        if len(w) <= WINDOW:
            return 0
        ids: dict[bytes, int] = {}
        codes = np.array([ids.setdefault(x, len(ids)) for x in w], np.int64)
        if len(ids) == len(w):
            return 0
        # Windows as numbers: pairs of numbers are renumbered, so they stay small and never collide.
        n = len(w) - WINDOW + 1
        key = codes[:n]
        for j in range(1, WINDOW):
            key = key * len(ids) + codes[j : j + n]
            if j == WINDOW - 1 or int(key.max()) > (1 << 62) // (len(ids) + 1):
                key = np.unique(key, return_inverse=True)[1]
        twice = np.bincount(key)[key] > 1
        if not twice.any():
            return 0
        edges = np.zeros(len(w) + 1, np.int64)
        at = np.flatnonzero(twice)
        np.add.at(edges, at, 1)
        np.add.at(edges, at + WINDOW, -1)
        return int((np.cumsum(edges[:-1]) > 0).sum())

    @cached_property
    def n_upper(self) -> int:
        return sum(1 for c in self.text if c.isupper())

    @cached_property
    def n_letters(self) -> int:
        return len(LETTER.findall(self.text))

    @cached_property
    def longest_word(self) -> int:
        return max(map(len, self.words), default=0)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


BASE = (
    Rule("few_words", lambda t: t.n_words < 10),
    Rule("repeated_words", lambda t: 100 * t.n_repeat_words > 20 * t.n_words),
)
# Wide limits: ordinary prose of any language stays far from them.
RULES = (
    *BASE,
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("repeated_lines", lambda t: 10 * t.n_dup_lines > 3 * len(t.lines)),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 15 * t.n_words),
    Rule("few_letters", lambda t: 2 * t.n_letters < t.word_chars),
    Rule("upper_case", lambda t: 2 * t.n_upper > t.n_letters),
    Rule("endless_word", lambda t: t.longest_word > 2000),
)


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    cost: float
    selectivity: float

    @property
    def gain(self) -> float:
        return self.selectivity / max(self.cost, 1e-9)


def estimate(texts: Sequence[str | None], rules: Sequence[Rule] = RULES) -> list[Estimate]:
    """Cost and selectivity of each rule by itself: no rule profits from what another has computed."""
    out = []
    for rule in rules:
        start = time.perf_counter()
        rejected = sum(rule.rejects(Text(t)) for t in texts)
        out.append(Estimate(rule, (time.perf_counter() - start) / max(1, len(texts)), rejected / max(1, len(texts))))
    return out


def ordered(estimates: Sequence[Estimate]) -> list[Rule]:
    """Most rejection per cost first; of equal ones the cheaper."""
    return [e.rule for e in sorted(estimates, key=lambda e: (-e.gain, e.cost, e.rule.name))]


def cascade(rules: Sequence[Rule], text: Text) -> str | None:
    """The first rule that rejects the text; the rest are not run."""
    return next((r.name for r in rules if r.rejects(text)), None)


def sample(docs: DataFrame) -> list[str | None]:
    """A bounded sample by the hash of the id, the same for the same table."""
    sizes = (
        docs.select(F.xxhash64("doc_id").alias("h"), "doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n"))
        .orderBy("h", "doc_id", "n").limit(SAMPLE_DOCS).collect()
    )
    total, ids = 0, []
    for r in sizes:
        total += r.n
        if total <= SAMPLE_CHARS and r.doc_id is not None:
            ids.append(r.doc_id)
    if not ids:
        return []
    # an id that repeats gives its shortest text, which is among those counted above
    least = F.min(F.struct(F.coalesce(F.length("text"), F.lit(0)).alias("n"), "text")).getField("text").alias("text")
    return [r.text for r in docs.where(F.col("doc_id").isin(sorted(set(ids)))).groupBy("doc_id").agg(least).orderBy("doc_id").collect()]


def _judged(batches: Iterator[pa.RecordBatch], rules: Sequence[Rule]) -> Iterator[pa.RecordBatch]:
    rest = [r for r in rules if r not in BASE]
    for batch in pieces(batches):
        rows = []
        for value in batch.column("text").to_pylist():
            t = Text(value)
            failed = cascade([r for r in rules if r in BASE], t)
            first = failed or cascade(rest, t)
            rows.append((t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, failed is not None, first is None))
        columns = list(zip(*rows)) if rows else [()] * 7
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns, kinds)], names=[c.split()[0] for c in JUDGED.split(", ")])


JUDGED = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean"
)


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Base measures, base verdict and verdict of every row; the rules' order is estimated first.

    The base measures are asked for in any case; the cascade spares the other measures.
    """
    order = ordered(estimate(sample(docs), rules))
    return docs.select("doc_id", "text").mapInArrow(partial(_judged, rules=order), JUDGED)


def keep(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows that no rule rejects, with all their columns; here every rule after the first rejection is spared."""
    order = ordered(estimate(sample(docs), rules))

    @F.pandas_udf("boolean")
    def passes(texts: pd.Series) -> pd.Series:
        return pd.Series([cascade(order, Text(t)) is None for t in texts], dtype=bool)

    return docs.where(passes("text"))
