"""BPE encoding and decoding by a trie of distinct words, for word-end BPE vocabularies.

The distinct words of a slice of texts form a trie. A depth-first walk gives every node the last token
of the encoding of the string that leads to it: of all vocabulary entries that end there, the
one whose pairing with the last token of what is before is stable, that is, the merge rules turn the
two tokens' characters into just these two tokens. A chain of stable pairs is the encoding, so a
prefix that many words share is encoded once, and a word's tokens are read off along its last tokens.

Texts are normalised and cut into words as the vocabulary's file says, one stretch between white space
at a time and each distinct one once. Those of Latin letters take a short way through one pattern, all
others go through the file's own normaliser and splitter. Special
tokens inside a text are recognised before that, as the library does.

Defined results: NULL counts as an empty text, which has no tokens and decodes to an empty text.
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata
import weakref
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import pieces

# Beyond so many stretches between white space, or words, a task keeps only those that the slice at hand holds;
# pairs whose stability it keeps.
KEPT = 250_000
PAIRS_KEPT = 300_000

# Below this code point no letter composes with a neighbour, and lower case is one letter for one (but for one).
LATIN = 0x250
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^{S}{L}{N}]+"


STOPS = ".,;:"


def _characters(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(LATIN) if unicodedata.category(chr(c))[0] == kind)


def byte_letters() -> dict[int, str]:
    """The printable letter for each byte: itself if it is printable, else the next from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _StablePairs(dict):
    """Whether no rule joins a part of a left token with a part of a right one while both are there.

    A rule comes after those that made its parts, so only the ends count. Where the same rule could
    apply twice in a row the left place comes first.
    """

    def __init__(self, v: Vocabulary):
        super().__init__()
        # A circle would keep the vocabulary of a task in memory after its end, beside that of the next one.
        self.v = weakref.proxy(v)

    def __missing__(self, pair: tuple[str, str]) -> bool:
        if len(self) > PAIRS_KEPT:
            self.clear()
        ranks = self.v.ranks
        value = self[pair] = not any(
            (rank := ranks.get((a, b))) is not None and rank < end_a and rank <= end_b
            for a, end_a in self.v.spine(pair[0], 1)
            for b, end_b in self.v.spine(pair[1], 0)
        )
        return value


class Vocabulary:
    """Tokens, merge rules and pairs known to be stable, read from the vocabulary's JSON text."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or model["unk_token"] or model["byte_fallback"]:
            raise ValueError("a BPE vocabulary with word ends and without unknown tokens is needed")
        self.text = text
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # One object for each token, wherever it is kept.
        self.own = {t: t for t in self.ids}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        merges = [tuple(self.own.get(t, t) for t in m) for m in pairs]
        self.ranks = {m: r for r, m in enumerate(merges)}
        self.parts = {self.own.get(t, t): m for m in merges for t in ("".join(m),)}
        if len(self.parts) < len(merges):
            raise ValueError("a token with two merge rules: stable pairs would not tell the encoding")
        self.stable = _StablePairs(self)
        self.spines: dict[tuple[str, int], list[tuple[str, int]]] = {}
        self.letters = byte_letters()
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        space = "".join(re.escape(chr(c)) for c in (*range(9, 14), 32, 0x85, 0xA0))
        self.words = re.compile(PATTERN.format(L=_characters("L"), N=_characters("N"), S=space))
        self.other = re.compile(rf"[^\x00-{re.escape(chr(LATIN - 1))}]|İ")
        self.library = None
        # Whether a word of ASCII letters, with or without one of STOPS after it, can hold no special token.
        self.plain = all(re.search(rf"[^A-Za-z{STOPS}]", t) for t in self.special)

    def spine(self, token: str, side: int) -> list[tuple[str, int]]:
        """The parts of a token that touch its left (0) or right (1) edge, each with the rank that ends it."""
        key = (token, side)
        if key not in self.spines:
            rank, parts = 1 << 40, []
            while True:
                parts.append((token, rank))
                if token not in self.parts:
                    break
                rank = self.ranks[self.parts[token]]
                token = self.parts[token][side]
            self.spines[key] = parts
        return self.spines[key]

    def chunk(self, text: str) -> list[str]:
        """Words of a stretch without white space, in the letters of the vocabulary; special tokens after a NUL."""
        if self.plain and text.isascii():
            if text.isalpha():
                return [text if text.islower() else text.lower()]
            if text[-1] in STOPS and text[:-1].isalpha():
                return [text[:-1].lower(), text[-1]]
        found = []
        for i, part in enumerate(self.split_special.split(text) if self.split_special else [text]):
            if i % 2:
                found.append("\0" + part)  # no letter of the vocabulary is NUL
            elif part:
                found += self._words(part)
        return found

    def _words(self, part: str) -> list[str]:
        if not self.other.search(part):
            words = self.words.findall(part.lower())
            if part.isascii() and part.isprintable():
                return words
            return [w if w.isalpha() and w.isascii() else w.encode().decode("latin-1").translate(self.letters) for w in words]
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.text)
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))]


# Unlike the library, Python takes these control characters for white space.
NOT_SPACE = re.compile("[\x1c-\x1f]")
SPLIT = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def chunks(text: str | None) -> list[str]:
    """Stretches of a text between white space."""
    if not text:
        return []
    if NOT_SPACE.search(text):
        return [c for c in SPLIT.split(text) if c]
    return text.split()


def encode_words(words, v: Vocabulary) -> dict[str, tuple[int, ...]]:
    """Ids of distinct words, by a depth-first walk over their trie.

    Sorted, the words are their trie in depth-first order: the path shared with the word before is the
    way back up, and the rest of the word leads down to new nodes. The nodes of the path keep the last
    token of the encoding up to them and where it starts. A word's last letter carries the word end, so
    a word is closed from the nodes before that letter.
    """
    out: dict[str, tuple[int, ...]] = {}
    ids, own, stable, end = v.ids, v.own, v.stable, v.end
    starts, tokens, path = [0], [""], ""  # by length of the path
    for word in sorted(words):
        inner = len(word) - 1
        shared, most = 0, min(inner, len(path))
        while shared < most and word[shared] == path[shared]:
            shared += 1
        del starts[shared + 1 :], tokens[shared + 1 :]
        path = word[:inner]
        for n in range(shared + 1, inner + 1):
            for start in range(n - 1, -1, -1):
                token = own.get(word[start:n])
                # A token alone is stable, too: each is the encoding of its own text.
                if token is not None and (not start or stable[tokens[start], token]):
                    break
            starts.append(start)
            tokens.append(token)
        closed = word + end
        for start in range(inner, -1, -1):
            token = own.get(closed[start:])
            if token is not None and (not start or stable[tokens[start], token]):
                break
        found = [ids[token]]
        while start:
            found.append(ids[tokens[start]])
            start = starts[start]
        found.reverse()
        out[word] = tuple(found)
    return out


@contextmanager
def _no_search_for_cycles() -> Iterator[None]:
    """Python looks through all that is kept whenever much is added; words and tuples of numbers form no cycles."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def _packed(ids: tuple[int, ...]) -> bytes:
    return array("i", ids).tobytes()


class _Chunks(dict):
    """Ids of the stretches a task has met, as the bytes of 32-bit numbers; when there are too many, those of the slice at hand stay."""

    def __init__(self, v: Vocabulary):
        super().__init__()
        self.v, self.words = v, {}
        self.special = {"\0" + t: _packed((i,)) for t, i in v.special.items()}

    def learn(self, new: set[str]) -> None:
        if len(self) > KEPT:
            kept = {c: self[c] for c in new & self.keys()}
            self.clear()
            self.update(kept)
        new = new - self.keys()
        cut = dict(zip(new, map(self.v.chunk, new)))
        needed = set(chain.from_iterable(cut.values()))
        known = self.words
        if len(known) > KEPT:
            known = self.words = {w: known[w] for w in needed & known.keys()}
        known.update(self.special)
        known.update((w, _packed(ids)) for w, ids in encode_words(needed - known.keys(), self.v).items())
        for c, ws in cut.items():
            self[c] = known[ws[0]] if len(ws) == 1 else b"".join(map(known.__getitem__, ws))


def _encoded(batches: Iterator[pa.RecordBatch], text) -> Iterator[pa.RecordBatch]:
    known = _Chunks(Vocabulary(text.value))
    for batch in pieces(batches):
        docs = [chunks(t) for t in batch.column("text").to_pylist()]
        with _no_search_for_cycles():
            known.learn(set(chain.from_iterable(docs)))
        ids = [b"".join(map(known.__getitem__, words)) for words in docs]
        offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32) // 4
        flat = np.frombuffer(b"".join(ids), np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], names) -> Iterator[pa.RecordBatch]:
    tokens = np.array(names.value, dtype=object)
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            column = part.column("ids")
            flat, offsets = column.values.to_numpy(), column.offsets.to_numpy()
            texts = [" ".join(tokens[flat[a:b]]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in part.schema.names), pa.array(texts, pa.string())], names=[*part.schema.names, "decoded"])


def _coded(batches: Iterator[pa.RecordBatch], text, names) -> Iterator[pa.RecordBatch]:
    return _decoded(_encoded(batches, text), names)


def token_names(text: str) -> list[str]:
    """The token of each id, from the vocabulary's JSON text."""
    spec = json.loads(text)
    names = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return [names.get(i, "") for i in range(max(names) + 1)]


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


DECODED = "doc_id bigint, ids array<int>, decoded string"


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """`doc_id, ids` for every row. `vocabulary`: path of the JSON file at the driver.

    What is broadcast has the size of that file, whatever the tables.
    """
    text = docs.sparkSession.sparkContext.broadcast(_read(vocabulary))
    return docs.select("doc_id", "text").mapInArrow(partial(_encoded, text=text), "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Adds `decoded`: the tokens of `ids` with one space between, as the library without a decoder does."""
    names = encoded.sparkSession.sparkContext.broadcast(token_names(_read(vocabulary)))
    return encoded.select("doc_id", "ids").mapInArrow(partial(_decoded, names=names), DECODED)


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """`doc_id, n_tokens, ids_sha256, decoded_sha256` for every row.

    Both ways run in one Python worker: the decoder reads nothing but the ids.
    """
    send = docs.sparkSession.sparkContext.broadcast
    text = _read(vocabulary)
    both = docs.select("doc_id", "text").mapInArrow(partial(_coded, text=send(text), names=send(token_names(text))), DECODED)
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        sha(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        sha(F.col("decoded")).alias("decoded_sha256"),
    )
