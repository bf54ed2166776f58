r"""Chat formatting: turns of typed parts become one text with marks, and a mask of what is learned.

A turn's content is a list of parts: text, image, audio or document. A visitor goes over them in order. Text is
escaped; each other part becomes a numbered placeholder, and its reference and the number of tokens that
it will expand to are recorded as an attachment.

A turn reads `### Role: content </turn>` and a line feed. In roles and texts a backslash goes before each
backslash and before the first letter of every control string, so the text can be read back exactly, and
no text can end a turn or pose as a placeholder. Neighbouring text parts are escaped as one text, as a control string
may begin in one and end in the next.

Conversations of any length are formatted in segments of at most `SEGMENT` turns, so that a row is bounded even where
one conversation holds a third of all turns; the segments of a conversation, in order, are its formatted text.

Defined results: turns go by `turn`, NULL first, ties by role and text; NULL text and role count as empty; rows
without conv_id are one conversation; repeated rows are repeated turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import groupby
from math import ceil

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import pieces

SEGMENT, SEGMENT_CHARS = 64, 1 << 20
LEARNED = "assistant"

HEAD, COLON, END = "### ", ": ", "</turn>\n"
# Control strings: turn marks and the opening of placeholders.
CONTROL = re.compile(r"\\|###|</turn>|<\||: ")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
TURN = re.compile(r"### ((?:[^\\:]++|\\.|:(?! ))*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)
# Goes over escaped letters, so what a text says is never taken for a placeholder.
PLACEHOLDER = re.compile(r"\\.|<\|(image|audio|document):(\d+)\|>", re.DOTALL)


@dataclass(frozen=True)
class Part:
    """A piece of a turn's content. Sizes: pixels of an image, seconds of audio, pages of a document."""

    kind: str
    text: str = ""
    reference: str = ""
    width: int = 0
    height: int = 0
    seconds: float = 0.0
    pages: int = 0

    def accept(self, visitor: Visitor) -> str:
        method = getattr(visitor, f"visit_{self.kind}", None)
        if method is None:
            raise ValueError(f"unknown kind of part: {self.kind}")
        return method(self)


@dataclass(frozen=True)
class Attachment:
    kind: str
    place: int
    reference: str
    tokens: int


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def joined(parts: Sequence[Part]) -> Iterator[Part]:
    """The same parts with each stretch of text parts as one."""
    for is_text, stretch in groupby(parts, lambda p: p.kind == "text"):
        if is_text:
            yield Part("text", "".join(p.text for p in stretch))
        else:
            yield from stretch


@dataclass
class Visitor:
    """Flattens parts in order. Tokens: a patch of an image, a frame of audio, a page each make so many."""

    patch: int = 14
    tokens_a_second: int = 25
    tokens_a_page: int = 1024
    attachments: list[Attachment] = field(default_factory=list)

    def visit_text(self, part: Part) -> str:
        return escape(part.text)

    def _attach(self, part: Part, tokens: int) -> str:
        place = len(self.attachments)
        self.attachments.append(Attachment(part.kind, place, part.reference, tokens))
        return f"<|{part.kind}:{place}|>"

    def visit_image(self, part: Part) -> str:
        return self._attach(part, ceil(part.width / self.patch) * ceil(part.height / self.patch))

    def visit_audio(self, part: Part) -> str:
        return self._attach(part, ceil(part.seconds * self.tokens_a_second))

    def visit_document(self, part: Part) -> str:
        return self._attach(part, part.pages * self.tokens_a_page)

    def flatten(self, parts: Sequence[Part]) -> str:
        return "".join(part.accept(self) for part in joined(parts))


def format_turn(role: str | None, parts: Sequence[Part], visitor: Visitor) -> tuple[str, int, int]:
    """The formatted turn, and start and end of its content in it."""
    head = f"{HEAD}{escape(role or '')}{COLON}"
    content = visitor.flatten(parts)
    return head + content + END, len(head), len(head) + len(content)


def read_turns(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """Role, text, and start and end of the content, for each turn of a formatted text."""
    at = 0
    for m in TURN.finditer(formatted):
        if m.start() != at:
            break
        at = m.end()
        yield unescape(m.group(1)), unescape(m.group(2)), m.start(2), m.end(2)
    if at != len(formatted):
        raise ValueError(f"not a formatted text from character {at} on")


# -- tables ------------------------------------------------------------------------------------

PARTS = "array<struct<kind:string,text:string,reference:string,width:int,height:int,seconds:double,pages:int>>"
SEGMENTS = (
    "conv_id bigint, part int, segment int, formatted string, loss array<struct<start:int,end:int>>, "
    "attachments array<struct<kind:string,place:int,reference:string,tokens:int>>"
)
_ATTACHMENT = pa.struct([("kind", pa.string()), ("place", pa.int32()), ("reference", pa.string()), ("tokens", pa.int32())])
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_SEGMENT = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("segment", pa.int32()), ("formatted", pa.string()), ("loss", pa.list_(_SPAN)), ("attachments", pa.list_(_ATTACHMENT))]
)


def _parts(text: str | None, parts: list[dict] | None) -> list[Part]:
    if parts is None:
        return [Part("text", text or "")]
    return [Part(**{k: v for k, v in p.items() if v is not None}) for p in parts]


def _formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation and turn; a segment ends with its conversation or when it is full."""
    part, number = TaskContext.get().partitionId(), 0
    now, texts, loss, chars, visitor = None, [], [], 0, Visitor()

    def segment():
        row = {"conv_id": now[0], "part": part, "segment": number, "formatted": "".join(texts), "loss": loss, "attachments": [vars(a) for a in visitor.attachments]}
        return pa.RecordBatch.from_pylist([row], schema=_SEGMENT)

    for batch in pieces(batches):
        for row in batch.to_pylist():
            if texts and (now != (row["conv_id"],) or len(texts) >= SEGMENT or chars >= SEGMENT_CHARS):
                yield segment()
                number += 1
                texts, loss, chars, visitor = [], [], 0, Visitor()
            now = (row["conv_id"],)
            text, start, end = format_turn(row["role"], _parts(row["text"], row["parts"]), visitor)
            if row["role"] == LEARNED:
                loss.append({"start": chars + start, "end": chars + end})
            texts.append(text)
            chars += len(text)
    if texts:
        yield segment()


def format_conversations(turns: DataFrame) -> DataFrame:
    """Segments of conversations, in order by `part` and `segment`, with the spans under the loss mask.

    `turns`: `conv_id, turn, role, text` and, optionally, `parts` (see PARTS), which goes before `text`.
    Turns are dealt by ranges of (conv_id, turn), so a long conversation spreads over tasks. Places in
    `loss` and numbers of attachments are those of the segment.
    """
    parts = F.col("parts") if "parts" in turns.columns else F.lit(None).cast(PARTS)
    rows = turns.select("conv_id", "turn", "role", "text", parts.alias("parts"))
    keys = ("conv_id", "turn", "role", "text")
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("turn").mapInArrow(_formatted, SEGMENTS)


DIGEST = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads segments back, in order. Two running hashes are all that is kept of a conversation."""
    now, state = None, None
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [c.split()[0] for c in DIGEST.split(", ")]
    done: list[tuple] = []

    def close():
        n, turns, chars, loss, total = state
        done.append((now[0], n, turns.hexdigest(), chars, loss.hexdigest(), total))

    def out():
        return pa.RecordBatch.from_arrays(list(map(pa.array, zip(*done), kinds)), names=names)

    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in ("conv_id", "formatted", "loss")}
            if now != (row["conv_id"],):
                if now is not None:
                    close()
                now, state = (row["conv_id"],), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            formatted = row["formatted"]
            for role, text, _, _ in read_turns(formatted):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            for span in row["loss"]:
                text = unescape(formatted[span["start"] : span["end"]])
                state[2] += len(text)
                state[3].update(text.encode("utf-8", "surrogatepass"))
            state[4] += len(formatted)
        if done:
            yield out()
            done = []
    if now is not None:
        close()
        yield out()


def digests(segments: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations, one row for each.

    A SHA-256 of a whole conversation can only be computed in order, so each conversation's segments stream
    through one task, which holds one segment at a time.
    """
    order = ("conv_id", "part", "segment")
    rows = segments.select(*order, "formatted", "loss").repartition("conv_id").sortWithinPartitions(*order)
    return rows.mapInArrow(_digested, DIGEST)
