"""Chat formatting with typed content parts.

A visitor flattens the parts of a turn in their order: text is escaped, an image, an audio
clip or a document becomes one placeholder, and its reference, place and expanded number of
tokens are recorded. Turns are formatted one by one, wherever they lie; a shuffle then brings
a conversation's segments to one task in order, where they are numbered as they stream by.
Nothing gathers a conversation: a task holds one Arrow batch, also of a conversation that
has a third of all turns.

Format of a turn: ``<|im_start|>role\\ntext<|im_end|>\\n``. In texts and roles a ``<``, any
number of backslashes and a ``|`` get one backslash more before the ``|``, so no text can
form a control string, and taking one away gives the text back. A line break in a role
becomes ``<|nl|>``, which no escaped text contains. The loss mask covers the text of the
assistant's text parts, between placeholders, in code points of the formatted conversation.

Defined cases: null text, null parts and empty lists give an empty turn, a null role an empty
one; a part of an unknown type becomes ``<|attachment|>`` of no tokens; null conversation ids
are one conversation; turns go by number, nulls first, ties by their formatted text, repeated
rows stay; a text of any length stays one row; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The control strings of the template.
START, END, LINE = "<|im_start|>", "<|im_end|>\n", "<|nl|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
OTHER = "<|attachment|>"
LEARNT = "assistant"

#: Type of a content column that is not plain text.
PARTS = (
    "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
)
SPANS = "array<struct<start:long,end:long>>"
ATTACHMENTS = "array<struct<kind:string,ref:string,at:long,tokens:long>>"


@dataclass(frozen=True)
class Sizes:
    """Tokens that attachments expand to: by image patch, second of audio, page."""

    patch: int = 28
    per_second: float = 25.0
    per_page: int = 256


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


@dataclass
class Flatten:
    """Visitor of a turn's parts: formatted pieces, spans of plain text, attachments.

    Neighbouring text parts are one text, or the first could end in ``<`` and the next begin
    with ``|``.
    """

    sizes: Sizes
    at: int = 0
    pieces: list[str] = field(default_factory=list)
    spans: list[dict] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    held: list[str] = field(default_factory=list)

    def visit(self, part: dict | None) -> None:
        if part is not None:
            getattr(self, f"visit_{part['type']}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        self.held.append(part["text"] or "")

    def visit_image(self, part: dict) -> None:
        across = math.ceil((part["width"] or 0) / self.sizes.patch)
        down = math.ceil((part["height"] or 0) / self.sizes.patch)
        self.attach(part, across * down)

    def visit_audio(self, part: dict) -> None:
        self.attach(part, math.ceil((part["seconds"] or 0) * self.sizes.per_second))

    def visit_document(self, part: dict) -> None:
        self.attach(part, (part["pages"] or 0) * self.sizes.per_page)

    def visit_other(self, part: dict) -> None:
        self.attach(part, 0)

    def attach(self, part: dict, tokens: int) -> None:
        self.end_text()
        self.attachments.append(
            {"kind": part["type"], "ref": part["ref"], "at": self.at, "tokens": tokens}
        )
        self.add(PLACEHOLDERS.get(part["type"], OTHER))

    def end_text(self) -> None:
        text = escape("".join(self.held))
        self.held.clear()
        if text:
            self.spans.append({"start": self.at, "end": self.at + len(text)})
            self.add(text)

    def add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.at += len(piece)


def format_turn(role: str | None, parts: list[dict | None], sizes: Sizes) -> tuple[str, list, list]:
    """Formatted turn, the spans of its plain text and its attachments, both counted from its start."""
    out = Flatten(sizes)
    out.add(START + escape(role or "").replace("\n", LINE) + "\n")
    for part in parts:
        out.visit(part)
    out.end_text()
    out.add(END)
    return "".join(out.pieces), out.spans, out.attachments


def format_chat(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
    content: str = "text", sizes: Sizes = Sizes(),
) -> DataFrame:
    """Segments of every conversation, one row a turn, in order within their partition.

    ``content`` is plain text or a list of ``PARTS``. Columns: ``conv_id``, ``place`` (of the
    turn in its conversation, from 0), ``start`` (code points before it), ``formatted``,
    ``loss`` (spans under the loss mask) and ``attachments`` (places and spans counted from
    the conversation's start). The segments of a conversation, joined, are its formatted text.
    """

    def format_rows(batches):
        import pyarrow as pa

        for batch in batches:
            texts, spans, attached = [], [], []
            for said_by, given in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if given is None or isinstance(given, str):
                    given = [{"type": "text", "text": given}]
                text, plain, found = format_turn(said_by, given, sizes)
                texts.append(text)
                spans.append(plain if said_by == LEARNT else [])
                attached.append(found)
            columns = [*batch.columns[:2], pa.array(texts, pa.string())]
            columns += [pa.array(spans, span_type), pa.array(attached, attachment_type)]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "turn", "formatted", "loss", "attachments"])

    def number(batches):
        import pyarrow as pa

        current, place, start = object(), 0, 0
        for batch in batches:
            places, starts, spans, attached = [], [], [], []
            rows = zip(*(batch.column(c).to_pylist() for c in (0, 2, 3, 4)))
            for conv_id, text, loss, found in rows:
                if conv_id != current:
                    current, place, start = conv_id, 0, 0
                places.append(place)
                starts.append(start)
                spans.append([{"start": start + x["start"], "end": start + x["end"]} for x in loss])
                attached.append([x | {"at": start + x["at"]} for x in found])
                place += 1
                start += len(text)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(places, pa.int64()),
                    pa.array(starts, pa.int64()),
                    batch.column(2),
                    pa.array(spans, span_type),
                    pa.array(attached, attachment_type),
                ],
                names=["conv_id", "place", "start", "formatted", "loss", "attachments"],
            )

    import pyarrow as pa

    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    attachment_type = pa.list_(
        pa.struct([("kind", pa.string()), ("ref", pa.string()), ("at", pa.int64()), ("tokens", pa.int64())])
    )
    chosen = turns.select(*(F.col(f"`{c}`") for c in (conv, turn, role, content)))
    ids = [f"{n} {f.dataType.simpleString()}" for n, f in zip(("conv_id", "turn"), chosen.schema.fields)]
    tail = ["formatted string", f"loss {SPANS}", f"attachments {ATTACHMENTS}"]
    made = chosen.mapInArrow(format_rows, ", ".join([*ids, *tail]))
    ordered = made.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return ordered.mapInArrow(number, ", ".join([ids[0], "place long", "start long", *tail]))


class Reader:
    """Turns of a formatted conversation, read from its text as it comes in."""

    def __init__(self) -> None:
        self.rest = ""

    def feed(self, text: str):
        """(role, text) of every turn that ends in what was fed so far."""
        *ended, self.rest = (self.rest + text).split(END)
        for segment in ended:
            role, _, said = segment.removeprefix(START).partition("\n")
            yield unescape(role.replace(LINE, "\n")), unescape(said)


def read_back(segments: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of each conversation.

    Reads segments as ``format_chat`` returns them (ordered within their partition): turns from
    the formatted text alone, what is learnt from the text under the mask. A digest takes its
    bytes in order, so the segments of one conversation stream through one task.
    """

    def run(batches):
        import pyarrow as pa

        class Digest:
            def __init__(self) -> None:
                self.reader, self.turns, self.loss = Reader(), hashlib.sha256(), hashlib.sha256()
                self.n_turns = self.loss_chars = self.formatted_chars = 0

            def row(self, conv_id):
                return (
                    conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars,
                    self.loss.hexdigest(), self.formatted_chars,
                )

        def out(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names
            )

        names, kinds = schema_names, None
        current, digest, done = None, None, []
        for batch in batches:
            kinds = [batch.schema.types[0], pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            for conv_id, start, text, loss in zip(*(c.to_pylist() for c in batch.columns)):
                if digest is None or conv_id != current:
                    if digest is not None:
                        done.append(digest.row(current))
                    current, digest = conv_id, Digest()
                digest.formatted_chars += len(text)
                for role, said in digest.reader.feed(text):
                    digest.n_turns += 1
                    digest.turns.update(f"{role}\n{said}\n".encode())
                for span in loss:
                    learnt = unescape(text[span["start"] - start : span["end"] - start])
                    digest.loss_chars += len(learnt)
                    digest.loss.update(learnt.encode())
            if len(done) > 5_000:
                yield out(done)
                done = []
        if digest is not None:
            yield out([*done, digest.row(current)])

    chosen = segments.select("conv_id", "start", "formatted", "loss")
    kind = chosen.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long"
    )
    schema_names = [part.split()[0] for part in schema.split(", ")]
    return chosen.mapInArrow(run, schema)
