"""Conversations of typed content parts, formatted as training text with a loss mask.

A turn's content is text or a list of parts: text, image, audio or document. A visitor walks the parts in
order. Text is escaped and copied; any other part becomes a numbered placeholder, is noted as an attachment,
and counts for the tokens it will be expanded to. What is under the loss mask are the contents of the
assistant's turns.

The formatted text of a conversation is the pieces of its turns in order, one row a turn. No step holds a
conversation in memory, however many turns it has.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cardlens.llm.common import slices

# The control strings of the template. Escaped text holds none of them: behind every "<" and "[" in it
# stands a backslash, which no control string has there.
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
_PLACE = "<|{kind}:{number}|>"

PART = T.StructType([
    T.StructField("kind", T.StringType()),  # text, image, audio or document
    T.StructField("text", T.StringType()),  # of a text part
    T.StructField("ref", T.StringType()),  # of an attachment: where it is kept
    T.StructField("width", T.IntegerType()),  # pixels of an image
    T.StructField("height", T.IntegerType()),
    T.StructField("seconds", T.DoubleType()),  # of an audio part
    T.StructField("pages", T.IntegerType()),  # of a document
])
_ATTACHMENT = "struct<kind:string,ref:string,number:long,at:long,tokens:long>"
PIECES = (
    "conv_id long, seq long, role string, piece string, start long, loss_start long, loss_end long, "
    f"attachments array<{_ATTACHMENT}>, tokens long"
)


@dataclass(frozen=True)
class Expansion:
    """How many tokens a part is expanded to."""

    image_tile: int = 28
    audio_per_second: float = 25.0
    document_per_page: int = 512


def escape(text: str) -> str:
    return text.replace("<", "<\\").replace("[", "[\\")


def unescape(text: str) -> str:
    return text.replace("<\\", "<").replace("[\\", "[")


@dataclass
class Visitor:
    """Flattens the parts of one turn; ``numbered`` counts the attachments of the conversation before it."""

    expansion: Expansion
    numbered: int
    offset: int
    out: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    tokens: int = 0

    def visit(self, part: dict) -> None:
        kind = part.get("kind") or "text"
        getattr(self, f"visit_{kind}", self.visit_unknown)(part)

    def visit_text(self, part: dict) -> None:
        text = part.get("text") or ""
        self._put(escape(text), len(text.split()))

    def visit_image(self, part: dict) -> None:
        tile = self.expansion.image_tile
        self._attach(part, math.ceil((part.get("width") or 0) / tile) * math.ceil((part.get("height") or 0) / tile))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, math.ceil((part.get("seconds") or 0) * self.expansion.audio_per_second))

    def visit_document(self, part: dict) -> None:
        self._attach(part, (part.get("pages") or 0) * self.expansion.document_per_page)

    def visit_unknown(self, part: dict) -> None:
        raise ValueError(f"no such kind of part: {part.get('kind')!r}")

    def _attach(self, part: dict, tokens: int) -> None:
        number = self.numbered + len(self.attachments)
        at = self.offset + sum(map(len, self.out))
        self.attachments.append(
            {"kind": part["kind"], "ref": part.get("ref"), "number": number, "at": at, "tokens": tokens}
        )
        self._put(_PLACE.format(kind=part["kind"], number=number), tokens)

    def _put(self, text: str, tokens: int) -> None:
        self.out.append(text)
        self.tokens += tokens


def _gathered(df: DataFrame, *order: str) -> DataFrame:
    """The rows of a conversation in one task and in order. They stream through it; none is kept."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def format_conversations(df: DataFrame, parts: str | None = None, expansion: Expansion = Expansion()) -> DataFrame:
    """The formatted turns of ``df`` (conv_id, turn, role, text), with the columns of ``PIECES``.

    ``parts`` names a column of type ``array<PART>`` that replaces ``text`` where it is not null. Rows are
    ordered by turn, then role and text, so the place of a repeated turn is defined; a null turn comes first.
    A null text or part is empty, a null role is an empty one, and rows without a conversation id make up one
    conversation of their own. Other columns are ignored. Offsets count code points from the start of the
    conversation; a span is null outside the loss mask.
    """
    content = F.col(parts) if parts else F.lit(None)
    turns = df.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), content.cast(T.ArrayType(PART)).alias("parts"),
    )
    types = T._parse_datatype_string(PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(types)
        current, seq, offset, numbered = object(), 0, 0, 0
        for batch in slices(batches, "text"):
            rows = []
            for r in batch.to_pylist():
                if r["conv_id"] != current:
                    current, seq, offset, numbered = r["conv_id"], 0, 0, 0
                head = f"{TURN}{escape(r['role'])}{BODY}"
                visitor = Visitor(expansion, numbered, offset + len(head))
                for part in [{"text": r["text"]}] if r["parts"] is None else r["parts"]:
                    visitor.visit(part or {})
                body = "".join(visitor.out)
                learned = r["role"] == "assistant"
                begin, end = offset + len(head), offset + len(head) + len(body)
                rows.append({
                    "conv_id": current, "seq": seq, "role": r["role"], "piece": f"{head}{body}{END}", "start": offset,
                    "loss_start": begin if learned else None, "loss_end": end if learned else None,
                    "attachments": visitor.attachments, "tokens": visitor.tokens,
                })
                seq, offset, numbered = seq + 1, end + len(END), numbered + len(visitor.attachments)
            yield pa.RecordBatch.from_pylist(rows, schema)

    return _gathered(turns, "turn", "role", "text").mapInArrow(run, types)


def parse_piece(piece: str) -> tuple[str, str]:
    """Role and content of a formatted turn; content with placeholders keeps them."""
    if not piece.startswith(TURN) or not piece.endswith(END):
        raise ValueError("not a formatted turn")
    role, _, body = piece[len(TURN):-len(END)].partition(BODY)
    return unescape(role), unescape(body)


def read_conversations(pieces: DataFrame) -> DataFrame:
    """What each formatted conversation says, read from its text and spans alone.

    Columns: conv_id, n_turns, turns_sha256 (of role, line feed, content, line feed for each turn),
    loss_chars and loss_sha256 (of all unescaped text under the loss mask), formatted_chars.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [f.name for f in T._parse_datatype_string(schema).fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def row(s: dict) -> list:
            return [s["conv"], s["turns"], s["all"].hexdigest(), s["chars"], s["loss"].hexdigest(), s["formatted"]]

        for batch in slices(batches, "piece"):
            done = []
            for r in batch.to_pylist():
                if state is None or r["conv_id"] != state["conv"]:
                    if state:
                        done.append(row(state))
                    state = {"conv": r["conv_id"], "turns": 0, "all": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "formatted": 0}
                role, content = parse_piece(r["piece"])
                state["all"].update(f"{role}\n{content}\n".encode())
                if r["loss_start"] is not None:
                    learned = unescape(r["piece"][r["loss_start"] - r["start"]:r["loss_end"] - r["start"]])
                    state["loss"].update(learned.encode())
                    state["chars"] += len(learned)
                state["turns"] += 1
                state["formatted"] += len(r["piece"])
            if done:
                yield _rows(done, names)
        if state:
            yield _rows([row(state)], names)

    return _gathered(pieces.select("conv_id", "seq", "piece", "start", "loss_start", "loss_end"), "seq").mapInArrow(run, schema)


def _rows(rows: list[list], names: list[str]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
