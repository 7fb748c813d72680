"""Chat formatting of conversations made of typed content parts.

A visitor walks a turn's parts in order: text is escaped and written out, images, audio and
documents become placeholders, with the attachment's reference, the place of its placeholder
and the number of tokens it stands for recorded.  A turn is written as

    <s>[ROLE]role[/ROLE][INST] content [/INST]</s>      from a user
    <s>[ROLE]role[/ROLE]content</s>                     from anyone else

and the loss mask covers the content of assistant turns.  Control strings inside roles and
texts get a backslash after their first character, and backslashes are doubled, so the
output can be read back exactly.

Turns are formatted row by row.  What concerns a whole conversation is folded over its rows
in order, one at a time, so a conversation of any length needs no memory to match.

Defined results: a null text or role is empty; rows are taken by turn, a null turn first, ties
by the formatted string, repeated rows all count; rows with a null conv_id form one
conversation with a null id; other columns are ignored; no rows give no conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed strings of the template
OPEN, CLOSE = "<s>", "</s>"
ROLE, END_ROLE = "[ROLE]", "[/ROLE]"
ASK, END_ASK = "[INST] ", " [/INST]"
PLACEHOLDERS = {"image": "<image>", "audio": "<audio>", "document": "<document>"}
# tokens per unit: patches of an image, seconds of audio, pages of a document
TOKENS_PER_UNIT = {"image": 1, "audio": 25, "document": 512}

# the first character of a control string that is all there
CONTROL = r"([<\[])(/?s>|image>|audio>|document>|/?ROLE\]|/?INST\])"
_control = re.compile(CONTROL)
_turn = re.compile(
    r"<s>\[ROLE\](?P<role>.*?)\[/ROLE\](?:\[INST\] (?P<asked>.*) \[/INST\]|(?P<said>.*))</s>", re.DOTALL
)
_part = re.compile("<(image|audio|document)>")


def escape(text: str) -> str:
    return _control.sub(r"\1\\\2", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


@dataclass
class Attachment:
    kind: str
    reference: str | None
    at: int
    tokens: int


@dataclass
class PartVisitor:
    """Flattens typed parts into one string with placeholders."""

    out: list[str] = field(default_factory=list)
    length: int = 0
    attachments: list[Attachment] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        getattr(self, f"visit_{kind}", self.visit_unknown)(part)

    def _write(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def visit_text(self, part: dict) -> None:
        self._write(escape(part.get("text") or ""))

    def _attach(self, part: dict) -> None:
        kind = part["type"]
        tokens = int(part.get("units") or 0) * TOKENS_PER_UNIT[kind]
        self.attachments.append(Attachment(kind, part.get("ref"), self.length, tokens))
        self._write(PLACEHOLDERS[kind])

    visit_image = visit_audio = visit_document = _attach

    def visit_unknown(self, part: dict) -> None:
        """A part of another type is kept as its text."""
        self.visit_text(part)


@dataclass
class Formatted:
    text: str
    loss_start: int
    loss_end: int
    attachments: list[Attachment]


def format_turn(role: str | None, parts: list[dict]) -> Formatted:
    visitor = PartVisitor()
    for part in parts:
        visitor.visit(part)
    role = role or ""
    head = OPEN + ROLE + escape(role) + END_ROLE + (ASK if role == "user" else "")
    tail = (END_ASK if role == "user" else "") + CLOSE
    content = "".join(visitor.out)
    for a in visitor.attachments:
        a.at += len(head)
    loss = (len(head), len(head) + len(content)) if role == "assistant" else (0, 0)
    return Formatted(head + content + tail, *loss, visitor.attachments)


def read_turn(text: str) -> tuple[str, str]:
    """Role and text of a formatted turn; placeholders are left out of the text."""
    found = _turn.fullmatch(text)
    content = found["said"] if found["asked"] is None else found["asked"]
    return unescape(found["role"]), unescape(_part.sub("", content))


TURN = (
    "conv_id long, turn long, formatted string, loss_start int, loss_end int, "
    "attachments array<struct<kind: string, reference: string, at: int, tokens: long>>, expanded_tokens long"
)
_ATTACHMENT = pa.struct([("kind", pa.string()), ("reference", pa.string()), ("at", pa.int32()), ("tokens", pa.int64())])


def format_turns(turns: DataFrame) -> DataFrame:
    """A formatted row per row of ``turns`` (conv_id, turn, role, text and, if there, parts).

    ``parts`` is an array of structs with any of type, text, ref and units; a row without it
    has its ``text`` as the only part.
    """
    parts = F.to_json("parts") if "parts" in turns.columns else F.lit(None).cast("string")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        for batch in batches:
            roles, texts, lists = (batch.column(i).to_pylist() for i in (2, 3, 4))
            out = [
                format_turn(r, [{"type": "text", "text": t}] if p is None else json.loads(p))
                for r, t, p in zip(roles, texts, lists)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([o.text for o in out], pa.string()),
                    pa.array([o.loss_start for o in out], pa.int32()), pa.array([o.loss_end for o in out], pa.int32()),
                    pa.array([[vars(a) for a in o.attachments] for o in out], pa.list_(_ATTACHMENT)),
                    pa.array([sum(a.tokens for a in o.attachments) for o in out], pa.int64()),
                ],
                ["conv_id", "turn", "formatted", "loss_start", "loss_end", "attachments", "expanded_tokens"],
            )

    given = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"),
        parts.alias("parts"),
    )
    return given.mapInArrow(rows, TURN)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """What is read back from the formatted turns, per conversation: see ``DIGEST``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def fresh(conv) -> list:
            return [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]

        def out(done: list[list]) -> pa.RecordBatch:
            cols = list(zip(*[(c, n, a.hexdigest(), k, b.hexdigest(), m) for c, n, a, k, b, m in done])) or [[]] * 6
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        for batch in batches:
            done = []
            for conv, text, start, end in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(state)
                    state = fresh(conv)
                role, said = read_turn(text)
                state[1] += 1
                state[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                if end > start:
                    lost = unescape(_part.sub("", text[start:end]))
                    state[3] += len(lost)
                    state[4].update(lost.encode("utf-8", "surrogatepass"))
                state[5] += len(text)
            yield out(done)
        if state is not None:
            yield out([state])

    ordered = formatted.select("conv_id", "formatted", "loss_start", "loss_end", "turn").repartition("conv_id")
    ordered = ordered.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "formatted").drop("turn")
    return ordered.mapInArrow(rows, DIGEST)
