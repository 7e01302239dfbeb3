"""Chat logs to training text: fold the events of each message, render the turns, read them back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import arrow_schema, partitions, record_batch

#: What an event does to its message: add to its text, replace its text, drop its text (a new answer follows).
DELTA, EDIT, REGENERATE = "delta", "edit", "regenerate"

#: Marks of the turns. Each opening mark has one closing mark; a role that is none of these three is named in its opening.
USER, SYSTEM, ASSISTANT, OTHER, UNNAMED = ("[INST] ", " [/INST]"), ("<<SYS>>\n", "\n<</SYS>>\n"), ("<s>", "</s>"), ("[ROLE]", "[/ROLE]"), "[NOROLE]"
#: The strings that a reader or a public tokenizer takes as control, not as text.
CONTROL = (
    "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[NOROLE]",
    "<unk>", "<|endoftext|>", "<|startoftext|>",
)
_TO_ESCAPE = re.compile(r"\\|[<\[](?=" + "|".join(re.escape(c[1:]) for c in sorted(CONTROL, key=len, reverse=True)) + ")")
_ESCAPED = re.compile(r"\\(\\?)")
_TURN = re.compile(
    r"\[INST\] (?P<user>.*?) \[/INST\]|<<SYS>>\n(?P<system>.*?)\n<</SYS>>\n|<s>(?P<assistant>.*?)</s>"
    r"|\[ROLE\](?P<role>.*?)\[/ROLE\](?P<other>.*?)</s>|\[NOROLE\](?P<unnamed>.*?)</s>",
    re.DOTALL,
)


def escape(text: str) -> str:
    """Break every control string by a backslash after its first character; a backslash becomes two."""
    return _TO_ESCAPE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render_turn(role: str | None, text: str) -> tuple[str, int, int]:
    """A turn between its marks, and the span that is trained on: an assistant's text, else nothing."""
    body = escape(text)
    if role == "assistant":
        return f"{ASSISTANT[0]}{body}{ASSISTANT[1]}", len(ASSISTANT[0]), len(body)
    if role in ("user", "system"):
        mark = USER if role == "user" else SYSTEM
        return f"{mark[0]}{body}{mark[1]}", 0, 0
    opening = UNNAMED if role is None else f"{OTHER[0]}{escape(role)}{OTHER[1]}"
    return f"{opening}{body}{ASSISTANT[1]}", 0, 0


@dataclass(frozen=True)
class Turn:
    role: str | None
    text: str
    #: The escaped text's place in the formatted string.
    start: int
    stop: int


def read_turns(formatted: str) -> Iterator[Turn]:
    """The turns of formatted text; whatever is no turn is an error."""
    at = 0
    for found in _TURN.finditer(formatted):
        if found.start() != at:
            break
        at = found.end()
        kind = found.lastgroup
        role = None if kind == "unnamed" else unescape(found["role"]) if kind == "other" else kind
        yield Turn(role, unescape(found[kind]), *found.span(kind))
    if at != len(formatted):
        raise ValueError(f"No turn at {at}: {formatted[at : at + 40]!r}")


LOG = "conv_id long, turn long, message string, seq long, kind string, role string, text string"
MESSAGES = "conv_id long, turn long, message string, role string, text string, n_events long"
SEGMENTS = "conv_id long, turn long, message string, formatted string, loss_start long, loss_length long"


class _Message:
    """What the events of one message have made of it so far."""

    def __init__(self, key: tuple, role: str | None):
        self.key, self.role, self.parts, self.events = key, role, [], 0

    def apply(self, kind: str, role: str | None, text: str | None) -> None:
        self.events += 1
        self.role = self.role if role is None else role
        if kind == DELTA:
            self.parts.append(text or "")
        elif kind == EDIT:
            self.parts = [text or ""]
        elif kind == REGENERATE:
            self.parts = []
        else:
            raise ValueError(f"Unknown kind of event: {kind!r}. Use {DELTA}, {EDIT} or {REGENERATE}.")

    @property
    def text(self) -> str:
        return "".join(self.parts)


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[list[_Message]]:
    """Messages of a log that is sorted by message and sequence, in lists of some; one message is held at a time."""
    current: _Message | None = None
    for batch in batches:
        done = []
        for conv, turn, message, kind, role, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            key = (conv, turn, message)
            if current is None or current.key != key:
                if current is not None:
                    done.append(current)
                current = _Message(key, None)
            current.apply(kind, role, text)
        yield done
    if current is not None:
        yield [current]


def in_sequence(log: DataFrame) -> DataFrame:
    """A log by conversation in the order of its messages and their events.

    Ranges of (conversation, turn, message) rather than conversations go to tasks: one that holds a third of all events is cut
    between its messages. Events with the same number come in the order of kind, then text.
    """
    rows = log.select(*[F.col(f).cast(t) for f, t in (c.split(" ") for c in LOG.split(", "))])
    place = ["conv_id", "turn", "message"]
    ranged = rows.repartitionByRange(partitions(log.sparkSession), *place)
    return ranged.sortWithinPartitions(*place, "seq", "kind", "text").select(*place, "kind", "role", "text")


def final_messages(log: DataFrame) -> DataFrame:
    """The messages that an event log leaves: deltas add to a message, an edit replaces it, a regeneration starts it anew.

    ``log`` has ``conv_id``, ``turn`` (the message's place in its conversation), ``message`` (its name, which tells messages
    at one place apart), ``seq``, ``kind``, ``role`` and ``text``; other columns are ignored. A role that an event names holds
    from there on. Null texts are empty; null conversations are one conversation; null turns, messages and numbers come
    first; a kind that is none of the three is an error. A message of which only regenerations are left is empty.
    """
    schema = arrow_schema(log.sparkSession, MESSAGES)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for done in _folded(batches):
            columns = list(zip(*[(*m.key, m.role, m.text, m.events) for m in done])) or [[]] * 6
            yield record_batch(dict(zip(schema.names, map(list, columns))), schema)

    return in_sequence(log).mapInArrow(fold, MESSAGES)


def formatted_turns(log: DataFrame) -> DataFrame:
    """The training text of an event log, a row per turn: concatenated in the order of ``turn`` and ``message``, the rows of a
    conversation are its formatted text. ``loss_start`` and ``loss_length`` give the trained span within the row, in code points."""
    schema = arrow_schema(log.sparkSession, SEGMENTS)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for done in _folded(batches):
            columns = list(zip(*[(*m.key, *render_turn(m.role, m.text)) for m in done])) or [[]] * 6
            yield record_batch(dict(zip(schema.names, map(list, columns))), schema)

    return in_sequence(log).mapInArrow(fold, SEGMENTS)


def conversation_log(conversations: DataFrame, piece_chars: int = 400) -> DataFrame:
    """Conversations as the log of a chat that led to them.

    An assistant's answer comes as a first attempt that breaks off after one piece, a regeneration, and then the whole text
    in streamed pieces; any other message is sent with its first half only and then edited. Rows at one turn are
    messages of their own, in the order of role and text hash; rows alike in all of them stay apart, too.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    name = F.concat_ws("/", F.coalesce(F.concat(F.lit("r"), "role"), F.lit("")), F.sha2(text, 256), F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0"))
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), name.alias("message"), "role", text.alias("whole"))
    pieces = F.regexp_extract_all("whole", F.lit(f"(?s).{{1,{piece_chars}}}"), F.lit(0))

    def event(kind: str, what: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), what.alias("text"))

    streamed = F.transform(pieces, lambda piece: event(DELTA, piece))
    begun = F.substring("whole", 1, piece_chars)
    answered = F.concat(F.array(event(DELTA, begun), event(REGENERATE, F.lit(None).cast("string"))), streamed)
    half = F.substring(F.col("whole"), F.lit(1), F.floor(F.length("whole") / 2).cast("int"))
    edited = F.array(event(DELTA, half), event(EDIT, F.col("whole")))
    events = F.when(F.col("role") == "assistant", answered).otherwise(edited)
    log = rows.select("conv_id", "turn", "message", "role", F.posexplode(events).alias("seq", "event"))
    return log.select("conv_id", "turn", "message", F.col("seq").cast("long").alias("seq"), "event.kind", "role", "event.text")


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def conversation_digests(turns: DataFrame) -> DataFrame:
    """What is read back from formatted turns, a row per conversation: its turns, and the text under the loss mask.

    The rows pass in order and only hashes are held, so memory does not grow with a conversation; the hash of one is
    sequential by its nature, so its rows pass through one task.
    """
    schema = arrow_schema(turns.sparkSession, DIGESTS)
    none = object()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = none, None
        for batch in batches:
            done = []
            for i, formatted, start, length in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if conv is none or i != conv:
                    if state is not None:
                        done.append((conv, *state.row()))
                    conv, state = i, _Digest()
                state.add(formatted, start, length)
            yield record_batch(dict(zip(schema.names, map(list, zip(*done)))) if done else dict.fromkeys(schema.names, []), schema)
        if state is not None:
            yield record_batch(dict(zip(schema.names, [[v] for v in (conv, *state.row())])), schema)

    dealt = turns.repartition(partitions(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "message")
    return dealt.select("conv_id", "formatted", "loss_start", "loss_length").mapInArrow(digest, DIGESTS)


class _Digest:
    def __init__(self) -> None:
        self.turns, self.all, self.loss, self.loss_chars, self.chars = count(), hashlib.sha256(), hashlib.sha256(), 0, 0

    def add(self, formatted: str, start: int, length: int) -> None:
        self.chars += len(formatted)
        trained = unescape(formatted[start : start + length])
        self.loss_chars += len(trained)
        self.loss.update(trained.encode())
        for turn in read_turns(formatted):
            next(self.turns)
            self.all.update(f"{turn.role or ''}\n{turn.text}\n".encode())

    def row(self) -> tuple:
        return next(self.turns), self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def round_trip(conversations: DataFrame) -> DataFrame:
    """Log, fold and render all conversations, and read them back.

    Null texts are empty; a null role is an own kind of turn, read back as an empty role; null conversation ids are one
    conversation; rows at the same turn come by role and text hash; repeated rows are turns of their own; an empty table has no rows.
    """
    return conversation_digests(formatted_turns(conversation_log(conversations)))
