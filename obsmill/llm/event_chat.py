"""Chat formatting from event logs: fold deltas, edits and regenerations into messages, then render.

A log is partitioned by conversation and message, sorted by sequence and folded; the messages are
partitioned by conversation, sorted by the sequence of their opening and rendered one after the other.
Tasks hold one message at a time, however long a log or a conversation is.

The template is one line per turn, `### role: text</turn>\\n`. Control strings inside roles and texts, and
the escape itself, are escaped by a backslash, so that turns and texts read back exactly.
"""

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

BEGIN, COLON, END = "### ", ": ", "</turn>\n"
ESCAPE = "\\"
#: The role whose texts are learned.
LEARNED = "assistant"
#: Kinds of events. `edit` replaces the characters [begin, end) of the message so far, all if null.
OPEN, DELTA, EDIT, REGENERATE, REMOVE = "open", "delta", "edit", "regenerate", "remove"
#: Characters of a delta in the logs that are made of finished conversations.
STREAMED = 256

_IN_TEXT = re.compile(r"\\|### |</turn>")
_IN_ROLE = re.compile(r"\\|### |</turn>|: ")
_ESCAPED = re.compile(r"\\(.)", re.S)
_STOPS = {stop: re.compile(r"\\.|" + re.escape(stop), re.S) for stop in (COLON, END)}


def escaped(text: str, pattern: re.Pattern = _IN_TEXT) -> str:
    return pattern.sub(lambda m: ESCAPE + m[0], text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn as the template writes it, and where its escaped text begins and ends."""
    head = BEGIN + escaped(role, _IN_ROLE) + COLON
    body = escaped(text)
    return head + body + END, len(head), len(head) + len(body)


class Reader:
    """Turns of a formatted text that comes in pieces of any size; holds one unfinished turn."""

    def __init__(self):
        self.held = ""

    def _stop(self, begin: int, stop: str) -> int:
        """The place of the next unescaped `stop`, or -1."""
        for m in _STOPS[stop].finditer(self.held, begin):
            if m[0] == stop:
                return m.start()
        return -1

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        self.held += piece
        while (colon := self._stop(len(BEGIN), COLON)) >= 0 and (end := self._stop(colon + len(COLON), END)) >= 0:
            if not self.held.startswith(BEGIN):
                raise ValueError("a turn begins with its mark")
            yield unescaped(self.held[len(BEGIN) : colon]), unescaped(self.held[colon + len(COLON) : end])
            self.held = self.held[end + len(END) :]

    def close(self) -> None:
        if self.held:
            raise ValueError("the text breaks off within a turn")


def folded(events: Iterator[dict]) -> Iterator[dict]:
    """Messages of events sorted by message and sequence: conversation, seq of the opening, role, text."""
    name = None
    none = object()
    at, role, parts, removed, last = none, "", [], False, none

    def message():
        if at is not none and not removed:
            yield {"conversation": name[0], "seq": at, "role": role, "text": "".join(parts)}

    for e in events:
        key = (e["conversation"], e["message"])
        if key != name:
            yield from message()
            name, at, role, parts, removed, last = key, none, "", [], False, none
        elif e["seq"] == last:
            continue
        last = e["seq"]
        kind, text = e["kind"], e["text"] or ""
        if kind == OPEN:
            if at is none:
                at, role = e["seq"], e["role"] or ""
        elif at is none:
            continue
        elif kind == DELTA:
            parts.append(text)
        elif kind == REGENERATE:
            parts = []
        elif kind == REMOVE:
            removed = True
        elif kind == EDIT:
            whole = "".join(parts)
            begin = 0 if e["begin"] is None else max(0, e["begin"])
            end = len(whole) if e["end"] is None else max(begin, e["end"])
            parts = [whole[:begin], text, whole[end:]]
    yield from message()


def _limited(rows: Iterator[dict], schema: pa.Schema, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Rows as batches of some `size` characters."""
    out, held = [], 0
    for row in rows:
        out.append(row)
        held += 100 + sum(len(v) for v in row.values() if isinstance(v, str))
        if held >= size:
            yield pa.RecordBatch.from_pylist(out, schema)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            yield from batch.slice(k, 256).to_pylist()


def messages(events: DataFrame) -> DataFrame:
    """Final messages of a log: conversation, seq (of the opening), role, text.

    `events` has conversation, message, seq (of any ordered type), kind, role, text, begin and end; more
    columns are not read. Within a message events count by seq: `open` begins it and names the role, the first
    one counts, and events before it are ignored; `delta` adds text; `edit` replaces characters
    [begin, end), of which null means the message's begin or end and what lies outside of it is cut; `regenerate` discards the text so
    far; `remove` takes the message out; other kinds are ignored. Of several events with one seq (a log
    delivered twice) the first by kind, text, role, begin, end counts. Null texts and roles are empty; a null
    conversation or message is one of its own. An empty log gives no rows.

    Messages, not conversations, are dealt out, so a hot conversation is spread over all tasks.
    """
    keys = ["conversation", "message"]
    slim = events.select(*keys, "seq", "kind", "role", "text", F.col("begin").cast("long"), F.col("end").cast("long"))
    ordered = slim.repartition(*keys).sortWithinPartitions(*keys, "seq", "kind", "text", "role", "begin", "end")
    fields = [T.StructField(f.name, f.dataType) for f in (slim.schema["conversation"], slim.schema["seq"])]
    schema = T.StructType([*fields, T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    shape = to_arrow_schema(schema)
    return ordered.mapInArrow(lambda batches: _limited(folded(_each(batches)), shape), schema)


def _written(rows: Iterator[dict]) -> Iterator[dict]:
    """Each message as its turn, with its number and the place of its text in the whole transcript."""
    conversation, number, offset = object(), 0, 0
    for row in rows:
        if row["conversation"] != conversation:
            conversation, number, offset = row["conversation"], 0, 0
        piece, begin, end = turn(row["role"] or "", row["text"] or "")
        learned = row["role"] == LEARNED
        yield {
            "conversation": conversation,
            "number": number,
            "formatted": piece,
            "loss_begin": offset + begin if learned else None,
            "loss_end": offset + end if learned else None,
        }
        number, offset = number + 1, offset + len(piece)


def _dealt(finished: DataFrame) -> DataFrame:
    """Messages of a conversation side by side and in order."""
    slim = finished.select("conversation", "seq", "role", "text")
    return slim.repartition("conversation").sortWithinPartitions("conversation", "seq", "role", "text").drop("seq")


def rendered(finished: DataFrame) -> DataFrame:
    """Transcripts of messages, a row per turn: conversation, number from 0, formatted, loss_begin, loss_end.

    Glued in order of number, `formatted` is the conversation's transcript; [loss_begin, loss_end) are code
    points of that transcript under the loss mask, null for turns of other roles than `assistant`. Roles
    other than null or text are written as they are. Equal messages are turns each.
    """
    schema = T.StructType(
        [
            T.StructField("conversation", finished.schema["conversation"].dataType),
            *T.StructType.fromDDL("number long, formatted string, loss_begin long, loss_end long").fields,
        ]
    )
    shape = to_arrow_schema(schema)
    return _dealt(finished).mapInArrow(lambda batches: _limited(_written(_each(batches)), shape), schema)


def _read(rows: Iterator[dict]) -> Iterator[dict]:
    """What the transcripts say when they are read back, a row per conversation."""
    conversation = object()
    out = None
    for row in rows:
        if row["conversation"] != conversation:
            if out:
                yield out.result()
            conversation, out = row["conversation"], _Account(row["conversation"])
        out.add(row)
    if out:
        yield out.result()


class _Account:
    def __init__(self, conversation):
        self.conversation = conversation
        self.reader = Reader()
        self.turns = self.loss_chars = self.chars = 0
        self.told, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, row: dict) -> None:
        piece = row["formatted"]
        for role, text in self.reader.feed(piece):
            self.turns += 1
            self.told.update(f"{role}\n{text}\n".encode())
        if row["loss_begin"] is not None:
            under = unescaped(piece[row["loss_begin"] - self.chars : row["loss_end"] - self.chars])
            self.loss_chars += len(under)
            self.loss.update(under.encode())
        self.chars += len(piece)

    def result(self) -> dict:
        self.reader.close()
        return {
            "conversation": self.conversation,
            "n_turns": self.turns,
            "turns_sha256": self.told.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.chars,
        }


def accounts(finished: DataFrame) -> DataFrame:
    """One row per conversation, read back from its transcript: turns, loss mask and length.

    The transcript is rendered and read in one stream; a digest of a whole conversation has to pass through
    one task, which holds one turn of it.
    """
    schema = T.StructType(
        [
            T.StructField("conversation", finished.schema["conversation"].dataType),
            *T.StructType.fromDDL(
                "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
            ).fields,
        ]
    )
    shape = to_arrow_schema(schema)
    return _dealt(finished).mapInArrow(lambda batches: _limited(_read(_written(_each(batches))), shape), schema)


def log_of(conversations: DataFrame) -> DataFrame:
    """The event log that finished conversations could have come from.

    Every row is a message: opened, streamed in deltas, and by a hash of its key sometimes drafted
    and regenerated, begun wrongly and edited, or preceded by a message that is removed. Folding it
    gives the rows back, ordered by turn (nulls first), role and text. Drafts are made of the row's text.
    """
    id = F.monotonically_increasing_id()
    rows = conversations.select(
        F.col("conv_id").alias("conversation"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"(?s).{{1,{STREAMED}}}"), 0).alias("pieces"),
        F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"),
        id.alias("id"),
    )
    kind = F.pmod(F.xxhash64("conversation", "turn", "digest"), F.lit(8))
    first = F.coalesce(F.try_element_at("pieces", F.lit(1)), F.lit(""))
    event = lambda kind, text=None, begin=None, end=None, other=False: F.struct(
        F.lit(other).alias("other"),
        F.lit(kind).alias("kind"),
        (F.lit(None).cast("string") if text is None else text).alias("text"),
        F.lit(begin).cast("long").alias("begin"),
        (F.lit(None).cast("long") if end is None else end).alias("end"),
    )
    streamed = F.transform("pieces", lambda piece: event(DELTA, piece))
    later = F.transform(F.slice("pieces", 2, F.greatest(F.size("pieces"), F.lit(1))), lambda piece: event(DELTA, piece))
    wrong = F.reverse(first)
    made = (
        F.when(kind == 0, F.concat(F.array(event(OPEN), event(DELTA, wrong), event(REGENERATE)), streamed))
        .when(
            kind == 1,
            F.concat(F.array(event(OPEN), event(DELTA, wrong)), later, F.array(event(EDIT, first, 0, F.length(wrong).cast("long")))),
        )
        .when(
            kind == 2,
            F.concat(F.array(event(OPEN, other=True), event(DELTA, wrong, other=True), event(REMOVE, other=True), event(OPEN)), streamed),
        )
        .otherwise(F.concat(F.array(event(OPEN)), streamed))
    )
    place = [F.col("turn"), F.left("role", F.lit(64)).alias("role"), F.left(first, F.lit(64)).alias("head"), F.col("digest"), F.col("id")]
    unfolded = rows.select("conversation", "id", "role", F.struct(*place).alias("place"), F.posexplode(made).alias("step", "e"))
    return unfolded.select(
        "conversation",
        F.when(F.col("e.other"), -1 - F.col("id")).otherwise(F.col("id")).alias("message"),
        F.struct("place.*", "step").alias("seq"),
        "e.kind",
        F.when(F.col("e.kind") == OPEN, F.col("role")).alias("role"),
        "e.text",
        "e.begin",
        "e.end",
    )


#: Read off the rows themselves; lengths by counting what the template adds and escapes.
ORACLE = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
sized AS (
  SELECT *, {len(BEGIN) + len(COLON) + len(END)} + length(role) + length(text)
    + len(regexp_extract_all(text, '\\\\|### |</turn>')) + len(regexp_extract_all(role, '\\\\|### |</turn>|: ')) AS chars
  FROM said)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = '{LEARNED}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = '{LEARNED}'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""
