"""Fill-in-the-middle over seekable compressed frames.

A text is kept as independent zstandard frames that end between two units, each with the number of
units and characters before it. A cut at unit k is looked up among the cumulative counts, and only the
frame that holds it is decompressed. Outputs and their digests are streamed frame by frame in the order
of the output's form, so that no second copy of a whole text is made.
"""

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Characters of a frame, and the compression level.
FRAME = 32_768
LEVEL = 1
#: Control strings: before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
#: Percentages of documents that are transformed, and of these in suffix-first order.
TRANSFORMED, SUFFIX_FIRST = 90, 20
FRAMES = "array<struct<units:bigint,chars:bigint,data:binary>>"
_STORED = pa.list_(pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("data", pa.binary())]))


def unit_starts(text: str) -> np.ndarray:
    """Offsets in code points at which units `[A-Za-z]+|[^A-Za-z]` begin."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) | 32
    letter = (codes >= 97) & (codes <= 122)
    begins = np.ones(len(codes), bool)
    begins[1:] = ~(letter[1:] & letter[:-1])
    return np.flatnonzero(begins)


def _blocks(text: str, size: int) -> Iterator[str]:
    """Consecutive parts of some `size` characters that end between two units."""
    begin = 0
    while begin < len(text):
        end = min(begin + size, len(text))
        # A run of letters is one unit and stays whole, however long.
        if end < len(text) and _LETTER(text[end - 1]):
            end = _RUN.match(text, end).end()
        yield text[begin:end]
        begin = end


_RUN = re.compile("[A-Za-z]*")
_LETTER = re.compile("[A-Za-z]").match


@lru_cache(1)
def _packer():
    return zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)


@lru_cache(1)
def _reader():
    return zstandard.ZstdDecompressor()


def pack(text: str, size: int = FRAME) -> list[dict]:
    """Frames of a text; an entry of counts without data closes them and holds the totals."""
    frames, units, chars = [], 0, 0
    for block in _blocks(text, size):
        frames.append({"units": units, "chars": chars, "data": _packer().compress(block.encode("utf-8", "surrogatepass"))})
        units += len(unit_starts(block))
        chars += len(block)
    return [*frames, {"units": units, "chars": chars, "data": None}]


class Frames:
    """Random access to a packed text. `opened` counts decompressed frames."""

    def __init__(self, frames: list[dict]):
        self.data = [f["data"] for f in frames[:-1]]
        self.units = [f["units"] for f in frames]
        self.chars = [f["chars"] for f in frames]
        self.opened = 0
        self._held = (-1, "")

    def frame(self, k: int) -> str:
        if self._held[0] != k:
            self.opened += 1
            self._held = (k, _reader().decompress(self.data[k]).decode("utf-8", "surrogatepass"))
        return self._held[1]

    def offset(self, unit: int) -> int:
        """The code point at which a unit begins; the text's length for the number of units."""
        k = bisect_right(self.units, unit) - 1
        if k >= len(self.data) or unit == self.units[k]:
            return self.chars[k]
        return self.chars[k] + int(unit_starts(self.frame(k))[unit - self.units[k]])

    def read(self, begin: int, end: int) -> Iterator[str]:
        """The characters from begin to end, frame by frame; other frames stay closed."""
        k = bisect_right(self.chars, begin) - 1
        while begin < end:
            piece = self.frame(k)[begin - self.chars[k] : end - self.chars[k]]
            if piece:
                yield piece
            k += 1
            begin = self.chars[k]

    def holds(self, marks: tuple[str, ...]) -> bool:
        """Whether a control string occurs, also across frames."""
        tail, longest = "", max(map(len, marks))
        for k in range(len(self.data)):
            piece = tail + self.frame(k)
            if any(m in piece for m in marks):
                return True
            tail = piece[1 - longest :]
        return False


class Plan(NamedTuple):
    """How a document is transformed: the form and where the middle begins and ends, in code points."""

    form: str
    begin: int | None
    end: int | None


def drawn(identifier, seed: int = 1) -> list[int]:
    """Four numbers that the document's identifier and the seed decide; a null identifier is empty."""
    named = f"{seed}:{'' if identifier is None else identifier}"
    digest = hashlib.sha256(named.encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def plan(frames: Frames, draws: list[int]) -> Plan:
    n = frames.units[-1]
    if n == 0 or draws[2] % 100 >= TRANSFORMED or frames.holds(MARKS):
        return Plan("plain", None, None)
    cuts = sorted(draw % (n + 1) for draw in draws[:2])
    return Plan("spm" if draws[3] % 100 < SUFFIX_FIRST else "psm", *map(frames.offset, cuts))


def output(frames: Frames, how: Plan) -> Iterator[str]:
    """The transformed text in pieces."""
    length = frames.chars[-1]
    if how.form == "plain":
        yield from frames.read(0, length)
        return
    prefix = (PREFIX, 0, how.begin)
    suffix = (SUFFIX, how.end, length)
    first, second = (prefix, suffix) if how.form == "psm" else (suffix, prefix)
    for mark, begin, end in (first, second, (MIDDLE, how.begin, how.end)):
        yield mark
        yield from frames.read(begin, end)


def _split(pieces: Iterator[str], marks: list[str]) -> Iterator[tuple[int, str]]:
    """(number of marks passed, text) of a stream, each mark looked for after the one before."""
    held, passed = "", 0
    for piece in pieces:
        held += piece
        while passed < len(marks) and (at := held.find(marks[passed])) >= 0:
            if at:
                yield passed, held[:at]
            held = held[at + len(marks[passed]) :]
            passed += 1
        sure = len(held) if passed == len(marks) else max(0, len(held) - len(marks[passed]) + 1)
        if sure:
            yield passed, held[:sure]
            held = held[sure:]
    if held:
        yield passed, held


def restored(pieces: Iterator[str], form: str, size: int = FRAME) -> Iterator[str]:
    """The text that an output was made of, from the output and its form alone.

    The parts of an output that come too early for the text are kept as frames until their turn.
    """
    if form == "plain":
        yield from pieces
        return
    marks, turn = ([PREFIX, SUFFIX, MIDDLE], (1, 3, 2)) if form == "psm" else ([SUFFIX, PREFIX, MIDDLE], (2, 3, 1))
    parts: dict[int, list[bytes]] = {1: [], 2: [], 3: []}
    loose: dict[int, list[str]] = {1: [], 2: [], 3: []}
    waiting = dict.fromkeys(parts, 0)

    def shut(k: int) -> None:
        if loose[k]:
            parts[k].append(_packer().compress("".join(loose[k]).encode("utf-8", "surrogatepass")))
        loose[k], waiting[k] = [], 0

    for k, piece in _split(pieces, marks):
        if k == 0:
            raise ValueError("an output begins with a control string")
        if form == "psm" and k == 1:
            yield piece
            continue
        loose[k].append(piece)
        waiting[k] += len(piece)
        if waiting[k] >= size:
            shut(k)
    for k in turn:
        for data in parts[k]:
            yield _reader().decompress(data).decode("utf-8", "surrogatepass")
        yield from loose[k]


def framed(documents: DataFrame, identifier: str = "doc_id", text: str = "text", size: int = FRAME) -> DataFrame:
    """identifier and `frames` of every row: a table that may be written and read in part later.

    The last entry of `frames` has no data and holds the totals. A null text is empty: no frame, zero
    units. A run of letters longer than `size` is one frame. Repeated rows are rows, further columns
    are not read.
    """
    rows = documents.select(F.col(identifier).alias("_id"), F.col(text).alias("_text"))
    schema = T.StructType([rows.schema["_id"], T.StructField("frames", T._parse_datatype_string(FRAMES))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = pa.array([pack(v or "", size) for v in batch.column(1).to_pylist()], _STORED)
            yield pa.RecordBatch.from_arrays([batch.column(0), out], names=["_id", "frames"])

    return rows.mapInArrow(run, schema).withColumnRenamed("_id", identifier)


def selected(frames: DataFrame, ranges: DataFrame, identifier: str = "doc_id") -> DataFrame:
    """The texts of unit ranges [begin, end) of stored documents: identifier, begin, end, `selected`.

    `ranges` holds identifier, begin and end; ends beyond a text are cut, empty ranges give an empty text.
    Only the frames that a range touches are decompressed. A null identifier matches nothing.
    """

    @F.udf("string")
    def cut(stored, begin, end):
        held = Frames([f.asDict() for f in stored])
        begin, end = (min(max(int(u), 0), held.units[-1]) for u in (begin, end))
        return "".join(held.read(held.offset(begin), held.offset(max(begin, end))))

    wanted = ranges.select(identifier, "begin", "end")
    return frames.join(wanted, identifier).select(identifier, "begin", "end", cut("frames", "begin", "end").alias("selected"))


def fill_in_middle(
    frames: DataFrame, identifier: str = "doc_id", seed: int = 1, text: bool = True, size: int = FRAME
) -> DataFrame:
    """Every framed document in the form that its identifier decides.

    Returns identifier, n (units), form, prefix_chars and middle_chars (null if plain), the output's and the
    restored text's digests and, unless `text` is false, the `output`. Forms: plain where the text
    is empty, holds a control string or isn't drawn; else psm or spm. Equal identifiers draw alike; a null
    one draws as an empty one. An empty table gives no rows. Memory: a row's frames, one open frame, and its output if asked for.
    """
    columns = [("n", "long"), ("form", "string"), ("prefix_chars", "long"), ("middle_chars", "long"),
               ("output_sha256", "string"), ("restored_sha256", "string"), ("output", "string")]
    columns = columns if text else columns[:-1]
    schema = T.StructType(
        [frames.schema[identifier], *T.StructType.fromDDL(", ".join(" ".join(c) for c in columns)).fields]
    )
    kinds = {"long": pa.int64(), "string": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, stored in zip(batch.column(0), batch.column(1)):
                held = Frames(stored.as_py())
                how = plan(held, drawn(name.as_py(), seed))
                made, kept = hashlib.sha256(), []

                def told():
                    for piece in output(held, how):
                        made.update(piece.encode("utf-8", "surrogatepass"))
                        if text:
                            kept.append(piece)
                        yield piece

                back = hashlib.sha256()
                for piece in restored(told(), how.form, size):
                    back.update(piece.encode("utf-8", "surrogatepass"))
                plain = how.form == "plain"
                row = (held.units[-1], how.form, how.begin, None if plain else how.end - how.begin, made.hexdigest(), back.hexdigest())
                out.append(dict(zip((c for c, _ in columns), (*row, "".join(kept)))))
            fields = pa.schema([(c, kinds[k]) for c, k in columns])
            rows = pa.RecordBatch.from_pylist(out, fields)
            yield pa.RecordBatch.from_arrays([batch.column(0), *rows.columns], names=schema.names)

    return frames.select(identifier, "frames").mapInArrow(run, schema)


def _part(k: int) -> str:
    return f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT)"


ORACLE = f"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, least({_part(0)} % (len(units) + 1), {_part(1)} % (len(units) + 1)) AS lo,
    greatest({_part(0)} % (len(units) + 1), {_part(1)} % (len(units) + 1)) AS hi,
    CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}')
      OR {_part(2)} % 100 >= {TRANSFORMED} THEN 'plain' WHEN {_part(3)} % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
  FROM cut),
parts AS (
  SELECT *, array_to_string(units[:lo], '') AS p, array_to_string(units[lo + 1:hi], '') AS m,
    array_to_string(units[hi + 1:], '') AS s FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
    ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts"""
