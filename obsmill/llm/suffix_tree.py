"""Scoring texts with a probabilistic suffix tree over words.

Contexts are named by 64-bit hashes, so that a run of any length is a few numbers: its context, the
context without its farthest word, and the next word. Runs of one word more are counted only after
contexts that occur often enough, which a bit map of fixed size tells every task.
"""

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from obsmill.llm.shared import BROADCAST_KEYS, CLEANUP, LOWER, configured, mixed, pieces
from obsmill.sinks.paths import discard, written

#: A context is tested if it occurs this often, and has at most this many words.
LEAST_COUNT = 24
DEPTH = 2
#: A next word is told apart in a context if it was seen there this often; the others are left to the shorter one.
SEEN = 2
#: One of this many texts, by hash, is held out when the least divergence of a context is set.
FOLDS = 8
#: Least divergences are tried in steps of this many nats.
STEP = 0.05
#: Taken off each seen next word's count and given to the shorter context.
DISCOUNT = 0.75
#: Words whose counts and contexts whose rests every task holds: the most frequent ones, this many of each at
#: most, and `GAINS` times as many tokens in context with their gains. The rest are joined.
FREQUENT = 1 << 19
GAINS = 4
#: Counts up to this are told apart when the least count of a frequent word is sought, larger ones by
#: eighths of a doubling.
EXACT_COUNTS = 1 << 10
#: Bits of the maps that tell tasks which contexts there are.
MAP_BITS = 1 << 23
#: Bits, for each run of the model, of the map that tells tasks which tokens in context there are, and the most of all.
RUN_BITS = 16
MOST_RUN_BITS = 1 << 26
#: Bytes of a map that one task puts together.
PIECE = 1 << 18
#: Runs counted together before they leave a task, texts read together, and a word's or context's runs that one group holds.
FLUSH = 400_000
TEXTS = 256
GROUP = 500_000
#: Bytes of a table's rows that are dealt out together, so that blocks are not small.
GATHER = 1 << 22
#: Parts that one task merges, one after the other, and writes as one file; tasks for each core, if there are so many parts.
PARTS = 8
TASKS = 4
#: A word is its hash without the low bits; the end is a number of its own.
_WORD = np.uint64((1 << 64) - 32)
END = np.uint64(16)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_KEY = np.uint64(0xD6E8FEB86659FD93)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Numbers of bytes, A-Z as lower case; spaces have none.
_LOWERED = np.where(_SPACE, np.uint64(0), mixed((np.frombuffer(LOWER, np.uint8).astype(np.uint64) + np.uint64(1)) * _STEP))
#: Words of more bytes are hashed one by one; bytes of texts hashed together.
_LONG = 512
_BYTES = 1 << 18


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number, and of its inverse."""
    inverse = np.uint64(pow(int(_STEP), -1, 1 << 64))
    return tuple(np.cumprod(np.append(np.uint64(1), np.full(size - 1, x))) for x in (_STEP, inverse))


def _hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts, and how many each has.

    A word's hash sums its bytes' numbers times powers by their places among all, and takes off the power of its first one.
    """
    joined = b" ".join([b"", *texts, b""])
    data = np.frombuffer(joined, np.uint8)
    space = _SPACE[data]
    turns = np.flatnonzero(space[1:] != space[:-1]) + 1
    word, after = turns[::2], turns[1::2]
    powers, inverses = _powers(_BYTES) if len(data) <= _BYTES else _powers.__wrapped__(len(data))
    term = _LOWERED[data]
    term *= powers[: len(data)]
    hashed = np.add.reduceat(term, word) * inverses[word] if len(word) else np.zeros(0, np.uint64)
    for k in np.flatnonzero(after - word > _LONG):
        hashed[k] = xxhash.xxh3_64_intdigest(joined[word[k] : after[k]].translate(LOWER))
    begins = np.cumsum([1, *(len(t) + 1 for t in texts)])
    return mixed(hashed + _KEY) & _WORD, np.diff(np.searchsorted(word, begins))


def _together(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of several texts, each with one end behind, and the text of each."""
    texts = [text or b"" for text in texts]
    found = [_hashed(texts[r.start : r.stop]) for r in pieces(texts, _BYTES - TEXTS - 1)]
    hashed, counts = (np.concatenate(c) for c in zip(*found))
    ends = np.cumsum(counts + 1) - 1
    own = np.empty(len(hashed) + len(texts), np.uint64)
    own[ends] = END
    inner = np.ones(len(own), bool)
    inner[ends] = False
    own[inner] = hashed
    return own, np.repeat(np.arange(len(texts)), counts + 1)


def _encoded(texts: pa.Array) -> list[bytes | None]:
    return texts.cast(pa.binary()).to_pylist()


def _contexts(own: np.ndarray, text: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For lengths 1 to `depth`: the hash of the words before each token, and whether there are so many."""
    out = []
    runs = np.zeros(len(own), np.uint64)
    for length in range(1, depth + 1):
        before = np.zeros_like(runs)
        before[1:] = runs[:-1]
        runs = extended(before, own)
        context = np.zeros_like(runs)
        context[1:] = runs[:-1]
        there = np.zeros(len(own), bool)
        there[length:] = text[length:] == text[:-length]
        out.append((context, there))
    return out


def extended(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The context of one more word; 0 is the context of none."""
    return mixed(context * _STEP + word)


def _key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(context * _KEY + word)


def _bit(contexts: np.ndarray, size: int = MAP_BITS) -> np.ndarray:
    return (contexts >> np.uint64(20)) & np.uint64(size - 1)


def _turned(keys: np.ndarray) -> np.ndarray:
    """Keys whose place in a map is another one."""
    return keys * _STEP


def _marked(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether a map's bits of keys are set, without unpacking it."""
    place = _bit(keys, 8 * len(bits))
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


#: Rows that a Python worker takes at once: those of long texts are large.
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def _held_out(text: str | bytes | None) -> bool:
    return xxhash.xxh3_64_intdigest(text or b"", seed=1) % FOLDS == 0


def _summed(key: np.ndarray, columns: list[np.ndarray], sums: list[np.ndarray]) -> tuple[list, list]:
    """Rows with equal keys as one row: the first of `columns`, the sum of `sums`."""
    order = np.argsort(key)
    key = key[order]
    new = np.ones(len(order), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    if not len(at):
        return columns, sums
    return [c[order[at]] for c in columns], [np.add.reduceat(c[order], at) for c in sums]


_BLOCK = pa.schema([("part", pa.int32()), ("kind", pa.int8()), *[(f"c{k}", pa.binary()) for k in range(6)]])
_BLOCKS = "part int, kind tinyint, " + ", ".join(f"c{k} binary" for k in range(6))


def _blocks(part: np.ndarray, kind: int, columns: list[np.ndarray]) -> pa.RecordBatch:
    """Rows as one block for each part: their columns, of eight bytes a value, side by side."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    at = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
    ends = np.append(at, len(part))
    packed = []
    for column in columns:
        column = column[order]
        packed.append([column[a:b].tobytes() for a, b in zip(ends, ends[1:])])
    return _batch(part[at], kind, packed)


def _batch(part: np.ndarray, kind: int, packed: list[list[bytes]]) -> pa.RecordBatch:
    packed = packed + [[None] * len(part)] * (6 - len(packed))
    return pa.RecordBatch.from_arrays(
        [pa.array(part.astype(np.int32)), pa.array(np.full(len(part), kind, np.int8)), *(pa.array(c, pa.binary()) for c in packed)],
        schema=_BLOCK,
    )


def _word_blocks(part: np.ndarray, kind: int, ids: np.ndarray, words: np.ndarray, numbers: list[np.ndarray], by: int | None, *more: np.ndarray) -> pa.RecordBatch:
    """Rows of words and numbers below 2 ** 32 as one block for each part, `more` columns of eight bytes beside them.

    A word is its place among the frequent ones, from 1; of a word that isn't there (0) the hash stands apart. Rows are in the
    order of word `by`, else in their own, and all first bytes stand before all second ones and so on, so that a block is small once compressed.
    """
    order = np.argsort(part, kind="stable") if by is None else np.argsort((part.astype(np.uint64) << np.uint64(32)) | ids[by])
    part, ids, words = part[order], ids[:, order], words[:, order]
    table = np.ascontiguousarray(np.vstack([ids, *(c[order].astype(np.uint32)[None] for c in numbers)]))
    height, width = table.shape
    table = np.ascontiguousarray(table.view(np.uint8).reshape(height, width, 4).transpose(0, 2, 1)).reshape(4 * height, width)
    unknown = ids == 0
    more = [c[order] for c in more]
    at = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
    ends = [*at.tolist(), len(part)]
    spans = list(zip(ends, ends[1:]))
    packed = [[table[:, a:b].tobytes() for a, b in spans], [words[:, a:b][unknown[:, a:b]].tobytes() for a, b in spans]]
    return _batch(part[at], kind, packed + [[c[a:b].tobytes() for a, b in spans] for c in more])


def _of_words(known: np.ndarray, words: int, numbers: int, more: list = ()):
    """A reader of such blocks: ids, hashes and numbers, then the other columns; `known` are the frequent words."""
    known = np.append(known, np.uint64(0))

    def read(packed):
        data = np.frombuffer(packed[0], np.uint8).reshape(words + numbers, 4, -1).transpose(0, 2, 1)
        table = np.ascontiguousarray(data).view(np.uint32)[:, :, 0]
        ids = table[:words]
        hashes = known[ids.astype(np.int64) - 1]
        if len(packed[1]):
            hashes[ids == 0] = np.frombuffer(packed[1], np.uint64)
        return [ids, hashes, table[words:], *(np.frombuffer(c, t) for c, t in zip(packed[2:], more))]

    none = [np.zeros((words, 0), np.uint32), np.zeros((words, 0), np.uint64), np.zeros((numbers, 0), np.uint32), *(np.zeros(0, t) for t in more)]
    return read, none


def _of_columns(types: list):
    """A reader of blocks of plain columns."""
    return lambda packed: [np.frombuffer(c, t) for c, t in zip(packed, types)], [np.zeros(0, t) for t in types]


def _unblocked(batches: Iterator[pa.RecordBatch], readers: dict) -> dict[int, list[np.ndarray]]:
    """The columns of each kind of a task's blocks, by the readers of the kinds."""
    held: dict[int, list[list]] = {kind: [[c] for c in none] for kind, (_, none) in readers.items()}
    for batch in batches:
        columns = [batch.column(2 + k) for k in range(6)]
        for row, kind in enumerate(batch.column(1).to_pylist()):
            packed = [column[row].as_buffer() for column in columns if column[row].is_valid]
            for place, values in zip(held[kind], readers[kind][0](packed)):
                place.append(values)
    return {kind: [np.concatenate(c, axis=-1) for c in columns] for kind, columns in held.items()}


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have `GATHER` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size > GATHER:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _in_files(merged: DataFrame, parts: int) -> DataFrame:
    """`merged`, made part by part, in fewer tasks: each holds one part at a time and writes one file."""
    least = TASKS * merged.sparkSession.sparkContext.defaultParallelism
    return merged.coalesce(min(parts, max(least, -(-parts // PARTS))))


def _part(key: np.ndarray, parts: int) -> np.ndarray:
    return ((key >> np.uint64(24)) % np.uint64(parts)).astype(np.int64)


def _flushes(batches: Iterator[pa.RecordBatch], picked, most: int = FLUSH) -> Iterator[tuple[np.ndarray, ...]]:
    """Texts put together until they have some `most` tokens to count: the words of all, where the tokens to count are,
    what each is counted by, and whether its text is held out. `picked` gives the second and third of some texts.
    """
    held: list[tuple] = []
    size = words = 0
    for batch in batches:
        for begin in range(0, batch.num_rows, TEXTS):
            part = _encoded(batch.column(0).slice(begin, TEXTS))
            own, text = _together(part)
            at, key = picked(own, text)
            held.append((own, at + words, key, np.array([_held_out(t) for t in part], np.int64)[text[at]]))
            size, words = size + len(at), words + len(own)
            if size > most or words > 8 * FLUSH:
                yield tuple(np.concatenate(c) for c in zip(*held))
                held, size, words = [], 0, 0
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held))


def _words(training: DataFrame) -> DataFrame:
    """word, n and held of all training texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, key, out in _flushes(batches, lambda own, text: (np.arange(len(own)), own), 3 * FLUSH):
            (word,), (n, held) = _summed(key, [key], [np.ones(len(key), np.int64), out])
            yield pa.RecordBatch.from_arrays([_long(word), pa.array(n), pa.array(held)], names=["word", "n", "held"])

    rows = training.select("_text").mapInArrow(count, "word long, n long, held long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"), F.sum("held").alias("held"))


def _context(words: np.ndarray) -> np.ndarray:
    """The context that words are, the nearest first."""
    context = np.zeros(words.shape[1], np.uint64)
    for word in words[::-1]:
        context = extended(context, word)
    return context


def _counted(training: DataFrame, length: int, bits, frequent, parts: int) -> DataFrame:
    """Blocks of runs of `length` words and the next after contexts of the map: the next word, the one before it and so
    on, n and held.

    Runs are dealt out by what the shorter context's probability is known by: the next word, in groups of a bounded size
    where it is very frequent, or the key of the shorter context and the next word.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = bits.value
        known = _indexed(frequent.value[0])
        counts = np.append(frequent.value[1], 0.0)

        def picked(own, text):
            context, there = _contexts(own, text, length)[-1]
            at = np.flatnonzero(there)
            at = at[_marked(wanted, context[at])]
            return at, _key(context[at], own[at])

        for own, at, key, out in _flushes(batches, picked):
            place = (_places(known, own) + 1).astype(np.uint32)
            (at,), (n, held) = _summed(key, [at], [np.ones(len(key), np.int64), out])
            every = at - np.arange(length + 1)[:, None]
            ids, words = place[every], own[every]
            context, name = _named(words)
            part = _part(name if length > 1 else _grouped(context, name, counts[ids[0].astype(np.int64) - 1]), parts)
            yield _word_blocks(part, 0, ids, words, [n, held], 0)

    return training.select("_text").mapInArrow(deal, _BLOCKS)


def _named(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of runs, next words first: the context, and the name by which the shorter context's probability is known."""
    return _context(words[1:]), words[0] if len(words) == 2 else _key(_context(words[1:-1]), words[0])


def _grouped(context: np.ndarray, word: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """What runs of a word and the next one are dealt out by: the latter, in groups as its count tells."""
    groups = 1 + (counts // GROUP).astype(np.uint64)
    return _key((context >> np.uint64(8)) % groups, word)


def _below_words(words: DataFrame, parts: int) -> DataFrame:
    """Blocks of words that may be told apart, one for each group of a very frequent word's runs: key, n and held."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            word, n, held, group = (np.asarray(c) for c in batch.columns)
            key = _key(group.view(np.uint64), word.view(np.uint64))
            yield _blocks(_part(key, parts), 1, [key, n, held])

    groups = F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n") / GROUP)))
    return words.filter(F.col("n") >= SEEN).select("word", "n", "held", groups.alias("group")).mapInArrow(deal, _BLOCKS)


def _below_runs(rows: DataFrame, parts: int) -> DataFrame:
    """Blocks of a level's runs: the key of context and next word, and its three probabilities."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            context, word = (np.asarray(c).view(np.uint64) for c in batch.columns[:2])
            key = _key(context, word)
            yield _blocks(_part(key, parts), 1, [key, *(np.asarray(c.fill_null(0.0)) for c in batch.columns[2:])])

    return rows.select("context", "next", "p", "p_learned", "q0").mapInArrow(deal, _BLOCKS)


def _merged(runs: DataFrame, below: DataFrame, frequent, length: int, parts: int) -> DataFrame:
    """Distinct runs seen `SEEN` times: context, next, n, held and what is known below: the next word's own counts
    (c, h), or its probabilities after the shorter context (q, q_learned) and after none (q0).

    A run that occurs so often also does so after the shorter context, so that it is found there; what isn't follows
    something that the map took for a context.
    """
    numbers = [("c", np.int64), ("h", np.int64)] if length == 1 else [(c, np.float64) for c in ("q", "q_learned", "q0")]
    names = ["context", "next", "n", "held", *(c for c, _ in numbers)]
    told = _of_columns([np.uint64, *(kind for _, kind in numbers)])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _unblocked(batches, {0: _of_words(frequent.value[0], length + 1, 2), 1: told})
        _, words, (n, held) = blocks[0]
        context, name = _named(words)
        (context, name, word), (n, held) = _summed(_key(context, name), [context, name, words[0]], [n.astype(np.int64), held.astype(np.int64)])
        often = np.flatnonzero(n >= SEEN)
        context, name, word, n, held = (c[often] for c in (context, name, word, n, held))
        by = np.argsort(blocks[1][0])
        keys = blocks[1][0][by]
        key = name if length > 1 else _grouped(context, name, _looked_up(*frequent.value, name)[0])
        # Ordered by name, so that equal numbers stand together in the table.
        order = np.argsort(name)
        context, word, n, held, key = (c[order] for c in (context, word, n, held, key))
        at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
        hit = np.flatnonzero(keys[at] == key) if len(keys) else np.zeros(0, np.int64)
        found = [c[by][at[hit]] for c in blocks[1][1:]]
        out = [_long(context[hit]), _long(word[hit]), pa.array(n[hit]), pa.array(held[hit]), *map(pa.array, found)]
        for begin in range(0, max(len(hit), 1), 100_000):
            yield pa.RecordBatch.from_arrays([c.slice(begin, 100_000) for c in out], names=names)

    schema = ", ".join(f"{c} {'double' if c in ('q', 'q_learned', 'q0') else 'long'}" for c in names)
    return runs.union(below).repartitionById(parts, F.col("part")).mapInArrow(merge, schema)


def _looked_up(known: np.ndarray, values: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of what is known, else 0, and whether it is."""
    if not len(known) or not len(asked):
        return np.zeros(len(asked)), np.zeros(len(asked), bool)
    order = np.argsort(asked)
    at = np.empty(len(asked), np.int64)
    at[order] = np.minimum(np.searchsorted(known, asked[order]), len(known) - 1)
    hit = known[at] == asked
    return np.where(hit, values[at], 0), hit


def _ordered(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    return keys[order], values[order]


def _indexed(known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.uint64]:
    """Ordered hashes with where those of each beginning begin."""
    bits = max(1, len(known).bit_length())
    shift = np.uint64(64 - bits)
    begins = np.searchsorted(known, np.arange(1 << bits, dtype=np.uint64) << shift).astype(np.int32)
    return np.append(known, ~np.uint64(0)), begins, shift


def _places(known: tuple[np.ndarray, np.ndarray, np.uint64], asked: np.ndarray) -> np.ndarray:
    """Where `known`, as indexed, has each hash; -1 if it doesn't."""
    hashes, begins, shift = known
    at = begins[asked >> shift]
    value = hashes[at]
    places = np.where(value == asked, at, -1)
    rest = np.flatnonzero(value < asked)
    at = at[rest]
    while len(rest):
        at = at + 1
        value, wanted = hashes[at], asked[rest]
        places[rest] = np.where(value == wanted, at, -1)
        on = value < wanted
        rest, at = rest[on], at[on]
    places[places == len(hashes) - 1] = -1
    return places


def _least(counts: DataFrame, most: int) -> int:
    """The least n that `most` rows or fewer reach; 0 if none does.

    A histogram of counts, of some thousand bins, tells that count, so that no partition sends rows
    that are not among them.
    """
    step = F.when(F.col("n") <= EXACT_COUNTS, F.col("n")).otherwise(EXACT_COUNTS + F.ceil(8 * F.log2(F.col("n") / EXACT_COUNTS)))
    bins = counts.groupBy(step.alias("step")).agg(F.count("*").alias("rows"), F.min("n").alias("least")).collect()
    least = rows = 0
    for row in sorted(bins, key=lambda r: -r["step"]):
        rows += row["rows"]
        if rows > most:
            break
        least = row["least"]
    return least


def _frequent(counts: DataFrame, key: str, value: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys, in order, and values of all rows from the least n that `FREQUENT` rows or fewer reach."""
    least = _least(counts, FREQUENT)
    if not least:
        return np.zeros(0, np.uint64), np.zeros(0)
    top = counts.filter(F.col("n") >= least).select(key, F.col(value).cast("double").alias("v")).toArrow()
    keys = np.asarray(top.column(0).combine_chunks()).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.asarray(top.column(1).combine_chunks())[order]


def _map(contexts: DataFrame, size: int = MAP_BITS) -> np.ndarray:
    """The bit map of a column of contexts, or of contexts and next words, of two bits each, put together from pieces of
    `PIECE` bytes.
    """
    piece = min(PIECE, size // 8)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size // 8, np.uint8)
        for batch in _gathered(batches):
            context, *word = (np.asarray(c).view(np.uint64) for c in batch.columns)
            key = _key(context, *word) if word else context
            place = np.sort(np.concatenate([_bit(key, size), _bit(_turned(key), size)]) if word else _bit(key, size))
            at = place >> np.uint64(3)
            first = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.zeros(0, np.int64)
            bit = np.uint8(1) << (place & np.uint64(7)).astype(np.uint8)
            if len(first):
                bits[at[first]] |= np.bitwise_or.reduceat(bit, first)
        yield from _pieces(bits, range(0, len(bits), piece))

    def _pieces(bits: np.ndarray, begins) -> Iterator[pa.RecordBatch]:
        for begin in begins:
            if bits[begin : begin + piece].any():
                own = bits[begin : begin + piece].tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([begin // piece], pa.int32()), pa.array([own], pa.binary())], names=["at", "bits"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held[at] = held.get(at, np.uint8(0)) | np.frombuffer(own, np.uint8)
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.int32()), pa.array([own.tobytes() for own in held.values()], pa.binary())], names=["at", "bits"]
            )

    rows = contexts.mapInArrow(places, "at int, bits binary").repartitionById(size // 8 // piece, F.col("at"))
    table = rows.mapInArrow(merge, "at int, bits binary").toArrow()
    packed = np.zeros(size // 8, np.uint8)
    for at, own in zip(table.column(0).to_pylist(), table.column(1).to_pylist()):
        packed[at * piece : (at + 1) * piece] = np.frombuffer(own, np.uint8)
    return packed


def _few(frame: DataFrame) -> DataFrame:
    """`frame`, to be broadcast if it has at most `BROADCAST_KEYS` rows."""
    return F.broadcast(frame) if frame.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else frame


def _p(count: Column, total: Column, rest: Column, shorter: Column) -> Column:
    """A next word's probability: its discounted share if it was seen often enough, and the rest by the shorter context."""
    return F.when(count >= SEEN, count - DISCOUNT).otherwise(0.0) / total + rest * shorter


def _rested(rows: DataFrame, able: DataFrame) -> DataFrame:
    """Contexts (context, shorter, total, out) with the parts of them that are left to the shorter one.

    `rest` is what the shares of the next words told apart leave of 1, `learned_rest` that without held-out texts.
    """
    own = F.col("n") - F.col("held")
    sums = rows.groupBy("context").agg(
        F.sum(F.col("n") - DISCOUNT).alias("_shares"), F.sum(F.when(own >= SEEN, own - DISCOUNT)).alias("_learned")
    )
    left = lambda shares, total: 1 - F.coalesce(shares, F.lit(0.0)) / F.col(total)
    contexts = able.withColumn("learned", F.col("total") - F.col("out"))
    return contexts.join(sums, "context", "left").select(
        "context", "shorter", "total", "out", "learned",
        left("_shares", "total").alias("rest"),
        F.when(F.col("learned") > 0, left("_learned", "learned")).alias("learned_rest"),
    )


def _with_p(rows: DataFrame, stats: DataFrame) -> DataFrame:
    """Rows with p and p_learned, by their contexts in `stats`; rows of other contexts drop out."""
    own = F.col("n") - F.col("held")
    return rows.join(_few(stats), "context").withColumns(
        {
            "p": _p(F.col("n"), F.col("total"), F.col("rest"), F.col("q")),
            "p_learned": F.when(F.col("learned") > 0, _p(own, F.col("learned"), F.col("learned_rest"), F.col("q_learned"))),
        }
    )


def _tested(rows: DataFrame, rested: DataFrame) -> DataFrame:
    """Contexts with `told` and `learned_told`, the nats by which their next words diverge from the shorter one's, by
    all texts and by those not held out, and `gain`, what they give to the held-out ones.

    Words that aren't told apart have the shorter context's probability times the rest.
    """
    own = F.col("n") - F.col("held")
    p = _with_p(rows, rested)
    sums = p.groupBy("context").agg(
        F.sum("p").alias("_p"),
        F.sum(F.col("p") * F.log(F.col("p") / F.col("q"))).alias("_told"),
        F.sum(F.when(own >= SEEN, F.col("p_learned"))).alias("_pl"),
        F.sum(F.when(own >= SEEN, F.col("p_learned") * F.log(F.col("p_learned") / F.col("q_learned")))).alias("_toldl"),
        F.sum(F.when(own >= SEEN, F.col("held"))).alias("_held"),
        F.sum(F.when(own >= SEEN, F.col("held") * F.log(F.col("p_learned") / F.col("q_learned")))).alias("_gain"),
    )
    none = lambda c: F.coalesce(c, F.lit(0.0))
    diverged = lambda told, mass, rest: none(told) + F.greatest(1 - none(mass), F.lit(0.0)) * F.log(rest)
    others = F.col("out") - F.coalesce("_held", F.lit(0))
    return rested.join(sums, "context", "left").select(
        "context", "shorter", "total", "out", "learned", "rest", "learned_rest",
        diverged("_told", "_p", "rest").alias("told"),
        F.when(F.col("learned") > 0, diverged("_toldl", "_pl", "learned_rest")).alias("learned_told"),
        F.when((F.col("out") > 0) & (F.col("learned") > 0), none("_gain") + others * F.log("learned_rest")).alias("gain"),
    )


def _threshold(stats: DataFrame) -> float:
    """The least divergence that gives held-out texts the greatest likelihood; without gain none is kept."""
    step = F.floor(F.col("learned_told") / STEP)
    bins = stats.filter("gain is not null").groupBy(step.alias("step")).agg(F.sum("gain").alias("gain"))
    best, at, total = 0.0, float("inf"), 0.0
    for row in sorted(bins.collect(), key=lambda r: -r["step"]):
        total += row["gain"]
        if total > best:
            best, at = total, row["step"] * STEP
    return at


class _Level:
    """Contexts of one length: their runs and what was found of them."""

    def __init__(self, table: DataFrame, able: DataFrame, scale: float, learned_scale: float):
        self.table = table
        #: context, next, n, held, q and q_learned by the shorter context, q0 by the root.
        self.rows = table
        if "c" in table.columns:
            q = (F.col("c") + 1) / F.lit(scale)
            learned = (F.col("c") - F.col("h") + 1) / F.lit(learned_scale)
            self.rows = table.select("context", "next", "n", "held", q.alias("q"), learned.alias("q_learned"), q.alias("q0"))
        rested = written(_rested(self.rows, able), "rested")
        self.stats = written(_tested(self.rows, rested), "stats")
        discard(rested)
        self.kept = self.stats.filter(F.col("told") >= _threshold(self.stats)).select("context")


def _levels(training: DataFrame, words: DataFrame, frequent, scales: tuple[float, float], depth: int, least: int, parts: int) -> list[_Level]:
    """The levels of the tree, shortest contexts first; a kept context's shorter ones are kept as well."""
    shared = training.sparkSession.sparkContext.broadcast
    levels: list[_Level] = []
    none = F.lit(0).cast("long")
    often = words.filter((F.col("n") >= least) & (F.col("word") != int(END)))
    # Contexts that occur often enough, with the one before them and how often they occur, held out too.
    able = _extended(often.select(none.alias("context"), none.alias("shorter"), F.col("word").alias("next"), "n", "held"))
    able = written(able, "able")
    for length in range(1, depth + 1):
        if able.isEmpty():
            break
        bits = shared(_map(able.select("context")))
        raw = _counted(training, length, bits, frequent, parts)
        if length == 1:
            below = _below_words(words, parts)
        else:
            shorter = levels[-1]
            needed = written(able.select(F.col("shorter").alias("context")).distinct(), "needed")
            below = _below_runs(_with_p(shorter.rows, shorter.stats.join(_few(needed), "context", "left_semi")), parts)
        table = written(_in_files(_merged(raw, below, frequent, length, parts), parts), "runs")
        bits.unpersist()
        levels.append(_Level(table, able, *scales))
        discard(able, *([needed] if length > 1 else []))
        runs = table.filter((F.col("n") >= least) & (F.col("next") != int(END)))
        known = levels[-1].stats.select("context", "shorter")
        able = written(_extended(runs.join(_few(known), "context").select("context", "shorter", "next", "n", "held")), "able")
    discard(able)
    for level, longer in zip(levels[-2::-1], levels[:0:-1]):
        above = longer.stats.join(longer.kept, "context", "left_semi").select(F.col("shorter").alias("context"))
        level.kept = written(level.kept.union(above).distinct(), "kept")
    return levels


def _extended(runs: DataFrame) -> DataFrame:
    """The contexts that runs (context, shorter, next, n, held) are: context, shorter, total, out.

    `shorter` lacks the farthest word; of a context of one word it is the context of none.
    """

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            context, shorter, word = (np.asarray(c).view(np.uint64) for c in batch.columns[:3])
            made = [_long(extended(context, word)), _long(np.where(context == 0, shorter, extended(shorter, word)))]
            yield pa.RecordBatch.from_arrays([*made, *batch.columns[3:]], names=["context", "shorter", "total", "out"])

    return runs.mapInArrow(name, "context long, shorter long, total long, out long")


def _gains(level: _Level, seen: Column) -> DataFrame:
    """(context, next, gain) of next words `seen` so often after kept contexts: log10 of the probability over the root's."""
    return _with_p(level.rows.filter(seen), _kept_stats(level)).select("context", "next", F.log10(F.col("p") / F.col("q0")).alias("gain"))


def _hot(levels: list[_Level]) -> tuple[np.ndarray, np.ndarray, Column]:
    """Keys, in order, and gains of the most frequent tokens in context, `GAINS` times `FREQUENT` at most; what tells the others."""
    keys, gains = [np.zeros(0, np.uint64)], [np.zeros(0)]
    if not levels:
        return keys[0], gains[0], F.lit(True)
    counts = levels[0].table.select("n")
    for level in levels[1:]:
        counts = counts.union(level.table.select("n"))
    least = _least(counts, GAINS * FREQUENT)
    for level in levels if least else []:
        top = _gains(level, F.col("n") >= least).mapInArrow(_keyed, "key long, gain double").toArrow()
        for batch in top.to_batches():
            keys.append(np.asarray(batch.column(0)).view(np.uint64))
            gains.append(np.asarray(batch.column(1)))
    top = batch = None  # one copy at a time
    keys = np.concatenate(keys)
    gains = np.concatenate(gains)
    return *_ordered(keys, gains), F.col("n") < least if least else F.lit(True)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys and gains of tokens in context (context, next, gain)."""
    for batch in batches:
        context, word = (np.asarray(c).view(np.uint64) for c in batch.columns[:2])
        yield pa.RecordBatch.from_arrays([_long(_key(context, word)), batch.column(2)], names=["key", "gain"])


def _resting(levels: list[_Level]) -> tuple[np.ndarray, np.ndarray, bool, tuple[np.ndarray, np.ndarray]]:
    """The most frequent kept contexts, in order, `FREQUENT` at most; log10 of their rests; whether these are all; and the
    contexts, in order, that come more than `GROUP` times, with how many groups they have beyond the first.
    """
    wide = (np.zeros(0, np.uint64), np.zeros(0))
    if not levels:
        return np.zeros(0, np.uint64), np.zeros(0), True, wide
    every = None
    for level in levels:
        states = _kept_stats(level).select("context", F.log10("rest").alias("rest"), F.col("total").alias("n"))
        every = states if every is None else every.union(states)
    every = written(every, "states")
    contexts, rests = _frequent(every, "context", "rest")
    whole = len(contexts) == every.count()
    # As many as the tokens have groups, at most, for each length.
    large = every.filter(F.col("n") >= GROUP).select("context", F.floor(F.col("n") / GROUP).alias("n")).toArrow()
    if large.num_rows:
        found, groups = (np.asarray(c.combine_chunks()) for c in large.columns)
        wide = _ordered(found.view(np.uint64), groups)
    discard(every)
    return contexts, rests, whole, wide


def _run_map(levels: list[_Level], others: Column) -> np.ndarray:
    """The bit map of the runs after kept contexts but for those whose gains tasks hold: what neither has, the model doesn't have."""
    runs = sum(level.table.count() for level in levels)
    size = min(MOST_RUN_BITS, max(64, 1 << (RUN_BITS * runs).bit_length()))
    every = None
    for level in levels:
        own = level.table.filter(others).select("context", "next").join(_few(level.kept), "context", "left_semi")
        every = own if every is None else every.union(own)
    return _map(every, size) if levels else np.zeros(8, np.uint8)


def _kept_stats(level: _Level) -> DataFrame:
    return level.stats.join(_few(level.kept), "context", "left_semi")


def _states(level: _Level) -> DataFrame:
    """(context, rest): kept contexts and log10 of what they give the shorter context for an unseen word."""
    return _kept_stats(level).select("context", F.log10("rest").alias("rest"))


def _read(rows: DataFrame, frequent, hot, resting, runs, maps: list, scale: float) -> DataFrame:
    """One row a text: n_tokens, n_known and base as far as frequent words tell, its rare words, the
    gain of the tokens in context as far as a task can score them, and those that it can't.

    A token begins at the longest context that the maps know. It is scored if it is among the frequent ones. If the
    map of runs doesn't have it, it goes on to the shorter context with the rest of this one, if that is held as well.
    What is left has the number of words of the context it came to (`levels`), and its word and those of the context, the nearest first, as places among the frequent ones or, where it is none of them, hashes (`unknown`).
    """
    schema = T.StructType(
        [
            *[rows.schema[c] for c in ("_row", "_id", "_trained")],
            *T.StructType.fromDDL(
                "n_tokens long, n_known long, base double, hot_gain double, rare array<struct<word:long,times:long>>, "
                "levels binary, times binary, words binary, unknown binary"
            ).fields,
        ]
    )

    def lists(values: pa.Array, sizes: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)

    def packed(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
        ends = (np.concatenate([[0], np.cumsum(sizes)]) * values.itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = frequent.value
        keys, gains = hot.value
        states, rests, whole, _ = resting.value
        known, keys, states = map(_indexed, (known, keys, states))
        shares, gains, rests = (np.append(c, 0.0) for c in (np.log10((counts + 1) / scale), gains, rests))
        present = runs.value
        for batch in batches:
            for begin in range(0, batch.num_rows, TEXTS):
                part = batch.slice(begin, TEXTS)
                n = part.num_rows
                own, text = _together(_encoded(part.column("_text")))
                place = _places(known, own)
                hit = place >= 0
                base = np.bincount(text, shares[place], n).astype(np.float64)
                seen = np.bincount(text, hit, n).astype(np.int64)
                rare = np.flatnonzero(~hit)
                rare_text, rare_word, rare_n, _ = _distinct(text[rare], own[rare])
                contexts = _contexts(own, text, len(maps))
                level = np.zeros(len(own), np.int8)
                for k, ((context, there), bits) in enumerate(zip(contexts, maps), 1):
                    level[there & _marked(bits.value, context)] = k
                key = np.zeros(len(own), np.uint64)
                gain = np.zeros(len(own))
                for k in range(len(maps), 0, -1):
                    at, context = np.flatnonzero(level == k), contexts[k - 1][0]
                    context = context[at]
                    # A token that goes on has its key by the longest context there is.
                    asked = _key(context, own[at])
                    key[at] = np.where(key[at] == 0, asked, key[at])
                    found = _places(keys, asked)
                    gain[at] += gains[found]
                    level[at[found >= 0]] = 0
                    missing = np.flatnonzero((found < 0) & ~(_marked(present, asked) & _marked(present, _turned(asked))))
                    held = _places(states, context[missing])
                    missing = at[missing]
                    gain[missing] += rests[held]
                    # With all kept contexts at hand, another one is what the map took for a context: it gives nothing.
                    level[missing if whole else missing[held >= 0]] = k - 1
                hot_gain = np.bincount(text, gain, n).astype(np.float64)
                left = np.flatnonzero(level > 0)
                left_text, _, times, first = _distinct(text[left], key[left])
                left = left[first]
                levels = level[left].astype(np.int64) + 1
                # The words of a token side by side, the next word first.
                token = np.repeat(np.arange(len(left)), levels)
                of = left[token] - (np.arange(len(token)) - np.repeat(np.cumsum(levels) - levels, levels))
                unknown = np.flatnonzero(place[of] < 0)
                words = pa.StructArray.from_arrays([_long(rare_word), pa.array(rare_n)], ["word", "times"])
                tokens, lengths = np.bincount(left_text, minlength=n), np.bincount(left_text[token], minlength=n)
                others = np.bincount(left_text[token[unknown]], minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("_row", "_id", "_trained")),
                        *map(pa.array, (np.bincount(text, minlength=n), seen, base, hot_gain)),
                        lists(words, np.bincount(rare_text, minlength=n)),
                        packed(level[left].astype(np.uint8), tokens),
                        packed(times.astype(np.uint32), tokens),
                        packed((place[of] + 1).astype(np.uint32), lengths),
                        packed(own[of[unknown]], others),
                    ],
                    names=schema.fieldNames(),
                )

    return rows.mapInArrow(read, schema)


def _distinct(text: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, value) in order of the text, how often each occurs, and where. Of at most `TEXTS` texts.

    Values are sorted without their low bits, beside the text in one number: two that differ in those alone, which
    hashes hardly do, may stand mixed, and then come in several rows.
    """
    order = np.argsort((text.astype(np.uint64) << np.uint64(56)) | (values >> np.uint64(8)))
    text, values = text[order], values[order]
    new = np.ones(len(order), bool)
    new[1:] = (text[1:] != text[:-1]) | (values[1:] != values[:-1])
    at = np.flatnonzero(new)
    return text[at], values[at], np.diff(np.append(at, len(order))), order[at]


def _tokens(read: DataFrame, level: int, frequent, wide, parts: int) -> DataFrame:
    """Blocks of the tokens of a level."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.append(frequent.value[0], np.uint64(0))
        for batch in _gathered(batches):
            rows, packed = np.asarray(batch.column(0)), [batch.column(k).to_pylist() for k in range(1, 5)]
            sizes = np.array([len(x) for x in packed[0]])
            kinds = (np.uint8, np.uint32, np.uint32, np.uint64)
            levels, times, ids, unknown = (np.frombuffer(b"".join(p), t) for p, t in zip(packed, kinds))
            words = known[ids.astype(np.int64) - 1]
            words[ids == 0] = unknown
            width = levels.astype(np.int64) + 1
            own = np.flatnonzero(levels == level)
            every = (np.cumsum(width) - width)[own] + np.arange(level + 1)[:, None]
            yield _token_blocks(np.repeat(rows, sizes)[own], times[own], ids[every], words[every], wide.value[3], parts)

    return read.select("_row", "levels", "times", "words", "unknown").mapInArrow(deal, _BLOCKS)


def _token_blocks(row, times, ids, words, wide, parts: int) -> pa.RecordBatch:
    """Blocks of tokens in context: the word and those before it, times, and the row in two halves."""
    context = _context(words[1:])
    part = _part(_spread(context, _key(context, words[0]), wide), parts)
    return _word_blocks(part, 0, ids, words, [times, *_halves(row)], 1)


def _halves(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    row = row.astype(np.uint64)
    return row & np.uint64(0xFFFFFFFF), row >> np.uint64(32)


def _spread(context: np.ndarray, key: np.ndarray, wide) -> np.ndarray:
    """What tokens in context are dealt out by: the context, and its group where it is very frequent."""
    groups = 1 + _looked_up(*wide, context)[0].astype(np.uint64)
    return _key((key >> np.uint64(8)) % groups, context)


def _model(gains: DataFrame, wide, parts: int) -> DataFrame:
    """Blocks of a level's next words: key and gain."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            context, word = (np.asarray(c).view(np.uint64) for c in batch.columns[:2])
            key = _key(context, word)
            yield _blocks(_part(_spread(context, key, wide.value[3]), parts), 1, [key, np.asarray(batch.column(2))])

    return gains.mapInArrow(deal, _BLOCKS)


def _below_tokens(states: DataFrame, wide, parts: int) -> DataFrame:
    """Blocks of a level's kept contexts (context, rest), one for each group of a very frequent one."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            context, rest = np.asarray(batch.column(0)).view(np.uint64), np.asarray(batch.column(1))
            groups = 1 + _looked_up(*wide.value[3], context)[0].astype(np.int64)
            group = np.arange(groups.sum()) - np.repeat(np.cumsum(groups) - groups, groups)
            context, rest = np.repeat(context, groups), np.repeat(rest, groups)
            yield _blocks(_part(_key(group.astype(np.uint64), context), parts), 2, [context, rest])

    return states.mapInArrow(deal, _BLOCKS)


def _found(blocks: DataFrame, level: int, frequent, wide, parts: int, targets: int) -> DataFrame:
    """Blocks of what tokens give to their rows (`kind` 3), and of the tokens that go on to the shorter context (`kind` 0).

    A token that isn't seen after its context gives what that one leaves and goes on; where the map took something else
    for a context, it gives nothing there.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _of_words(frequent.value[0], level + 1, 3)
        pairs = _of_columns([np.uint64, np.float64])
        blocks = _unblocked(batches, {0: tokens, 1: pairs, 2: pairs})
        ids, words, (times, low, high) = blocks[0]
        row = low.astype(np.int64) | (high.astype(np.int64) << 32)
        context = _context(words[1:])
        gain, hit = _looked_up(*_ordered(*blocks[1]), _key(context, words[0]))
        left = np.flatnonzero(~hit)
        gain[left] = _looked_up(*_ordered(*blocks[2]), context[left])[0]
        rows, of = np.unique(row, return_inverse=True)
        sums = np.bincount(of, times * gain, len(rows)).astype(np.float64)
        none = np.zeros((0, len(rows)), np.uint32)
        yield _word_blocks(_part(mixed(rows.view(np.uint64)), targets), 3, none, none, _halves(rows), None, sums)
        if level > 1:
            yield _token_blocks(row[left], times[left], ids[:-1, left], words[:-1, left], wide.value[3], parts)

    return blocks.repartitionById(parts, F.col("part")).mapInArrow(find, _BLOCKS)


def _by_row(blocks: DataFrame, targets: int) -> DataFrame:
    """(_row, _gain): sums of blocks of rows and gains."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, (low, high), gain = _unblocked(batches, {3: _of_words(np.zeros(0, np.uint64), 0, 2, [np.float64])})[3]
        row = low.astype(np.int64) | (high.astype(np.int64) << 32)
        rows, of = np.unique(row, return_inverse=True)
        sums = np.bincount(of, gain, len(rows)).astype(np.float64)
        for begin in range(0, max(len(rows), 1), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[begin : begin + 100_000]) for c in (rows, sums)], names=["_row", "_gain"])

    return blocks.repartitionById(targets, F.col("part")).mapInArrow(total, "_row long, _gain double")


def _gained(read: DataFrame, levels: list[_Level], others: Column, frequent, wide, parts: int) -> tuple[DataFrame, list[DataFrame]]:
    """(_row, _gain) of the tokens in context that tasks couldn't score, by their longest states; tables it reads.

    Gains and rests that such a token may ask for come to the part of its context.
    """
    targets = int(read.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    done, tables, left = None, [], None
    for k in range(len(levels), 0, -1):
        blocks = _tokens(read, k, frequent, wide, parts)
        blocks = blocks if left is None else blocks.union(left)
        # A token that comes from a longer context may ask for what tasks hold, too.
        model = _model(_gains(levels[k - 1], others if left is None else F.lit(True)), wide, parts).union(_below_tokens(_states(levels[k - 1]), wide, parts))
        found = _found(blocks.union(model), k, frequent, wide, parts, targets)
        if k > 1:
            found = written(_in_files(found, parts), "found")
            tables.append(found)
            discard(levels[k - 1].table)
            left = found.filter("kind = 0")
        sums = found.filter("kind = 3")
        done = sums if done is None else done.union(sums)
    return _by_row(done, targets), tables


def score(
    documents: DataFrame,
    trained: Column,
    identifier: str = "doc_id",
    text: str = "text",
    depth: int = DEPTH,
    least: int = LEAST_COUNT,
) -> DataFrame:
    """identifier, trained, n_tokens, n_known, train_tokens, base_score and score of every row.

    Tokens are a text's words, A-Z in lower case, then one end. The model learns from the rows where
    `trained` holds. Its root gives a word (c + 1) / (N + V + 1), and `base_score` sums log10 of
    that. Contexts of up to `depth` words are states of a suffix tree if they occur `least`
    times and their next words diverge from the shorter context's; a state without its farthest word
    is a state too. For each length the least divergence is the one that gives most to the
    likelihood of one training text in `FOLDS`, under a model of the others. In a state the next words seen there
    `SEEN` times have their discounted shares, and the rest is dealt out by the shorter context's distribution. A
    token is scored by its longest state; `score` sums log10 of that.

    Counts cover all training rows and grow with them: words first, then what comes after words that occur
    often enough, then after such pairs, and so on. Runs before a very frequent word are dealt out in groups. Tasks
    hold the `FREQUENT` commonest words' counts, `GAINS` times as many gains of tokens in context and bit maps of
    `MAP_BITS` contexts; all are of fixed size. Rare words and other tokens after kept contexts are shuffled, counted before
    that, and joined. Tables are removed once their last reader has run.

    A null text is empty and has one token, the end. A null `trained` counts as false. Repeated
    rows are learned from and scored each; an empty table gives no rows.
    """
    with configured(documents.sparkSession, {CLEANUP: "true", _ROWS: str(4 * TEXTS)}):
        return _score(documents, trained, identifier, text, depth, least)


def _score(documents: DataFrame, trained: Column, identifier: str, text: str, depth: int, least: int) -> DataFrame:
    rows = documents.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(identifier).alias("_id"),
        F.col(text).alias("_text"),
        F.coalesce(trained, F.lit(False)).alias("_trained"),
    )
    training = rows.filter("_trained")
    words = written(_words(training), "words")
    known = words.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("held"), F.lit(0))).first()
    learned = known[1]
    scale = float(learned + known[0] + 1)
    shared = documents.sparkSession.sparkContext.broadcast
    frequent = shared(_frequent(words, "word", "n"))
    parts = max(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-learned // GROUP))
    made = _levels(training, words, frequent, (scale, scale - known[2]), depth, least, parts)
    levels = [level for level in made if not level.kept.isEmpty()]
    maps = [shared(_map(level.kept.select("context"))) for level in levels]
    *hot, others = _hot(levels)
    held = (shared(hot), shared(_resting(levels)), shared(_run_map(levels, others)))
    read = written(_read(rows, frequent, *held, maps, scale), "read")
    for each in (held[0], held[2], *maps):
        each.unpersist()
    rare = read.select("_row", F.explode("rare").alias("x")).select("_row", "x.*")
    found = rare.join(words.select("word", "n"), "word", "left")
    c = F.coalesce("n", F.lit(0))
    base = found.groupBy("_row").agg(
        F.sum(F.col("times") * F.log10((c + 1) / F.lit(scale))).alias("_base"),
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("_known"),
    )
    base = written(base, "base")
    discard(words)
    texts = read.select("_row", "_id", "_trained", "n_tokens", "n_known", "base", "hot_gain").join(base, "_row", "left")
    if levels:
        gained, tables = _gained(read, levels, others, frequent, held[1], parts)
        gained = written(gained, "gained")
        discard(*tables)
        texts = texts.join(gained, "_row", "left")
    else:
        texts = texts.withColumn("_gain", F.lit(0.0))
    for each in (frequent, held[1]):
        each.unpersist()
    discard(*(level.table for level in made))
    total = F.col("base") + F.coalesce("_base", F.lit(0.0))
    return texts.select(
        F.col("_id").alias(identifier),
        F.col("_trained").alias("trained"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(learned).cast("long").alias("train_tokens"),
        total.alias("base_score"),
        (total + F.col("hot_gain") + F.coalesce("_gain", F.lit(0.0))).alias("score"),
    )
