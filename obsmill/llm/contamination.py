"""Benchmark decontamination: an Aho-Corasick automaton over the items' word windows."""

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from obsmill.sinks.paths import written

WINDOW = 10
#: Characters of windows in one automaton; more windows make more automata, one pass each.
BLOCK_CHARS = 2_000_000
#: Normal form, byte by byte so that offsets stay: A-Z in lower case, other ASCII but digits blank.
NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


def _key(words: list[bytes]) -> str:
    """Words between single blanks; one character for each byte."""
    return f" {b' '.join(words).decode('latin-1')} "


def windows(benchmark: DataFrame, item: str, text: str, width: int) -> DataFrame:
    """(window, item): every distinct run of `width` words, a shorter item as one window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = normal_words(body)
                if words:
                    found |= {(_key(words[k : k + width]), name) for k in range(max(1, len(words) - width + 1))}
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in found], pa.string()), pa.array([i for _, i in found], pa.string())],
                names=["window", "item"],
            )

    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    return items.mapInArrow(cut, "window string, item string").distinct()


def _merged(first: np.ndarray, last: np.ndarray) -> list[list[int]]:
    """Runs of covered words from inclusive ranges."""
    runs: list[list[int]] = []
    for a, b in sorted(zip(first.tolist(), last.tolist())):
        if runs and a <= runs[-1][1] + 1:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    return runs


def _word_runs(text: str, automaton, known: tuple[list, list], words: list[bytes]) -> tuple[list[list[int]], set]:
    key = _key(words)
    lengths, items = known
    hits = list(automaton.iter(key))
    if not hits:
        return [], set()
    blanks = np.flatnonzero(np.frombuffer(key.encode("latin-1"), np.uint8) == 32)
    last = np.searchsorted(blanks, [end for end, _ in hits]) - 1
    first = last - np.array([lengths[k] for _, k in hits]) + 1
    return _merged(first, last), set().union(*(items[k] for _, k in hits))


def _source_spans(text: str, runs: list[list[int]]) -> list[dict]:
    """Runs of words as code point spans of the original text."""
    raw = text.encode()
    solid = np.frombuffer(raw.translate(NORMAL), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8)))
    point = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [{"begin": int(point[edges[2 * a]]), "end": int(point[edges[2 * b + 1]])} for a, b in runs]


_AUTOMATA: dict[str, tuple] = {}


def _automaton(name: str, block) -> tuple:
    """The block's automaton, built once in a worker; older ones go."""
    if name not in _AUTOMATA:
        _AUTOMATA.clear()
        automaton, lengths, items = ahocorasick.Automaton(), [], []
        for k, (window, owners) in enumerate(block.value.items()):
            automaton.add_word(window, k)
            lengths.append(window.count(" ") - 1)
            items.append(owners)
        automaton.make_automaton()
        _AUTOMATA[name] = (automaton, (lengths, items))
    return _AUTOMATA[name]


SPANS = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))
_RUNS = pa.list_(pa.list_(pa.int64()))
_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _scan(rows: DataFrame, block, name: str, last: bool) -> DataFrame:
    """Adds one block's runs and items to each row; the last scan gives the spans."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known = _automaton(name, block)
        for batch in batches:
            texts, runs, items, totals, hit, spans = batch.column("_text").to_pylist(), [], [], [], [], []
            for text, old_runs, old_items in zip(texts, batch.column("_runs").to_pylist(), batch.column("items").to_pylist()):
                words = normal_words(text)
                found, owners = _word_runs(text, automaton, known, words) if words and known[0] else ([], set())
                if old_runs:
                    found = _merged(*np.array(found + old_runs).T)
                runs.append(found)
                items.append(sorted({*owners, *old_items} - {None}))
                if last:
                    totals.append(len(words))
                    hit.append(sum(b - a + 1 for a, b in found))
                    spans.append(_source_spans(text, found) if found else [])
            made = [batch.column("_id"), pa.array(items, pa.list_(pa.string()))]
            if last:
                made += [pa.array(totals, pa.int64()), pa.array(hit, pa.int64()), pa.array(spans, _SPANS)]
            else:
                made += [batch.column("_text"), pa.array(runs, _RUNS)]
            yield pa.RecordBatch.from_arrays(made, names=schema.fieldNames())

    schema = T.StructType([rows.schema["_id"], T.StructField("items", T.ArrayType(T.StringType()))])
    if last:
        for field, kind in (("n_words", T.LongType()), ("n_hit", T.LongType()), ("spans", SPANS)):
            schema = schema.add(field, kind)
    else:
        schema = schema.add("_text", T.StringType()).add("_runs", T.ArrayType(T.ArrayType(T.LongType())))
    return rows.mapInArrow(scan, schema)


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    identifier: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """identifier, n_words, n_hit, items (found, sorted as strings) and spans of every row.

    A word is hit when it lies in an occurrence of a window of `width` consecutive item words (of
    all its words, if an item has fewer); `spans` are the runs of hit words, in code points of the
    original text. Each text is scanned once per automaton. Windows are dealt to automata by hash
    so that none holds more than about `block_chars` characters: the driver and each worker hold
    one block at a time, however large the benchmark, and a block's scan is written before the
    next begins. Documents are never shuffled.

    Null texts and texts without words have no words and no hits, such items no windows. Windows
    of an item with a null identifier count as hits without an item. Repeated rows give repeated
    rows; empty tables give no rows or no hits; further columns are not read.
    """
    spark = documents.sparkSession
    patterns = written(windows(benchmark, item, item_text, width), "windows")
    chars = patterns.agg(F.coalesce(F.sum(F.length("window") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // block_chars))
    rows = documents.select(
        F.col(identifier).alias("_id"),
        F.col(text).alias("_text"),
        F.expr("cast(array() as array<array<bigint>>)").alias("_runs"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    for k in range(blocks):
        block: dict[str, list] = {}
        for window, owner in patterns.filter(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == k).collect():
            block.setdefault(window, []).append(owner)
        shared = spark.sparkContext.broadcast(block)
        rows = _scan(rows, shared, uuid.uuid4().hex, k == blocks - 1)
        if k < blocks - 1:
            rows = written(rows, "scanned")
    return rows.select(F.col("_id").alias(identifier), "n_words", "n_hit", "items", "spans")


ORACLE = r"""
WITH iw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, array_to_string(w[k : k + least(10, len(w)) - 1], ' ') AS g, least(10, len(w)) AS n
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS k FROM iw WHERE len(w) > 0)
), dw AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), widths AS (
  SELECT DISTINCT n FROM win
), grams AS (
  SELECT r, n, unnest(generate_series(1, len(w) - n + 1)) AS k, w FROM dw, widths WHERE len(w) >= n
), hits AS (
  SELECT r, k, n, item_id FROM (SELECT r, k, n, array_to_string(w[k : k + n - 1], ' ') AS g FROM grams) JOIN win USING (g, n)
), covered AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(k, k + n - 1)) AS p FROM hits) GROUP BY r
), found AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hits) WHERE i IS NOT NULL GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""
