"""Language identification with a bit-sliced Bloom filter of character trigrams."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from obsmill.llm.shared import mixed, pieces
from obsmill.sinks.paths import written

UNKNOWN = "und"
GRAM = 3
#: An n-gram belongs to the languages that use it at least this share as often as its first user.
SHARE = 0.3
#: Rows of the filter for each n-gram held, and rows that each n-gram sets. A filter of more than
#: `MOST_ROWS` rows has fewer a n-gram, at least `LEAST_ROWS_PER_GRAM`; its false rate, taken off the
#: scores, is greater, but it holds every n-gram.
ROWS_PER_GRAM = 16
LEAST_ROWS_PER_GRAM = 2
MOST_ROWS = 1 << 24
HASHES = 2
#: Rows of the filter that come to the driver as one value.
BLOCK = 1 << 12
MOST_LANGUAGES = 4096
#: Characters worked on at once; longer texts are cut into pieces that overlap.
PIECE = 1_000_000
_BLANK = 32


def _letters() -> np.ndarray:
    """By code point: whether a character is a letter."""
    return np.array([chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in range(0x110000)])


_IS_LETTER: list[np.ndarray] = []


def codes(text: str) -> np.ndarray:
    """Lower-case letters as code points, every other character a blank."""
    if not _IS_LETTER:
        _IS_LETTER.append(_letters())
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_IS_LETTER[0][points], points, _BLANK)


def grams(points: np.ndarray) -> np.ndarray:
    """Each three neighbours, blanks at the ends of words included, as one 63-bit number."""
    p = points.astype(np.int64)
    held = (p[1:-1] != _BLANK) if len(p) >= GRAM else np.zeros(0, bool)
    if not len(held):
        return np.zeros(0, np.int64)
    return ((p[:-2] << 42) | (p[1:-1] << 21) | p[2:])[held]


def _parts(text: str) -> Iterator[np.ndarray]:
    """A text's n-grams, piece by piece, with a blank before and after the text."""
    for at in range(0, max(len(text), 1), PIECE):
        head = " " if at == 0 else text[at - GRAM + 1 : at]
        tail = " " if at + PIECE >= len(text) else ""
        yield grams(codes(head + text[at : at + PIECE] + tail))


@dataclass(frozen=True)
class Filters:
    """Row r holds one bit a language; an n-gram is in the languages that all its rows have."""

    languages: list[str]
    rows: np.ndarray  # (rows, words) uint64
    false_rate: np.ndarray  # by language: how often an n-gram that isn't held is found

    @staticmethod
    def of(languages: list[str], held: list[np.ndarray]) -> "Filters":
        size = Filters.size(max(map(len, held), default=1))
        rows = np.zeros((size, max(1, -(-len(languages) // 64))), np.uint64)
        for k, own in enumerate(held):
            for at in Filters._places(own, size):
                np.bitwise_or.at(rows[:, k // 64], at, np.uint64(1 << (k % 64)))
        return Filters.filled(languages, rows)

    @staticmethod
    def size(most: int) -> int:
        """Rows of a filter whose largest language has `most` n-grams."""
        wanted = 1 << max(12, int(ROWS_PER_GRAM * most).bit_length())
        return wanted if wanted <= MOST_ROWS else max(MOST_ROWS, 1 << int(LEAST_ROWS_PER_GRAM * most).bit_length())

    @staticmethod
    def filled(languages: list[str], rows: np.ndarray) -> "Filters":
        full = [float((rows[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)).mean()) for k in range(len(languages))]
        return Filters(languages, rows, np.array(full) ** HASHES)

    @staticmethod
    def _places(found: np.ndarray, size: int) -> list[np.ndarray]:
        first = mixed(found.view(np.uint64))
        step = (first >> np.uint64(32)) | np.uint64(1)
        return [((first + step * np.uint64(k)) & np.uint64(size - 1)).astype(np.int64) for k in range(HASHES)]

    def counts(self, found: np.ndarray) -> np.ndarray:
        """By language: how many of the n-grams its filter has."""
        places = Filters._places(found, len(self.rows))
        masks = self.rows[places[0]]
        for at in places[1:]:
            masks = masks & self.rows[at]
        return np.array([(masks[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)).sum() for k in range(len(self.languages))])

    def decide(self, text: str | None) -> tuple[str, float]:
        """The language with most n-grams beyond those expected falsely; ties by name."""
        total, hits = 0, np.zeros(len(self.languages))
        for found in _parts(text or ""):
            total += len(found)
            if len(found) and self.languages:
                hits += self.counts(found)
        if not total or not self.languages:
            return UNKNOWN, 0.0
        own = np.clip((hits - total * self.false_rate) / (1 - np.minimum(self.false_rate, 0.999)), 0, total) / total
        best = int(np.argmax(own))
        return self.languages[best], float(own[best])


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) over whole texts; counted in each batch before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            by: dict[str, list] = {}
            for text, lang in zip(texts, langs):
                by.setdefault(lang, []).append(text)
            for lang, own in by.items():
                for part in pieces(own, PIECE):
                    found = np.concatenate([g for k in part for g in _parts(own[k])])
                    gram, n = np.unique(found, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n, pa.int64())],
                        names=["lang", "gram", "n"],
                    )

    counted = labelled.select("text", "lang").mapInArrow(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _rows(kept: DataFrame, names: list[str], size: int) -> np.ndarray:
    """The filter's rows, put together by blocks in tasks."""
    at = {name: k for k, name in enumerate(names)}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array([at[name] for name in batch.column(0).to_pylist()], np.int64)
            bits = (np.uint64(1) << (lang % 64).astype(np.uint64)).view(np.int64)
            for row in Filters._places(np.asarray(batch.column(1)), size):
                yield pa.RecordBatch.from_arrays(
                    [pa.array((row // BLOCK).astype(np.int32)), pa.array((lang // 64).astype(np.int32)), pa.array((row % BLOCK).astype(np.int32)), pa.array(bits)],
                    names=["block", "word", "row", "bits"],
                )

    def block(part: pa.Table) -> pa.Table:
        own = np.zeros(BLOCK, np.uint64)
        np.bitwise_or.at(own, part.column("row").to_numpy(), part.column("bits").to_numpy().view(np.uint64))
        return pa.table({"block": part.column("block")[:1], "word": part.column("word")[:1], "rows": pa.array([own.tobytes()], pa.binary())})

    placed = kept.select("lang", "gram").mapInArrow(place, "block int, word int, row int, bits long")
    placed = placed.groupBy("block", "word", "row").agg(F.bit_or("bits").alias("bits"))
    rows = np.zeros((size, max(1, -(-len(names) // 64))), np.uint64)
    for r in placed.groupBy("block", "word").applyInArrow(block, "block int, word int, rows binary").collect():
        rows[r["block"] * BLOCK : (r["block"] + 1) * BLOCK, r["word"]] = np.frombuffer(r["rows"], np.uint64)
    return rows


def learn(documents: DataFrame, text: str = "text", lang: str = "lang", share: float = SHARE) -> Filters:
    """Filters from labelled rows, of every n-gram that passes the share test.

    The filter is sized by the n-grams of its largest language and built in tasks; the driver gets
    its bits, not the n-grams. Rows without a label or a text are not learned from; their languages
    are only known if other rows name them. Languages are in order of code point.
    """
    rows = documents.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).dropna()
    counts = gram_counts(rows)
    total = counts.groupBy("lang").agg(F.sum("n").alias("_all"))
    rated = counts.join(total, "lang").withColumn("rate", F.col("n") / F.col("_all"))
    first = rated.groupBy("gram").agg(F.max("rate").alias("_first"))
    kept = written(
        rated.join(first, "gram").filter(F.col("rate") >= F.lit(share) * F.col("_first")).select("lang", "gram"), "grams"
    )
    names = sorted(r[0] for r in rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} values in {lang}: not a column of languages")
    most = kept.groupBy("lang").count().agg(F.max("count")).first()[0]
    return Filters.filled(names, _rows(kept, names, Filters.size(most or 1)))


def language(documents: DataFrame, filters: Filters, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """identifier, lang_pred and score of every row, from its whole text only.

    All languages that hold an n-gram come from one look-up in the bit-sliced filter; each
    language's number of n-grams is corrected for its filter's false positives and the greatest
    decides. The score is the corrected share of the text's n-grams that the language holds, 0 to
    1. Null texts and texts without a letter are `und` with score 0; ties go to the first name;
    with no language learned all are `und`; repeated rows are rows; an empty table gives none.
    """
    shared = documents.sparkSession.sparkContext.broadcast(filters)
    rows = documents.select(F.col(identifier).alias("_id"), F.col(text).alias("_text"))
    schema = T.StructType(
        [rows.schema["_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            decided = [known.decide(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([d[0] for d in decided], pa.string()), pa.array([d[1] for d in decided], pa.float64())],
                names=["_id", "lang_pred", "score"],
            )

    return rows.mapInArrow(decide, schema).withColumnRenamed("_id", identifier)
