"""Quality classification by co-training a view of the text and a view of the metadata."""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F, types as T

from obsmill.llm.shared import CLEANUP, LOWER, configured, remainder
from obsmill.sinks.paths import written

ROUNDS = 2
#: How sure a view must be of a document to teach it to the other, and what such a lesson weighs.
CONFIDENT = 0.97
LESSON = 0.2
#: Labelled documents by crc32 of the identifier modulo FOLDS: CALIBRATION fits the views' scales,
#: HELD_OUT is seen by nothing, the rest trains.
FOLDS, CALIBRATION, HELD_OUT = 5, 0, 1
LANG_SLOTS, SOURCE_SLOTS = 16, 64
#: Absolute-value penalty of the text view's fit: words that tell little weigh nothing.
WORDING_PENALTY = 0.003
#: Rows whose vectors are made at once.
ROWS = 500
#: Rows that one task of a fit sums, at least, unless there are more cores than that leaves tasks.
ROWS_A_SUM = 50_000
#: Surface shares of a text, and slots that its words are hashed to.
SHARES, WORD_SLOTS = 42, 1 << 15

#: Blanks for ASCII characters other than letters; letters beyond ASCII stay.
_NO_LETTER = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def text_view(text: str | None) -> list[float]:
    """Shares that describe the whole text: letters, other characters, words, lines, repeats."""
    text = text or ""
    raw = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256).astype(float)
    size = max(1.0, raw.sum())
    upper, lower, digits = raw[65:91].sum(), raw[97:123].sum(), raw[48:58].sum()
    letters = raw[65:91] + raw[97:123]
    words = text.split()
    n = max(1, len(words))
    lines = text.split("\n")
    first = [w[:1] for w in words]
    return [
        *(letters / max(1.0, letters.sum())),
        upper / max(1.0, upper + lower),
        digits / size,
        raw[128:].sum() / size,
        (raw[:128].sum() - upper - lower - digits - raw[32] - raw[10]) / size,
        raw[33] / size,
        raw[46] / size,
        raw[44] / size,
        raw[32] / size,
        np.log1p(len(words)) / 10,
        np.log1p(len(text) / n) / 3,
        len(set(words)) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        len(set(lines)) / len(lines),
        np.log1p(n / len(lines)) / 5,
        sum(w.isupper() for w in first if w) / n,
        sum(w.isalpha() for w in words) / n,
    ]


def word_view(text: str | None) -> np.ndarray:
    """Sorted slots of the distinct words of the whole text."""
    words = set((text or "").encode().translate(LOWER).translate(_NO_LETTER).split())
    return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(w) % WORD_SLOTS for w in words), np.int32, len(words)))


def metadata_view(lang: str | None, source: str | None, chars: int | None) -> list[float]:
    """Language and source by slot, and the stated length; nothing from the text."""
    out = np.zeros(LANG_SLOTS + SOURCE_SLOTS + 4)
    out[zlib.crc32((lang or "").encode()) % LANG_SLOTS] = 1
    out[LANG_SLOTS + zlib.crc32((source or "").encode()) % SOURCE_SLOTS] = 1
    size = np.log1p(max(chars or 0, 0)) / 10
    out[-4:] = [size, size * size, size**3, chars is None]
    return out.tolist()


def views(documents: DataFrame, identifier: str, text: str, lang: str, source: str, chars: str) -> DataFrame:
    """(_id, _fold, shares, words, lang, source, chars) of every row: what its vectors are made of, packed.

    A text's shares take eight bytes each, and two bytes name a distinct word's slot.
    """
    rows = documents.select(
        F.col(identifier).alias("_id"),
        F.coalesce(remainder(identifier, FOLDS), F.lit(FOLDS - 1)).cast("int").alias("_fold"),
        F.col(text).alias("text"),
        F.col(lang).cast("string").alias("lang"),
        F.col(source).cast("string").alias("source"),
        F.col(chars).cast("long").alias("chars"),
    )
    packed = T.StructType.fromDDL("shares binary, words binary").fields
    schema = T.StructType([rows.schema["_id"], rows.schema["_fold"], *packed, *(rows.schema[c] for c in ("lang", "source", "chars"))])

    def view(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            texts = batch.column("text").to_pylist()
            shares = [np.array(text_view(t), np.float64).tobytes() for t in texts]
            words = [word_view(t).astype(np.uint16).tobytes() for t in texts]
            first, last = (batch.column(c) for c in ("_id", "_fold")), (batch.column(c) for c in ("lang", "source", "chars"))
            yield pa.RecordBatch.from_arrays(
                [*first, pa.array(shares, pa.binary()), pa.array(words, pa.binary()), *last], names=schema.fieldNames()
            )

    return rows.mapInArrow(view, schema)


def vectors(rows: DataFrame) -> DataFrame:
    """(_id, _fold, _label, text_view, metadata_view) of rows of `views` with their label."""
    vector = T.StructField("text_view", VectorUDT())
    numbers = T.StructField("metadata_view", T.ArrayType(T.DoubleType()))
    schema = T.StructType([*(rows.schema[c] for c in ("_id", "_fold", "_label")), vector, numbers])
    shares = np.arange(SHARES, dtype=np.int32)

    def sparse(told: list[bytes], words: list[bytes]) -> pa.StructArray:
        """Spark's sparse vectors: the shares, then a slot a distinct word, of unit length in all."""
        slots = [np.frombuffer(w, np.uint16).astype(np.int32) for w in words]
        ends = pa.array(np.concatenate([[0], np.cumsum([SHARES + len(w) for w in slots])]), pa.int32())
        at = np.concatenate([np.concatenate([shares, w + SHARES]) for w in slots]).astype(np.int32)
        values = np.concatenate(
            [np.concatenate([np.frombuffer(t, np.float64), np.full(len(w), 1 / np.sqrt(max(1, len(w))))]) for t, w in zip(told, slots)]
        )
        return pa.StructArray.from_arrays(
            [
                pa.array(np.zeros(len(slots)), pa.int8()),
                pa.array(np.full(len(slots), SHARES + WORD_SLOTS), pa.int32()),
                pa.ListArray.from_arrays(ends, pa.array(at)),
                pa.ListArray.from_arrays(ends, pa.array(values)),
            ],
            names=["type", "size", "indices", "values"],
        )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            told, words, lang, source, chars = (batch.column(c).to_pylist() for c in ("shares", "words", "lang", "source", "chars"))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("_id", "_fold", "_label")),
                    sparse(told, words),
                    pa.array([metadata_view(*m) for m in zip(lang, source, chars)], pa.list_(pa.float64())),
                ],
                names=schema.fieldNames(),
            )

    return rows.mapInArrow(make, schema)


def _fit(rows: DataFrame, view: str, label: Column, weight: Column, steps: int, parts: int, sparse: bool = False) -> LogisticRegressionModel:
    """A fit over `parts` partitions at most, as each shuffles a gradient of all coefficients a step."""
    lessons = rows.select(F.col(view), label.cast("double").alias("_y"), weight.alias("_w")).filter("_y is not null").coalesce(parts)
    return LogisticRegression(
        featuresCol=view, labelCol="_y", weightCol="_w", maxIter=steps,
        regParam=WORDING_PENALTY if sparse else 1e-4, elasticNetParam=1.0 if sparse else 0.0,
        probabilityCol="_p", rawPredictionCol="_raw", predictionCol="_yes",
    ).fit(lessons)


def _with_odds(rows: DataFrame, model: LogisticRegressionModel, name: str) -> DataFrame:
    """Adds the model's log odds that a document is good."""
    scored = model.transform(rows)
    return scored.withColumn(name, vector_to_array("_raw")[1]).drop("_raw", "_p", "_yes")


def _p(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def _scale(rows: DataFrame, odds: str, parts: int) -> tuple[float, float]:
    """Slope and shift that calibrate a view's odds on the calibration fold (Platt)."""
    fold = rows.filter((F.col("_fold") == CALIBRATION) & F.col("_label").isNotNull())
    one = fold.select(array_to_vector(F.array(odds)).alias("odds"), "_label")
    if one.select("_label").distinct().count() < 2:
        return 1.0, 0.0
    model = _fit(one, "odds", F.col("_label"), F.lit(1.0), 30, parts)
    return float(model.coefficients[0]), float(model.intercept)


def quality(
    documents: DataFrame,
    labels: DataFrame,
    identifier: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    chars: str = "n_chars",
    label: str = "quality",
    rounds: int = ROUNDS,
) -> DataFrame:
    """identifier, p_text, p_metadata, score, label (0, 1 or null), held_out of every row.

    Two logistic regressions see different things of a document: its text (surface shares and hashed
    words), or its metadata. Both
    begin with the labelled training folds; in each round every document without a label of which
    one view is `CONFIDENT` becomes a lesson for the other. Then each view's log odds are calibrated
    on a fold that trained nothing, and as the views err apart their calibrated odds are summed, the
    prior's taken off once: `score` is the probability of label 1.

    Views are computed once, joined with the labels while they are packed, written as vectors, and have some hundred
    numbers and one a distinct word a row, of `WORD_SLOTS` at most; the text view's fit leaves out words that tell
    little. Fits are distributed sums
    over all rows, so nothing is sampled and the driver holds coefficients only. Each view's share
    in the score is what its calibration gives it: metadata that tell nothing weigh nothing.

    Null texts and metadata are empty views. Documents that `labels` contradicts itself on count as
    without a label; if a label never occurs in training every score is 0.5. Repeated rows are
    rows; an empty table gives none.
    """
    known = (
        labels.select(F.col(identifier).alias("_of"), F.col(label).cast("int").alias("_label"))
        .filter("_of is not null and _label in (0, 1)")
        .groupBy("_of")
        .agg(F.min("_label").alias("_label"), F.max("_label").alias("_most"))
        .filter("_label = _most")
        .drop("_most")
    )
    seen = views(documents, identifier, text, lang, source, chars)
    with configured(documents.sparkSession, {CLEANUP: "true"}):
        rows = written(vectors(seen.join(known, F.col("_id") == F.col("_of"), "left")), "labelled")
    rows = rows.withColumn("metadata_view", array_to_vector("metadata_view"))
    trains = F.when(~F.col("_fold").isin(CALIBRATION, HELD_OUT), F.col("_label"))
    counts = {r[0]: r[1] for r in rows.groupBy(trains.alias("y")).count().collect()}
    by_label = {y: n for y, n in counts.items() if y is not None}
    parts = max(documents.sparkSession.sparkContext.defaultParallelism, -(-sum(counts.values()) // ROWS_A_SUM))
    held_out = (F.col("_fold") == HELD_OUT).alias("held_out")
    if len(by_label) < 2:
        half = F.lit(0.5)
        return rows.select(
            F.col("_id").alias(identifier), half.alias("p_text"), half.alias("p_metadata"), half.alias("score"),
            F.col("_label").alias("label"), held_out,
        )
    ready = rows.withColumn("_trains", trains)
    own = {"text_view": F.col("_trains"), "metadata_view": F.col("_trains")}
    weight = F.when(F.col("_trains").isNotNull(), 1.0).otherwise(LESSON)
    for k in range(rounds + 1):
        models = {
            "text_view": _fit(ready, "text_view", own["text_view"], weight, 40, parts, sparse=True),
            "metadata_view": _fit(ready, "metadata_view", own["metadata_view"], weight, 15, parts),
        }
        scored = _with_odds(_with_odds(rows, models["text_view"], "_text"), models["metadata_view"], "_metadata")
        if k == rounds:
            break
        ready = scored.withColumn("_trains", trains)
        sure = lambda odds: F.when(F.col("_label").isNull(), F.when(_p(F.col(odds)) >= CONFIDENT, 1).when(_p(F.col(odds)) <= 1 - CONFIDENT, 0))
        own = {"text_view": F.coalesce("_trains", sure("_metadata")), "metadata_view": F.coalesce("_trains", sure("_text"))}
    prior = float(np.log(by_label[1] / by_label[0]))
    (a, b), (c, d) = _scale(scored, "_text", parts), _scale(scored, "_metadata", parts)
    text_odds, metadata_odds = F.col("_text") * a + b, F.col("_metadata") * c + d
    return scored.select(
        F.col("_id").alias(identifier),
        _p(text_odds).alias("p_text"),
        _p(metadata_odds).alias("p_metadata"),
        _p(text_odds + metadata_odds - prior).alias("score"),
        F.col("_label").alias("label"),
        held_out,
    )
