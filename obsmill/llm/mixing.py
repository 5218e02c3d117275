"""Mixing sources to target weights by systematic sampling. DataFrame functions only."""

import random

from pyspark.sql import DataFrame, Window, functions as F

from obsmill.llm.shared import gapless

WORD = r"[^\x20\x09-\x0D]+"
MOST_COPIES = 3
SEED = 9
#: The one random offset of a mix: SEED decides.
OFFSET = random.Random(SEED).random()


def targets(sizes: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """`sizes`, rows of source and source_size, with `weight` and `target`.

    Sources by code point, null last, weigh 1, 2, 3, repeating. They share the sum of all sizes by
    weight; a target stops at `most` times its source's size and what is over is shared again. The
    end of that process is a level L with target = least(most * size, L * weight): in order of
    size / weight the first sources are at their limit, and the first source whose limit is above
    its share of the rest gives L. One row per source goes through the windows, no document does.
    """
    ranked = Window.orderBy(F.col("source").asc_nulls_last())
    sizes = sizes.withColumn("weight", (F.row_number().over(ranked) - 1) % 3 + 1)
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_room.rowsBetween(0, Window.unboundedFollowing)
    whole = by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        sizes.withColumn("_all", F.sum("source_size").over(whole))
        .withColumn("_held", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most)
        .withColumn("_level", (F.col("_all") - F.col("_held")) / F.sum("weight").over(rest))
        .withColumn("_room", F.col("source_size") * most)
        .withColumn("_level", F.first(F.when(F.col("_room") >= F.col("_level") * F.col("weight"), F.col("_level")), ignorenulls=True).over(whole))
        .withColumn("target", F.least(F.col("_room").cast("double"), F.col("_level") * F.col("weight")))
        .drop("_all", "_held", "_level", "_room")
        .withColumn("target", F.coalesce("target", F.lit(0.0)))
    )


def _sampled(documents: DataFrame, identifier: str, text: str, source: str, offset: float, most: int, *carried) -> DataFrame:
    rows = documents.select(
        F.col(identifier).alias("_id"),
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("_group"),
        F.col(source).alias("_source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        *carried,
    )
    digits = F.bin("size")
    rows = rows.withColumn("_hash", F.md5(F.coalesce(F.col("_id").cast("string"), F.lit("")).cast("binary")))
    rows = rows.withColumns(
        {
            "_bin": F.concat(F.lpad(F.length(digits).cast("string"), 2, "0"), F.left(digits, F.lit(5))),
            "_slice": F.left("_hash", F.lit(2)),
        }
    )
    sizes = rows.groupBy("_group").agg(F.sum("size").alias("source_size"), F.first("_source").alias("source"))
    shares = targets(sizes, most).select("_group", "source_size", "target")
    ranked = gapless(rows, ["_group"], ["_bin", "_slice"], ["size", "_hash", "_id"], "_rank")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    crossed = F.floor(rate * (F.col("_rank") + 1) + offset) - F.floor(rate * F.col("_rank") + offset)
    return ranked.join(shares, "_group").withColumn("copies", crossed.cast("long"))


def mix(
    documents: DataFrame,
    identifier: str = "doc_id",
    text: str = "text",
    source: str = "source",
    offset: float = OFFSET,
    most: int = MOST_COPIES,
) -> DataFrame:
    """identifier, source, size, source_size, target, copies and taken of every row.

    Size is the number of words. Every document of a source is expected target / source_size times;
    expected copies are summed in the source's order, and one copy goes out for every integer that
    the sum, begun at `offset`, crosses. The order is by size within octaves cut in sixteen, dealt
    over 256 slices by md5 of the identifier, so that long and short documents are taken alike and
    a source's words come near its target: each chunk is off by at most about one document.

    Sums are of equal terms, so they are taken as rank times rate, without rounding drift; reruns
    agree. No source is ordered in one task (`gapless`). Null texts and texts without words have
    size 0 and take nothing; a null source is a source; repeated rows are rows; an empty table
    gives no rows; other columns of `documents` are not read.
    """
    return _sampled(documents, identifier, text, source, offset, most).select(
        F.col("_id").alias(identifier),
        F.col("_source").alias(source),
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed_documents(
    documents: DataFrame,
    identifier: str = "doc_id",
    text: str = "text",
    source: str = "source",
    offset: float = OFFSET,
    most: int = MOST_COPIES,
) -> DataFrame:
    """`documents` as the mix takes them: each row as often as it has copies, columns unchanged."""
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")
    sampled = _sampled(documents, identifier, text, source, offset, most, whole)
    return (
        sampled.filter("copies > 0")
        .select("_row", F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int"))).alias("_copy"))
        .select("_row.*")
    )


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, size, h, lpad(CAST(length(b) AS VARCHAR), 2, '0') || left(b, 5) AS bin, left(h, 2) AS slice
  FROM (SELECT *, bin(size) AS b FROM (
    SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
      CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents))
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s
), f AS (
  SELECT *, (sum(source_size) OVER () - {MOST_COPIES} * coalesce(sum(source_size) OVER (room ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (room ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW room AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST)
), t AS (
  SELECT source, source_size, coalesce(least({MOST_COPIES}.0::DOUBLE * source_size,
    first_value(CASE WHEN {MOST_COPIES} * source_size >= level * weight THEN level END IGNORE NULLS) OVER whole * weight), 0) AS target FROM f
  WINDOW whole AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY bin, slice, size, h, doc_id) - 1 AS k FROM d
), c AS (
  SELECT doc_id, size, source_size, target, k, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(floor(rate * (k + 1) + {OFFSET!r}) - floor(rate * k + {OFFSET!r}) AS BIGINT) * size AS taken
FROM c
"""
