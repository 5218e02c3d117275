"""A corpus from raw documents to shards: STAGES in order, each over all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as
the next one's docs. All but the last return the columns of documents.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from obsmill.llm import contamination, language_filters, mixing, overlap_join, sharding
from obsmill.llm.shared import remainder, table
from obsmill.sinks.paths import written

#: A document is rejected if its likeliest language holds less of its letter trigrams than this part
#: of what the language holds of half of its own labelled documents.
LEAST_OF_USUAL = 0.3


def _whole(docs: DataFrame) -> DataFrame:
    """Rows as one column beside the text, so that an operator hands them through."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"))


def _usual(docs: DataFrame, filters: language_filters.Filters) -> dict[str, float]:
    """By language: the median score of the documents that bear its label and are found to be in it."""
    labelled = docs.select(F.col("lang").cast("string").alias("own"), "text").filter("own is not null")
    scored = language_filters.language(labelled, filters, identifier="own").filter("own = lang_pred")
    return {r[0]: r[1] for r in scored.groupBy("own").agg(F.percentile_approx("score", 0.5)).collect()}


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no language that the labelled ones teach, go.

    What a language usually holds is told by documents that it didn't learn from; a language that
    has none is measured on those that it did learn from.
    """
    held_out = remainder("doc_id", 3) == 1
    filters = language_filters.learn(docs.filter(~held_out))
    usual = _usual(docs.filter(held_out), filters)
    untold = [name for name in filters.languages if name not in usual]
    if untold:
        usual |= _usual(docs.filter(F.col("lang").cast("string").isin(untold)), filters)
    decided = language_filters.language(_whole(docs), filters, identifier="row")
    rows = [(name, LEAST_OF_USUAL * score) for name, score in usual.items()]
    least = F.broadcast(spark.createDataFrame(rows, "lang_pred string, _least double"))
    known = decided.filter(F.col("lang_pred") != language_filters.UNKNOWN).join(least, "lang_pred", "left")
    return known.filter(F.col("score") >= F.coalesce("_least", F.lit(0.0))).select("row.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the document with the least identifier stays."""
    return overlap_join.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    found = contamination.contamination(_whole(docs), table(spark, sf_dir, "benchmark"), identifier="row")
    return found.filter("n_hit = 0").select("row.*")


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its size, checksum, shard and slot."""
    return sharding.shard(docs, carry=True)


STAGES = [
    ("language", in_a_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", to_target_weights),
    ("sharding", into_shards),
]

#: Language filters, components and differencing aren't expressible in SQL; tests take their place.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
