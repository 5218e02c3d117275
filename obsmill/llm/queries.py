"""The operators of this folder over whole tables, with the columns their contracts name."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from obsmill.llm import contamination, cotraining, event_chat, language_filters, lattice, middle_frames, mixing, overlap_join, private_data, sharding, suffix_tree, token_trie, turn_repair
from obsmill.llm.shared import remainder, table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = cotraining.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("kept", F.col("score") >= 0.5)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private_data.private_data(table(spark, sf_dir, "documents"))
    plain = F.filter("spans", lambda s: s["plain"])
    shown = lambda spans: F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string")))
    )
    count = lambda kind: F.size(F.filter(plain, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(kind) for kind in private_data.KINDS]
    return found.select("doc_id", *counts, F.sha2(shown(plain), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(remainder("doc_id", 7) == 2, F.lit(False))
    scored = suffix_tree.score(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select(
        "doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    filters = language_filters.learn(documents.filter(remainder("doc_id", 3) != 1))
    decided = language_filters.language(documents, filters)
    return decided.select("doc_id", (F.coalesce(remainder("doc_id", 3), F.lit(0)) == 1).alias("held_out"), "lang_pred", "score")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_trie.token_counts(table(spark, sf_dir, "documents"))


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    hurt = turn_repair.damaged(table(spark, sf_dir, "conversations"))
    return turn_repair.report(turn_repair.repair(hurt, copies="copies")).withColumnRenamed("conversation", "conv_id")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle_frames.fill_in_middle(middle_frames.framed(table(spark, sf_dir, "documents")), text=False)


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    awkward = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", awkward), (-7, 1, "assistant", awkward)], said.schema)
    finished = event_chat.messages(event_chat.log_of(said.unionByName(own)))
    return event_chat.accounts(finished).withColumnRenamed("conversation", "conv_id")


QUERIES = {
    "op1_quality": op1_quality,
    "op2_decontamination": op2_decontamination,
    "op3_private_data": op3_private_data,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_suffix_tree": op5_suffix_tree,
    "op6_language": op6_language,
    "op7_token_counts": op7_token_counts,
    "op8_near_vectors": op8_near_vectors,
    "op9_mixing": op9_mixing,
    "op10_sharding": op10_sharding,
    "op11_repair": op11_repair,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_chat_format": op13_chat_format,
}
ORACLES = {
    "op2_decontamination": contamination.ORACLE,
    "op9_mixing": mixing.ORACLE,
    "op11_repair": turn_repair.ORACLE,
    "op12_fill_in_middle": middle_frames.ORACLE,
    "op13_chat_format": event_chat.ORACLE,
}
