"""The whole way: plans, tasks, landed values, outcomes, items, first writers, counts."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from obsmill.operators import extract, failover, observations as obs
from obsmill.plans.expansion import expand_tasks
from workload import bindings as b


def stored_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations per concept and granularity, after failover and first-writer-wins."""
    plans, ids = b.plans(spark, sf_dir), b.identifiers(spark, sf_dir)
    points = extract.frame_points(b.price_frame(spark, sf_dir), "o_orderkey")
    task = ["plan_id", "concept_id", "entity_type", "entity_id", "date", "unit", "granularity", "start", "end"]
    tried = [*task, "rank", "source"]
    # Only served tasks count here, so the others leave before the shuffle of the outcomes.
    single = expand_tasks(plans, ids, mode="per_date").join(points, extract.POINT_KEY).select(
        *tried, "value", F.lit(None).cast("map<string,string>").alias("series")
    )
    days = extract.frame_points(b.price_frame(spark, sf_dir, timed=True), "o_orderkey", daily=True)
    ranged = extract.extract_ranges(expand_tasks(plans, ids, mode="series"), days, tried).withColumn(
        "value", F.lit(None).cast("string")
    )
    attempts = single.unionByName(ranged).withColumn("error", F.lit(None).cast("string"))
    responses = failover.resolve(attempts, task).withColumn("source", F.col("served_source"))
    rows = obs.with_defaults(obs.item_rows(obs.parse_responses(responses, keep=("plan_id",))))
    firsts = obs.first_writer(obs.complete_keys(rows), ["plan_id"])
    return firsts.groupBy("concept_id", "granularity").agg(
        F.count("*").alias("observations"),
        F.countDistinct("entity_id").alias("entities"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )
