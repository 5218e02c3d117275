"""Ranked-source failover over landed fetch attempts."""

from pyspark.sql import DataFrame, functions as F, types as T

from obsmill.functions.text import is_missing_text


def with_chain(tasks: DataFrame, chain: str = "chain") -> DataFrame:
    """One row per task and chain entry; a task without a chain is its own single entry.

    An entry without a column takes the task's.
    """
    own = F.struct(
        F.col("source").alias("source"),
        F.col("command").alias("command"),
        F.col("column").alias("column_name"),
    )
    entries = F.when(F.size(chain) > 0, F.col(chain)).otherwise(F.array(own))
    others = [c for c in tasks.columns if c not in (chain, "source", "command", "column")]
    ranked = tasks.select(*others, "column", F.posexplode(entries).alias("rank", "entry"))
    return ranked.select(
        *others,
        "rank",
        F.col("entry.source").alias("source"),
        F.col("entry.command").alias("command"),
        F.coalesce(F.nullif("entry.column_name", F.lit("")), F.col("column")).alias("column"),
    )


def in_chain(tasks: DataFrame, attempts: DataFrame, key: list[str], chain: str = "chain") -> DataFrame:
    """The attempts whose source stands in their task's chain, at that place.

    A task without a `chain` column, or with an empty one, has its own source at rank 0 alone. An attempt of a source
    that the task doesn't list, or at another rank, isn't part of its outcome. Key columns must not be null.
    """
    sources = F.array("source")
    if chain in tasks.columns:
        sources = F.when(F.size(chain) > 0, F.col(f"{chain}.source")).otherwise(sources)
    listed = tasks.select(*key, F.posexplode(sources).alias("rank", "source")).distinct()
    return attempts.join(listed, [*key, "rank", "source"], "left_semi")


def attempt_body(attempts: DataFrame) -> DataFrame:
    """Adds `body`: the value text or the series as JSON; null where the source gave nothing.

    A series is a map, or JSON text already; a source without entries leaves the text null.
    """
    value = F.when(~is_missing_text(F.col("value")), F.col("value"))
    if "series" in attempts.columns:
        if attempts.schema["series"].dataType == T.StringType():
            series = F.col("series")
        else:
            series = F.when(F.size("series") > 0, F.to_json("series"))
        value = F.coalesce(value, series)
    return attempts.withColumn("body", value)


def resolve(attempts: DataFrame, task: list[str], order: list[str] | None = None) -> DataFrame:
    """Outcome per task: lowest-ranked value wins.

    Status 200 with the winner's body and source; else 503 with the highest-ranked error if any
    source failed; else 204. `order` breaks ties among attempts of one rank. Every aggregate
    reduces map-side, so a task with very many attempts does not become one large group.
    """
    place = F.struct("rank", *(order or []))
    served = F.col("body").isNotNull()
    failed = F.col("error").isNotNull()
    outcome = (
        attempt_body(attempts)
        .groupBy(*task)
        .agg(
            F.min(F.when(served, F.struct(place, "body", "source"))).alias("winner"),
            F.max(F.when(failed, F.struct(place, "error"))).alias("failure"),
        )
    )
    status = (
        F.when(F.col("winner").isNotNull(), F.lit(200))
        .when(F.col("failure").isNotNull(), F.lit(503))
        .otherwise(F.lit(204))
    )
    return outcome.select(
        *task,
        status.alias("status"),
        F.coalesce("winner.body", F.lit("")).alias("body"),
        F.col("winner.source").alias("served_source"),
        F.when(F.col("winner").isNull(), F.col("failure.error")).alias("last_error"),
    )


def outcomes(
    tasks: DataFrame, attempts: DataFrame, task: list[str], order: list[str] | None = None
) -> DataFrame:
    """`tasks` with the outcome of their attempts; a task without any has status 204.

    Attempts resolve per key before they meet the tasks. Key columns must not be null.
    """
    return tasks.join(resolve(attempts, task, order), task, "left").withColumns(
        {"status": F.coalesce("status", F.lit(204)), "body": F.coalesce("body", F.lit(""))}
    )
