"""Reports on endpoints, circuits, sources, frames and workers."""

from pyspark.sql import DataFrame, functions as F


def status_counts(registry: DataFrame) -> DataFrame:
    """Active and retired endpoints, sorted by status."""
    known = registry.filter(F.col("status").isin("active", "retired"))
    return known.groupBy("status").agg(F.count("*").alias("endpoints")).orderBy("status")


def recent_outcomes(
    log: DataFrame, sources: list[str], n: int = 10, tie_break: str | None = None
) -> DataFrame:
    """Of the latest `n` outcomes, those of `sources`: the limit comes before the filter."""
    order = [F.desc("timestamp"), *([F.desc(tie_break)] if tie_break else [])]
    return log.orderBy(*order).limit(n).filter(F.col("source").isin(*sources))


def circuit_states(circuits: DataFrame, source: str, n: int = 10) -> DataFrame:
    """First `n` circuits of a source by key, split into their parts."""
    parts = F.split("key", ":")
    mine = circuits.filter(F.col("key").startswith(f"circuit:{source}:"))
    return (
        mine.orderBy("key")
        .limit(n)
        .select("key", parts[1].alias("source"), parts[2].alias("endpoint_id"), "state")
    )


def health_lines(log: DataFrame) -> DataFrame:
    """One line per call: OK or FAIL, elapsed milliseconds and the start of the error text."""
    return log.withColumns(
        {
            "outcome": F.when(F.col("error").isNull(), F.lit("OK")).otherwise(F.lit("FAIL")),
            "detail": F.substring("error", 1, 50),
        }
    )


def source_health(lines: DataFrame) -> DataFrame:
    """OK and FAIL counts and slowest call per source and command, with one row of totals.

    The totals come from the grouped counts, so the lines are read once.
    """
    per_command = lines.groupBy("source", "command").agg(
        F.count_if(F.col("outcome") == "OK").alias("ok"),
        F.count_if(F.col("outcome") == "FAIL").alias("failed"),
        F.max("elapsed_ms").alias("slowest_ms"),
    )
    return per_command.groupingSets([["source", "command"], []], "source", "command").agg(
        F.sum("ok").alias("ok"),
        F.sum("failed").alias("failed"),
        F.max("slowest_ms").alias("slowest_ms"),
    )


def frame_profile(frame: DataFrame, by: list[str]) -> DataFrame:
    """Rows and columns of each landed frame, with the label a report shows."""
    columns = len(frame.columns) - len(by)
    sized = frame.groupBy(*by).agg(F.count("*").alias("row_count"))
    return sized.withColumns(
        {
            "column_count": F.lit(columns),
            "profile": F.format_string("DataFrame(%dr×%dc)", F.col("row_count"), F.lit(columns)),
        }
    )


def task_outcomes(tasks: DataFrame, observations: DataFrame, key: list[str]) -> DataFrame:
    """Per source: tasks that wrote at least one row, and tasks that wrote none.

    Only the presence of a row matters, so observations reduce to distinct keys before the join.
    """
    wrote = observations.select(*key).distinct().withColumn("_wrote", F.lit(True))
    return (
        tasks.join(wrote, key, "left")
        .groupBy("source")
        .agg(
            F.count_if(F.col("_wrote")).alias("processed"),
            F.count_if(F.col("_wrote").isNull()).alias("errors"),
        )
    )
