"""Statement tasks: every stock times a fixed list of functions."""

from pyspark.sql import DataFrame, functions as F

from obsmill.functions.text import composite_key
from obsmill.schemas import STATEMENT_FUNCTIONS, STOCK_CODE_PATTERN


def stock_codes(identifiers: DataFrame) -> DataFrame:
    """Identifiers that are exactly six digits."""
    return identifiers.filter(F.col("identifier").rlike(STOCK_CODE_PATTERN))


def statement_tasks(
    stocks: DataFrame,
    concept_ids: list[int] | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
) -> DataFrame:
    """Twelve tasks per stock, as an explode of a literal array: no join, no shuffle."""
    functions = F.array(
        *[
            F.struct(
                F.lit(source).alias("source"),
                F.lit(name).alias("function_name"),
                F.lit(command).alias("function_command"),
            )
            for source, name, command in STATEMENT_FUNCTIONS
        ]
    )
    tasks = stocks.select("entity_id", "identifier", F.explode(functions).alias("function")).select(
        "entity_id", "identifier", "function.*"
    )
    if concept_ids is not None:
        tasks = tasks.withColumn("concept_ids", F.array(*[F.lit(c) for c in concept_ids]))
    if start_date is not None:
        tasks = tasks.withColumn("start_date", F.lit(start_date))
    if end_date is not None:
        tasks = tasks.withColumn("end_date", F.lit(end_date))
    return tasks


def with_task_key(tasks: DataFrame) -> DataFrame:
    return tasks.withColumn(
        "task_key", composite_key(F.col("entity_id"), F.col("source"), F.col("function_name"))
    )


def new_statement_tasks(stocks: DataFrame, seen: DataFrame, **task_options) -> DataFrame:
    """One task per `entity:source:function` that no earlier run recorded.

    A key repeats only where an entity has several identifiers, so the stocks are made unique
    (smallest identifier) before the twelvefold explode rather than the tasks after it.
    """
    unique = stocks.groupBy("entity_id").agg(F.min("identifier").alias("identifier"))
    tasks = with_task_key(statement_tasks(unique, **task_options))
    return tasks.join(seen.select("task_key"), "task_key", "left_anti")


def in_entity_order(tasks: DataFrame) -> DataFrame:
    """Global order by entity: a range partitioning, not a single task."""
    return tasks.orderBy("entity_id")


def queue_size(stocks: DataFrame) -> DataFrame:
    """How many statement tasks the stocks make, before any is made: stocks, functions of a stock, tasks."""
    functions = F.lit(len(STATEMENT_FUNCTIONS)).cast("bigint")
    return stocks.agg(F.count("*").alias("stocks")).select(
        "stocks", functions.alias("functions"), (F.col("stocks") * functions).alias("tasks")
    )
