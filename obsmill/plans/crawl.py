"""The whole way from plans to the store, on landed attempts or through adapters."""

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from obsmill.operators.failover import in_chain, outcomes
from obsmill.operators.health import task_outcomes
from obsmill.operators.observations import clamp_counts, item_rows, parse_responses
from obsmill.operators.statements import legacy_rows, parse_frames
from obsmill.plans.expansion import joined_request_key, request_key_parts, unseen_tasks
from obsmill.plans.ranges import balanced, distinct_ranges, expand
from obsmill.sinks.paths import discard, written
from obsmill.sinks.store import InsertReport, KeyedStore, ObservationStore, append_audit, observed


@dataclass(frozen=True)
class ResponseReport(InsertReport):
    kept: int
    dropped: int


SEEN = T.StructType([T.StructField("request_key", T.StringType())])


def plan_tasks(
    plans: DataFrame,
    identifiers: DataFrame,
    seen: DataFrame | None = None,
    chained: bool = False,
    taken: DataFrame | None = None,
) -> DataFrame:
    """Distinct tasks of the plans that no earlier run has taken.

    Earlier runs are told by the ranges they took, which are compared before any task is expanded, or
    by the keys of `seen` tasks.
    """
    return range_tasks(distinct_ranges(plans, identifiers, taken, chained=chained), seen)


def range_tasks(ranges: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Keyed tasks of distinct ranges, in even partitions, without those of `seen` keys.

    All of a key but the date is made once per run, before the run unfolds.
    """
    parts = request_key_parts()
    tasks = expand(balanced(ranges).withColumns(parts)).withColumn("request_key", joined_request_key()).drop(*parts)
    return tasks if seen is None else unseen_tasks(tasks, seen)


def task_responses(tasks: DataFrame, attempts: DataFrame) -> DataFrame:
    """Tasks with the outcome of their attempts (request_key, rank, source, value, ...).

    Attempts may have landed earlier or come out of `fetch_attempts`. Only those of the task's own sources, at
    their places in its chain, count. A task without attempts has status 204.
    """
    return outcomes(tasks, in_chain(tasks, attempts, ["request_key"]), ["request_key"])


def store_responses(
    responses: DataFrame, store: ObservationStore, batch_id: str, audit: str | None = None
) -> ResponseReport:
    """Items of the responses into the store, and unexploded into the audit log.

    Several sources may answer for one key; the better-ranked one counts as the first writer. The report
    also has the numbers of series entries inside and outside their ranges, taken while the items are written.
    """
    kept, dropped = clamp_counts()
    items, clamped = observed(
        parse_responses(responses, keep=("rank",), typed=audit is not None),
        "items",
        F.sum(kept).alias("kept"),
        F.sum(dropped).alias("dropped"),
    )
    report = store.insert(item_rows(items), batch_id, ["rank", "source_used"])
    if audit is not None:
        append_audit(items.drop("rank"), audit, batch_id)
    discard(items)
    return ResponseReport(**asdict(report), kept=clamped["kept"] or 0, dropped=clamped["dropped"] or 0)


def store_statements(
    tasks: DataFrame,
    wide: DataFrame | None,
    transposed: DataFrame | None,
    store: ObservationStore,
    batch_id: str,
) -> tuple[InsertReport, DataFrame]:
    """Landed statement frames into the store, and per source the tasks that gave rows and that gave none.

    Of rows with one key the one of the earlier task counts, by the order of the statement functions.
    """
    parsed = written(parse_frames(wide, transposed), "statements")
    report = store.insert(legacy_rows(parsed), batch_id, ["arrival", "value"], computed=True)
    return report, task_outcomes(tasks, parsed, ["entity_id", "source", "function_name"])


def seen_tasks(spark: SparkSession, path: str) -> KeyedStore:
    """Keys of the tasks that earlier runs have taken; empty before the first."""
    return KeyedStore(spark, path, SEEN, ["request_key"])
