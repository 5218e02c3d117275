"""Command line: `spark-submit` or `python -m obsmill <command> ...`."""

import argparse
import json
import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from obsmill.operators import endpoints, health, statements
from obsmill.plans import crawl, expansion, ranges, statements as statement_plans
from obsmill.schemas import ENDPOINT_REGISTRY, STATEMENT_TASK
from obsmill.sinks.paths import written
from obsmill.sinks.snapshots import SnapshotTable
from obsmill.sinks.store import KeyedStore, ObservationStore
from obsmill.sources import landed
from obsmill.streaming import intake


def _crawl(spark: SparkSession, args) -> None:
    tasks = crawl.plan_tasks(
        landed.read_plans(spark, args.plan), landed.read_identifiers(spark, args.identifiers)
    )
    responses = crawl.task_responses(tasks, spark.read.parquet(args.attempts))
    store = ObservationStore(spark, args.store)
    print(crawl.store_responses(responses, store, args.batch, args.audit))


def _tasks(spark: SparkSession, args) -> None:
    record = crawl.seen_tasks(spark, args.record) if args.record else None
    plans = landed.read_plans(spark, args.plan)
    known = [record.read()] if record else []
    if args.seen:
        known.append(spark.read.parquet(args.seen).select("request_key"))
    seen = reduce(DataFrame.union, known) if known else None
    taken = ranges.read_ranges(spark, args.taken) if args.taken else None
    found = written(ranges.distinct_ranges(plans, landed.read_identifiers(spark, args.identifiers), taken), "ranges")
    crawl.range_tasks(found, seen).write.mode("errorifexists").parquet(args.out)
    if args.taken:
        ranges.record_ranges(found, args.taken)
    if record:
        # After the tasks: a run that breaks off in between repeats them rather than losing them.
        record.insert(spark.read.parquet(args.out).select("request_key"), uuid.uuid4().hex, ["request_key"])


def _statement_tasks(spark: SparkSession, args) -> None:
    ids = landed.read_identifiers(spark, args.identifiers)
    stocks = statement_plans.stock_codes(landed.scan_identifiers(ids, "akshare", args.entity_type))
    tasks = statement_plans.statement_tasks(stocks, args.concepts, args.start_date, args.end_date)
    statement_plans.in_entity_order(tasks).write.mode("errorifexists").json(args.out)


def _statements(spark: SparkSession, args) -> None:
    tasks = spark.read.schema("entity_id BIGINT, source STRING, function_name STRING").json(args.tasks)
    wide, transposed = (spark.read.parquet(p) if p else None for p in (args.wide, args.transposed))
    store = ObservationStore(spark, args.store)
    report, outcomes = crawl.store_statements(tasks, wide, transposed, store, args.batch)
    print(report)
    outcomes.show()


def _migrate(spark: SparkSession, args) -> None:
    table = spark.read.parquet(args.table)
    rows = statements.migrate_legacy(table, args.source, args.symbol, args.limit, arrival=args.arrival)
    print(ObservationStore(spark, args.store).insert(rows, args.batch, ["arrival"]))


def _refresh(spark: SparkSession, args) -> None:
    registry = SnapshotTable(spark, args.registry)
    pages = landed.fetched_ok(landed.read_pages(spark, args.pages))
    probes = spark.read.parquet(args.probes)
    now = datetime.fromisoformat(args.now)
    before = registry.read(ENDPOINT_REGISTRY)
    after = endpoints.refresh(before, pages, probes, now, args.count)
    if after is not before:
        registry.replace(after)
    for row in endpoints.changes(before, registry.read(ENDPOINT_REGISTRY), now).collect():
        print(json.dumps(row.asDict()))
    health.status_counts(registry.read(ENDPOINT_REGISTRY)).show()


def _take_responses(spark: SparkSession, args) -> None:
    stream = intake.response_stream(spark, args.incoming)
    store = ObservationStore(spark, args.store)
    intake.response_stream_to_store(stream, store, ["source_used"], args.checkpoint, args.audit)
    print(store.read().count())


def _take_tasks(spark: SparkSession, args) -> None:
    stream = intake.task_stream(spark, args.incoming, STATEMENT_TASK, args.files)
    keyed = statement_plans.with_task_key(stream)
    queue = KeyedStore(spark, args.queue, keyed.schema, ["task_key"])
    intake.drain_tasks(keyed, queue, ["identifier"], args.checkpoint)
    print(queue.read().count())


def _size(spark: SparkSession, args) -> None:
    identifiers = landed.read_identifiers(spark, args.identifiers)
    if args.plan:
        for row in expansion.plan_totals(landed.read_plans(spark, args.plan), identifiers).toLocalIterator():
            print(json.dumps(row.asDict()))
    stocks = statement_plans.stock_codes(landed.scan_identifiers(identifiers, "akshare", args.entity_type))
    print(json.dumps(statement_plans.queue_size(stocks).first().asDict()))


def _health(spark: SparkSession, args) -> None:
    lines = health.health_lines(spark.read.parquet(args.log))
    report = health.source_health(lines).orderBy("source", "command")
    if args.out:
        report.write.parquet(args.out)
        return
    for row in report.toLocalIterator():
        print(json.dumps(row.asDict(recursive=True), default=str, ensure_ascii=False))


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="obsmill")
    commands = parser.add_subparsers(required=True)

    def command(name, run, *required, **optional):
        sub = commands.add_parser(name)
        for flag in required:
            sub.add_argument(f"--{flag}", required=True)
        for flag, options in optional.items():
            sub.add_argument(f"--{flag.replace('_', '-')}", **options)
        sub.set_defaults(run=run)
        return sub

    command("crawl", _crawl, "plan", "identifiers", "attempts", "store", "batch", audit={})
    command("tasks", _tasks, "plan", "identifiers", "out", taken={}, seen={}, record={})
    command(
        "statement-tasks", _statement_tasks, "identifiers", "out",
        entity_type={"default": "stock"},
        concepts={"type": lambda text: [int(part) for part in text.split(",")]},
        start_date={}, end_date={},
    )
    command("statements", _statements, "tasks", "store", "batch", wide={}, transposed={})
    migrate = command(
        "migrate", _migrate, "table", "store", "batch", symbol={}, limit={"type": int}, arrival={}
    )
    migrate.add_argument("source", choices=list(statements.LEGACY_TABLES))
    command(
        "refresh", _refresh, "registry", "pages", "probes", "now",
        count={"type": int, "default": endpoints.ENDPOINT_FETCH_COUNT},
    )
    command("health", _health, "log", out={})
    command("take-responses", _take_responses, "incoming", "store", "checkpoint", audit={})
    command("take-tasks", _take_tasks, "incoming", "queue", "checkpoint", files={"type": int})
    command("size", _size, "identifiers", plan={}, entity_type={"default": "stock"})
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    args.run(SparkSession.builder.appName("obsmill").getOrCreate(), args)


if __name__ == "__main__":
    main()
