"""One query per operator. Each takes (spark, sf_dir) and runs over whole tables."""

from datetime import datetime
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from obsmill import schemas
from obsmill.functions import dates, text
from obsmill.operators import endpoints, extract, failover, health, observations as obs, statements
from obsmill.plans import crawl, expansion, providers, ranges, statements as statement_plans
from obsmill.sinks.paths import scratch_path, written
from obsmill.sinks.snapshots import SnapshotTable
from obsmill.sinks.store import BucketedObservations, KeyedStore, ObservationStore, append_audit
from obsmill.sources import adapters as sources, landed
from obsmill.streaming import intake
from workload import bindings as b
from workload import adapters as samples

# Python workers need not have this repository on their path.
for module in (sources, samples):
    cloudpickle.register_pickle_by_value(module)

QUERIES = {}
NOW = datetime(1998, 1, 1, 0, 30)
BUDGET = 200
ROW = [*schemas.KEY, "value", "unit", "source_used"]


def query(function):
    QUERIES[function.__name__] = function
    return function


def series_text(series: str = "series"):
    """Canonical text of a series, for comparison."""
    pairs = F.array_sort(F.map_entries(series))
    return F.array_join(
        F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null")))),
        "|",
    )


# Plans and tasks

@query
def plan_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expansion.flatten_plan(b.landed_plans(spark, sf_dir))


@query
def date_spine(spark, sf_dir):
    flat = expansion.flatten_plan(b.plans(spark, sf_dir))
    spine = dates.date_spine(F.col("start"), F.col("end"), F.col("frequency"))
    return flat.filter(F.col("rank") == 0).select(
        "plan_id", "concept_id", "code", "frequency", F.explode(spine).alias("date")
    )


@query
def granularity_tag(spark, sf_dir):
    flat = expansion.flatten_plan(b.plans(spark, sf_dir))
    return flat.groupBy("frequency", "granularity").agg(F.count("*").alias("n"))


@query
def entity_scope_all(spark, sf_dir):
    ids = landed.scan_identifiers(b.identifiers(spark, sf_dir), "akshare", "stock")
    return ids.select("entity_id", "identifier")


@query
def entity_scope_ids(spark, sf_dir):
    return expansion.scoped_entities(b.plans(spark, sf_dir), b.identifiers(spark, sf_dir))


@query
def stock_code_filter(spark, sf_dir):
    return statement_plans.stock_codes(b.identifiers(spark, sf_dir)).select(
        "source", "entity_id", "identifier"
    )


def _tasks(spark, sf_dir, mode=None, plans=None):
    plans = b.plans(spark, sf_dir) if plans is None else plans
    return expansion.expand_tasks(plans, b.identifiers(spark, sf_dir), mode=mode)


@query
def tasks_per_date(spark, sf_dir):
    return _tasks(spark, sf_dir, "per_date")


@query
def tasks_series(spark, sf_dir):
    return _tasks(spark, sf_dir, "series")


def _distinct(spark, sf_dir, taken=None):
    found = ranges.distinct_ranges(b.plans(spark, sf_dir), b.identifiers(spark, sf_dir), taken)
    return crawl.range_tasks(found)


@query
def provider_params(spark, sf_dir):
    tasks = _distinct(spark, sf_dir)
    point = providers.point_params(F.col("identifier"), F.coalesce("date", "start"))
    ranged = providers.range_params(F.col("identifier"))
    history = providers.history_params(F.col("identifier"), F.col("start"), F.col("end"))
    statement = providers.statement_params(F.col("source"), F.col("identifier"))
    return tasks.select(
        "source",
        "concept_id",
        "granularity",
        "unit",
        point["symbol"].alias("point_symbol"),
        point["date"].alias("point_date"),
        ranged["symbol"].alias("range_symbol"),
        history["start_date"].alias("history_start"),
        history["end_date"].alias("history_end"),
        statement["symbol"].alias("statement_symbol"),
    )


@query
def request_key(spark, sf_dir):
    return _tasks(spark, sf_dir).select("plan_id", expansion.request_key().alias("request_key"))


@query
def task_dedup(spark, sf_dir):
    return _distinct(spark, sf_dir).select("request_key")


@query
def task_incremental(spark, sf_dir):
    """A second run after one that took the finished orders' plans and recorded their ranges."""
    path = scratch_path(spark, "taken")
    earlier = b.plans(spark, sf_dir).filter(F.col("o_orderstatus") == "F")
    ranges.record_ranges(ranges.distinct_ranges(earlier, b.identifiers(spark, sf_dir)), path)
    return _distinct(spark, sf_dir, ranges.read_ranges(spark, path)).select("request_key")


@query
def plan_size(spark, sf_dir):
    return expansion.plan_size(b.plans(spark, sf_dir), b.identifiers(spark, sf_dir))


@query
def plan_totals(spark, sf_dir):
    return expansion.plan_totals(b.plans(spark, sf_dir), b.identifiers(spark, sf_dir))


@query
def queue_size(spark, sf_dir):
    return statement_plans.queue_size(_stocks(spark, sf_dir))


def _stocks(spark, sf_dir, source="akshare"):
    ids = landed.scan_identifiers(b.identifiers(spark, sf_dir), source, "stock")
    return statement_plans.stock_codes(ids)


@query
def statement_tasks(spark, sf_dir):
    return statement_plans.in_entity_order(
        statement_plans.statement_tasks(_stocks(spark, sf_dir), start_date="2024-01-01")
    )


@query
def statement_task_dedup(spark, sf_dir):
    seen = b.table(spark, sf_dir, "supplier").select(
        text.composite_key(F.col("s_suppkey"), F.lit("akshare"), F.lit("annual_bs")).alias("task_key")
    )
    return statement_plans.new_statement_tasks(_stocks(spark, sf_dir, None), seen)


# Fetch results

@query
def point_extract(spark, sf_dir):
    tasks = _tasks(spark, sf_dir, "per_date").select(
        "plan_id", "concept_id", "source", "identifier", "date", "column"
    )
    points = extract.open_points(b.open_price_frames(spark, sf_dir), "o_orderkey")
    return extract.extract_points(tasks, points)


def _series(spark, sf_dir):
    frame = b.event_frame(spark, sf_dir)
    return extract.extract_series(
        frame, ["user_id", "event_type"], "value", "event_id", "2024-01-05", "2024-01-20"
    )


@query
def series_extract(spark, sf_dir):
    return _series(spark, sf_dir).select(
        "user_id", "event_type", F.size("series").alias("days"), series_text().alias("series")
    )


def _outcomes(spark, sf_dir):
    """Attempts along the chain of their tasks; an unlisted source, and a listed one out of place, don't count."""
    key = ["entity_id", "command", "date"]
    attempts = b.attempts(spark, sf_dir)
    entry = lambda source: F.struct(*[F.lit(v).alias(n) for n, v in (("source", source), ("command", "c"), ("column_name", ""))])
    chain = F.array(*[entry(source) for source in ("akshare", "yfinance", "wbgapi")])
    tasks = attempts.select(*key).distinct().withColumns({"source": F.lit("akshare"), "column": F.lit("v"), "chain": chain})
    better = attempts.filter("arrival % 2 = 0")
    strangers = better.withColumns({"source": F.lit("unlisted"), "value": F.lit("!"), "rank": F.lit(0)})
    misplaced = better.withColumns({"source": F.lit("wbgapi"), "value": F.lit("?"), "rank": F.lit(0)})
    every = reduce(DataFrame.unionByName, [attempts, strangers, misplaced])
    return failover.resolve(failover.in_chain(tasks, every, key), key, ["arrival"])


@query
def source_failover(spark, sf_dir):
    return _outcomes(spark, sf_dir).filter(F.col("status") == 200).select(
        "entity_id", "command", "date", "body", "served_source"
    )


@query
def fetch_status(spark, sf_dir):
    """Tasks of all attempts, of which a quarter never landed."""
    key = ["entity_id", "command", "date"]
    attempts = b.attempts(spark, sf_dir)
    landed_ones = attempts.filter(F.col("arrival") % 4 != 3)
    found = failover.outcomes(attempts.select(*key).distinct(), landed_ones, key, ["arrival"])
    return found.select(*key, "status", "last_error")


@query
def fetch_map(spark, sf_dir):
    chain = F.array(*[
        F.struct(F.lit(s).alias("source"), F.lit(c).alias("command"), F.lit(n).alias("column_name"))
        for s, c, n in [("akshare", "hist", "close"), ("yfinance", "info", "")]
    ])
    none = F.lit(None).cast("string")
    ranged = F.col("o_orderkey") % 3 == 0
    day = F.col("o_orderdate").cast("date").cast("string")
    tasks = b.table(spark, sf_dir, "orders").select(
        F.lit("akshare").alias("source"), F.lit("hist").alias("command"),
        F.col("o_custkey").cast("string").alias("identifier"), F.when(~ranged, day).alias("date"),
        F.lit("price").alias("column"), F.lit(1).alias("concept_id"), F.lit("fund").alias("entity_type"),
        F.col("o_orderkey").alias("entity_id"), F.lit("").alias("unit"), F.lit("day").alias("granularity"),
        F.when(ranged, day).alias("start"), F.when(ranged, day).otherwise(none).alias("end"), chain.alias("chain"),
    )
    # The table function: groups of one source, split by a hash of the key.
    calls = sources.call_groups(tasks.count(), spark.sparkContext.defaultParallelism)
    keyed = tasks.withColumn("request_key", expansion.request_key())
    keyed.withColumn("part", F.pmod(F.xxhash64("request_key"), F.lit(calls))).createOrReplaceTempView("keyed_tasks")
    spark.udtf.register("fetch", sources.fetch_table(samples.adapters, "chain"))
    attempts = spark.sql("SELECT * FROM fetch(TABLE(keyed_tasks) PARTITION BY (source, part))")
    return failover.resolve(attempts, ["request_key", "entity_id", "identifier"]).drop("request_key")


# Observations

@query
def response_parse(spark, sf_dir):
    items = obs.parse_responses(b.responses(spark, sf_dir))
    return items.select(
        "concept_id", "entity_type", "entity_id", "date", "value",
        F.size("series").alias("days"), "start", "end", "unit", "source_used", "granularity",
    )


@query
def series_decode(spark, sf_dir):
    served = b.responses(spark, sf_dir).filter(
        (F.col("status") == 200) & (F.col("body") != "") & F.col("date").isNull()
    )
    decoded = obs.decode_series(served, F.col("body"))
    return decoded.select("event_id", series_text().alias("series"))


@query
def series_decode_faults(spark, sf_dir):
    """Bodies cut short count as malformed, per source."""
    cut = F.when(F.col("event_id") % 5 == 0, F.expr("substring(body, 1, length(body) - 1)"))
    return obs.decode_faults(b.responses(spark, sf_dir).withColumn("body", F.coalesce(cut, "body")))


def _series_items(spark, sf_dir):
    items = obs.parse_responses(b.responses(spark, sf_dir))
    return items.filter(F.col("series").isNotNull())


@query
def series_explode_clamp(spark, sf_dir):
    return obs.explode_series(_series_items(spark, sf_dir)).select(*ROW)


@query
def series_clamp_stats(spark, sf_dir):
    stats = obs.clamp_stats(_series_items(spark, sf_dir))
    return stats.groupBy("concept_id", "entity_id").agg(
        F.count("*").alias("items"), F.sum("kept").alias("kept"), F.sum("dropped").alias("dropped")
    )


@query
def obs_defaults(spark, sf_dir):
    filled = obs.with_defaults(b.observations(spark, sf_dir))
    return filled.select("arrival", "granularity", "unit", "source_used")


@query
def obs_value_text(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem")
    scaled = [("plain", "l_extendedprice"), ("large", "l_extendedprice * 1000000.0"),
              ("huge", "l_extendedprice * 1e14"), ("small", "l_discount / 64.0"),
              ("tiny", "l_tax / 1048576.0")]
    rows = lines.select("l_orderkey", "l_linenumber", *[F.expr(e).alias(n) for n, e in scaled])
    for name, _ in scaled:
        rows = obs.with_value_text(rows, name)
    return rows


@query
def obs_union_shapes(spark, sf_dir):
    return obs.item_rows(obs.parse_responses(b.responses(spark, sf_dir))).select(*ROW)


def _rows(spark, sf_dir):
    filled = obs.with_value_text(obs.with_defaults(b.observations(spark, sf_dir)))
    return obs.complete_keys(filled)


def _firsts(spark, sf_dir):
    return obs.first_writer(_rows(spark, sf_dir), ["arrival"])


@query
def obs_first_writer(spark, sf_dir):
    return _firsts(spark, sf_dir).select(*ROW)


@query
def obs_insert_if_absent(spark, sf_dir):
    store = ObservationStore(spark, scratch_path(spark, "observations"))
    rows = b.observations(spark, sf_dir)
    store.insert(rows.filter(F.col("wave") == 0), "a", ["arrival"])
    store.insert(rows, "b", ["arrival"])
    return store.read().select(*ROW)


@query
def obs_insert_repeated_batch(spark, sf_dir):
    store = ObservationStore(spark, scratch_path(spark, "observations"))
    rows = b.observations(spark, sf_dir)
    store.insert(rows.filter(F.col("wave") == 0), "legacy", ["arrival"])
    store.insert(rows, "legacy", ["arrival"])
    return store.read().select(*ROW)


@query
def obs_insert_bucketed(spark, sf_dir):
    path = scratch_path(spark, "bucketed")
    store = BucketedObservations(spark, path, path.rsplit("/", 1)[-1].replace("-", "_"), buckets=16)
    rows = b.observations(spark, sf_dir)
    store.insert(rows.filter(F.col("wave") == 0), "a", ["arrival"])
    store.insert(rows, "b", ["arrival"])
    return store.read().select(*ROW)


@query
def obs_granularity_coexist(spark, sf_dir):
    cadences = _firsts(spark, sf_dir).groupBy("concept_id", "entity_type", "entity_id", "date").agg(
        F.count("*").alias("cadences")
    )
    return cadences.filter(F.col("cadences") > 1)


@query
def obs_range_count(spark, sf_dir):
    return obs.count_in_period(_firsts(spark, sf_dir), "2024-01-05", "2024-01-20")


@query
def obs_cache_misses(spark, sf_dir):
    stored = _firsts(spark, sf_dir)
    wanted = stored.select("concept_id", "entity_type", "entity_id").distinct().select(
        "*", F.lit("day").alias("granularity"), F.lit("daily").alias("frequency"),
        F.lit("2024-01-01").alias("start"), F.lit("2024-01-31").alias("end"),
    )
    return obs.cache_misses(wanted, stored).select(*schemas.KEY)


@query
def obs_coverage(spark, sf_dir):
    covered = obs.coverage(_firsts(spark, sf_dir))
    return covered.groupBy(*obs.SERIES_KEY).agg(F.sum("days").alias("days"))


@query
def audit_json(spark, sf_dir):
    path = scratch_path(spark, "audit")
    items = obs.parse_responses(b.responses(spark, sf_dir), typed=True)
    append_audit(items, path)
    # Read back by type: numbers are numbers in the log.
    typed = spark.read.schema(items.withColumn("series", F.col("typed")).drop("typed").schema).json(path)
    entries = F.map_entries("series")
    spelled = F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"], text.variant_text(e["value"]))))
    kinds = F.transform(entries, lambda e: F.schema_of_variant(e["value"]))
    numbers = F.size(F.filter(kinds, lambda k: ~k.isin("STRING", "BOOLEAN", "VOID")))
    return typed.select(
        "concept_id", "entity_id", "date", "value", series_text(spelled).alias("series"),
        F.when(F.col("series").isNotNull(), numbers).alias("numbers"), "end", "unit", "source_used",
    )


# Statements

@query
def statement_melt(spark, sf_dir):
    frame = b.statements(spark, sf_dir)
    return statements.melt_wide(
        frame, ["entity_id", "source", "function_name"], b.STATEMENT_FIELDS
    ).select("entity_id", "source", "function_name", "field", "date", "value")


@query
def concept_mapping(spark, sf_dir):
    melted = statements.melt_wide(
        b.statements(spark, sf_dir), ["entity_id", "source", "function_name"], b.STATEMENT_FIELDS
    )
    parsed = statements.map_concepts(melted, statements.concept_map(spark))
    return parsed.select("entity_id", "function_name", "field", "concept_id", "date", "value")


@query
def statement_melt_transposed(spark, sf_dir):
    frame = b.transposed_statements(spark, sf_dir)
    parsed = statements.parse_transposed(frame, ["entity_id"], statements.date_columns(frame))
    return parsed.select("entity_id", "function_name", "field", "concept_id", "date", "value")


@query
def missing_value_filter(spark, sf_dir):
    frame = b.statements(spark, sf_dir)
    kinds = {c: frame.schema[c].dataType for c in b.STATEMENT_FIELDS}
    present = [
        F.count_if(statements.not_missing(F.col(c), kinds[c])).alias(c.lower()) for c in kinds
    ]
    return frame.groupBy("entity_id").agg(*present)


@query
def entity_code_fallback(spark, sf_dir):
    frame = b.statements(spark, sf_dir)
    return frame.groupBy(statements.entity_code(frame).alias("entity_code")).agg(
        F.count("*").alias("n")
    )


@query
def obs_legacy_constants(spark, sf_dir):
    parsed = statements.parse_wide(b.statements(spark, sf_dir), ["entity_id"])
    return statements.legacy_rows(parsed).select(*ROW)


@query
def statement_store(spark, sf_dir):
    store = ObservationStore(spark, scratch_path(spark, "observations"))
    tasks = statement_plans.statement_tasks(_stocks(spark, sf_dir))
    wide, transposed = b.statements(spark, sf_dir), b.transposed_statements(spark, sf_dir)
    crawl.store_statements(tasks, wide, transposed, store, "statements")
    return store.read().select(*ROW)


@query
def legacy_migrate(spark, sf_dir):
    """All six sources: all rows, one symbol, or the first rows."""
    prices = b.bind(spark, sf_dir, "orders", [
        "o_orderkey", "o_custkey AS entity_id", f"{b.code('o_custkey')} AS symbol", "o_orderdate AS `date`",
        "o_totalprice AS `close`",
    ])
    frames = b.bind(spark, sf_dir, "lineitem", [*b.STATEMENTS, "cast(l_partkey as string) AS symbol", "l_orderkey * 10 + l_linenumber AS place"])
    tables = [
        ("astock", prices.filter("o_orderkey % 3 = 0"), {}),
        ("astock-hk", prices.filter("o_orderkey % 3 = 1"), {"symbol": "HK000007"}),
        ("astock-us", prices.filter("o_orderkey % 3 = 2"), {"limit": 500, "arrival": "o_orderkey"}),
        ("astock-balance", frames, {}),
        ("astock-profit", frames, {}),
        ("astock-cashflow", frames, {"limit": 2000, "arrival": "place"}),
    ]
    migrated = [statements.migrate_legacy(table, name, **options) for name, table, options in tables]
    return reduce(DataFrame.unionByName, migrated).select(*ROW)


# Endpoints and health

@query
def page_ip_extract(spark, sf_dir):
    pages = b.table(spark, sf_dir, "pages")
    status = F.when(F.col("page_id") % 10 == 9, 404).otherwise(200)
    found = endpoints.page_matches(landed.fetched_ok(pages, status))
    both = found.select("page_id", F.posexplode(F.arrays_zip("ips", "ports")).alias("pos", "found"))
    return both.select("page_id", "pos", F.col("found.ips").alias("ip"), F.col("found.ports").alias("port"))


def _pairs(spark, sf_dir):
    return endpoints.pair_endpoints(landed.fetched_ok(b.listing(spark, sf_dir)))


@query
def endpoint_pair(spark, sf_dir):
    return _pairs(spark, sf_dir)


@query
def endpoint_source_budget(spark, sf_dir):
    return endpoints.within_budget(_pairs(spark, sf_dir), BUDGET)


def _unique(spark, sf_dir):
    return endpoints.first_seen(_pairs(spark, sf_dir))


@query
def endpoint_dedup(spark, sf_dir):
    return _unique(spark, sf_dir)


@query
def endpoint_topn(spark, sf_dir):
    return endpoints.gather(landed.fetched_ok(b.listing(spark, sf_dir)), BUDGET)


def _valid(spark, sf_dir):
    return endpoints.valid_endpoints(_unique(spark, sf_dir), b.probes(spark, sf_dir))


@query
def endpoint_valid(spark, sf_dir):
    return _valid(spark, sf_dir)


@query
def target_success_rate(spark, sf_dir):
    results = endpoints.probe_results(_unique(spark, sf_dir), b.probes(spark, sf_dir))
    return endpoints.success_rates(results)


def _registry_text(registry):
    stamps = ["created_at", "updated_at", "retired_at"]
    return registry.withColumns({c: F.col(c).cast("string") for c in stamps})


@query
def endpoint_upsert(spark, sf_dir):
    table = SnapshotTable(spark, scratch_path(spark, "registry"))
    valid = written(_valid(spark, sf_dir), "valid")
    table.replace(endpoints.upsert(b.registry(spark, sf_dir), valid, NOW))
    return _registry_text(table.read())


@query
def endpoint_retire(spark, sf_dir):
    return _registry_text(endpoints.retire(b.registry(spark, sf_dir), NOW))


@query
def endpoint_refresh(spark, sf_dir):
    pages = landed.fetched_ok(b.listing(spark, sf_dir))
    refreshed = endpoints.refresh(
        b.registry(spark, sf_dir), pages, b.probes(spark, sf_dir), NOW, BUDGET
    )
    return _registry_text(refreshed)


@query
def endpoint_changes(spark, sf_dir):
    registry = b.registry(spark, sf_dir)
    pages = landed.fetched_ok(b.listing(spark, sf_dir))
    refreshed = written(endpoints.refresh(registry, pages, b.probes(spark, sf_dir), NOW, BUDGET), "refreshed")
    return endpoints.changes(registry, refreshed, NOW)


@query
def endpoint_status_counts(spark, sf_dir):
    return health.status_counts(b.registry(spark, sf_dir))


@query
def recent_outcomes(spark, sf_dir):
    latest = health.recent_outcomes(
        b.fetch_log(spark, sf_dir), ["akshare", "yfinance"], tie_break="event_id"
    )
    return latest.select(
        "source", "endpoint_id", "status", "classification", F.col("timestamp").cast("string").alias("at")
    )


@query
def circuit_states(spark, sf_dir):
    return health.circuit_states(b.circuits(spark, sf_dir), "akshare")


@query
def source_health(spark, sf_dir):
    return health.source_health(health.health_lines(b.fetch_log(spark, sf_dir)))


@query
def source_health_lines(spark, sf_dir):
    lines = health.health_lines(b.fetch_log(spark, sf_dir))
    return lines.select("event_id", "source", "command", "outcome", "elapsed_ms", "detail")


@query
def frame_profile(spark, sf_dir):
    return health.frame_profile(b.statements(spark, sf_dir), ["source", "function_name"])


@query
def task_outcomes(spark, sf_dir):
    key = ["entity_id", "source", "function_name"]
    parsed = statements.parse_wide(b.statements(spark, sf_dir), ["entity_id"])
    tasks = statement_plans.statement_tasks(_stocks(spark, sf_dir))
    return health.task_outcomes(tasks, parsed, key)


# Streams

@query
def stream_tasks(spark, sf_dir):
    base = scratch_path(spark, "tasks")
    schema = "entity_id BIGINT, identifier STRING, source STRING, function_name STRING, function_command STRING"
    tasks = statement_plans.statement_tasks(_stocks(spark, sf_dir))
    stored = statement_plans.with_task_key(tasks).schema
    queue = KeyedStore(spark, f"{base}/queue", stored, ["task_key"])
    for waiting in (tasks.filter(F.col("source") == "akshare"), tasks):
        waiting.write.mode("append").json(f"{base}/incoming")
        stream = statement_plans.with_task_key(intake.task_stream(spark, f"{base}/incoming", schema))
        intake.drain_tasks(stream, queue, ["identifier"], f"{base}/checkpoint")
    return queue.read()


@query
def stream_obs_upsert(spark, sf_dir):
    base = scratch_path(spark, "stream")
    store = ObservationStore(spark, f"{base}/store")
    rows = b.observations(spark, sf_dir)
    for arriving in (rows.filter(F.col("wave") == 0), rows.filter(F.col("wave") == 1)):
        arriving.write.mode("append").parquet(f"{base}/incoming")
        stream = intake.observation_stream(spark, f"{base}/incoming", rows.schema)
        intake.upsert_stream(stream, store, ["arrival"], f"{base}/checkpoint")
    return store.read().select(*ROW)


# Scalar functions

@query
def scalar_suite(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date").cast("string")
    ident = F.expr(b.code("o_custkey"))
    days = F.create_map(day, F.col("o_totalprice"), F.lit("9999-01-01"), F.lit(0.0))
    return orders.select(
        "o_orderkey",
        F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("cut"),
        ident.startswith("6").alias("shanghai"),
        text.compact_date(day).alias("compact"),
        F.lower("o_orderpriority").alias("lowered"),
        F.aggregate(
            text.int_list(F.concat_ws(", ", "o_orderkey", "o_custkey", F.lit("7"))),
            F.lit(0).cast("bigint"), lambda a, x: a + x,
        ).alias("int_list_sum"),
        text.form_encode(F.concat(ident, F.lit(" 收/*~+&"), "o_orderpriority")).alias("form"),
        text.path_quote(F.concat(ident, F.lit(" 收/*~+&"), "o_orderpriority")).alias("path"),
        F.to_json(F.struct(F.col("o_custkey").alias("id"), F.lit("收盘").alias("name"))).alias("json"),
        F.add_months(F.trunc("o_orderdate", "MM"), 1).cast("string").alias("next_month"),
        F.date_add(day.cast("date"), 1).cast("string").alias("next_day"),
        F.make_date(F.year("o_orderdate"), F.lit(12), F.lit(31)).cast("string").alias("year_end"),
        dates.days_inclusive(day, F.lit("2001-12-31")).alias("days"),
        (F.col("o_orderdate") - F.expr("INTERVAL 30 MINUTES")).cast("string").alias("half_hour_before"),
        text.percentage(F.col("o_custkey"), F.col("o_orderkey") + 1).alias("percent"),
        text.money(F.col("o_totalprice")).alias("money"),
        text.truthy(F.when(F.col("o_orderstatus") == "F", F.lit("")).otherwise(F.col("o_orderstatus")), "none").alias("filled"),
        F.regexp_extract_all("o_orderpriority", F.lit("([A-Z]{2})"), 1)[0].alias("letters"),
        ident.rlike(schemas.STOCK_CODE_PATTERN).alias("is_code"),
        text.composite_key(F.col("o_orderkey"), F.lit("akshare"), F.col("o_orderstatus")).alias("key"),
        F.size(F.map_filter(days, lambda k, v: k < F.lit("9999"))).alias("days_kept"),
    )
