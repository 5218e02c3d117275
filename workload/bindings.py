"""Inputs of the operators, derived from the whole test tables.

The expressions below are plain SQL that Spark and DuckDB read the same way, so that a query and
its check start from one definition of the input.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from obsmill.sinks.paths import scratch_path
from obsmill.sources.landed import read_open_frames, read_plan_lines


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def code(key: str) -> str:
    """Identifier of an entity: six digits, a prefixed form, or digits and a newline."""
    digits = f"lpad(cast({key} as string), 6, '0')"
    return (
        f"CASE WHEN {key} % 7 = 0 THEN 'HK' || {digits}"
        f" WHEN {key} % 11 = 5 THEN {digits} || chr(10) ELSE {digits} END"
    )


def ip(key: str) -> str:
    parts = [f"cast(floor({key} / {n}) as bigint) % 250" for n in (62500, 250)]
    return " || '.' || ".join(["'10'", *[f"cast({p} as string)" for p in parts],
                               f"cast({key} % 250 as string)"])


def port(key: str) -> str:
    return f"cast(60000 + (7 * ({key})) % 9000 as int)"


ENTITY_TYPE = (
    "CASE c_mktsegment WHEN 'BUILDING' THEN 'stock' WHEN 'AUTOMOBILE' THEN 'fund'"
    " ELSE 'company' END"
)
# Every entity is known to the first source, those with a positive balance to the second too.
IDENTIFIERS = [
    ("customer", source, [f"'{name}' AS source", f"{ENTITY_TYPE} AS entity_type",
                          "c_custkey AS entity_id", f"{code('c_custkey')} AS identifier"])
    for name, source in (("akshare", "true"), ("yfinance", "c_acctbal > 0"))
]

DAY = "substring(cast(ts as string), 1, 10)"
CONCEPT = (
    "cast(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3"
    " WHEN 'signup' THEN 4 ELSE 5 END as int)"
)

OBSERVATIONS = [
    f"{CONCEPT} AS concept_id",
    "CASE WHEN event_id % 97 = 0 THEN NULL WHEN user_id % 2 = 0 THEN 'stock' ELSE 'fund' END"
    " AS entity_type",
    "user_id AS entity_id",
    f"CASE WHEN event_id % 10 = 7 THEN substring({DAY}, 1, 8) || '01' ELSE {DAY} END AS \"date\"",
    "CASE event_id % 10 WHEN 7 THEN 'month' WHEN 3 THEN '' WHEN 5 THEN NULL ELSE 'day' END"
    " AS granularity",
    "value",
    "CASE user_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'USD' END AS unit",
    "CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'akshare' ELSE 'yfinance' END AS source_used",
    "event_id AS arrival",
    "CASE WHEN ts >= timestamp_ntz '2024-01-16 00:00:00' THEN 0 ELSE 1 END AS wave",
]

ATTEMPTS = [
    "user_id AS entity_id",
    "event_type AS command",
    f'{DAY} AS "date"',
    "cast(event_id % 3 as int) AS rank",
    "event_id AS arrival",
    "CASE event_id % 3 WHEN 0 THEN 'akshare' WHEN 1 THEN 'yfinance' ELSE 'wbgapi' END AS source",
    "CASE WHEN event_id % 5 = 0 OR event_id % 11 = 0 THEN NULL ELSE cast(value as string) END"
    " AS value",
    "CASE WHEN event_id % 11 = 0 THEN 'timeout of call ' || cast(event_id as string) END AS error",
]

PRICE_SOURCE = "CASE WHEN o_orderkey % 3 = 0 THEN 'yfinance' ELSE 'akshare' END"
PRICE = "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END"

IS_SERIES = "event_id % 4 = 0"
# Series entries of every type: key, JSON, the text that is stored.
TYPED = [
    ("2024-01-21 00:00:01", "true", "True"), ("2024-01-21 00:00:02", '"true"', "true"),
    ("2024-01-21 00:00:03", '"1.5E3"', "1.5E3"), ("2024-01-21 00:00:04", "1.5E3", "1500.0"),
    ("2024-01-21 00:00:05", "12345678901234567890", "12345678901234567890"),
    ("2024-01-21 00:00:06", "Infinity", "inf"), ("2024-01-21 00:00:07", "1e22", "1e+22"),
]
RESPONSES = [
    "event_id",
    "CASE WHEN user_id % 4 = 0 THEN 'akshare' ELSE 'yfinance' END AS source",
    f"{CONCEPT} AS concept_id",
    "'fund' AS entity_type",
    "user_id AS entity_id",
    f'CASE WHEN {IS_SERIES} THEN NULL ELSE {DAY} END AS "date"',
    "CASE WHEN user_id % 2 = 0 THEN 'CNY' ELSE '' END AS unit",
    "CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'month' ELSE 'day' END AS granularity",
    "'2024-01-05' AS \"start\"",
    "CASE WHEN event_id % 8 = 0 THEN '2024-01-20' END AS \"end\"",
    "cast(CASE event_id % 9 WHEN 1 THEN 204 WHEN 2 THEN 503 ELSE 200 END as int) AS status",
    # A repeated key, a large number, a null, time-stamped keys, and values of every type.
    "CASE WHEN event_id % 13 = 0 THEN ''"
    f" WHEN {IS_SERIES} THEN '{{\"' || {DAY} || '\": 1.50, \"2021-06-30\": 3.25, \"' || {DAY} ||"
    " '\": ' || cast(value as string) || ', \"2024-01-20 00:00:00\": 20000000.0,"
    f" \"2024-01-19\": null, {', '.join(f'{chr(34)}{day}{chr(34)}: {raw}' for day, raw, _ in TYPED)}}}'"
    " ELSE cast(value as string) END AS body",
]

REPORT_DATE = (
    "CASE WHEN l_orderkey % 19 = 0 THEN NULL WHEN l_orderkey % 23 = 0 THEN ''"
    " ELSE cast(l_shipdate as string) END"
)
STATEMENTS = [
    "l_suppkey AS entity_id",
    "'akshare' AS source",
    "CASE l_linenumber % 4 WHEN 0 THEN 'annual_bs' WHEN 1 THEN 'annual_is'"
    " WHEN 2 THEN 'quarterly_cf' ELSE 'no_such_function' END AS function_name",
    f'{REPORT_DATE} AS "REPORT_DATE"',
    "CASE WHEN l_orderkey % 3 = 0 THEN NULL WHEN l_orderkey % 3 = 1 THEN ''"
    " ELSE 'S' || cast(l_suppkey as string) END AS \"SECUCODE\"",
    "'C' || cast(l_partkey as string) AS \"SECURITY_CODE\"",
    'CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_extendedprice END AS "TOTAL_ASSETS"',
    'l_quantity AS "TOTAL_LIABILITIES"',
    "CASE WHEN l_orderkey % 17 = 0 THEN 'nan' WHEN l_orderkey % 17 = 1 THEN 'NAN'"
    ' ELSE cast(l_extendedprice as string) END AS "TOTAL_EQUITY"',
    "CASE WHEN l_orderkey % 29 = 0 THEN cast('nan' as double) ELSE l_tax END"
    ' AS "OPERATE_INCOME"',
    'l_discount AS "NETPROFIT"',
    'l_extendedprice AS "NETCASH_OPERATE"',
]
STATEMENT_FIELDS = [
    "TOTAL_ASSETS", "TOTAL_LIABILITIES", "TOTAL_EQUITY",
    "OPERATE_INCOME", "NETPROFIT", "NETCASH_OPERATE",
]

STATEMENT_ROW = (
    "CASE event_type WHEN 'click' THEN 'Total Assets' WHEN 'view' THEN 'Net Income'"
    " WHEN 'purchase' THEN 'Total Revenue' WHEN 'signup' THEN 'Stockholders Equity'"
    " ELSE 'Other' END"
)

# A quarter of the customers repeats the endpoint of an earlier one, on another page.
LISTED = "CASE WHEN c_custkey % 4 = 3 AND c_custkey > 61 THEN c_custkey - 61 ELSE c_custkey END"
LISTING_ROW = (
    f"'<tr><td>' || {ip('listed')} || '</td>' || CASE WHEN c_custkey % 9 = 0 THEN ''"
    f" ELSE '<td>' || cast({port('listed')} as string) || '</td>' END || '</tr>'"
)
PAGE_NO = "cast(floor(c_custkey / 50) as bigint)"
# Sources come in the order of their pages, which isn't that of their names.
PAGE_SOURCE = "'site-' || reverse(lpad(cast(page_no as string), 9, '0'))"
PAGE_RANK = "cast(page_no as int)"
PAGE_STATUS = "cast(CASE WHEN page_no % 10 = 9 THEN 500 ELSE 200 END as int)"

REGISTRY = [
    "o_orderkey AS id",
    "'http' AS scheme",
    f"{ip('o_orderkey')} AS ip",
    f"cast({port('o_orderkey')} + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END as int) AS port",
    "CASE WHEN o_orderkey % 6 = 0 THEN 'user' END AS auth",
    "CASE o_orderstatus WHEN 'F' THEN 'active' WHEN 'O' THEN 'retired' ELSE 'pending' END"
    " AS status",
    "CASE WHEN o_orderkey % 6 = 0 THEN 'paid' ELSE 'free-proxy' END AS label",
    "o_orderdate AS created_at",
    "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END AS updated_at",
    "CASE WHEN o_orderstatus = 'O' THEN o_orderdate END AS retired_at",
]
PROBE_STATUS = (
    "cast(CASE (o_orderkey + {n}) % 5 WHEN 0 THEN 200 WHEN 1 THEN 503 WHEN 2 THEN 600"
    " ELSE NULL END as int)"
)

SOURCE = (
    "CASE {key} % 4 WHEN 0 THEN 'akshare' WHEN 1 THEN 'yfinance' WHEN 2 THEN 'wbgapi'"
    " ELSE 'cn-report' END"
)
FETCH_LOG = [
    "event_id",
    f"{SOURCE.format(key='user_id')} AS source",
    "event_type AS command",
    "user_id AS endpoint_id",
    "CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'OK' END AS status",
    "CASE WHEN event_type = 'error' THEN 'banned' ELSE 'success' END AS classification",
    "ts AS \"timestamp\"",
    "cast(floor(value * 10) as int) AS elapsed_ms",
    "CASE WHEN event_type = 'error' THEN 'ConnectionError: the provider did not answer call '"
    " || cast(event_id as string) || ' ' || props END AS error",
]
CIRCUITS = [
    f"'circuit:' || {SOURCE.format(key='o_orderkey')} || ':' || cast(o_orderkey as string) AS key",
    "CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'OPEN' ELSE 'HALF_OPEN' END AS state",
]

# Plans: one document per order, two concepts each, three ranked sources in all.
PLANS = [
    "o_orderkey AS plan_id",
    "CASE o_orderkey % 4 WHEN 0 THEN 'series' WHEN 1 THEN NULL ELSE 'per_date' END AS mode",
    "substring(cast(o_orderdate as string), 1, 10) AS first_day",
    "cast(cast(o_orderdate as date) + cast(o_orderkey % 17 - 4 as int) as string) AS last_day",
    "cast(230 + o_orderkey % 10 as int) AS concept_a",
    "cast(330 + o_custkey % 10 as int) AS concept_b",
    "CASE o_orderkey % 5 WHEN 0 THEN 'daily' WHEN 1 THEN 'weekly' WHEN 2 THEN 'monthly'"
    " WHEN 3 THEN 'yearly' END AS frequency_a",
    "CASE o_custkey % 5 WHEN 0 THEN 'daily' WHEN 1 THEN 'weekly' WHEN 2 THEN 'monthly'"
    " WHEN 3 THEN 'yearly' END AS frequency_b",
    "CASE WHEN o_orderkey % 23 = 0 THEN 'quarter' WHEN o_orderkey % 3 = 0 THEN '' END"
    " AS granularity_a",
    "CASE WHEN o_custkey % 2 = 0 THEN '' END AS unit_b",
    "CASE o_custkey % 3 WHEN 0 THEN 'stock' WHEN 1 THEN 'fund' ELSE 'company' END AS scope_type",
    # Two plans reach every entity of their type: one list is null, one is empty.
    "CASE WHEN o_orderkey = 1 THEN 'null' WHEN o_orderkey = 2 THEN 'empty' ELSE 'ids' END"
    " AS scope_kind",
    "o_custkey AS scope_id",
    "o_orderstatus",
]
# source, command, column, concept, rank
RANKED = [
    ("akshare", "stock_zh_a_hist", "收盘", "a", 0),
    ("yfinance", "history/1d now", "Close*~+", "a", 1),
    ("yfinance", "ticker_info", "Market Cap", "b", 0),
]


def bind(spark: SparkSession, sf_dir: str, name: str, exprs: list[str]) -> DataFrame:
    """A table under `exprs`."""
    rows = table(spark, sf_dir, name)
    columns = [e.replace('"', "`") if e.endswith('"') else e for e in exprs]
    return rows.selectExpr(*columns)


def identifiers(spark, sf_dir) -> DataFrame:
    parts = [
        table(spark, sf_dir, name).filter(condition).selectExpr(*exprs)
        for name, condition, exprs in IDENTIFIERS
    ]
    return reduce(DataFrame.unionByName, parts)


def observations(spark, sf_dir) -> DataFrame:
    return bind(spark, sf_dir, "events", OBSERVATIONS)


def attempts(spark, sf_dir) -> DataFrame:
    return bind(spark, sf_dir, "events", ATTEMPTS)


def responses(spark, sf_dir) -> DataFrame:
    return bind(spark, sf_dir, "events", RESPONSES)


def event_frame(spark, sf_dir) -> DataFrame:
    """A provider frame with a date column in the provider's language."""
    return bind(spark, sf_dir, "events", [
        "event_id", "user_id", "event_type", "cast(ts as date) AS `日期`", "value",
    ])


def price_frame(spark, sf_dir, timed: bool = False) -> DataFrame:
    """Landed frames of two sources, each with a value column of its own, by day or by time stamp."""
    day = "o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 as int), 30)" if timed else "cast(o_orderdate as date)"
    return bind(spark, sf_dir, "orders", [
        "o_orderkey", f"{PRICE_SOURCE} AS source", f"{code('o_custkey')} AS identifier",
        f"{day} AS `日期`",
        f"CASE WHEN {PRICE_SOURCE} = 'akshare' THEN {PRICE} END AS `收盘`",
        f"CASE WHEN {PRICE_SOURCE} = 'yfinance' THEN {PRICE} END AS `Close*~+`",
    ])


def open_price_frames(spark, sf_dir) -> DataFrame:
    """The same prices as JSON frames of two sources with unlike columns, in a folder each."""
    path = scratch_path(spark, "frames")
    rows = price_frame(spark, sf_dir)
    own = {"akshare": ["日期", "收盘"], "yfinance": ["Date", "Close*~+", "Volume"]}
    for source, columns in own.items():
        frame = rows.filter(F.col("source") == source).withColumnRenamed("日期", columns[0])
        frame = frame.withColumn("Volume", F.col("o_orderkey") % 2 == 0)
        frame.select(columns[0], "o_orderkey", "identifier", *columns[1:]).write.json(f"{path}/source={source}")
    return read_open_frames(spark, path)


def statements(spark, sf_dir) -> DataFrame:
    return bind(spark, sf_dir, "lineitem", STATEMENTS)


def transposed_statements(spark, sf_dir) -> DataFrame:
    """Fields as rows, one column per day of the table, several functions per entity."""
    cells = table(spark, sf_dir, "events").selectExpr(
        "user_id AS entity_id", f"{STATEMENT_ROW} AS field", f"{DAY} || ' 00:00:00' AS day", "value"
    )
    wide = cells.groupBy("entity_id", "field").pivot("day").agg(F.max("value"))
    function = (
        F.when(F.col("field").isin("Total Assets", "Stockholders Equity"), F.lit("annual_bs"))
        .otherwise(F.lit("quarterly_is"))
    )
    return wide.withColumn("function_name", function)


def listing(spark, sf_dir) -> DataFrame:
    """Listing pages of at most 50 customers each."""
    rows = (
        table(spark, sf_dir, "customer")
        .selectExpr("c_custkey", f"{PAGE_NO} AS page_no", f"{LISTED} AS listed")
        .selectExpr("c_custkey", "page_no", f"{LISTING_ROW} AS cell")
    )
    cells = F.array_sort(F.collect_list(F.struct("c_custkey", "cell")))
    html = F.array_join(cells["cell"], "")
    return rows.groupBy("page_no").agg(html.alias("html")).selectExpr(
        f"{PAGE_SOURCE} AS source", f"{PAGE_RANK} AS source_rank", f"{PAGE_STATUS} AS status", "html"
    )


def registry(spark, sf_dir) -> DataFrame:
    return bind(spark, sf_dir, "orders", REGISTRY)


def probes(spark, sf_dir) -> DataFrame:
    outcomes = F.array(*[
        F.struct(F.lit(target).alias("target"), F.expr(PROBE_STATUS.format(n=n)).alias("status"))
        for n, target in enumerate(("eastmoney", "tencent", "yahoo_finance"))
    ])
    return table(spark, sf_dir, "orders").select(
        F.expr(ip("o_orderkey")).alias("ip"),
        F.expr(port("o_orderkey")).alias("port"),
        F.explode(outcomes).alias("outcome"),
    ).select("ip", "port", "outcome.*")


def fetch_log(spark, sf_dir) -> DataFrame:
    return bind(spark, sf_dir, "events", FETCH_LOG)


def circuits(spark, sf_dir) -> DataFrame:
    return bind(spark, sf_dir, "orders", CIRCUITS)


def _ranked(concept: str) -> Column:
    return F.array(*[
        F.struct(
            F.lit(source).alias("source"), F.lit(0.9).alias("score"),
            F.lit(command).alias("function_command"), F.lit(column).alias("column_name"),
        )
        for source, command, column, of, _ in RANKED
        if of == concept
    ])


def plans(spark, sf_dir) -> DataFrame:
    """Plans with their nested parts as columns."""
    concepts = F.array(
        F.struct(
            F.col("concept_a").alias("concept_id"), F.lit("close").alias("code"),
            F.lit("stock").alias("entity_type"), F.lit("CNY").alias("unit"),
            F.col("frequency_a").alias("frequency"), F.col("granularity_a").alias("granularity"),
            _ranked("a").alias("ranked_sources"),
        ),
        F.struct(
            F.col("concept_b").alias("concept_id"), F.lit("cap").alias("code"),
            F.lit("company").alias("entity_type"), F.col("unit_b").alias("unit"),
            F.col("frequency_b").alias("frequency"),
            F.lit(None).cast("string").alias("granularity"), _ranked("b").alias("ranked_sources"),
        ),
    )
    ids = F.array(F.col("scope_id"), F.col("scope_id") + 1, F.col("scope_id"))
    scope = F.struct(
        F.col("scope_type").alias("entity_type"),
        F.when(F.col("scope_kind") == "ids", ids)
        .when(F.col("scope_kind") == "empty", F.array().cast("array<bigint>"))
        .alias("entity_ids"),
        F.lit("ignored").alias("filter"),
    )
    period = F.struct(F.col("first_day").alias("start"), F.col("last_day").alias("end"))
    return bind(spark, sf_dir, "orders", PLANS).select(
        "plan_id", "o_orderstatus", "mode", concepts.alias("wanted_concepts"),
        scope.alias("entity_scope"), period.alias("date_range"),
    )


def landed_plans(spark, sf_dir) -> DataFrame:
    """The same plans, landed as JSON lines and read back."""
    path = scratch_path(spark, "plans")
    plans(spark, sf_dir).drop("o_orderstatus").write.json(path)
    return read_plan_lines(spark, path)


# The same inputs for DuckDB, as common table expressions.
def _select(name: str, exprs: list[str], where: str = "true") -> str:
    return f"SELECT {', '.join(exprs)} FROM {name} WHERE {where}".replace("timestamp_ntz", "timestamp")


def _flat_plans() -> str:
    parts = []
    for source, command, column, concept, rank in RANKED:
        parts.append(
            f"SELECT plan_id, coalesce(mode = 'series', false) AS is_series,"
            f" concept_{concept} AS concept_id,"
            f" '{'close' if concept == 'a' else 'cap'}' AS code,"
            f" '{'stock' if concept == 'a' else 'company'}' AS entity_type,"
            f" {chr(39) + 'CNY' + chr(39) if concept == 'a' else chr(39) * 2} AS unit,"
            f" frequency_{concept} AS frequency,"
            + (" coalesce(nullif(granularity_a, '')," if concept == "a" else " coalesce(NULL,")
            + f" CASE frequency_{concept} WHEN 'yearly' THEN 'year' WHEN 'monthly' THEN 'month'"
            f" ELSE 'day' END) AS granularity, {rank} AS rank, '{source}' AS source,"
            f" '{command}' AS command, '{column}' AS \"column\","
            f" first_day AS \"start\", last_day AS \"end\" FROM plan_docs"
        )
    return " UNION ALL ".join(parts)


SPINE = """
    CASE frequency
      WHEN 'yearly' THEN list_transform(
        range(year(least("start"::date, "end"::date)), year(greatest("start"::date, "end"::date)) + 1),
        lambda y: y || '-12-31')
      WHEN 'monthly' THEN list_transform(
        generate_series(date_trunc('month', least("start"::date, "end"::date))::timestamp,
                        greatest("start"::date, "end"::date)::timestamp, INTERVAL 1 MONTH),
        lambda d: strftime(d, '%Y-%m-%d'))
      ELSE list_transform(
        generate_series(least("start"::date, "end"::date)::timestamp,
                        greatest("start"::date, "end"::date)::timestamp, INTERVAL 1 DAY),
        lambda d: strftime(d, '%Y-%m-%d'))
    END"""

CTES = {
    "ids": " UNION ALL ".join(_select(name, exprs, where) for name, where, exprs in IDENTIFIERS),
    "obs_raw": _select("events", OBSERVATIONS),
    "obs_filled": "SELECT concept_id, entity_type, entity_id, \"date\","
    " coalesce(nullif(granularity, ''), 'day') AS granularity, cast(value as string) AS value,"
    " coalesce(unit, '') AS unit, coalesce(source_used, '') AS source_used, arrival, wave"
    " FROM obs_raw WHERE entity_type IS NOT NULL",
    "obs_first": "SELECT * FROM obs_filled QUALIFY row_number() OVER (PARTITION BY concept_id,"
    " entity_type, entity_id, \"date\", granularity ORDER BY arrival) = 1",
    "obs_waves": "SELECT * FROM obs_filled QUALIFY row_number() OVER (PARTITION BY concept_id,"
    " entity_type, entity_id, \"date\", granularity ORDER BY wave, arrival) = 1",
    # One column a source; the first order of a day counts, also where it has no price.
    "points": "SELECT source, identifier, \"date\", CASE source WHEN 'akshare' THEN '收盘' ELSE 'Close*~+'"
    " END AS \"column\", cast(price as string) AS value FROM (SELECT " + PRICE_SOURCE + " AS source,"
    f" {code('o_custkey')} AS identifier, strftime(o_orderdate, '%Y-%m-%d') AS \"date\","
    f" list({PRICE} ORDER BY o_orderkey)[1] AS price FROM orders GROUP BY 1, 2, 3)"
    " WHERE price IS NOT NULL",
    "attempts": _select("events", ATTEMPTS),
    "responses": _select("events", RESPONSES + ["value AS raw_value", f"{DAY} AS raw_day"]),
    "served": "SELECT * FROM responses WHERE status = 200 AND body <> ''",
    # Decoded series: the repeated key keeps its last value; a null value stays.
    "decoded": "SELECT event_id, concept_id, entity_type, entity_id, unit, granularity, source,"
    " \"start\", \"end\", d.day AS day, d.value AS value FROM served, LATERAL (VALUES"
    " (raw_day, CASE WHEN raw_day = '2024-01-19' THEN NULL ELSE cast(raw_value as string) END),"
    " ('2021-06-30', '3.25'), ('2024-01-20 00:00:00', '20000000.0'),"
    + "".join(f" ('{day}', '{stored}')," for day, _, stored in TYPED) +
    " (CASE WHEN raw_day = '2024-01-19' THEN NULL ELSE '2024-01-19' END, NULL)) AS d(day, value)"
    " WHERE \"date\" IS NULL AND d.day IS NOT NULL",
    "exploded": "SELECT * FROM decoded WHERE value IS NOT NULL AND day BETWEEN \"start\""
    " AND coalesce(\"end\", '9999-12-31')",
    "statements": _select("lineitem", STATEMENTS),
    "melted": "SELECT entity_id, source, function_name, substring(\"REPORT_DATE\", 1, 10) AS"
    " \"date\", field, concept_id, value FROM (SELECT *, unnest(["
    + ", ".join(
        f"{{'field': '{f}', 'kind': '{k}', 'concept_id': {c},"
        f" 'value': cast(\"{f}\" as string)}}"
        for f, k, c in [
            ("TOTAL_ASSETS", "bs", 242), ("TOTAL_LIABILITIES", "bs", 243),
            ("TOTAL_EQUITY", "bs", 244), ("OPERATE_INCOME", "is", 239),
            ("NETPROFIT", "is", 240), ("NETCASH_OPERATE", "cf", 241),
        ]
    )
    + "], recursive := true) FROM statements)"
    " WHERE value IS NOT NULL AND value <> 'nan' AND \"REPORT_DATE\" <> ''",
    "mapped": "SELECT * FROM melted WHERE (function_name, field) IN (('annual_bs', 'TOTAL_ASSETS'),"
    " ('annual_bs', 'TOTAL_LIABILITIES'), ('annual_bs', 'TOTAL_EQUITY'),"
    " ('annual_is', 'OPERATE_INCOME'), ('annual_is', 'NETPROFIT'),"
    " ('quarterly_cf', 'NETCASH_OPERATE'))",
    "listing_rows": f"SELECT c_custkey, {PAGE_NO} AS page_no, {LISTED} AS listed FROM customer",
    "listing": f"SELECT {PAGE_SOURCE} AS source, {PAGE_RANK} AS source_rank, {PAGE_STATUS} AS status, html FROM ("
    f"SELECT page_no, string_agg({LISTING_ROW}, '' ORDER BY c_custkey) AS html"
    " FROM listing_rows GROUP BY page_no)",
    "pairs": "SELECT source, source_rank, cast(pos - 1 as int) AS pos, 'http' AS scheme, ips[pos] AS ip,"
    " cast(ports[pos] as int) AS port FROM (SELECT *, unnest(range(1, least(len(ips), len(ports))"
    " + 1)) AS pos FROM (SELECT source, source_rank,"
    r" regexp_extract_all(html, '(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})', 1) AS ips,"
    r" regexp_extract_all(html, '<td>(\d{2,5})</td>', 1) AS ports"
    " FROM listing WHERE status = 200)) WHERE cast(ports[pos] as int) BETWEEN 1 AND 65535",
    "unique_pairs": "SELECT * FROM pairs QUALIFY"
    " row_number() OVER (PARTITION BY ip, port ORDER BY source_rank, pos) = 1",
    "registry": _select("orders", REGISTRY),
    "probes": " UNION ALL ".join(
        f"SELECT {ip('o_orderkey')} AS ip, {port('o_orderkey')} AS port, '{target}' AS target,"
        f" {PROBE_STATUS.format(n=n)} AS status FROM orders"
        for n, target in enumerate(("eastmoney", "tencent", "yahoo_finance"))
    ),
    "fetch_log": _select("events", FETCH_LOG),
    "circuits": _select("orders", CIRCUITS),
    "plan_docs": _select("orders", PLANS),
    "plan_flat": _flat_plans(),
    "scoped": "SELECT plan_id, source, i.entity_id, identifier FROM plan_docs p JOIN ids i"
    " ON i.entity_type = p.scope_type WHERE scope_kind <> 'ids' UNION ALL"
    " SELECT plan_id, source, i.entity_id, identifier FROM plan_docs p JOIN ids i"
    " ON i.entity_type = p.scope_type AND (i.entity_id = p.scope_id OR i.entity_id = p.scope_id + 1)"
    " WHERE scope_kind = 'ids'",
    "tasks": "SELECT f.plan_id, f.rank, f.source, f.command, s.identifier,"
    f" unnest(CASE WHEN is_series THEN [NULL] ELSE {SPINE} END) AS \"date\", f.\"column\","
    " f.concept_id, f.entity_type, s.entity_id, f.unit, f.granularity,"
    " CASE WHEN is_series THEN f.\"start\" END AS \"start\","
    " CASE WHEN is_series THEN f.\"end\" END AS \"end\""
    " FROM plan_flat f JOIN scoped s ON f.plan_id = s.plan_id AND f.source = s.source",
}

ORDER = list(CTES)


def with_ctes(body: str) -> str:
    """`body` under the expressions that it, or one of them, names."""
    import re

    needed, frontier = set(), [body]
    while frontier:
        text = frontier.pop()
        for name in ORDER:
            if name not in needed and re.search(rf"\b{name}\b(?!')", text):
                needed.add(name)
                frontier.append(CTES[name])
    ctes = ", ".join(f"{name} AS ({CTES[name]})" for name in ORDER if name in needed)
    return f"WITH {ctes} {body}" if ctes else body
