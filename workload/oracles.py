"""SQL that gives each query's result in DuckDB, over the same whole tables."""

from workload.bindings import REPORT_DATE, SPINE, code, with_ctes

KEY = 'concept_id, entity_type, entity_id, "date", granularity'
TASK = (
    'plan_id, rank, source, command, identifier, "date", "column", concept_id, entity_type,'
    ' entity_id, unit, granularity, "start", "end"'
)
STAMPED = (
    "id, scheme, ip, port, auth, status, label, cast(created_at as string) AS created_at,"
    " cast(updated_at as string) AS updated_at, cast(retired_at as string) AS retired_at"
)
NOW = "timestamp '1998-01-01 00:30:00'"
CUTOFF = "timestamp '1998-01-01 00:00:00'"
BUDGET = 200


def form(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


def path(x: str) -> str:
    return f"replace(url_encode({x}), '%2F', '/')"


TASK_FIELDS = [
    "source", "command", "identifier", "date", "column", "concept_id", "entity_type",
    "entity_id", "unit", "granularity", "start", "end",
]
REQUEST_KEY = (
    f"'fetch://' || source || '/' || {path('command')} || '?' || concat_ws('&', "
    + ", ".join(
        f"CASE WHEN \"{f}\" IS NOT NULL THEN '{f}=' || {form(f'cast({chr(34)}{f}{chr(34)} as string)')} END"
        for f in TASK_FIELDS
    )
    + ")"
)
SAME_FRAME = 'f.source = t.source AND f.identifier = t.identifier AND f."column" = t."column"'
PAIR = "source, source_rank, pos, scheme, ip, port"
VALID = (
    f"SELECT {PAIR} FROM unique_pairs u WHERE EXISTS (SELECT 1 FROM probes p"
    " WHERE p.ip = u.ip AND p.port = u.port AND p.status < 600)"
)
BUDGETED = (
    "SELECT * FROM pairs WHERE source_rank IN (SELECT source_rank FROM (SELECT source_rank,"
    " coalesce(sum(n) OVER (ORDER BY source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    " AS before FROM (SELECT source_rank, count(*) AS n FROM pairs GROUP BY source_rank))"
    f" WHERE before < {BUDGET})"
)
TOP = (
    f"SELECT * FROM ({BUDGETED}) QUALIFY row_number() OVER (PARTITION BY ip, port"
    f" ORDER BY source_rank, pos) = 1 ORDER BY source_rank, pos LIMIT {BUDGET}"
)
TOP_VALID = (
    f"SELECT * FROM ({TOP}) u WHERE EXISTS (SELECT 1 FROM probes p"
    " WHERE p.ip = u.ip AND p.port = u.port AND p.status < 600)"
)


def upserted(fresh: str) -> str:
    return (
        "SELECT r.id, coalesce(r.scheme, f.scheme) AS scheme, coalesce(r.ip, f.ip) AS ip,"
        " coalesce(r.port, f.port) AS port, r.auth,"
        " CASE WHEN f.ip IS NOT NULL THEN 'active' ELSE r.status END AS status,"
        " CASE WHEN r.ip IS NULL THEN 'free-proxy' ELSE r.label END AS label,"
        f" CASE WHEN r.ip IS NULL THEN {NOW} ELSE r.created_at END AS created_at,"
        f" CASE WHEN f.ip IS NOT NULL THEN {NOW} ELSE r.updated_at END AS updated_at,"
        " CASE WHEN f.ip IS NOT NULL THEN NULL ELSE r.retired_at END AS retired_at"
        f" FROM registry r FULL OUTER JOIN ({fresh}) f ON r.ip = f.ip AND r.port = f.port"
    )


def retired(rows: str) -> str:
    stale = f"(status = 'active' AND (updated_at IS NULL OR updated_at < {CUTOFF}))"
    return (
        f"SELECT id, scheme, ip, port, auth, CASE WHEN {stale} THEN 'retired' ELSE status END AS"
        f" status, label, created_at, updated_at, CASE WHEN {stale} THEN {NOW} ELSE retired_at END"
        f" AS retired_at FROM ({rows})"
    )


OUTCOMES = (
    "SELECT entity_id, command, \"date\","
    " CASE WHEN count(value) > 0 THEN 200 WHEN count(error) > 0 THEN 503 ELSE 204 END AS status,"
    " (arg_min(value, rank * 1000000000 + arrival) FILTER (WHERE value IS NOT NULL)) AS body,"
    " (arg_min(source, rank * 1000000000 + arrival) FILTER (WHERE value IS NOT NULL)) AS served_source,"
    " CASE WHEN count(value) = 0 THEN"
    " (arg_max(error, rank * 1000000000 + arrival) FILTER (WHERE error IS NOT NULL)) END AS last_error"
    " FROM attempts GROUP BY ALL"
)
SERIES = (
    "SELECT user_id, event_type, count(*)::INTEGER AS days,"
    " string_agg(day || '=' || value, '|' ORDER BY day) AS series FROM (SELECT user_id, event_type,"
    " substring(cast(ts as string), 1, 10) AS day, cast(arg_min(value, event_id) as string) AS value"
    " FROM events GROUP BY ALL) WHERE day BETWEEN '2024-01-05' AND '2024-01-20' GROUP BY ALL"
)
ITEM_TAIL = (
    " unit, source AS source_used, coalesce(granularity, 'day') AS granularity"
)
EXPLODED = (
    f"SELECT concept_id, entity_type, entity_id, day AS \"date\", value,{ITEM_TAIL} FROM exploded"
)
LEGACY = (
    "SELECT concept_id, 'stock' AS entity_type, entity_id, \"date\", 'day' AS granularity, value,"
    " 'currency' AS unit, source AS source_used FROM mapped"
)
STOCKS = (
    "SELECT entity_id, identifier FROM ids WHERE {source} entity_type = 'stock'"
    " AND regexp_full_match(identifier, '[0-9]{{6}}')"
)
FUNCTIONS = (
    "SELECT * FROM (VALUES"
    " ('akshare', 'annual_bs', 'balance_sheet_by_yearly_em'),"
    " ('akshare', 'annual_is', 'profit_sheet_by_yearly_em'),"
    " ('akshare', 'annual_cf', 'cash_flow_sheet_by_yearly_em'),"
    " ('akshare', 'quarterly_bs', 'balance_sheet_by_report_em'),"
    " ('akshare', 'quarterly_is', 'profit_sheet_by_report_em'),"
    " ('akshare', 'quarterly_cf', 'cash_flow_sheet_by_report_em'),"
    " ('yfinance', 'annual_bs', 'ticker_balance_sheet'),"
    " ('yfinance', 'annual_is', 'ticker_financials'),"
    " ('yfinance', 'annual_cf', 'ticker_cashflow'),"
    " ('yfinance', 'quarterly_bs', 'quarterly_balance_sheet'),"
    " ('yfinance', 'quarterly_is', 'quarterly_financials'),"
    " ('yfinance', 'quarterly_cf', 'quarterly_cashflow'))"
    " AS f(source, function_name, function_command)"
)
AKSHARE_STOCKS = STOCKS.format(source="source = 'akshare' AND")
STATEMENT_TASKS = f"SELECT * FROM ({AKSHARE_STOCKS}), ({FUNCTIONS})"

# The transposed statements stay long in SQL: a cell is the largest value of the day.
TRANSPOSED = (
    "SELECT entity_id, CASE WHEN field IN ('Total Assets', 'Stockholders Equity') THEN 'annual_bs'"
    " ELSE 'quarterly_is' END AS function_name, field, CASE field WHEN 'Total Assets' THEN 242"
    " WHEN 'Stockholders Equity' THEN 244 WHEN 'Total Revenue' THEN 239 WHEN 'Net Income' THEN 240"
    " END AS concept_id, \"date\", cast(value as string) AS value FROM (SELECT user_id AS entity_id,"
    " CASE event_type WHEN 'click' THEN 'Total Assets' WHEN 'view' THEN 'Net Income'"
    " WHEN 'purchase' THEN 'Total Revenue' WHEN 'signup' THEN 'Stockholders Equity' END AS field,"
    " substring(cast(ts as string), 1, 10) AS \"date\", max(value) AS value FROM events GROUP BY ALL)"
    " WHERE field IS NOT NULL"
)

PRICES = f"SELECT *, {code('o_custkey')} AS symbol FROM orders"

_BODIES = {
    "plan_flatten": 'SELECT plan_id, is_series, concept_id, code, entity_type, unit, frequency,'
    ' granularity, rank, source, command, "column", "start", "end" FROM plan_flat',
    "date_spine": f'SELECT plan_id, concept_id, code, frequency, unnest({SPINE}) AS "date"'
    " FROM plan_flat WHERE rank = 0",
    "granularity_tag": "SELECT frequency, granularity, count(*) AS n FROM plan_flat GROUP BY ALL",
    "entity_scope_all": "SELECT entity_id, identifier FROM ids WHERE source = 'akshare'"
    " AND entity_type = 'stock'",
    "entity_scope_ids": "SELECT plan_id, source, entity_id, identifier FROM scoped",
    "stock_code_filter": "SELECT source, entity_id, identifier FROM ids"
    " WHERE regexp_full_match(identifier, '[0-9]{6}')",
    "tasks_per_date": f'SELECT {TASK} FROM tasks WHERE "date" IS NOT NULL',
    "tasks_series": f'SELECT {TASK} FROM tasks WHERE "date" IS NULL',
    "provider_params": "SELECT source, concept_id, granularity, unit, identifier AS point_symbol,"
    ' coalesce("date", "start") AS point_date, identifier AS range_symbol,'
    " replace(\"start\", '-', '') AS history_start, replace(\"end\", '-', '') AS history_end,"
    " CASE source WHEN 'akshare' THEN identifier WHEN 'yfinance' THEN identifier ||"
    " CASE WHEN starts_with(identifier, '6') THEN '.SS' ELSE '.SZ' END END AS statement_symbol"
    f" FROM (SELECT DISTINCT {', '.join(chr(34) + f + chr(34) for f in TASK_FIELDS)} FROM tasks)",
    "request_key": f"SELECT plan_id, {REQUEST_KEY} AS request_key FROM tasks",
    "task_dedup": f"SELECT DISTINCT {REQUEST_KEY} AS request_key FROM tasks",
    "task_incremental": f"SELECT DISTINCT {REQUEST_KEY} AS request_key FROM tasks EXCEPT"
    f" SELECT {REQUEST_KEY} FROM tasks WHERE plan_id IN"
    " (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')",
    "plan_size": "SELECT t.concept_id, t.source, e.entities, t.tasks FROM"
    " (SELECT concept_id, source, count(*) AS tasks FROM tasks GROUP BY ALL) t JOIN"
    " (SELECT concept_id, source, cast(sum(n) as bigint) AS entities FROM plan_flat JOIN"
    " (SELECT plan_id, source, count(*) AS n FROM scoped GROUP BY ALL) USING (plan_id, source)"
    " GROUP BY ALL) e ON t.concept_id = e.concept_id AND t.source = e.source",
    "plan_totals": "SELECT t.concept_id, t.source, e.entities, t.tasks FROM"
    " (SELECT concept_id, source, count(*) AS tasks FROM tasks GROUP BY ROLLUP (concept_id, source)) t JOIN"
    " (SELECT concept_id, source, cast(sum(n) as bigint) AS entities FROM plan_flat JOIN"
    " (SELECT plan_id, source, count(*) AS n FROM scoped GROUP BY ALL) USING (plan_id, source)"
    " GROUP BY ROLLUP (concept_id, source)) e ON t.concept_id IS NOT DISTINCT FROM e.concept_id"
    " AND t.source IS NOT DISTINCT FROM e.source",
    "queue_size": f"SELECT count(*) AS stocks, cast(12 as bigint) AS functions, 12 * count(*) AS tasks FROM ({AKSHARE_STOCKS})",
    "statement_tasks": "SELECT entity_id, identifier, source, function_name, function_command,"
    f" '2024-01-01' AS start_date FROM ({STATEMENT_TASKS}) ORDER BY entity_id",
    "statement_task_dedup": "SELECT task_key, entity_id, identifier, source, function_name,"
    " function_command FROM (SELECT *, entity_id || ':' || source || ':' || function_name AS task_key"
    " FROM (SELECT entity_id, min(identifier) AS identifier FROM"
    f" ({STOCKS.format(source='')}) GROUP BY entity_id), ({FUNCTIONS})) WHERE task_key NOT IN"
    " (SELECT s_suppkey || ':akshare:annual_bs' FROM supplier)",
    "point_extract": 'SELECT plan_id, concept_id, t.source, t.identifier, t."date", t."column", value'
    f' FROM tasks t LEFT JOIN points f ON {SAME_FRAME} AND f."date" = t."date"'
    ' WHERE t."date" IS NOT NULL',
    "series_extract": SERIES,
    "source_failover": f"SELECT entity_id, command, \"date\", body, served_source FROM ({OUTCOMES})"
    " WHERE status = 200",
    "fetch_status": 'SELECT t.entity_id, t.command, t."date", coalesce(status, 204) AS status, last_error'
    ' FROM (SELECT DISTINCT entity_id, command, "date" FROM attempts) t LEFT JOIN ('
    + OUTCOMES.replace("FROM attempts", "FROM attempts WHERE arrival % 4 <> 3")
    + ') o ON o.entity_id = t.entity_id AND o.command = t.command AND o."date" = t."date"',
    "fetch_map": """
        SELECT entity_id, cast(n as string) AS identifier,
          cast(CASE WHEN first_served OR second_served THEN 200
               WHEN first_error IS NOT NULL OR second_error IS NOT NULL THEN 503 ELSE 204 END
               as int) AS status,
          CASE WHEN first_served AND ranged THEN
                 '{"' || strftime(d, '%Y-%m-%d') || '":' || (n * 10) || ',"'
                 || strftime(d + INTERVAL 1 DAY, '%Y-%m-%d') || '":' || (n * 10 + 1) || ',"'
                 || strftime(d + INTERVAL 2 DAY, '%Y-%m-%d') || '":' || (n * 10 + 2) || '}'
               WHEN first_served THEN cast(n * 100 + day(d) as string)
               WHEN second_served THEN cast(-n as string) ELSE '' END AS body,
          CASE WHEN first_served THEN 'akshare' WHEN second_served THEN 'yfinance' END
            AS served_source,
          CASE WHEN NOT first_served AND NOT second_served
               THEN coalesce(second_error, first_error) END AS last_error
        FROM (SELECT o_orderkey AS entity_id, o_custkey AS n, o_orderdate AS d,
                o_orderkey % 3 = 0 AS ranged, o_custkey % 5 > 2 AS first_served,
                CASE o_custkey % 5 WHEN 0 THEN 'no answer for ' || o_custkey
                  WHEN 1 THEN 'akshare unavailable' END AS first_error,
                o_custkey % 5 <= 2 AND o_orderkey % 3 <> 0 AND o_custkey % 7 <> 0 AS second_served,
                CASE WHEN o_custkey % 5 <= 2 AND o_orderkey % 3 = 0
                  THEN 'yfinance/info has no extract_series' END AS second_error
              FROM orders)""",
    "response_parse": 'SELECT concept_id, entity_type, entity_id, "date",'
    ' CASE WHEN "date" IS NOT NULL THEN body END AS value,'
    ' CASE WHEN "date" IS NULL THEN cast(CASE WHEN raw_day = \'2024-01-19\' THEN 10 ELSE 11 END'
    " as int) END AS days, CASE WHEN \"date\" IS NULL THEN \"start\" END AS \"start\","
    f' CASE WHEN "date" IS NULL THEN "end" END AS "end",{ITEM_TAIL} FROM served',
    "series_decode": "SELECT event_id, string_agg(day || '=' || coalesce(value, 'null'), '|'"
    " ORDER BY day) AS series FROM decoded GROUP BY event_id",
    "series_decode_faults": "SELECT source, count(*) AS bodies, count(*) FILTER (WHERE event_id % 5 = 0)"
    " AS malformed FROM served WHERE \"date\" IS NULL GROUP BY source",
    "series_explode_clamp": EXPLODED,
    "series_clamp_stats": "SELECT concept_id, entity_id, count(DISTINCT event_id) AS items,"
    " count(*) FILTER (WHERE day BETWEEN \"start\" AND coalesce(\"end\", '9999-12-31')) AS kept,"
    " count(*) FILTER (WHERE NOT (day BETWEEN \"start\" AND coalesce(\"end\", '9999-12-31')))"
    " AS dropped FROM decoded GROUP BY ALL",
    "obs_defaults": "SELECT arrival, coalesce(nullif(granularity, ''), 'day') AS granularity,"
    " coalesce(unit, '') AS unit, coalesce(source_used, '') AS source_used FROM obs_raw",
    "obs_value_text": "SELECT l_orderkey, l_linenumber, cast(l_extendedprice as string) AS plain,"
    " cast(l_extendedprice * 1000000.0::double as string) AS large,"
    " cast(l_extendedprice * 1e14 as string) AS huge,"
    " cast(l_discount / 64.0::double as string) AS small,"
    " cast(l_tax / 1048576.0::double as string) AS tiny FROM lineitem",
    "obs_union_shapes": f"{EXPLODED} UNION ALL SELECT concept_id, entity_type, entity_id, \"date\","
    f' body AS value,{ITEM_TAIL} FROM served WHERE "date" IS NOT NULL',
    "obs_first_writer": f"SELECT {KEY}, value, unit, source_used FROM obs_first",
    "obs_insert_if_absent": f"SELECT {KEY}, value, unit, source_used FROM obs_waves",
    "obs_insert_bucketed": f"SELECT {KEY}, value, unit, source_used FROM obs_waves",
    "obs_insert_repeated_batch": f"SELECT {KEY}, value, unit, source_used FROM obs_waves",
    "stream_obs_upsert": f"SELECT {KEY}, value, unit, source_used FROM obs_waves",
    "obs_granularity_coexist": 'SELECT concept_id, entity_type, entity_id, "date",'
    " count(*) AS cadences FROM obs_first GROUP BY ALL HAVING count(*) > 1",
    "obs_range_count": "SELECT concept_id, entity_id, count(*) AS observations FROM obs_first"
    " WHERE \"date\" BETWEEN '2024-01-05' AND '2024-01-20' GROUP BY ALL",
    "obs_cache_misses": "SELECT concept_id, entity_type, entity_id, \"date\", 'day' AS granularity"
    " FROM (SELECT DISTINCT concept_id, entity_type, entity_id FROM obs_first),"
    " (SELECT strftime(d, '%Y-%m-%d') AS \"date\" FROM (SELECT unnest(generate_series("
    "timestamp '2024-01-01', timestamp '2024-01-31', INTERVAL 1 DAY)) AS d))"
    " EXCEPT SELECT concept_id, entity_type, entity_id, \"date\", granularity FROM obs_first",
    "obs_coverage": "SELECT concept_id, entity_type, entity_id, granularity, count(*) AS days"
    " FROM obs_first GROUP BY ALL",
    "audit_json": 'SELECT concept_id, entity_id, "date", CASE WHEN "date" IS NOT NULL THEN body END'
    ' AS value, s.series, s.numbers, CASE WHEN "date" IS NULL THEN "end" END AS "end", unit,'
    " source AS source_used FROM served LEFT JOIN (SELECT event_id, string_agg(day || '=' ||"
    # In the log a JSON number has no point zero, and what is no JSON number is quoted.
    " coalesce(CASE WHEN value = 'inf' THEN 'Infinity' WHEN value = '1500.0' THEN value"
    r" ELSE regexp_replace(value, '\.0$', '') END, 'null'),"
    " '|' ORDER BY day) AS series,"
    " cast(count(*) FILTER (value NOT IN ('True', 'true', '1.5E3', 'inf')) as int) AS numbers"
    " FROM decoded GROUP BY event_id) s"
    " USING (event_id)",
    "statement_melt": 'SELECT entity_id, source, function_name, field, "date", value FROM melted',
    "concept_mapping": 'SELECT entity_id, function_name, field, concept_id, "date", value FROM mapped',
    "statement_melt_transposed": TRANSPOSED,
    "missing_value_filter": "SELECT entity_id, "
    + ", ".join(
        f"count(*) FILTER (WHERE \"{c}\" IS NOT NULL AND cast(\"{c}\" as string) <> 'nan')"
        f" AS {c.lower()}"
        for c in ["TOTAL_ASSETS", "TOTAL_LIABILITIES", "TOTAL_EQUITY", "OPERATE_INCOME",
                  "NETPROFIT", "NETCASH_OPERATE"]
    )
    + " FROM statements GROUP BY entity_id",
    "entity_code_fallback": "SELECT coalesce(nullif(\"SECUCODE\", ''), \"SECURITY_CODE\")"
    " AS entity_code, count(*) AS n FROM statements GROUP BY 1",
    "obs_legacy_constants": LEGACY,
    "statement_store": "SELECT concept_id, 'stock' AS entity_type, entity_id, \"date\", 'day' AS granularity,"
    " value, 'currency' AS unit, source AS source_used FROM (SELECT *, row_number() OVER (PARTITION BY"
    " concept_id, entity_id, \"date\" ORDER BY source, list_position(['annual_bs', 'annual_is', 'annual_cf',"
    " 'quarterly_bs', 'quarterly_is', 'quarterly_cf'], function_name), value) AS place FROM (SELECT concept_id,"
    " entity_id, source, function_name, \"date\", value FROM mapped UNION ALL SELECT concept_id, entity_id,"
    f" 'yfinance', function_name, \"date\", value FROM ({TRANSPOSED}))) WHERE place = 1",
    # Three price tables and three of statements; one symbol of the second, the first rows of the third and last.
    "legacy_migrate": "SELECT 234 AS concept_id, 'stock' AS entity_type, o_custkey AS entity_id,"
    " substring(cast(o_orderdate as string), 1, 10) AS \"date\", 'day' AS granularity,"
    " cast(o_totalprice as string) AS value, 'currency' AS unit, name AS source_used FROM ("
    f"SELECT 'astock' AS name, * FROM ({PRICES}) WHERE o_orderkey % 3 = 0 UNION ALL"
    f" SELECT 'astock-hk', * FROM ({PRICES}) WHERE o_orderkey % 3 = 1 AND symbol = 'HK000007' UNION ALL"
    f" SELECT 'astock-us', * FROM (SELECT * FROM ({PRICES}) WHERE o_orderkey % 3 = 2"
    " ORDER BY symbol, o_orderdate, o_orderkey LIMIT 500))"
    " UNION ALL SELECT concept_id, 'stock', entity_id, \"date\", 'day', value, 'currency',"
    " 'astock-balance' FROM melted WHERE concept_id IN (242, 243, 244)"
    " UNION ALL SELECT concept_id, 'stock', entity_id, \"date\", 'day', value, 'currency',"
    " 'astock-profit' FROM melted WHERE concept_id IN (239, 240)"
    " UNION ALL SELECT 241, 'stock', l_suppkey, substring(REPORT_DATE, 1, 10), 'day', cast(l_extendedprice as string), 'currency',"
    " 'astock-cashflow' FROM (SELECT *, " + REPORT_DATE + " AS REPORT_DATE FROM lineitem"
    " ORDER BY l_partkey::string, REPORT_DATE NULLS FIRST, l_orderkey * 10 + l_linenumber LIMIT 2000)"
    " WHERE REPORT_DATE <> ''",
    "page_ip_extract": "SELECT page_id, cast(pos - 1 as int) AS pos, ips[pos] AS ip, ports[pos] AS port"
    " FROM (SELECT *, unnest(range(1, greatest(len(ips), len(ports)) + 1)) AS pos FROM (SELECT page_id,"
    r" regexp_extract_all(html, '(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})', 1) AS ips,"
    r" regexp_extract_all(html, '<td>(\d{2,5})</td>', 1) AS ports"
    " FROM pages WHERE page_id % 10 <> 9))",
    "endpoint_pair": f"SELECT {PAIR} FROM pairs",
    "endpoint_source_budget": f"SELECT {PAIR} FROM ({BUDGETED})",
    "endpoint_dedup": f"SELECT {PAIR} FROM unique_pairs",
    "endpoint_topn": f"SELECT {PAIR} FROM ({TOP})",
    "endpoint_valid": VALID,
    "target_success_rate": "SELECT target, passed, tried, round(100.0::double * passed / tried, 1)"
    " AS rate FROM (SELECT target, count(*) FILTER (WHERE coalesce(status < 600, false)) AS passed,"
    " count(*) AS tried FROM (SELECT u.ip, u.port, t.target, p.status FROM unique_pairs u,"
    " (VALUES ('eastmoney'), ('tencent'), ('yahoo_finance')) AS t(target) LEFT JOIN probes p"
    " ON p.ip = u.ip AND p.port = u.port AND p.target = t.target) GROUP BY target"
    f" UNION ALL SELECT 'overall', (SELECT count(*) FROM ({VALID})),"
    " (SELECT count(*) FROM unique_pairs))",
    "endpoint_upsert": f"SELECT {STAMPED} FROM ({upserted(VALID)})",
    "endpoint_retire": f"SELECT {STAMPED} FROM ({retired('SELECT * FROM registry')})",
    "endpoint_refresh": f"SELECT {STAMPED} FROM ({retired(upserted(TOP_VALID))})",
    "endpoint_changes": f"SELECT count(*) FILTER (WHERE updated_at = {NOW}) AS touched, count(*)"
    " - (SELECT count(*) FROM registry) AS inserted, count(*) FILTER (WHERE retired_at = "
    f"{NOW}) AS retired FROM ({retired(upserted(TOP_VALID))})",
    "endpoint_status_counts": "SELECT status, count(*) AS endpoints FROM registry"
    " WHERE status IN ('active', 'retired') GROUP BY status",
    "recent_outcomes": "SELECT source, endpoint_id, status, classification,"
    " cast(\"timestamp\" as string) AS at FROM (SELECT * FROM fetch_log"
    " ORDER BY \"timestamp\" DESC, event_id DESC LIMIT 10) WHERE source IN ('akshare', 'yfinance')",
    "circuit_states": "SELECT key, split_part(key, ':', 2) AS source,"
    " split_part(key, ':', 3) AS endpoint_id, state FROM circuits"
    " WHERE starts_with(key, 'circuit:akshare:') ORDER BY key LIMIT 10",
    "source_health": "SELECT source, command, count(*) FILTER (WHERE error IS NULL) AS ok,"
    " count(error) AS failed, max(elapsed_ms) AS slowest_ms FROM fetch_log"
    " GROUP BY GROUPING SETS ((source, command), ())",
    "source_health_lines": "SELECT event_id, source, command,"
    " CASE WHEN error IS NULL THEN 'OK' ELSE 'FAIL' END AS outcome, elapsed_ms,"
    " substring(error, 1, 50) AS detail FROM fetch_log",
    "frame_profile": "SELECT source, function_name, count(*) AS row_count, 10 AS column_count,"
    " 'DataFrame(' || count(*) || 'r×10c)' AS profile FROM statements GROUP BY source, function_name",
    "task_outcomes": "SELECT t.source, count(m.entity_id) AS processed,"
    f" count(*) FILTER (WHERE m.entity_id IS NULL) AS errors FROM ({STATEMENT_TASKS}) t LEFT JOIN"
    " (SELECT DISTINCT entity_id, source, function_name FROM mapped) m ON t.entity_id = m.entity_id"
    " AND t.source = m.source AND t.function_name = m.function_name GROUP BY t.source",
    "stream_tasks": "SELECT entity_id, identifier, source, function_name, function_command,"
    f" entity_id || ':' || source || ':' || function_name AS task_key FROM ({STATEMENT_TASKS})",
    "scalar_suite": f"""
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS cut,
          starts_with(ident, '6') AS shanghai, strftime(o_orderdate, '%Y%m%d') AS compact,
          lower(o_orderpriority) AS lowered, o_orderkey + o_custkey + 7 AS int_list_sum,
          {form("ident || ' 收/*~+&' || o_orderpriority")} AS form,
          {path("ident || ' 收/*~+&' || o_orderpriority")} AS path,
          '{{"id":' || o_custkey || ',"name":"收盘"}}' AS json,
          strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH, '%Y-%m-%d') AS next_month,
          strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS next_day,
          year(o_orderdate) || '-12-31' AS year_end,
          cast(date '2001-12-31' - cast(o_orderdate as date) + 1 as int) AS days,
          cast(o_orderdate - INTERVAL 30 MINUTE as string) AS half_hour_before,
          round(o_custkey * 100.0::double / (o_orderkey + 1), 1) AS percent,
          printf('%.2f', o_totalprice) AS money,
          CASE o_orderstatus WHEN 'F' THEN 'none' ELSE o_orderstatus END AS filled,
          regexp_extract_all(o_orderpriority, '([A-Z]{{2}})', 1)[1] AS letters,
          regexp_full_match(ident, '[0-9]{{6}}') AS is_code,
          o_orderkey || ':akshare:' || o_orderstatus AS key, 1 AS days_kept
        FROM (SELECT *, {code('o_custkey')} AS ident FROM orders)""",
    "stored_observations": "SELECT concept_id, granularity, count(*) AS observations,"
    " count(DISTINCT entity_id) AS entities, min(\"date\") AS first_date, max(\"date\") AS last_date"
    " FROM (SELECT DISTINCT concept_id, entity_type, entity_id, day AS \"date\", granularity FROM"
    ' (SELECT t.*, f."date" AS day FROM tasks t'
    f' JOIN points f ON {SAME_FRAME} AND f."date" BETWEEN coalesce(t."date", t."start")'
    ' AND coalesce(t."date", t."end") QUALIFY t.rank = min(t.rank) OVER (PARTITION BY t.plan_id,'
    ' t.concept_id, t.entity_type, t.entity_id, t."date", t.unit, t.granularity, t."start", t."end")))'
    " GROUP BY ALL",
}

ORACLES = {name: with_ctes(body) for name, body in _BODIES.items()}
