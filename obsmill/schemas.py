"""Schemas and fixed values shared by the operators."""

from pyspark.sql import types as T

KEY = ["concept_id", "entity_type", "entity_id", "date", "granularity"]
#: Its parts of many values, by which rows are told apart soonest.
SELECTIVE = ("entity_id", "date")

_INT, _LONG, _DOUBLE, _TEXT = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
_STAMP, _STAMP_NTZ = T.TimestampType(), T.TimestampNTZType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


OBSERVATION = _struct(
    concept_id=_INT,
    entity_type=_TEXT,
    entity_id=_LONG,
    date=_TEXT,
    granularity=_TEXT,
    value=_TEXT,
    unit=_TEXT,
    source_used=_TEXT,
    fetched_at=_STAMP,
)

RANKED_SOURCE = _struct(
    source=_TEXT,
    score=_DOUBLE,
    function_id=_INT,
    function_command=_TEXT,
    column_name=_TEXT,
    binding_id=_INT,
    confidence=_DOUBLE,
)

WANTED_CONCEPT = _struct(
    concept_id=_INT,
    code=_TEXT,
    entity_type=_TEXT,
    unit=_TEXT,
    frequency=_TEXT,
    granularity=_TEXT,
    ranked_sources=T.ArrayType(RANKED_SOURCE),
)

PLAN = _struct(
    version=_TEXT,
    mode=_TEXT,
    wanted_concepts=T.ArrayType(WANTED_CONCEPT),
    entity_scope=_struct(entity_type=_TEXT, entity_ids=T.ArrayType(_LONG), filter=_TEXT),
    date_range=_struct(start=_TEXT, end=_TEXT, frequency=_TEXT),
    unroutable=T.ArrayType(_TEXT),
    unmapped=T.ArrayType(_TEXT),
    persistence=_struct(table=_TEXT),
)

IDENTIFIERS = _struct(source=_TEXT, entity_type=_TEXT, entity_id=_LONG, identifier=_TEXT)

# Task fields, in the order in which the request key lists them.
TASK = _struct(
    source=_TEXT,
    command=_TEXT,
    identifier=_TEXT,
    date=_TEXT,
    column=_TEXT,
    concept_id=_INT,
    entity_type=_TEXT,
    entity_id=_LONG,
    unit=_TEXT,
    granularity=_TEXT,
    start=_TEXT,
    end=_TEXT,
)
TASK_FIELDS = TASK.fieldNames()

RESPONSE = T.StructType([*TASK.fields, *_struct(status=_INT, body=_TEXT).fields])

STATEMENT_TASK = _struct(
    entity_id=_LONG,
    identifier=_TEXT,
    source=_TEXT,
    function_name=_TEXT,
    function_command=_TEXT,
    concept_ids=T.ArrayType(_INT),
    start_date=_TEXT,
    end_date=_TEXT,
)

# Pages are read in the order of `source_rank`.
PAGE = _struct(source=_TEXT, source_rank=_INT, status=_INT, html=_TEXT)

ENDPOINT_REGISTRY = _struct(
    id=_LONG,
    scheme=_TEXT,
    ip=_TEXT,
    port=_INT,
    auth=_TEXT,
    status=_TEXT,
    label=_TEXT,
    created_at=_STAMP_NTZ,
    updated_at=_STAMP_NTZ,
    retired_at=_STAMP_NTZ,
)

# They must equal the providers' and the store's own.
DATE_COLUMN_NAMES = ("date", "日期", "datetime", "时间")

STATEMENT_FUNCTIONS = [
    ("akshare", "annual_bs", "balance_sheet_by_yearly_em"),
    ("akshare", "annual_is", "profit_sheet_by_yearly_em"),
    ("akshare", "annual_cf", "cash_flow_sheet_by_yearly_em"),
    ("akshare", "quarterly_bs", "balance_sheet_by_report_em"),
    ("akshare", "quarterly_is", "profit_sheet_by_report_em"),
    ("akshare", "quarterly_cf", "cash_flow_sheet_by_report_em"),
    ("yfinance", "annual_bs", "ticker_balance_sheet"),
    ("yfinance", "annual_is", "ticker_financials"),
    ("yfinance", "annual_cf", "ticker_cashflow"),
    ("yfinance", "quarterly_bs", "quarterly_balance_sheet"),
    ("yfinance", "quarterly_is", "quarterly_financials"),
    ("yfinance", "quarterly_cf", "quarterly_cashflow"),
]

STATEMENT_CONCEPTS = {
    "akshare": {
        "bs": [("TOTAL_ASSETS", 242), ("TOTAL_LIABILITIES", 243), ("TOTAL_EQUITY", 244)],
        "is": [("OPERATE_INCOME", 239), ("NETPROFIT", 240)],
        "cf": [("NETCASH_OPERATE", 241)],
    },
    "yfinance": {
        "bs": [("Total Assets", 242), ("Total Liab Net Debt", 243), ("Stockholders Equity", 244)],
        "is": [("Total Revenue", 239), ("Net Income", 240)],
        "cf": [("Total Cash From Operating Activities", 241)],
    },
}

PROBE_TARGETS = ["eastmoney", "tencent", "yahoo_finance"]

IPV4_PATTERN = r"(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})"
PORT_CELL_PATTERN = r"<td>(\d{2,5})</td>"

REQUEST_SCHEME = "fetch://"
STOCK_CODE_PATTERN = r"^[0-9]{6}\z"
DEFAULT_GRANULARITY = "day"
OPEN_END = "9999-12-31"
LEGACY_ENTITY_TYPE = "stock"
LEGACY_UNIT = "currency"
ENDPOINT_LABEL = "free-proxy"
STALE_MINUTES = 30
ENDPOINT_FETCH_COUNT = 50
