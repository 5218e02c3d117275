"""Call parameters of a task, for sources without an adapter of their own."""

from pyspark.sql import Column, functions as F

from obsmill.functions import text


def point_params(identifier: Column, date: Column) -> Column:
    return F.create_map(F.lit("symbol"), identifier, F.lit("date"), date)


def range_params(identifier: Column) -> Column:
    return F.create_map(F.lit("symbol"), identifier)


def history_params(identifier: Column, start: Column, end: Column) -> Column:
    """Daily price history: compact dates, forward-adjusted."""
    return F.create_map(
        F.lit("symbol"), identifier,
        F.lit("start_date"), text.compact_date(start),
        F.lit("end_date"), text.compact_date(end),
        F.lit("adjust"), F.lit("qfq"),
    )


def statement_params(source: Column, identifier: Column) -> Column:
    """Statement call: the global source wants an exchange suffix; unknown sources give null."""
    symbol = F.when(source == "akshare", identifier).when(
        source == "yfinance", text.market_symbol(identifier)
    )
    return F.when(symbol.isNotNull(), F.create_map(F.lit("symbol"), symbol))
