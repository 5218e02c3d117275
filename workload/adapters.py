"""Two sources of the `fetch_map` query: each answers from the call's own parameters."""

from datetime import date, timedelta

from obsmill.sources.adapters import Adapter, FetchError, SourceUnavailable


class PriceSource(Adapter):
    """Serves points and series; some symbols fail, some are unknown."""

    def range_params(self, command, identifier, start, end, column):
        return {"symbol": identifier, "start": start, "end": end}

    def fetch(self, command, params):
        number = int(params["symbol"])
        if number % 5 == 0:
            raise FetchError(f"no answer for {number}")
        if number % 5 == 1:
            raise SourceUnavailable
        return number

    def extract_value(self, result, column, date, identifier):
        return None if result % 5 == 2 else result * 100 + int(date[-2:])

    def extract_series(self, result, column, start, end):
        if result % 5 == 2:
            return {}
        first = date.fromisoformat(start)
        return {(first + timedelta(days=n)).isoformat(): result * 10 + n for n in range(3)}


class PointSource(Adapter):
    """Serves points only."""

    def fetch(self, command, params):
        return int(params["symbol"])

    def extract_value(self, result, column, date, identifier):
        return None if result % 7 == 0 else -result


def adapters():
    return {"akshare": PriceSource(), "yfinance": PointSource()}
