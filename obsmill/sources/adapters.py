"""User adapters: one Python object per source, run per task partition."""

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Row, functions as F, types as T

from obsmill.schemas import DATE_COLUMN_NAMES, TASK, TASK_FIELDS

#: Names the adapter of sources that have none of their own.
ANY_SOURCE = "*"
#: Calls of one group of `fetch_table`, about.
GROUP_CALLS = 10_000

ATTEMPT = T.StructType(
    [
        T.StructField("request_key", T.StringType()),
        *TASK.fields,
        T.StructField("rank", T.IntegerType()),
        T.StructField("value", T.StringType()),
        T.StructField("series", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
_ARROW_TYPES = {
    T.IntegerType: pa.int32(),
    T.LongType: pa.int64(),
    T.StringType: pa.string(),
}
_ARROW = pa.schema([(field.name, _ARROW_TYPES[type(field.dataType)]) for field in ATTEMPT.fields])


class SourceUnavailable(Exception):
    """Raised by an adapter's `fetch` when its source cannot be reached at all."""


class FetchError(Exception):
    """Raised by an adapter's `fetch` when a call fails."""


class Adapter:
    """What a source needs: call parameters, the call, and the value in its result.

    `range_params(command, identifier, start, end, column)` and
    `extract_series(result, column, start, end)` are optional: without the first a range call uses
    the point parameters at its start, without the second the source cannot serve series.
    """

    def point_params(self, command: str, identifier: str, date: str, column: str) -> dict:
        return {"symbol": identifier, "date": date}

    def fetch(self, command: str, params: dict):
        raise NotImplementedError

    def extract_value(self, result, column: str, date: str, identifier: str):
        """The column's value in the first of the result's rows (mappings) that has the date."""
        for row in result or ():
            dated = next((c for c in row if c.lower() in DATE_COLUMN_NAMES), None)
            if dated is not None and str(row[dated]) == date:
                return row.get(column)
        return None


def _missing(value) -> bool:
    return value is None or value != value


def _series_json(series: Mapping) -> str | None:
    """JSON text of the days that have a value, numbers as numbers; null without any."""
    plain = {str(day): v.item() if hasattr(v, "item") else v for day, v in series.items()}
    kept = {day: v for day, v in plain.items() if not _missing(v)}
    return json.dumps(kept, ensure_ascii=False, separators=(",", ":"), default=str) if kept else None


def _attempt(adapter: Adapter | None, task: dict) -> dict:
    """One call: its value, its series, or its error; all empty where the source has no value.

    Whatever the adapter raises is this attempt's error, and the next source is tried.
    """
    source = task["source"]
    if adapter is None:
        return {"error": f"{source} unavailable"}
    try:
        return _call(adapter, task)
    except SourceUnavailable:
        return {"error": f"{source} unavailable"}
    except FetchError as error:
        return {"error": str(error)}
    except Exception as error:
        return {"error": f"{type(error).__name__}: {error}"}


def _call(adapter: Adapter, task: dict) -> dict:
    source, command, column = task["source"], task["command"], task["column"]
    ranged = task["date"] is None
    if ranged and hasattr(adapter, "range_params"):
        params = adapter.range_params(command, task["identifier"], task["start"], task["end"], column)
    else:
        at = task["start"] if ranged else task["date"]
        params = adapter.point_params(command, task["identifier"], at, column)
    result = adapter.fetch(command, params)
    if not ranged:
        value = adapter.extract_value(result, column, task["date"], task["identifier"])
        return {} if _missing(value) else {"value": str(value)}
    extract = getattr(adapter, "extract_series", None)
    series = extract(result, column, task["start"], task["end"]) if extract else None
    if series is None:
        return {"error": f"{source}/{command} has no extract_series"}
    return {"series": _series_json(series)}


class Landing:
    """Outcomes of calls by request key and rank, in a shared folder.

    An outcome lands before its task goes on, so a task that is lost and repeated finds what its calls gave
    instead of making them again. One folder belongs to one run. `uri` is a path or URI of any file
    system that Arrow knows; each outcome is a small file that is renamed into place once it is complete.
    """

    def __init__(self, uri: str):
        self.files, root = fs.FileSystem.from_uri(uri)
        self.root = root.rstrip("/")

    def _place(self, key: str, rank: int) -> str:
        name = hashlib.sha256(key.encode()).hexdigest()
        return f"{self.root}/{name[:2]}/{name}-{rank}.json"

    def get(self, key: str, rank: int) -> dict | None:
        place = self._place(key, rank)
        if self.files.get_file_info(place).type == fs.FileType.NotFound:
            return None
        with self.files.open_input_stream(place) as stream:
            return json.loads(stream.read())

    def put(self, key: str, rank: int, outcome: dict) -> None:
        place = self._place(key, rank)
        self.files.create_dir(place.rsplit("/", 1)[0], recursive=True)
        part = f"{place}.{uuid.uuid4().hex}"
        with self.files.open_output_stream(part) as stream:
            stream.write(json.dumps(outcome, ensure_ascii=False).encode())
        self.files.move(part, place)


def _landed(landing: Landing | None, adapter: Adapter | None, tried: dict, rank: int) -> dict:
    """The outcome of a call, made now unless it has landed before."""
    if landing is None:
        return _attempt(adapter, tried)
    outcome = landing.get(tried["request_key"], rank)
    if outcome is None:
        outcome = _attempt(adapter, tried)
        landing.put(tried["request_key"], rank, outcome)
    return outcome


def _walk(
    adapters: Mapping[str, Adapter], task: dict, chain: list[dict] | None, landing: Landing | None = None
) -> Iterator[dict]:
    """Attempts in rank order, up to the first that serves the task."""
    own = {key: task[key] for key in ("source", "command")} | {"column_name": task["column"]}
    for rank, entry in enumerate(chain or [own]):
        tried = task | {
            "source": entry["source"],
            "command": entry["command"],
            "column": entry["column_name"] or task["column"],
        }
        outcome = _landed(landing, adapters.get(tried["source"], adapters.get(ANY_SOURCE)), tried, rank)
        yield tried | {"rank": rank} | outcome
        if outcome.get("value") is not None or outcome.get("series"):
            return


def fetch_attempts(
    tasks: DataFrame,
    adapters: Callable[[], Mapping[str, Adapter]],
    chain: str | None = None,
    calls: int | None = None,
    landing: str | None = None,
) -> DataFrame:
    """Run keyed tasks through the adapters of their sources, one row per call.

    `chain` names an array column of (source, command, column_name), tried in order until one
    serves; without it a task tries its own source only. `adapters` is called once per task
    partition, so connections are made where they are used. Under `ANY_SOURCE` it may name an
    adapter for all other sources, such as one with the default parameters and look-up by column. `calls` is the number of partitions
    to spread the tasks over, and so how many calls run at the same time. `landing` is the folder of a
    `Landing`: calls whose outcome has landed there aren't made again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_source = adapters()
        landed = Landing(landing) if landing else None
        for batch in batches:
            done = [
                attempt
                for task in batch.to_pylist()
                for attempt in _walk(by_source, task, task.pop(chain) if chain else None, landed)
            ]
            yield pa.RecordBatch.from_pylist(done, schema=_ARROW)

    columns = ["request_key", *TASK_FIELDS, *([chain] if chain else [])]
    wanted = tasks.select(*columns)
    if calls is not None:
        wanted = wanted.repartition(calls)
    return wanted.mapInArrow(run, ATTEMPT)


def call_groups(tasks: int, calls: int) -> int:
    """Parts for `fetch_table`: one per call at the same time, more where a part would grow with the tasks.

    A group lies in one partition, which sorts it and what its calls give.
    """
    return max(calls, -(-tasks // GROUP_CALLS))


def fetch_table(adapters: Callable[[], Mapping[str, Adapter]], chain: str | None = None, landing: str | None = None):
    """The same calls as a table function for SQL, to be registered with `spark.udtf.register`.

    `SELECT * FROM fetch(TABLE(tasks) PARTITION BY (source, part))`: the adapters are made once per group, so a
    group's calls share a connection. Rows need `request_key`, the task fields and `chain`, if it is named; `part`,
    a hash of the request key, splits a source that has most of the tasks into `call_groups` parts.
    """
    names = ATTEMPT.fieldNames()

    class Fetch:
        def __init__(self):
            self.by_source = adapters()
            self.landed = Landing(landing) if landing else None

        def eval(self, row: Row):
            given = row.asDict(recursive=True)
            task = {name: given[name] for name in ("request_key", *TASK_FIELDS)}
            for attempt in _walk(self.by_source, task, given[chain] if chain else None, self.landed):
                yield tuple(attempt.get(name) for name in names)

    return F.udtf(Fetch, returnType=ATTEMPT)
