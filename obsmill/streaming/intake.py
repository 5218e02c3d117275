"""Streams: queued tasks and arriving observations."""

from pyspark.sql import DataFrame, SparkSession, types as T

from obsmill.operators.observations import item_rows, parse_responses
from obsmill.schemas import RESPONSE
from obsmill.sinks.store import KeyedStore, ObservationStore, append_audit


def task_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """JSON tasks, one per line, as files arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def observation_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def response_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Responses, one JSON object per line, as files arrive in a folder."""
    return task_stream(spark, path, RESPONSE, files_per_batch)


def _insert_batches(stream: DataFrame, store: KeyedStore, order: list[str], checkpoint: str):
    def insert(batch: DataFrame, number: int) -> None:
        store.insert(batch, f"{number:012d}", order)

    return stream.writeStream.foreachBatch(insert).option("checkpointLocation", checkpoint)


def drain_tasks(
    stream: DataFrame, queue: KeyedStore, order: list[str], checkpoint: str
) -> None:
    """Take in all waiting tasks; a task key that any earlier batch took is not taken again.

    The seen keys are the table itself rather than streaming state, which would grow forever.
    """
    writer = _insert_batches(stream, queue, order, checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def upsert_stream(
    stream: DataFrame,
    store: ObservationStore,
    order: list[str],
    checkpoint: str,
    interval: str | None = None,
):
    """Insert-if-absent per micro-batch; a replayed batch finds its rows in its own folder and adds what is missing.

    Without an interval the stream takes what is there and ends; with one it keeps running.
    A killed job loses at most the batch in hand, which the checkpoint brings back.
    """
    writer = _insert_batches(stream, store, order, checkpoint)
    if interval is not None:
        return writer.trigger(processingTime=interval).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def response_stream_to_store(
    responses: DataFrame,
    store: ObservationStore,
    order: list[str],
    checkpoint: str,
    audit: str | None = None,
) -> None:
    """Responses as they arrive: parsed, exploded, inserted if absent, then audited unexploded."""

    def take(batch: DataFrame, number: int) -> None:
        batch_id = f"{number:012d}"
        more = tuple(c for c in order if c != "source_used")
        items = parse_responses(batch, keep=more, typed=audit is not None)
        store.insert(item_rows(items), batch_id, order)
        if audit is not None:
            append_audit(items.drop(*more), audit, batch_id)

    writer = responses.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
