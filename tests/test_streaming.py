import json

from obsmill.plans import statements
from obsmill.schemas import OBSERVATION
from obsmill.sinks.paths import scratch_path
from obsmill.sinks.store import KeyedStore, ObservationStore
from obsmill.streaming import intake

ROW = ("concept_id INT, entity_type STRING, entity_id BIGINT, date STRING, granularity STRING, value STRING,"
       " unit STRING, source_used STRING, arrival INT")


def _observations(spark, *entries):
    return spark.createDataFrame([(1, "stock", e, "2024-01-02", None, v, None, None, n) for n, (e, v) in enumerate(entries)], ROW)


def test_upsert_over_restarts(spark, rows):
    base = scratch_path(spark, "stream")
    store = ObservationStore(spark, f"{base}/store")
    for entries in ([(1, "a"), (1, "b"), (2, "c")], [(2, "d"), (3, "e")]):
        batch = _observations(spark, *entries)
        batch.write.mode("append").parquet(f"{base}/incoming")
        stream = intake.observation_stream(spark, f"{base}/incoming", batch.schema)
        intake.upsert_stream(stream, store, ["arrival"], f"{base}/checkpoint")
    expected = [(1, "a"), (2, "c"), (3, "e")]
    assert rows(store.read(), "entity_id", "value") == expected
    assert store.read().columns == OBSERVATION.fieldNames()
    # A replay of everything, as after a lost checkpoint, changes nothing but the batch folders.
    stream = intake.observation_stream(spark, f"{base}/incoming", batch.schema)
    intake.upsert_stream(stream, store, ["arrival"], f"{base}/other-checkpoint")
    assert [e for e, _ in rows(store.read(), "entity_id", "value")] == [1, 2, 3]


def test_queue_takes_each_task_once(spark, rows):
    base = scratch_path(spark, "queue")
    stocks = spark.createDataFrame([(1, "600000"), (2, "000001")], "entity_id BIGINT, identifier STRING")
    tasks = statements.statement_tasks(stocks)
    queue = KeyedStore(spark, f"{base}/queue", statements.with_task_key(tasks).schema, ["task_key"])
    for waiting in (tasks.filter("entity_id = 1"), tasks):
        waiting.write.mode("append").json(f"{base}/incoming")
        stream = intake.task_stream(spark, f"{base}/incoming", tasks.schema, files_per_batch=2)
        intake.drain_tasks(statements.with_task_key(stream), queue, ["identifier"], f"{base}/checkpoint")
    assert queue.read().count() == queue.read().select("task_key").distinct().count() == 24


def test_responses_to_store_and_audit(spark, rows):
    base = scratch_path(spark, "responses")
    store = ObservationStore(spark, f"{base}/store")
    schema = ("source STRING, concept_id INT, entity_type STRING, entity_id BIGINT, date STRING, unit STRING,"
              " granularity STRING, start STRING, end STRING, status INT, body STRING, arrival INT")
    series = json.dumps({"2024-01-02": 1.5, "2024-01-03": 1.6, "2025-01-01": 9})
    waves = [
        [("a", 1, "fund", 1, None, "", None, "2024-01-01", "2024-12-31", 200, series, 1),
         ("a", 1, "fund", 1, "2024-01-04", "", None, None, None, 204, "", 2)],
        [("b", 1, "fund", 1, "2024-01-02", "", "day", None, None, 200, "7", 3),
         ("b", 1, "fund", 1, "2024-01-05", "", "day", None, None, 200, "nan", 4),
         ("b", 1, "fund", 1, "2024-01-05", "", "day", None, None, 200, "8", 5)],
    ]
    for wave in waves:
        spark.createDataFrame(wave, schema).write.mode("append").json(f"{base}/incoming")
        stream = intake.task_stream(spark, f"{base}/incoming", schema)
        intake.response_stream_to_store(stream, store, ["arrival"], f"{base}/checkpoint", f"{base}/audit")
    assert rows(store.read(), "date", "value", "source_used") == [
        ("2024-01-02", "1.5", "a"), ("2024-01-03", "1.6", "a"), ("2024-01-05", "8", "b")
    ]
    assert spark.read.json(f"{base}/audit").count() == 4
