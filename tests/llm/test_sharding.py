import random
import zlib

from obsmill.llm.sharding import difference, shard


def test_differencing_beats_dealing_in_order():
    draw = random.Random(4)
    sizes = [draw.randint(1, 1000) for _ in range(200)]
    placed = difference([[0, 0, 0, n] for n in sizes])
    sums = [0] * 4
    for n, p in zip(sizes, placed):
        assert sorted(p) == [0, 1, 2, 3]
        sums[p[-1]] += n
    assert max(sums) - min(sums) <= 5
    assert difference([]) == [] and difference([[3, 1]]) == [[0, 1]]


def test_shards_are_near_equal_and_equal_texts_stay_together(spark):
    draw = random.Random(6)
    texts = ["é" * draw.randint(0, 200) for _ in range(900)] + ["same text"] * 120 + [None, None, "", ""]
    rows = [(k % 1000 if k % 50 else None, t, "x") for k, t in enumerate(texts)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, slot string")
    found = shard(documents, shards=5, groups_per_task=40).collect()
    assert len(found) == len(rows)
    by, slots, group = [0] * 5, [[] for _ in range(5)], {}
    for r in found:
        by[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert group.setdefault(r.text_crc32, r.shard) == r.shard or r.text_crc32 == 0
    assert max(by) - min(by) <= 0.01 * sum(by)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts)
    assert sorted((r.size, r.text_crc32) for r in found) == want
    again = shard(documents.repartition(5), shards=5, groups_per_task=40).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_carried_columns_and_empty_tables(spark):
    documents = spark.createDataFrame([(1, "a", "u"), (2, "b", None)], "doc_id long, text string, lang string")
    assert shard(documents, carry=True).columns[:3] == ["doc_id", "text", "lang"]
    assert shard(documents.limit(0)).count() == 0


def test_partial_partitions_are_differenced_level_by_level(spark):
    draw = random.Random(12)
    rows = [(k, "x" * draw.randint(0, 400) + str(k), 1, 2, "s") for k in range(600)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, size int, Shard int, slot_carried string")
    found = shard(documents, shards=4, groups_per_task=20, partials_at_once=3, carry=True)
    assert found.columns == ["doc_id", "text", "size_carried", "Shard_carried", "slot_carried", "size", "text_crc32", "shard", "slot"]
    by, slots = [0] * 4, [[] for _ in range(4)]
    for r in found.collect():
        by[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert sum(by) == sum(len(t) + 1 for _, t, *_ in rows) and max(by) - min(by) <= 0.01 * sum(by)
    assert all(sorted(s) == list(range(len(s))) for s in slots)


def test_differencing_against_all_partitions(spark):
    """Two shards of a few texts: no split is nearer than what differencing can reach by its own bound."""
    draw = random.Random(3)
    for _ in range(20):
        sizes = [draw.randint(1, 30) for _ in range(7)]
        best = min(abs(sum(sizes) - 2 * sum(s for k, s in enumerate(sizes) if m >> k & 1)) for m in range(128))
        placed = difference([[0, n] for n in sizes])
        sums = [sum(n for n, p in zip(sizes, placed) if p[-1] == k) for k in range(2)]
        assert best <= abs(sums[0] - sums[1]) <= best + max(sizes)
