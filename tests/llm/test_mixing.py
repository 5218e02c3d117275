import random

from pyspark.sql import functions as F

from obsmill.llm.mixing import mix, mixed_documents, targets


def shares(sizes, most=3):
    """Targets by the process itself: share, hold, share again."""
    weights = [k % 3 + 1 for k in range(len(sizes))]
    held = set()
    while True:
        rest = sum(sizes) - sum(most * sizes[k] for k in held)
        weight = sum(w for k, w in enumerate(weights) if k not in held)
        over = {k for k in range(len(sizes)) if k not in held and rest * weights[k] > most * sizes[k] * weight}
        if not over:
            return [float(most * s) if k in held else rest * w / weight for k, (s, w) in enumerate(zip(sizes, weights))]
        held |= over


def test_targets_are_those_of_the_process(spark):
    draw = random.Random(1)
    for _ in range(6):
        sizes = [draw.choice([1, 5, 40, 300, 9000]) for _ in range(draw.randint(1, 9))]
        frame = spark.createDataFrame([(f"s{k}", n) for k, n in enumerate(sizes)], "source string, source_size long")
        got = [r.target for r in targets(frame).orderBy("source").collect()]
        assert all(abs(a - b) < 1e-6 * max(1, b) for a, b in zip(got, shares(sizes))), (sizes, got, shares(sizes))


def test_words_taken_come_near_the_target_and_reruns_agree(spark):
    draw = random.Random(2)
    rows = [(k, "w " * draw.randint(0, 80), draw.choice("aaaaabc") if k % 9 else None, 1) for k in range(1500)]
    rows += [(7, None, "a", 1), (7, "w w", "a", 1), (7, "w w", "a", 1), (None, "w", "b", 1)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string, taken int")
    mixed = mix(documents)
    found = mixed.collect()
    assert sorted(map(str, found)) == sorted(map(str, mix(documents.repartition(7)).collect()))
    by = {}
    for r in found:
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        got = by.setdefault(r.source, [r.target, 0, r.source_size])
        got[1] += r.taken
    assert set(by) == {"a", "b", "c", None} and all(abs(t - n) <= 160 for t, n, _ in by.values())
    assert abs(sum(t for t, _, _ in by.values()) - sum(s for _, _, s in by.values())) < 1e-6
    out = mixed_documents(documents)
    assert out.columns == documents.columns
    assert out.count() == sum(r.copies for r in found)


def test_empty_and_wordless(spark):
    schema = "doc_id long, text string, source string"
    assert mix(spark.createDataFrame([], schema)).count() == 0
    (row,) = mix(spark.createDataFrame([(1, " \t", None)], schema)).collect()
    assert (row.size, row.target, row.taken) == (0, 0.0, 0)
    assert mixed_documents(spark.createDataFrame([], schema)).filter(F.lit(True)).count() == 0
