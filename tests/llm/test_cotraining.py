import random

from obsmill.llm import cotraining
from obsmill.llm.cotraining import quality


def test_held_out_accuracy_nulls_and_no_labels(spark):
    draw = random.Random(9)
    rows, labels = [], []
    for k in range(600):
        good = draw.random() < 0.7
        text = " ".join(draw.choices("river stone light window garden morning".split(), k=30)) if good else "BUY!! " * 20
        rows.append((k, text, "en", "good" if draw.random() < (0.9 if good else 0.2) else "bad", len(text), 0.0))
        if k % 2:
            labels.append((k, int(good)))
    rows += [(None, None, None, None, None, None), (3, "BUY!! " * 5, "en", "bad", 30, 0.0), (3, "", "", "", 0, 0.0)]
    labels += [(5, 0), (5, 1), (None, 1), (6, None)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    found = quality(documents, known, rounds=1).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out and r.label is not None]
    assert sum((r.score >= 0.5) == (r.label == 1) for r in held) >= 0.95 * len(held)
    assert next(r.label for r in found if r.doc_id == 5) is None
    assert {r.score for r in quality(documents, known.limit(0)).collect()} == {0.5}
    assert quality(documents.limit(0), known).count() == 0


def test_documents_told_apart_by_wording_only(spark):
    draw = random.Random(4)
    plain = "river stone light window garden morning street bridge".split()
    rows, labels = [], []
    for k in range(800):
        good = draw.random() < 0.6
        words = draw.choices(plain, k=40)
        words[draw.randrange(40)] = "tablet" if good else "battle"  # the same letters
        rows.append((k, " ".join(words), "en", "one", 0))
        labels.append((k, int(good)))
    rows += [(None, "tablet " * 60_000, "en", "one", None), (900, "\u00df \ud83d\ude00 7 ...", None, None, 1)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = quality(documents, spark.createDataFrame(labels, "doc_id long, quality int"), rounds=1).collect()
    assert len(found) == len(rows)
    held = [r for r in found if r.held_out and r.label is not None]
    assert sum((r.score >= 0.5) == (r.label == 1) for r in held) >= 0.97 * len(held)


def test_views_are_joined_packed_and_written_once(spark, monkeypatch):
    rows = [(k, f"river stone w{k} " * 5 if k % 3 else None, "en", "one", 9) for k in range(60)] + [(None, "a A b 1", None, None, None)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    names, write, parts, fit = [], cotraining.written, [], cotraining.LogisticRegression.fit
    monkeypatch.setattr(cotraining, "written", lambda frame, name: (names.append(name), write(frame, name))[1])
    monkeypatch.setattr(cotraining.LogisticRegression, "fit", lambda self, frame: (parts.append(frame.rdd.getNumPartitions()), fit(self, frame))[1])
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(0, 60, 2)], "doc_id long, quality int")
    assert quality(documents.repartition(12), labels, rounds=0).count() == 61
    assert names == ["labelled"]
    assert parts and max(parts) <= spark.sparkContext.defaultParallelism
    packed = cotraining.views(documents, "doc_id", "text", "lang", "source", "n_chars")
    sizes = {r._id: (len(r.shares), len(r.words)) for r in packed.collect()}
    assert sizes[None] == (8 * cotraining.SHARES, 2 * 2) and sizes[0] == (8 * cotraining.SHARES, 0) and sizes[1][1] == 2 * 3
    made = {r._id: r for r in cotraining.vectors(packed.withColumn("_label", packed._fold)).collect()}
    assert [round(v, 9) for v in made[None].text_view.values[cotraining.SHARES :]] == [round(0.5**0.5, 9)] * 2
    assert made[0].text_view.values.tolist() == cotraining.text_view(None) and len(made[1].metadata_view) == 84
