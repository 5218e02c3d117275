import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_only_lose_what_they_reject(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for (name, stage), n in zip(corpus_pipeline.STAGES, range(5)):
        after = stage(spark, docs, SF)
        assert n == 4 or after.columns == docs.columns
        rows = spark.createDataFrame(after.collect(), after.schema)
        if name in ("language", "near_duplicates", "decontamination"):
            assert 0 < rows.count() <= before
        docs, before = rows, rows.count()
    assert before > 0 and docs.select("shard").distinct().count() <= 16


def test_mended_inputs(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "the cat sat on the mat again", "en", "a", 1), (2, "the cat sat on the mat again", "en", None, 1), (None, None, None, None, None), (3, "!!", "en", "b", 2)]
    docs = spark.createDataFrame(rows * 2, schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() <= 3 * len(rows) * 2
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_a_language_with_a_long_tail_of_trigrams_stays(spark):
    import random

    draw = random.Random(2)
    wide = [(k, "".join(chr(0x4E00 + draw.randrange(70)) for _ in range(200)), "xz") for k in range(300)]
    plain = [(1000 + k, "the cat sat on the mat again and again", "en") for k in range(20)]
    noise = [(2000 + k, "жщъ" * 20, None) for k in range(5)]
    docs = spark.createDataFrame(wide + plain + noise, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in corpus_pipeline.in_a_language(spark, docs, SF).collect()}
    assert kept == {k for k, _, _ in wide + plain}
