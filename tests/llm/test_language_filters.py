import numpy as np

from obsmill.llm.language_filters import Filters, grams, codes, language, learn

TEXTS = {"xa": "the cat and that other thing with them", "xb": "das ist nicht der einzige weg für üble", "xc": "Это не тот самый путь"}


def test_filters_have_what_was_put_in():
    held = [grams(codes(f" {t} ")) for t in TEXTS.values()]
    filters = Filters.of(list(TEXTS), held)
    for k, own in enumerate(held):
        assert filters.counts(own)[k] == len(own)
    other = np.arange(10**6, 10**6 + 20_000)
    assert np.all(filters.counts(other) / len(other) <= 3 * filters.false_rate + 1e-3)


def test_languages_nulls_and_many_languages(spark):
    rows = [(k, t, name, "z") for name, t in TEXTS.items() for k in range(3)]
    rows += [(9, f"{'q' + chr(97 + k // 26) + chr(97 + k % 26)} " * 3, f"l{k:03}", "z") for k in range(70)]
    schema = "doc_id long, text string, lang string, score string"
    filters = learn(spark.createDataFrame([*rows, (1, None, "xa", ""), (2, "noise", None, "")], schema))
    assert len(filters.languages) == 73 and filters.rows.shape[1] == 2
    asked = [(1, "that cat", None, ""), (2, "nicht für", "xa", ""), (3, "тот путь", None, ""), (None, None, None, None), (4, "12 !", "xb", ""), (5, "qbc " * 2, None, ""), (1, "that cat", None, "")]
    found = language(spark.createDataFrame(asked, schema), filters).collect()
    got = sorted((r.doc_id or 0, r.lang_pred) for r in found)
    assert got == [(0, "und"), (1, "xa"), (1, "xa"), (2, "xb"), (3, "xc"), (4, "und"), (5, "l028")]
    assert all(0 <= r.score <= 1 for r in found)
    nothing = learn(spark.createDataFrame([], schema))
    assert [r.lang_pred for r in language(spark.createDataFrame(asked[:1], schema), nothing).collect()] == ["und"]
    assert language(spark.createDataFrame([], schema), filters).count() == 0


def test_long_texts_are_cut_without_loss(monkeypatch):
    from obsmill.llm import language_filters

    text = "Über das große Haus " * 30
    whole = np.concatenate(list(language_filters._parts(text)))
    monkeypatch.setattr(language_filters, "PIECE", 7)
    assert np.array_equal(np.concatenate(list(language_filters._parts(text))), whole)


def test_every_trigram_of_a_large_inventory_is_held(spark):
    draw = np.random.default_rng(4)
    large = ["".join(map(chr, draw.integers(0x4E00, 0x4E00 + 400, 500))) for _ in range(40)]
    rows = [*((t, "xz") for t in large), *((t, name) for name, t in TEXTS.items())]
    filters = learn(spark.createDataFrame(rows, "text string, lang string"))
    at = filters.languages.index("xz")
    assert len(np.unique(np.concatenate([grams(codes(t)) for t in large]))) > 15_000
    for t in large:
        own = grams(codes(f" {t} "))
        assert filters.counts(own)[at] == len(own)
    assert [filters.decide(t)[0] for t in TEXTS.values()] == list(TEXTS)
    held = [grams(codes(f" {t} ")) for t in TEXTS.values()]
    in_tasks = learn(spark.createDataFrame([(t, name) for name, t in TEXTS.items()], "text string, lang string"), share=0.0)
    assert np.array_equal(in_tasks.rows, Filters.of(list(TEXTS), held).rows)


def test_size_grows_with_the_trigrams():
    assert Filters.size(6_000) == 1 << 17 and Filters.size(10**7) == 1 << 25
    assert all(Filters.size(n) >= 2 * n for n in (1, 10**5, 10**6, 10**8))
