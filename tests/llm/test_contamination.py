import random
import re

from obsmill.llm.contamination import contamination


def words(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [(m[0], m.span()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)]


def expected(text, items, width):
    own = words(text)
    hit, found = set(), set()
    for name, body in items:
        w = [x for x, _ in words(body)]
        for k in range(max(1, len(w) - width + 1)) if w else ():
            window = w[k : k + width]
            for at in range(len(own) - len(window) + 1):
                if [x for x, _ in own[at : at + len(window)]] == window:
                    hit |= set(range(at, at + len(window)))
                    found |= {str(name)} if name is not None else set()
    return len(own), len(hit), sorted(found), [own[k][1] for k in sorted(hit)]


def test_against_brute_force_in_one_block_and_in_many(spark):
    draw = random.Random(5)
    some = lambda n: " ".join(draw.choices(["a", "B", "é", "x1", "c!", "\n"], k=n))
    items = [(k, some(draw.randint(0, 14))) for k in range(12)] + [(1, None), (None, "a b a b a b"), (2, "a b"), (2, "a b")]
    texts = [(k, some(draw.randint(0, 60)), "n") for k in range(40)] + [(None, None, None), (7, "", ""), (7, "A—b", ""), (7, "A—b", "")]
    documents = spark.createDataFrame(texts, "doc_id long, text string, n_words string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for block in (1_000_000, 150):
        found = contamination(documents, benchmark, width=4, block_chars=block).collect()
        got = sorted((r.doc_id is None, r.doc_id, r.n_words, r.n_hit, r["items"], len(r.spans)) for r in found)
        want = []
        for name, text, _ in texts:
            n, hit, owners, spans = expected(text, items, 4)
            want.append((name is None, name, n, hit, owners))
        assert [g[:5] for g in got] == sorted(want)


def test_spans_are_offsets_of_the_original(spark):
    text = "Ünsinn — The QUICK,brown fox!! ende"
    documents = spark.createDataFrame([(1, text)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(9, "the quick brown fox")], "item_id long, text string")
    (row,) = contamination(documents, benchmark).collect()
    assert [text[s.begin : s.end] for s in row.spans] == ["The QUICK,brown fox"]


def test_empty_tables(spark):
    documents = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:4] for r in contamination(documents, nothing).collect()] == [(1, 2, 0, [])]
    assert contamination(documents.limit(0), nothing).count() == 0
