import random
import re

import numpy as np

from obsmill.llm.overlap_join import divide_skip, near_duplicates, one_of_each


def brute(rows):
    def cut(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()

    sets = [cut(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                root[top(a)] = top(b)
    names = {}
    for k, (name, _) in enumerate(rows):
        names.setdefault(top(k), []).append(name)
    least = lambda k: min((n for n in names[top(k)] if n is not None), default=None)
    return sorted(((rows[k][0], len(sets[k]), least(k)) for k in range(len(rows))), key=str)


def corpus():
    draw = random.Random(11)
    base = [[f"w{draw.randint(0, 4000)}" for _ in range(draw.randint(20, 120))] for _ in range(12)]
    common = [f"c{k}" for k in range(30)]
    rows = []
    for k in range(220):
        words = list(draw.choice(base))
        for _ in range(draw.randint(0, 6)):
            words[draw.randrange(len(words))] = f"x{draw.randint(0, 10**6)}"
        rows.append((1000 - k, " ".join(words + common * (k % 3 == 0))))
    chain = [f"d{k}" for k in range(60)]
    rows += [(2000 + k, " ".join(chain[k : k + 40])) for k in range(0, 20, 2)]
    rows += [(5, None), (6, ""), (7, " \t"), (8, "one two"), (9, "ONE  two"), (10, "one two three"), (None, "one two")]
    rows += [(11, "a b c d e"), (11, "a b c d e"), (12, "A B C D E"), (13, "a b c d e f"), (None, "zz")]
    return rows


def test_against_brute_force_whole_and_in_chunks(spark):
    rows = corpus()
    documents = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, set_id string")
    for chunk in (400_000, 300):
        found = near_duplicates(documents, chunk=chunk).collect()
        assert sorted(map(tuple, found), key=str) == brute(rows)


def test_one_of_each_component_stays(spark):
    rows = [r for r in corpus() if r[0] is not None]
    documents = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, set_id string")
    kept = one_of_each(documents)
    assert kept.columns == documents.columns
    want = sorted({(name, n, c) for name, n, c in brute(rows) if n and name == c} | {(5, 0, 5), (6, 0, 6), (7, 0, 7)})
    assert sorted(r.doc_id for r in kept.collect()) == [w[0] for w in want]
    assert near_duplicates(documents.limit(0)).count() == 0


def one_a_component(rows):
    """What one_of_each must keep, as (doc_id, words): one row a component, and the wordless rows."""
    named = [(k, " ".join((t or "").lower().split())) for k, t in rows]
    # Each row under an identifier of its own, so that components are known row by row.
    parts = {}
    for (k, own), (_, _, c) in zip(named, sorted(brute([(n, t) for n, (_, t) in enumerate(rows)]), key=lambda r: r[0])):
        if own:
            parts.setdefault(c, []).append((k is None, k or 0))
    return sorted(min(p) for p in parts.values()), sorted(str(k) for k, own in named if not own)


def test_repeated_and_null_identifiers_are_decided_row_by_row(spark):
    words = lambda tag, n=60: [f"{tag}{k}" for k in range(n)]
    near = lambda own: " ".join([*own[:-1], "other"])
    a, b, c = words("a"), words("b"), words("c")
    rows = [(3, " ".join(a)), (7, near(a)), (7, " ".join(b))]
    rows += [(None, near(b)), (None, " ".join(c)), (None, "quite on its own"), (None, " "), (None, None)]
    rows += [(20, "first text of this number"), (20, "second text under the same one"), (20, "First  text of this number"), (21, " ".join(words("d")))]
    rows += [(20, ""), (30, " ".join(words("e"))), (30, near(words("e"))), (31, " ".join(words("e")))]
    rows += corpus()
    documents = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, _key string")
    kept = one_of_each(documents)
    assert kept.columns == documents.columns
    assert {r["_key"] for r in kept.collect()} == {"n"}
    got = [(r.doc_id, r.text) for r in kept.collect()]
    worded, wordless = one_a_component(rows)
    assert sorted((k is None, k or 0) for k, t in got if (t or "").split()) == worded
    assert sorted(str(k) for k, t in got if not (t or "").split()) == wordless
    texts = [(k, t) for k, t in got]
    assert {(3, " ".join(a)), (7, " ".join(b)), (None, " ".join(c)), (None, "quite on its own")} <= set(texts)
    assert {t for k, t in texts if k == 20} == {"First  text of this number", "second text under the same one", ""}
    # No two kept rows are near copies.
    left = [(n, t) for n, (_, t) in enumerate(got)]
    assert all(n == c for n, size, c in brute(left) if size)


def joined(nodes, links):
    root = list(range(nodes))
    for a, b in links:
        old, new = max(root[a], root[b]), min(root[a], root[b])
        root = [new if r == old else r for r in root]
    return root


def test_search_joins_what_all_pairs_join():
    draw = np.random.default_rng(5)
    link = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b))
    for _ in range(60):
        base = [draw.integers(0, 300, 40) for _ in range(4)]
        sets = []
        for _ in range(30):
            own = base[draw.integers(4)].copy()
            changed = draw.integers(0, 40, draw.integers(0, 9))
            own[changed] = draw.integers(300, 400, len(changed))
            sets.append(np.unique(own[: draw.integers(1, 41)] if draw.random() < 0.2 else own).astype(np.uint64))
        pairs = [(a, b) for a in range(30) for b in range(a) if link(sets[a], sets[b])]
        assert joined(30, divide_skip(sets, sets, True)) == joined(30, pairs)
        index, queries = sets[:14], sets[14:]
        pairs = [(14 + a, b) for a in range(16) for b in range(14) if link(queries[a], index[b])]
        assert joined(30, divide_skip(queries, index, False)) == joined(30, pairs)
