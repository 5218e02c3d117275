import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from obsmill.llm import suffix_tree


def test_base_is_exact_and_context_helps(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "FREQUENT", 5)
    draw = random.Random(8)
    rows = []
    for k in range(200):
        words = []
        while len(words) < draw.randint(1, 60):
            words += ["rare", f"u{draw.randint(0, 500)}"] if draw.random() < 0.5 else ["New", "york", "city"]
        rows.append((k, " ".join(words), 1))
    rows += [(200, None, 1), (201, "", 1), (3, "New york", 1), (3, "New york", 1)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, score int")
    split = lambda t: (t or "").lower().split() + [None]
    trains = lambda k: k % 4 != 0
    counts = Counter(w for k, t, _ in rows if trains(k) for w in split(t))
    total, kinds = sum(counts.values()), len(counts)
    found = suffix_tree.score(documents, F.col("doc_id") % 4 != 0).collect()
    want = sorted(
        (k, trains(k), len(split(t)), sum(counts[w] > 0 for w in split(t)), total,
         round(sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in split(t)), 6))
        for k, t, _ in rows
    )
    assert sorted((r.doc_id, r.trained, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == want
    held = [r for r in found if not r.trained]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 100


def test_nothing_to_learn_from(spark):
    documents = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    (row,) = suffix_tree.score(documents, F.lit(False)).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.score) == (3, 0, 0, 0.0)
    assert suffix_tree.score(documents.limit(0), F.lit(True)).count() == 0


def test_a_two_word_context_counts_though_its_last_word_alone_tells_nothing(spark):
    draw = random.Random(5)
    rows = []
    for k in range(600):
        words = []
        for _ in range(25):
            lead = f"l{draw.randint(0, 39)}"
            # After "the" alone any of 40 words comes; the word before tells which.
            words += [lead, "the", f"n{lead}", *(f"r{draw.randint(0, 300)}" for _ in range(3))]
        rows.append((k, " ".join(words)))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    found = [r for r in suffix_tree.score(documents, F.col("doc_id") % 4 != 0).collect() if not r.trained]
    per_lead = sum(r.score - r.base_score for r in found) / (25 * len(found))
    # "the" after a lead and its word are sure, 40 equally likely words before: both are learned.
    assert per_lead > 2.0


def test_gains_held_by_tasks_and_joined_ones_agree(spark, monkeypatch):
    draw = random.Random(9)
    rows = [(k, " ".join(f"w{min(draw.randint(0, 30), draw.randint(0, 30))}" if draw.random() < 0.6 else "x y z" for _ in range(60))) for k in range(200)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    scores = []
    for n in (1 << 17, 3):
        monkeypatch.setattr(suffix_tree, "FREQUENT", n)
        scores.append({r.doc_id: round(r.score, 6) for r in suffix_tree.score(documents, F.col("doc_id") % 3 != 0).collect()})
    assert scores[0] == scores[1]


def brute(texts, trained, depth, least):
    """log10 of each text's probability under the same tree, with plain dictionaries."""
    split = lambda t: [w.lower() for w in (t or "").split()] + [None]
    counts, held = Counter(), Counter()
    for t in trained:
        counts.update(split(t))
        if suffix_tree._held_out(t):
            held.update(split(t))
    scale = sum(counts.values()) + len(counts) + 1
    root = lambda w: (counts[w] + 1) / scale
    learned_root = lambda w: (counts[w] - held[w] + 1) / (scale - sum(held.values()))
    able = {(w,) for w, n in counts.items() if n >= least and w is not None}
    tree, kept, runs_of = [], [], []
    below = lambda context, w: (root(w), learned_root(w))
    d, seen = suffix_tree.DISCOUNT, suffix_tree.SEEN
    for length in range(1, depth + 1):
        runs = {}
        for t in trained:
            words = split(t)
            for k in range(length, len(words)):
                if tuple(words[k - length : k]) in able:
                    n, out = runs.setdefault(tuple(words[k - length : k]), (Counter(), Counter()))
                    n[words[k]] += 1
                    out[words[k]] += suffix_tree._held_out(t)
        if not runs:
            break
        level, bins = {}, Counter()
        for context, (n, out) in runs.items():
            total, own = sum(n.values()), n - out
            learned = sum(own.values())
            rest = 1 - sum(c - d for c in n.values() if c >= seen) / total
            rest_learned = 1 - sum(c - d for c in own.values() if c >= seen) / learned if learned else None
            p, pl, told, learned_told, gain = {}, {}, 0.0, 0.0, 0.0
            for w in n:
                q, ql = below(context[1:], w)
                p[w] = (n[w] - d) / total * (n[w] >= seen) + rest * q
                if n[w] >= seen:
                    told += p[w] * math.log(p[w] / q)
                if learned:
                    pl[w] = (own[w] - d) / learned * (own[w] >= seen) + rest_learned * ql
                    gain += out[w] * math.log(pl[w] / ql) if out[w] else 0.0
                    if own[w] >= seen:
                        learned_told += pl[w] * math.log(pl[w] / ql)
            told += (1 - sum(p[w] for w in n if n[w] >= seen)) * math.log(rest)
            level[context] = (p, pl, told, rest, rest_learned)
            if learned and any(out.values()):
                learned_told += (1 - sum(pl[w] for w in n if own[w] >= seen)) * math.log(rest_learned)
                bins[math.floor(learned_told / suffix_tree.STEP)] += gain
        best, at, total = 0.0, math.inf, 0.0
        for step in sorted(bins, reverse=True):
            total += bins[step]
            if total > best:
                best, at = total, step * suffix_tree.STEP
        tree.append(level)
        runs_of.append(runs)
        kept.append({c for c, (_, _, told, _, _) in level.items() if told >= at})
        below = lambda context, w, level=level: (level[context][0][w], level[context][1].get(w))
        able = {(*c, w) for c, (n, _) in runs.items() for w in n if n[w] >= least and w is not None}
    for k in range(len(kept) - 1, 0, -1):
        kept[k - 1] |= {c[1:] for c in kept[k]}

    def probability(context, w):
        for k in range(len(kept), 0, -1):
            if len(context) >= k and context[-k:] in kept[k - 1]:
                p, _, _, rest, _ = tree[k - 1][context[-k:]]
                n = runs_of[k - 1][context[-k:]][0][w]
                return p[w] if n >= seen else rest * probability(context[-k:][1:], w)
        return root(w)

    out = []
    for t in texts:
        words = split(t)
        out.append(sum(math.log10(probability(tuple(words[max(0, k - depth) : k]), w)) for k, w in enumerate(words)))
    return out, [len(k) for k in kept]


def test_scores_are_those_of_a_plain_tree(spark, monkeypatch):
    draw = random.Random(13)
    rows = []
    for k in range(300):
        words = []
        for _ in range(draw.randint(0, 25)):
            lead = draw.choice("abcd")
            words += [f"l{lead}", "Of", "the", f"n{lead}{draw.randint(0, 1)}"] if draw.random() < 0.6 else [f"r{draw.randint(0, 40)}", "the", f"x{draw.randint(0, 9)}"]
        rows.append((k, " ".join(words)))
    rows += [(300, None), (None, "la of the na0 unseen words of the"), (7, "of the " * 400)]
    documents = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, level string")
    learns = lambda k: k is not None and k % 5 != 2
    for depth, frequent in ((1, 1 << 20), (3, 1 << 20), (3, 4)):
        monkeypatch.setattr(suffix_tree, "FREQUENT", frequent)
        want, sizes = brute([t for _, t in rows], [t for k, t in rows if learns(k)], depth, 6)
        found = suffix_tree.score(documents, F.col("doc_id") % 5 != 2, depth=depth, least=6).collect()
        assert len(sizes) == depth and all(sizes)
        key = lambda r: (str(r[0]), round(r[1], 6))
        assert sorted(map(key, ((r.doc_id, r.score) for r in found))) == sorted(map(key, zip((k for k, _ in rows), want)))


def test_tasks_score_what_the_model_surely_lacks(spark, monkeypatch):
    draw = random.Random(21)
    rows = []
    for k in range(300):
        words = []
        for _ in range(20):
            lead = draw.choice("abcdef")
            # Two fifths of the words after a lead come once only: no model has them after it.
            words += [f"l{lead}", "of", f"n{lead}{draw.randint(0, 1)}" if draw.random() < 0.6 else f"u{draw.randint(0, 10**6)}"]
        rows.append((k, " ".join(words)))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    want, sizes = brute([t for _, t in rows], [t for k, t in rows if k % 4], 2, 6)
    assert all(sizes)
    shipped, write = [], suffix_tree.written

    def watched(frame, name):
        table = write(frame, name)
        if name == "read":
            shipped.append(table.agg(F.sum(F.length("levels"))).first()[0])
        return table

    monkeypatch.setattr(suffix_tree, "written", watched)
    # Tasks hold all; then next to nothing, beside a map of runs that is full.
    for frequent, most in ((1 << 19, 1 << 26), (4, 64)):
        monkeypatch.setattr(suffix_tree, "FREQUENT", frequent)
        monkeypatch.setattr(suffix_tree, "MOST_RUN_BITS", most)
        found = suffix_tree.score(documents, F.col("doc_id") % 4 != 0, least=6).collect()
        assert sorted((r.doc_id, round(r.score, 6)) for r in found) == [(k, round(p, 6)) for (k, _), p in zip(rows, want)]
    assert 20 * shipped[0] < shipped[1]


def test_many_parts_are_merged_in_few_tasks_with_the_same_scores(spark, monkeypatch):
    draw = random.Random(34)
    ending = lambda lead: f"n{lead}{draw.randint(0, 1)}" if draw.random() < 0.6 else f"u{draw.randint(0, 10**6)}"
    rows = [(k, " ".join(f"l{lead} of {ending(lead)}" for lead in draw.choices("abcdef", k=20))) for k in range(300)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    want, sizes = brute([t for _, t in rows], [t for k, t in rows if k % 4], 2, 6)
    assert all(sizes)
    monkeypatch.setattr(suffix_tree, "GROUP", 50)
    # So few are held by tasks that tokens are joined as well.
    monkeypatch.setattr(suffix_tree, "FREQUENT", 4)
    files, write = Counter(), suffix_tree.written

    def watched(frame, name):
        table = write(frame, name)
        files[name] = max(files[name], len(table.inputFiles()))
        return table

    monkeypatch.setattr(suffix_tree, "written", watched)
    found = suffix_tree.score(documents, F.col("doc_id") % 4 != 0, least=6).collect()
    assert sorted((r.doc_id, round(r.score, 6)) for r in found) == [(k, round(p, 6)) for (k, _), p in zip(rows, want)]
    parts = sum(len(t.split()) + 1 for k, t in rows if k % 4) // 50
    most = max(4 * spark.sparkContext.defaultParallelism, parts // 8 + 1)
    assert parts > 5 * most and 0 < files["runs"] <= most and 0 < files["found"] <= most


def test_distinct_words_of_texts():
    texts, values = np.array([1, 0, 1, 255, 1, 0]), np.array([1 << 63, 7 << 20, 1 << 63, 5 << 30, 3 << 40, 7 << 20], np.uint64)
    text, value, times, where = suffix_tree._distinct(texts, values)
    assert list(zip(text, value, times)) == [(0, 7 << 20, 2), (1, 3 << 40, 1), (1, 1 << 63, 2), (255, 5 << 30, 1)]
    assert all(texts[where] == text) and all(values[where] == value)


def test_tokens_that_go_on_find_the_gains_that_tasks_hold(spark, monkeypatch):
    draw = random.Random(55)
    rows = []
    for k in range(300):
        words = []
        for _ in range(20):
            lead = draw.choice("abcdef")
            # After "of" two words are frequent; after a lead and "of" mostly one of them, so that the other goes on to "of".
            words += [f"l{lead}", "of", ("n0" if lead < "d" else "n1") if draw.random() < 0.9 else draw.choice(["n0", "n1", f"u{draw.randint(0, 60)}"])]
        rows.append((k, " ".join(words)))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    want, sizes = brute([t for _, t in rows], [t for k, t in rows if k % 4], 2, 6)
    assert all(sizes)
    nodes, made = [], suffix_tree._found

    def watched(blocks, *args):
        found = made(blocks, *args)
        nodes.append(found)
        return found

    monkeypatch.setattr(suffix_tree, "_found", watched)
    # A map that is full lets all go on by way of the parts; contexts are dealt out in one group, then in many.
    monkeypatch.setattr(suffix_tree, "MOST_RUN_BITS", 64)
    for frequent, group in ((3, 500_000), (8, 500_000), (8, 20), (20, 20)):
        monkeypatch.setattr(suffix_tree, "FREQUENT", frequent)
        monkeypatch.setattr(suffix_tree, "GROUP", group)
        found = suffix_tree.score(documents, F.col("doc_id") % 4 != 0, least=6).collect()
        assert sorted((r.doc_id, round(r.score, 6)) for r in found) == [(k, round(p, 6)) for (k, _), p in zip(rows, want)]
    # What the parts give comes as blocks, not as a row a token: nothing joins tokens one by one.
    assert nodes and all(frame.columns[:2] == ["part", "kind"] for frame in nodes)


def test_runs_and_tokens_leave_tasks_as_few_small_blocks(spark, monkeypatch):
    draw = random.Random(3)
    rows = [(k, " ".join(f"w{int(draw.paretovariate(0.7)) % 3000}" for _ in range(100))) for k in range(1500)]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(suffix_tree, "FREQUENT", 500)
    sizes, write = {}, suffix_tree.written
    deal = suffix_tree._merged

    def merged(runs, below, *args):
        length = F.coalesce(F.length("c0"), F.lit(0)) + sum(F.coalesce(F.length(f"c{k}"), F.lit(0)) for k in range(1, 6))
        sizes[len(sizes)] = (runs.agg(F.sum(length)).first()[0], below.count())
        return deal(runs, below, *args)

    def watched(frame, name):
        table = write(frame, name)
        if name == "read":
            packed = sum(F.length(c) for c in ("levels", "times", "words", "unknown"))
            sizes["token"] = table.agg(F.sum(packed) / F.sum(F.length("levels"))).first()[0]
        return table

    monkeypatch.setattr(suffix_tree, "_merged", merged)
    monkeypatch.setattr(suffix_tree, "written", watched)
    suffix_tree.score(documents, F.col("doc_id") % 3 != 0, least=6).collect()
    tokens = sum(len(t.split()) + 1 for k, t in rows if k % 3)
    # A run of one word and the next: two places, n and held of four bytes each, 32 bytes in all before.
    assert 0 < sizes[0][0] <= 24 * tokens
    # One block a task and part, not one for each thousand rows and part.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert all(blocks <= 64 * parts for _, blocks in (sizes[0], sizes[1]))
    # Level, times and two or three words; 33 bytes at least before.
    assert sizes["token"] < 33


def test_words_are_the_same_wherever_they_stand():
    texts = ["", None, " ", "a", "A a\tb\x0bB\n ", " x", "x ", "\u00e9 \u00c9 \u00e9a", "z" * 600, "Z" * 600 + " " + "z" * 599, "q" * 300_000 + " x a"]
    split = lambda t: [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").replace("\x0b", " ").split(" ")]
    want = [[w for x in split(t) for w in x.split() if w] for t in texts]
    own, text = suffix_tree._together([None if t is None else t.encode() for t in texts])
    found = [own[text == k].tolist() for k in range(len(texts))]
    assert [len(f) for f in found] == [len(w) + 1 for w in want] and all(f[-1] == suffix_tree.END for f in found)
    names = {(w, h) for ws, hs in zip(want, found) for w, h in zip(ws, hs)}
    assert len(names) == len({w for w, _ in names}) == len({h for _, h in names})


def test_places_of_hashes():
    draw = np.random.default_rng(4)
    for n in (0, 1, 3, 5000):
        known = np.unique(suffix_tree.mixed(draw.integers(1, 1 << 40, n)))
        asked = np.concatenate([known, suffix_tree.mixed(draw.integers(1 << 41, 1 << 42, 1000)), np.array([0, 2**64 - 1], np.uint64)])
        places = suffix_tree._places(suffix_tree._indexed(known), asked)
        assert places[: len(known)].tolist() == list(range(len(known))) and (places[len(known) :] == -1).all()
