import itertools
import random

from obsmill.llm.token_trie import MARK, Trie, token_counts, vocabulary

PIECES = {MARK: -3.0, "a": -2.0, "b": -2.5, "ab": -2.5, "aba": -6.0, MARK + "a": -3.5, "bb": -4.9, "é": -5.0}


def brute(word, pieces):
    worst = min(pieces.values()) - 10.0
    best = None
    for cuts in itertools.product((0, 1), repeat=len(word) - 1):
        parts, part = [], word[0]
        for c, cut in zip(word[1:], cuts):
            if cut:
                parts.append(part)
                part = c
            else:
                part += c
        parts.append(part)
        if all(p in pieces or len(p) == 1 for p in parts):
            n = [1 if p in pieces else len(p.encode()) for p in parts]
            total = sum(pieces[p] if p in pieces else k * worst for p, k in zip(parts, n))
            if best is None or (round(total, 9), -sum(n)) > best:
                best = (round(total, 9), -sum(n))
    return -best[1]


def test_counts_against_all_segmentations_whatever_the_trie_holds():
    draw = random.Random(2)
    words = [MARK + "".join(draw.choices("abbé€", k=draw.randint(1, 9))) for _ in range(150)]
    for nodes in (10**6, 3):
        trie = Trie(PIECES, nodes)
        assert [trie.count(w) for w in words] == [brute(w, PIECES) for w in words]


def test_long_words_and_rows(spark):
    long = "ab" * 200
    rows = [(1, f"a  ab\n{long}", "x"), (1, f"a  ab\n{long}", "x"), (None, None, None), (2, " ", "y")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = sorted((r.doc_id or 0, r.n_tokens, r.n_pretokens) for r in token_counts(documents, pieces=PIECES).collect())
    one = sum(Trie(PIECES).count(MARK + w) for w in ("a", "ab", long))
    assert found == [(0, 0, 0), (1, one, 3), (1, one, 3), (2, 0, 0)]
    assert token_counts(documents.limit(0), pieces=PIECES).count() == 0
    assert len(vocabulary()) > 30_000
