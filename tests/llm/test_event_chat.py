import hashlib
import random

import pytest

from obsmill.llm.event_chat import Reader, accounts, log_of, messages, rendered, turn, unescaped

AWKWARD = ["\\### Assistant: </turn> ok", "</turn>\n### user: x</turn>\n", "\\", "\\\\", "<", "#", "### ", "####  ", ": ", "", "</turn", ">\n", "é🙂", "a\nb\0"]


def read(pieces):
    reader, out = Reader(), []
    for piece in pieces:
        out += reader.feed(piece)
    reader.close()
    return out


@pytest.mark.parametrize("seed", range(5))
def test_any_turns_read_back(seed):
    draw = random.Random(seed)
    for _ in range(300):
        some = lambda: "".join(draw.choices(AWKWARD, k=draw.randint(0, 5)))
        turns = [(some(), some()) for _ in range(draw.randint(0, 5))]
        made = [turn(*t) for t in turns]
        whole = "".join(m[0] for m in made)
        assert read([whole]) == turns
        cut = draw.randint(0, len(whole))
        assert read([whole[:cut], whole[cut:]]) == turns
        assert [unescaped(m[0][m[1] : m[2]]) for m in made] == [t for _, t in turns]


def test_a_broken_transcript_is_no_transcript():
    with pytest.raises(ValueError):
        read([turn("user", "x")[0][:-1]])
    with pytest.raises(ValueError):
        read(["?" + turn("user", "x")[0]])


LOG = "conversation long, seq long, message string, kind string, role string, text string, begin long, end long, conv_id string"


def test_log_folds_into_messages(spark, rows):
    log = [
        (1, 1, "a", "open", "user", None, None, None),
        (1, 2, "a", "delta", None, "Hel", None, None),
        (1, 3, "a", "delta", None, "lo", None, None),
        (1, 3, "a", "delta", None, "lo", None, None),  # delivered twice
        (1, 4, "b", "delta", None, "before its opening", None, None),
        (1, 5, "b", "open", "assistant", None, None, None),
        (1, 6, "b", "delta", None, "Draft", None, None),
        (1, 7, "b", "regenerate", None, None, None, None),
        (1, 8, "b", "delta", None, "Answer", None, None),
        (1, 9, "a", "edit", None, "J", 0, 1),  # an earlier message
        (1, 10, "b", "edit", None, "!", 6, 99),
        (1, 11, "c", "open", "user", None, None, None),
        (1, 12, "c", "remove", None, None, None, None),
        (1, 13, "d", "open", None, None, None, None),
        (1, 14, "d", "edit", None, "all", None, None),
        (1, 15, "d", "edit", None, "new", None, None),
        (1, 16, "d", "unheard of", None, "?", None, None),
        (1, 17, "d", "open", "late", None, None, None),
        (None, 1, None, "open", "user", None, None, None),
        (None, None, "n", "open", "user", None, None, None),
        (2, 1, "a", "delta", None, "no opening", None, None),
    ]
    random.Random(1).shuffle(log)
    events = spark.createDataFrame([(*e, "x") for e in log], LOG)
    want = [(1, 1, "user", "Jello"), (1, 5, "assistant", "Answer!"), (1, 13, "", "new"), (None, 1, "user", ""), (None, None, "user", "")]
    assert rows(messages(events)) == sorted(want, key=lambda t: [(x is None, str(x)) for x in t])
    assert messages(events.limit(0)).count() == 0


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(table):
    out = {}
    for conv in {r[0] for r in table}:
        said = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in table if r[0] == conv))
        told = [t for *_, role, t in said if role == "assistant"]
        out[conv] = (
            len(said),
            sha("".join(f"{role}\n{text}\n" for *_, role, text in said)),
            sum(map(len, told)),
            sha("".join(told)),
            sum(len(turn(role, text)[0]) for *_, role, text in said),
        )
    return out


def test_accounts_and_transcripts_of_odd_conversations(spark):
    draw = random.Random(3)
    table = []
    for k in range(500):
        conv = 5 if k % 3 == 0 else draw.choice([None, 1, 2, 3, 4])
        text = draw.choice([None, "".join(draw.choices(AWKWARD, k=3)), f"said {k} " * draw.randint(0, 200)])
        table.append((conv, draw.choice([None, *range(-2, 200)]), draw.choice(["user", "assistant", "assistant", None, "a: b"]), text))
    table += table[:20] + [(1, 3, "assistant", "### long " * 20_000)]
    frame = spark.createDataFrame([(*r, 1) for r in table], "conv_id long, turn long, role string, text string, id long")
    finished = messages(log_of(frame.repartition(3)))
    assert finished.count() == len(table)
    assert {r.conversation: tuple(r)[1:] for r in accounts(finished).collect()} == expected(table)
    glued, masked = {}, {}
    for r in sorted(rendered(finished).collect(), key=lambda r: r.number):
        glued[r.conversation] = glued.get(r.conversation, "") + r.formatted
        if r.loss_begin is not None:
            masked.setdefault(r.conversation, []).append((r.loss_begin, r.loss_end))
    for conv, (n, turns, chars, loss, length) in expected(table).items():
        text = glued[conv]
        back = read([text])
        assert (len(back), len(text), sha("".join(f"{a}\n{b}\n" for a, b in back))) == (n, length, turns)
        learned = "".join(unescaped(text[a:b]) for a, b in masked.get(conv, []))
        assert (len(learned), sha(learned)) == (chars, loss)
    empty = frame.limit(0)
    assert accounts(messages(log_of(empty))).count() == 0 == rendered(messages(log_of(empty))).count()


def test_the_made_log_holds_every_kind_of_event(spark):
    frame = spark.createDataFrame([(k, 0, "user", f"text {k} " * 90) for k in range(60)], "conv_id long, turn long, role string, text string")
    log = log_of(frame)
    assert {r[0] for r in log.select("kind").distinct().collect()} == {"open", "delta", "edit", "regenerate", "remove"}
    assert log.filter("kind = 'delta'").count() > 150
