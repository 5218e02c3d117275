import hashlib
import heapq
import random
import zlib

import pytest

from obsmill.llm.turn_repair import ENDING, START, before_all, damaged, ending, rebuilt, repair, report, runs, symbol, transition, unroll, applied

SPACE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit, turns) by a search over all edits, cheapest and ASCII-least first."""
    heap = [(0, "", 0, "", ())]
    done = set()
    while heap:
        cost, audit, k, initials, turns = heapq.heappop(heap)
        tail = initials[-1:]
        # What may follow depends on the last initial alone, so the first arrival there is the best.
        if (k, tail) in done:
            continue
        done.add((k, tail))
        if k == len(rows) and tail in ("", "a"):
            return cost, audit, list(turns)
        told = "a" if tail == "u" else "u"
        name = {"u": "user", "a": "assistant"}[told]
        heapq.heappush(heap, (cost + 3, audit + "I", k, initials + told, (*turns, f"{name}:")))
        if k < len(rows):
            role, text, fault = rows[k]
            heapq.heappush(heap, (cost + 4, audit + "D", k + 1, initials, turns))
            more = 3 if fault == "truncated" else 0
            if fault in ("blank", "duplicate"):
                continue
            heapq.heappush(heap, (cost + 3 + more, audit + "R", k + 1, initials + told, (*turns, f"{name}:{text}")))
            if role[:1] == told or role[:1] == "s" and not initials:
                heapq.heappush(heap, (cost + more, audit + "K", k + 1, initials + role[:1], (*turns, f"{role}:{text}")))


def expected(table, damage=True):
    """The contract's rows, one conversation after the other."""
    out = {}
    for conv in {r[0] for r in table}:
        rows = []
        for _, turn, role, text in [r for r in table if r[0] == conv]:
            role, text = (" " if v is None else v for v in (role, text))
            key = ":".join(" " if v is None else str(v) for v in (conv, turn))
            kind = zlib.crc32(key.encode()) % 20 if damage else 19
            if kind == 0:
                continue
            text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
            rows += [(turn is not None, turn or 0, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        rows.sort()
        seen, judged, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in rows:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            judged.append((role, text, fault))
            if fault:
                counts[fault] += 1
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(judged, judged[1:])]
        turns = {r[1] for r in rows if r[0]}
        cost, audit, repaired = cheapest(judged)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *counts.values(),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(repaired).encode()).hexdigest(),
        )
    return out


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def told(frame):
    rows = frame.collect()
    assert len({r.conversation for r in rows}) == len(rows)
    return {r.conversation: tuple(r[c] for c in NAMES) for r in rows}


def test_equal_symbols_are_one_run():
    assert runs("uuaU--") == [("u", 2), ("a", 1), ("U", 1), ("-", 2)] and runs("") == []
    assert [symbol("u", 0), symbol("", 0), symbol("s", 1), symbol("t", 2), symbol("a", 3)] == ["u", "o", "-", "-", "A"]


@pytest.mark.parametrize("seed", range(6))
def test_edits_are_the_cheapest_and_least(seed):
    draw = random.Random(seed)
    for _ in range(150):
        rows = []
        for _ in range(draw.randint(0, 9)):
            rows += [(draw.choice(["user", "assistant", "system", "tool", ""]), str(len(rows)), draw.choice([0, 0, 0, 1, 3]))] * draw.choice([1, 1, 3])
        signs = "".join(symbol(r[:1], f) for r, _, f in rows)
        faults = {0: "", 1: "blank", 3: "truncated"}
        cost, audit, turns = cheapest([(r, t, faults[f]) for r, t, f in rows])
        letters, state = unroll(signs, START, ENDING)
        assert (before_all(signs, ENDING)[START], letters + ending(state)) == (cost, audit)
        assert [f"{r}:{t}" for r, t in rebuilt([(r, t) for r, t, _ in rows], audit, START)] == turns
        cut = draw.randint(0, len(signs))
        assert applied(transition(signs[:cut]), before_all(signs[cut:], ENDING)) == before_all(signs, ENDING)


def test_long_runs_take_binary_powers():
    assert before_all("u" * 100_001 + "a", ENDING)[START] == 3 * 50_000  # every second one changes its role
    letters, state = unroll("s" * 3_000, START, ENDING)
    assert len(letters.replace("I", "")) == 3_000 and state is not None


def messy(draw, n):
    texts = ["Yes.", "no", "", None, "  \t", "Why?", "Because it is so!", "one. two", "\x0b", "a.\n", "é?"]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "usr"]
    convs = [None, 1, 2, 3, *range(10, 40)]
    hot = 1
    rows = []
    for k in range(n):
        conv = hot if k % 3 == 0 else draw.choice(convs)
        turn = None if draw.random() < 0.05 else draw.randint(-3, n // 8 if conv == hot else 9)
        rows.append((conv, turn, draw.choice(roles), draw.choice(texts) if draw.random() < 0.5 else f"Text {draw.randint(0, 200)}."))
    return rows + rows[:15]


@pytest.mark.parametrize("segment", [30, 4_000_000])
def test_report_equals_the_contract(spark, segment):
    table = messy(random.Random(segment), 400)
    frame = spark.createDataFrame([(*r, "x") for r in table], "conv_id long, turn long, role string, text string, copies string")
    found = report(repair(damaged(frame.repartition(3)), copies="copies", segment=segment))
    assert told(found) == expected(table)


def test_hot_conversation_is_cut_and_parts_are_real_turns(spark):
    table = [(7, k, "user" if k % 2 else "assistant", f"{k} said.") for k in range(300)] + [(8, 1, "user", "Hello.")]
    frame = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    parts = repair(frame, segment=200).collect()
    hot = sorted((r for r in parts if r.conversation == 7), key=lambda r: r.part)
    assert len(hot) > 10 and {r.parts for r in hot} == {len(hot)} and [r.part for r in hot] == list(range(len(hot)))
    turns = [t for r in hot for t in r.rows]
    assert [t.role[:1] for t in turns] == ["u", "a"] * (len(turns) // 2)
    assert {k: v[5:7] for k, v in told(report(repair(frame, segment=200))).items()} == {
        k: v[5:7] for k, v in expected(table, damage=False).items()
    }


def test_equal_rows_clashing_columns_and_empty_tables(spark):
    same = [(None, None, "user", "Same.")] * 500 + [(1, 1, "user", "x" * 200_000 + ".")] * 2
    frame = spark.createDataFrame([(*r, 1, "n") for r in same], "conv_id long, turn long, role string, text string, part long, name string")
    found = told(report(repair(frame.repartition(5), segment=100)))
    assert found == expected(same, damage=False) and found[None][2] == 499
    shape = "conv_id long, turn long, role string, text string"
    assert report(repair(damaged(spark.createDataFrame([], shape)), copies="copies")).count() == 0
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(gone, 0, "user", "Hi.")], shape)
    assert told(report(repair(damaged(frame), copies="copies"))) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
