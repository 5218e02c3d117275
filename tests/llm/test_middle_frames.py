import hashlib
import random
import re

import pytest

from obsmill.llm.middle_frames import Frames, Plan, drawn, fill_in_middle, framed, output, pack, plan, restored, selected

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)
ALPHABET = ["a", "Zz", "word", "é", "ſ", "K", " ", "\n", "\0", "<", "P", ">", "S", "M", "<P", "🙂", "İ", "["]


def expected(doc_id, text):
    """The contract's row, plainly."""
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    form = "plain" if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90 else "spm" if h4 % 100 < 20 else "psm"
    made = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    lengths = (None, None) if form == "plain" else (len(p), len(m))
    return (doc_id, len(units), form, *lengths, made, text)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50, 100_000])
def test_frames_read_cut_and_restore(size):
    draw = random.Random(size)
    for k in range(300):
        text = "".join(draw.choices(ALPHABET, k=draw.randint(0, 60)))
        held = Frames(pack(text, size))
        units = UNIT.findall(text)
        assert held.units[-1] == len(units) and held.chars[-1] == len(text)
        assert [held.offset(u) for u in range(len(units) + 1)] == [len("".join(units[:u])) for u in range(len(units) + 1)]
        a, b = sorted(draw.randint(0, len(text)) for _ in range(2))
        assert "".join(held.read(a, b)) == text[a:b]
        _, n, form, prefix, middle, made, _ = expected(k, text)
        how = plan(held, drawn(k))
        assert (how.form, how.begin) == (form, prefix) and (how.end is None or how.end - how.begin == middle)
        assert "".join(output(held, how)) == made
        assert "".join(restored(iter(made), form, size)) == text
        assert "".join(restored(output(held, how), form, size)) == text


def test_marks_across_frames_and_cut_marks():
    for size in (1, 2, 3):
        assert Frames(pack("x<<S>y", size)).holds(("<P>", "<S>")) and not Frames(pack("<<S<P", size)).holds(("<P>", "<S>"))
    held = Frames(pack("a<S<M<P", 2))
    for begin in range(8):
        for end in range(begin, 8):
            for form in ("psm", "spm"):
                made = "".join(output(held, Plan(form, begin, end)))
                assert "".join(restored(iter([made[:5], made[5:]]), form, 2)) == "a<S<M<P"


def test_a_cut_opens_one_frame_only():
    held = Frames(pack("word " * 100_000, 1_000))
    assert held.offset(123_457) == 308_644 and held.opened == 1
    assert "".join(held.read(5_000, 5_010)) == "word word " and held.opened == 2


def test_every_row_equals_the_contract(spark):
    draw = random.Random(9)
    texts = [None, "", "a", "é", "<P>", "no <M> mark", "A" * 100_000, "long text, " * 30_000, "x" * 32_768 + ". y", "🙂" * 70_000]
    texts += ["".join(draw.choices(ALPHABET, k=draw.randint(0, 400))) for _ in range(200)]
    rows = [(k if k % 40 else None, t, "psm", b"") for k, t in enumerate(texts)] + [(3, "é", "spm", b"")] * 2
    documents = spark.createDataFrame(rows, "doc_id long, text string, form string, frames binary")
    frames = framed(documents)
    found = fill_in_middle(frames).collect()
    want = [expected(r[0], r[1]) for r in rows]
    key = lambda r: tuple(map(str, r))
    assert sorted([(*tuple(r)[:5], r.output) for r in found], key=key) == sorted([w[:6] for w in want], key=key)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted((str(r.doc_id), r.output_sha256, r.restored_sha256) for r in found) == sorted((str(w[0]), sha(w[5]), sha(w[6])) for w in want)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert fill_in_middle(framed(documents.limit(0)), text=False).count() == 0


def test_stored_frames_are_read_in_part(spark, tmp_path):
    documents = spark.createDataFrame([(1, "one two three. " * 9_000), (2, "b")], "doc_id long, text string")
    framed(documents, size=512).write.parquet(str(tmp_path / "frames"))
    stored = spark.read.parquet(str(tmp_path / "frames"))
    ranges = spark.createDataFrame([(1, 70_000, 70_004), (2, 0, 99), (1, 9, 3), (None, 0, 1)], "doc_id long, begin long, end long")
    found = {(r.doc_id, r.begin): r.selected for r in selected(stored, ranges).collect()}
    units = UNIT.findall("one two three. " * 9_000)
    assert found == {(1, 70_000): "".join(units[70_000:70_004]), (2, 0): "b", (1, 9): ""}
