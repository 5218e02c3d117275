import re

import pytest

from obsmill.llm.private_data import KINDS, detect, private_data, private_spans

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain(text):
    found = {}
    for kind, pattern in PATTERNS.items():
        found[kind] = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits)
                or kind == "phone" and 8 <= len(digits) <= 15
            ):
                found[kind].append(m.span())
    return found


CASES = [
    "", "a@b", "a@b.c@d.e", "@x.y", "..a@b-c.d.e. and q@r.s", "1.2.3.4.5.6.7.8", "300.1.1.1 1.2.3.256 01.002.0.4",
    "4111 1111-1111 1111", "4111  1111 1111 1111", "41111111111111111111111", "4111111111111112", "+49 (30) 123-456", "+1", "+1 ()", "+12.34.56.78",
    "+1-2-3 +44 20 7946 0958 x", "é a.b%c+d@é.com x@y.zé", "1" * 300, "a." * 200 + "@b.c", "x@" * 50 + "y.z", "9.9.9.9.", ".9.9.9.9",
]


@pytest.mark.parametrize("text", CASES)
def test_plain_spans_are_those_of_the_patterns(text):
    assert detect(text) == plain(text)


def test_plain_spans_on_random_texts():
    import random

    draw = random.Random(3)
    for _ in range(3000):
        text = "".join(draw.choices("ab1234567890..@@++-- ()é%", k=draw.randint(0, 60)))
        assert detect(text) == plain(text), text


DISGUISED = [
    ("write to jane (at) mail (dot) example (dot) com now", "email", "jane (at) mail (dot) example (dot) com"),
    ("jane[at]example.com", "email", "jane[at]example.com"),
    ("ask jane.roe at example dot com, please", "email", "jane.roe at example dot com"),
    ("jane@example dot org", "email", "jane@example dot org"),
    ("jаne@exаmple.com", "email", "jаne@exаmple.com"),
    ("ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("ja​ne@example.com", "email", "ja​ne@example.com"),
    ("host 10 dot 20 dot 30 dot 40 up", "ip", "10 dot 20 dot 30 dot 40"),
    ("10[.]20[.]30[.]40", "ip", "10[.]20[.]30[.]40"),
    ("one zero dot two zero dot three dot four", "ip", "one zero dot two zero dot three dot four"),
    ("card four one one one one one one one one one one one one one one one.", "card", "four one one one one one one one one one one one one one one one"),
    ("41l1 1111 1111 l1lI", "card", "41l1 1111 1111 l1lI"),
    ("４１１１１１１１１１１１１１１１", "card", "４１１１１１１１１１１１１１１１"),
    ("call plus four nine three zero one two three four five", "phone", "plus four nine three zero one two three four five"),
]


@pytest.mark.parametrize("text, kind, span", DISGUISED)
def test_disguised_spans_map_back(text, kind, span):
    base, more = private_spans(text)
    assert span in [text[a:b] for a, b in more[kind] + base[kind]]


ALONE = [
    ("card 4111 1111 1111 111 one", "card", "4111 1111 1111 111 one"),
    ("+1 415 555 01 two", "phone", "+1 415 555 01 two"),
    ("plus 49 30 1234567", "phone", "plus 49 30 1234567"),
    ("৪১১১১১১১১১১১১১১১", "card", "৪১১১১১১১১১১১১১১১"),
    ("๑๐.๒๐.๓๐.๔๐", "ip", "๑๐.๒๐.๓๐.๔๐"),
    ("④①①①①①①①①①①①①①①①", "card", "④①①①①①①①①①①①①①①①"),
    ("+⁴⁴ 20 7946 0958", "phone", "+⁴⁴ 20 7946 0958"),
    ("jane﹫example.com", "email", "jane﹫example.com"),
    ("ⓙane@example.com", "email", "ⓙane@example.com"),
    ("jane\t@\texample.com", "email", "jane\t@\texample.com"),
    ("10\tdot\t20\tdot\t30\tdot\t40", "ip", "10\tdot\t20\tdot\t30\tdot\t40"),
    ("jane at example\tdot\tcom", "email", "jane at example\tdot\tcom"),
]


@pytest.mark.parametrize("text, kind, span", [*DISGUISED, *ALONE])
def test_what_is_found_does_not_depend_on_the_rest_of_the_text(text, kind, span):
    around = "None stood alone, someone wrote; often nine or ten gone. ＡＢ (at) the end. "
    for before, after in (("", ""), (around, ""), ("", "; " + around), (around, "; " + around)):
        base, more = private_spans(before + text + after)
        assert span in [(before + text + after)[a:b] for a, b in more[kind] + base[kind]]


def test_letters_that_only_fold_to_ascii_beside_digit_words():
    assert private_spans("fİve sİx eİght nİne one two three four")[1]["card"] == []


@pytest.mark.parametrize(
    "text",
    ["look at the dot on this page", "we met at noon. dot dot dot", "one two three, at home", "a (at) b", "Привет, мир 2024", "stare at polka dot dresses", "point at this point in time"],
)
def test_clean_texts_stay_clean(text):
    assert all(not spans for found in private_spans(text) for spans in found.values())


def test_rows_nulls_repeats_and_other_columns(spark):
    rows = [(1, "a@b.c", "x"), (1, "a@b.c", "x"), (None, None, None), (3, "", "y"), (4, "é jane (at) b.com", None)]
    found = private_data(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()
    by = sorted((r.doc_id or 0, [tuple(s) for s in r.spans]) for r in found)
    assert by == [(0, []), (1, [("email", 0, 5, True)]), (1, [("email", 0, 5, True)]), (3, []), (4, [("email", 2, 17, False)])]
    assert private_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert KINDS == ("email", "ip", "card", "phone")
