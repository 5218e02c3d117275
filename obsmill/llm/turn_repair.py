"""Conversation structure repair: run-length dynamic programming over a min-plus semiring.

A repaired conversation has the role initials `(s?(ua)+)?`. Rows become symbols (role initial and
fault), equal consecutive symbols a run. A symbol's edits are a 4 x 4 min-plus matrix over the states
of that grammar, a run of n rows its n-th power, put together from cached binary powers.

Matrices are associative, so a conversation needn't meet in one task: rows are dealt out by ranges of
(conversation, turn), each task sums up its own segment in one matrix, the matrices of a cut
conversation are chained from the back, and each segment then unrolls its choices by itself.
"""

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from obsmill.llm.shared import TEXT_SPACE
from obsmill.operators.joins import salted_join
from obsmill.sinks.paths import written

#: States: nothing written yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
FAR = 1 << 60
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: What the grammar writes next in a state, and the state after that.
NEXT = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
NAMES = {"u": "user", "a": "assistant"}
LEGAL = frozenset(("su", "ua", "au"))
#: Faults of a row, the first that holds.
SOUND, BLANK, DUPLICATE, CUT = range(4)
#: Characters of one segment; a longer conversation is handed on in several.
SEGMENT = 4_000_000

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def symbol(initial: str, fault: int) -> str:
    """What the edits of a row depend on: `-` if it must go, else its initial, upper-case if truncated."""
    if fault in (BLANK, DUPLICATE):
        return "-"
    known = initial if initial in ("s", "u", "a") else "o"
    return known.upper() if fault == CUT else known


@cache
def edits(sign: str) -> list[tuple[str, int, dict[int, int]]]:
    """(letter, cost, state to state) of a row's edits, in ASCII order."""
    every = [("D", DELETE, {q: q for q in range(4)})]
    if sign == "-":
        return every
    more = TRUNCATED if sign.isupper() else 0
    initial = sign.lower()
    kept = {q: state for q, (role, state) in NEXT.items() if role == initial}
    if initial == "s":
        kept = {START: SYSTEM}
    every.append(("K", KEEP + more, kept))
    every.append(("R", REROLE + more, {q: state for q, (_, state) in NEXT.items()}))
    return every


def times(a: Matrix, b: Matrix) -> Matrix:
    columns = tuple(zip(*b))
    return tuple(tuple(min(min(x + y for x, y in zip(row, column)), FAR) for column in columns) for row in a)


def applied(a: Matrix, v: Vector) -> Vector:
    return tuple(min(min(x + y for x, y in zip(row, v)), FAR) for row in a)


UNIT: Matrix = tuple(tuple(0 if p == q else FAR for q in range(4)) for p in range(4))


def _inserts() -> Matrix:
    """Cheapest inserts from state to state: closed after three, for four states."""
    one = [list(row) for row in UNIT]
    for q, (_, state) in NEXT.items():
        one[q][state] = min(one[q][state], INSERT)
    once = tuple(map(tuple, one))
    return times(once, times(once, once))


INSERTS = _inserts()
#: Costs to an accepted end without further rows.
ENDING: Vector = applied(INSERTS, tuple(0 if q in ACCEPTED else FAR for q in range(4)))


@cache
def power(sign: str, k: int) -> Matrix:
    """Transition of 2 ** k rows of one symbol, each with the inserts before it."""
    if k:
        half = power(sign, k - 1)
        return times(half, half)
    one = [[FAR] * 4 for _ in range(4)]
    for _, cost, moves in edits(sign):
        for q, state in moves.items():
            one[q][state] = min(one[q][state], cost)
    return times(INSERTS, tuple(map(tuple, one)))


def runs(signs: str) -> list[tuple[str, int]]:
    out: list[tuple[str, int]] = []
    for sign in signs:
        if out and out[-1][0] == sign:
            out[-1] = (sign, out[-1][1] + 1)
        else:
            out.append((sign, 1))
    return out


def before(sign: str, n: int, after: Vector) -> Vector:
    """Costs to the end from before a run, given those from after it."""
    for k in range(n.bit_length()):
        if n >> k & 1:
            after = applied(power(sign, k), after)
    return after


def before_all(signs: str, after: Vector) -> Vector:
    for sign, n in reversed(runs(signs)):
        after = before(sign, n, after)
    return after


def transition(signs: str) -> Matrix:
    """The matrix of a whole segment."""
    out = UNIT
    for sign, n in runs(signs):
        for k in range(n.bit_length()):
            if n >> k & 1:
                out = times(out, power(sign, k))
    return out


def _step(sign: str, state: int, after: Vector) -> tuple[str, int]:
    """The ASCII-least cheapest edits of one row, with the inserts before it, and the next state."""
    here = applied(power(sign, 0), after)
    letters = ""
    while True:
        told = NEXT[state][1]
        if DELETE + after[state] == here[state]:
            return letters + "D", state
        if INSERT + here[told] == here[state]:
            letters, state = letters + "I", told
            continue
        for letter, cost, moves in edits(sign)[1:]:
            if state in moves and cost + after[moves[state]] == here[state]:
                return letters + letter, moves[state]
        raise AssertionError("costs to the end don't belong to these rows")


def _unrolled(sign: str, n: int, state: int, after: Vector, out: list[str]) -> int:
    """Adds the letters of a run to `out`; the costs inside the run come from binary powers."""
    if n == 1:
        letters, state = _step(sign, state, after)
        out.append(letters)
        return state
    k = (n - 1).bit_length() - 1
    state = _unrolled(sign, n - (1 << k), state, applied(power(sign, k), after), out)
    return _unrolled(sign, 1 << k, state, after, out)


def unroll(signs: str, state: int, after: Vector) -> tuple[str, int]:
    """Audit letters of a segment that is entered in `state`, and the state it is left in."""
    parts = runs(signs)
    costs = [after]
    for sign, n in reversed(parts):
        costs.append(before(sign, n, costs[-1]))
    out: list[str] = []
    for k, (sign, n) in enumerate(parts):
        state = _unrolled(sign, n, state, costs[len(parts) - 1 - k], out)
    return "".join(out), state


def ending(state: int) -> str:
    """Inserts that an end in `state` needs."""
    out = ""
    while state not in ACCEPTED:
        out, state = out + "I", NEXT[state][1]
    return out


def rebuilt(rows: list[tuple[str, str]], audit: str, state: int) -> list[tuple[str, str]]:
    """The turns that the edits of `audit` make of `rows`."""
    out, k = [], 0
    for letter in audit:
        told, after = NEXT[state]
        if letter == "I":
            out.append((NAMES[told], ""))
        elif letter == "R":
            out.append((NAMES[told], rows[k][1]))
        elif letter == "K":
            out.append(rows[k])
            after = SYSTEM if state == START and rows[k][0][:1] == "s" else after
        if letter != "D":
            state = after
        if letter != "I":
            k += 1
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and `copies` of every row after the damage of the contract.

    A dropped row stays with 0 copies, so that its conversation is still reported; a repeated one
    has 2. Nulls of role, text and the key are one space; conv_id and turn themselves stay null.
    """
    key = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *key).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


class _Segment:
    """Consecutive rows of one conversation, as one task sees them."""

    def __init__(self, conversation):
        self.conversation = conversation
        self.rows: list[tuple[str, str]] = []
        self.signs: list[str] = []
        self.size = 0
        self.faults = [0, 0, 0, 0]
        self.illegal = 0
        self.turns = 0
        self.least = self.most = None

    def add(self, turn, role: str, text: str, copies: int, repeated: bool) -> None:
        for copy in range(copies):
            worded = text.rstrip(TEXT_SPACE)
            if not worded:
                fault = BLANK
            elif repeated or copy:
                fault = DUPLICATE
            else:
                fault = SOUND if worded[-1] in ".!?" else CUT
            if self.rows and self.rows[-1][0][:1] + role[:1] not in LEGAL:
                self.illegal += 1
            if turn is not None and (self.most is None or turn != self.most):
                self.turns += 1
                self.least = turn if self.least is None else self.least
                self.most = turn
            self.faults[fault] += 1
            self.signs.append(symbol(role[:1], fault))
            self.rows.append((role, text))
            self.size += len(role) + len(text) + 1


_TURN = pa.struct([("role", pa.string()), ("text", pa.string())])
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns", "least", "most")


def _segments(limit: int, conversation: pa.DataType):
    """Task function: sorted rows to segments; a conversation that is seen from end to end is done.

    The first and the last conversation of a task may go on elsewhere. They stay open, as does
    one longer than `limit` characters.
    """
    schema = pa.schema(
        [("conversation", conversation), ("part", pa.int64()), ("number", pa.int64()), ("signs", pa.string()),
         ("matrix", pa.list_(pa.int64())), ("first", pa.string()), ("last", pa.string()), ("cost", pa.int64()),
         ("audit", pa.string()), ("rows", pa.list_(_TURN)), *[(c, pa.int64()) for c in _COUNTS]]
    )

    def row(s: _Segment, part: int, number: int, shut: bool) -> dict:
        signs = "".join(s.signs)
        out = {
            "conversation": s.conversation, "part": part, "number": number, "signs": signs, "blank": s.faults[BLANK],
            "duplicate": s.faults[DUPLICATE], "truncated": s.faults[CUT], "illegal": s.illegal, "turns": s.turns,
            "least": s.least, "most": s.most,
            "first": s.rows[0][0][:1] if s.rows else None, "last": s.rows[-1][0][:1] if s.rows else None,
        }
        turns = s.rows
        if shut:
            audit, state = unroll(signs, START, ENDING)
            audit += ending(state)
            turns = rebuilt(turns, audit, START)
            out |= {"audit": audit, "cost": before_all(signs, ENDING)[START]}
        else:
            out["matrix"] = [x for line in transition(signs) for x in line]
        return out | {"rows": [{"role": r, "text": t} for r, t in turns]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held = None
        number, border = 0, True
        for batch in batches:
            out, size = [], 0
            for conv, *values in zip(*(c.to_pylist() for c in batch.columns)):
                if held is not None and (held.conversation != conv or held.size >= limit):
                    goes_on = held.conversation == conv
                    out.append(row(held, part, number, shut=not (border or goes_on)))
                    size += held.size
                    # What a cut conversation leaves open its later segments leave open as well.
                    border, number = goes_on, number + 1
                    held = None
                    if size >= limit:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, size = [], 0
                held = held or _Segment(conv)
                held.add(*values)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if held is not None:
            yield pa.RecordBatch.from_pylist([row(held, part, number, shut=False)], schema)

    return run


def _chained(segments: list[dict]) -> list[Vector]:
    """Costs to the end from after each of a conversation's segments."""
    after, out = ENDING, []
    for s in reversed(segments):
        out.append(after)
        flat = s["matrix"]
        after = applied(tuple(tuple(flat[4 * q : 4 * q + 4]) for q in range(4)), after)
    return out[::-1]


def _walked(segments: list[dict]) -> tuple[list[int], int]:
    """The state in which each segment is entered, and the one at the end."""
    state, out = START, []
    for s in segments:
        out.append(state)
        state = s["left"][state]
    return out, state


def _summed(segments: list[dict]) -> dict:
    """Counts of a whole conversation; a pair or a turn across a border counts once."""
    out = {c: sum(s[c] for s in segments) for c in ("blank", "duplicate", "truncated", "illegal", "turns")}
    last = most = None
    least = None
    for s in segments:
        if s["first"] is not None:
            out["illegal"] += last is not None and last + s["first"] not in LEGAL
            last = s["last"]
        if s["most"] is not None:
            out["turns"] -= most is not None and most == s["least"]
            least, most = s["least"] if least is None else least, s["most"]
    return out | {"gaps": 0 if most is None else most - least + 1 - out["turns"]}


def _in_order(segments: list[dict]) -> list[dict]:
    return sorted(segments, key=lambda s: (s["part"], s["number"]))


_REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair(
    conversations: DataFrame,
    conversation: str = "conv_id",
    order: str = "turn",
    role: str = "role",
    text: str = "text",
    copies: str | None = None,
    segment: int = SEGMENT,
) -> DataFrame:
    """Cheapest edits that bring every conversation to role initials `(s?(ua)+)?`, and its new turns.

    Returns conversation, the number of its `parts` (1, and more for one that spans tasks or is longer
    than `segment` characters), `part` from 0, for the whole conversation gaps, blank, duplicate,
    truncated, illegal and cost, and of the part its letters (`audit`) and its turns (`rows`).
    `copies` names a column that says how often a row stands there, 0 for none.

    Rows are taken by `order`, an integer (nulls first), then role, the text's first 64 characters and a digest. Null
    roles and texts are one space; a null conversation is one of its own; equal rows are interchangeable, all but
    the first are duplicates; a conversation without rows has zeros and an empty audit; an empty table
    gives no rows. Further columns are not read. Among equally cheap edits the ASCII-least letters win.

    No group meets in one task: ranges of (conversation, turn, ...) are dealt out, an index per row
    splits equal ones, and of a cut conversation only a 16-number matrix a segment is brought together.
    """
    told = conversations.select(
        F.col(conversation).alias("conversation"),
        F.col(order).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        (F.col(copies) if copies else F.lit(1)).cast("int").alias("copies"),
        F.monotonically_increasing_id().alias("id"),
    )
    key = F.coalesce(F.col("conversation").cast("string"), F.lit(""))
    marks = [F.col("conversation").isNull().cast("string"), F.length(key), F.length("role"), key, "role", "text"]
    told = told.withColumn("name", F.unhex(F.md5(F.concat_ws("|", *marks))))
    present = told.filter("copies > 0")
    several = written(
        present.groupBy("name")
        .agg(F.count("*").alias("n"), F.min(F.struct("turn", "id")).alias("earliest"))
        .filter("n > 1")
        .select("name", F.col("earliest.id").alias("earliest")),
        "repeated",
    )
    marked = salted_join(told, several, ["name"], ["id"], "left")
    repeated = F.coalesce(F.col("earliest") != F.col("id"), F.lit(False)).alias("repeated")
    keys = ["conversation", "turn", F.left("role", F.lit(64)), F.left("text", F.lit(64)), "name", "id"]
    kind = told.schema["conversation"].dataType
    shape = (
        f"conversation {kind.simpleString()}, part long, number long, signs string, matrix array<long>, first string, "
        "last string, cost long, audit string, rows array<struct<role:string,text:string>>, "
        + ", ".join(f"{c} long" for c in _COUNTS)
    )
    dealt = marked.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = dealt.select("conversation", "turn", "role", "text", "copies", repeated)
    segments = written(dealt.mapInArrow(_segments(segment, to_arrow_type(kind)), shape), "segments")
    done = segments.filter("audit is not null").select(
        "conversation",
        F.lit(1).cast("long").alias("parts"),
        F.lit(0).cast("long").alias("part"),
        F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps"),
        *_REPORT[1:],
        "audit",
        "rows",
    )
    return done.unionByName(_joined(segments.filter("audit is null"), shape))


def _joined(open_segments: DataFrame, shape: str) -> DataFrame:
    """The conversations at the borders of tasks, from the matrices of their segments."""
    slim = F.struct("part", "number", "matrix", "first", "last", *_COUNTS)
    named = open_segments.withColumn(
        "name", F.coalesce(F.concat(F.lit("="), F.col("conversation").cast("string")), F.lit("-"))
    )

    @F.udf("array<struct<part:long,number:long,after:array<long>>>")
    def chain(segments):
        rows = _in_order([s.asDict() for s in segments])
        return [(s["part"], s["number"], list(v)) for s, v in zip(rows, _chained(rows))]

    ends = (
        named.groupBy("name")
        .agg(F.collect_list(slim).alias("all"))
        .select("name", F.explode(chain("all")).alias("e"))
        .select("name", "e.part", "e.number", "e.after")
    )

    @F.udf("struct<audits:array<string>,left:array<int>>")
    def choices(signs, after):
        audits, left = [], []
        for state in range(4):
            reached = before_all(signs, tuple(after))[state] < FAR
            letters, state = unroll(signs, state, tuple(after)) if reached else (None, 0)
            audits.append(letters)
            left.append(state)
        return audits, left

    unrolled = written(
        named.join(ends, ["name", "part", "number"]).withColumn("choice", choices("signs", "after")), "unrolled"
    )
    report = "array<struct<part:long,number:long,entered:int,place:long,parts:long,end:int>>"

    @F.udf(f"struct<segments:{report},{','.join(f'{c}:long' for c in _REPORT)}>")
    def walk(segments):
        rows = _in_order([s.asDict() for s in segments])
        entered, end = _walked(rows)
        cost = applied(tuple(tuple(rows[0]["matrix"][4 * q : 4 * q + 4]) for q in range(4)), tuple(rows[0]["after"]))
        counts = _summed(rows) | {"cost": cost[START]}
        listed = [
            (s["part"], s["number"], q, k, len(rows), end if k == len(rows) - 1 else None)
            for k, (s, q) in enumerate(zip(rows, entered))
        ]
        return (listed, *[int(counts[c]) for c in _REPORT])

    slim = F.struct("part", "number", "matrix", "after", F.col("choice.left").alias("left"), "first", "last", *_COUNTS)
    walked = (
        unrolled.groupBy("name")
        .agg(F.collect_list(slim).alias("all"))
        .select("name", walk("all").alias("w"))
        .select("name", *[f"w.{c}" for c in _REPORT], F.explode("w.segments").alias("s"))
        .select("name", *_REPORT, "s.*")
    )

    @F.udf("struct<audit:string,rows:array<struct<role:string,text:string>>>")
    def build(audits, entered, end, rows):
        audit = audits[entered] + (ending(end) if end is not None else "")
        return audit, rebuilt([(r["role"], r["text"]) for r in rows], audit, entered)

    kept = unrolled.select("name", "part", "number", "conversation", "choice", "rows")
    return (
        kept.join(walked, ["name", "part", "number"])
        .withColumn("built", build("choice.audits", "entered", "end", "rows"))
        .select("conversation", "parts", F.col("place").alias("part"), *_REPORT, "built.audit", "built.rows")
    )


def lines(rows: Column) -> Column:
    return F.concat_ws("\n", F.transform(rows, lambda r: F.concat(r["role"], F.lit(":"), r["text"])))


def report(repaired: DataFrame) -> DataFrame:
    """One row per conversation of `repair`: its counts, audit and the digest of its new turns.

    Digests of conversations of one part are taken where the row lies. Those of cut ones are brought
    together, and hashed part by part in order: SHA-256 has no other way than one after the other.
    """
    whole = repaired.filter("parts = 1").select(
        "conversation", *_REPORT, "audit", F.sha2(lines(F.col("rows")), 256).alias("repaired_sha256")
    )
    cut = repaired.filter("parts > 1").select(
        "conversation", "part", "parts", *_REPORT, "audit", F.size("rows").alias("n"), lines(F.col("rows")).alias("block")
    )
    ordered = cut.repartition("conversation").sortWithinPartitions("conversation", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, audit, begun = hashlib.sha256(), [], False
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] == 0:
                    digest, audit, begun = hashlib.sha256(), [], False
                if row["n"]:
                    digest.update((("\n" if begun else "") + row["block"]).encode())
                    begun = True
                audit.append(row["audit"])
                if row["part"] == row["parts"] - 1:
                    out = {c: [row[c]] for c in ("conversation", *_REPORT)}
                    out |= {"audit": ["".join(audit)], "repaired_sha256": [digest.hexdigest()]}
                    yield pa.RecordBatch.from_pydict(out, types)

    types = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in whole.schema])
    return whole.union(ordered.mapInArrow(run, whole.schema))


#: CRC-32 of the ASCII text `key`, bit by bit, by its reflected polynomial.
_CRC = """xor(4294967295, list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(length(key)), lambda i: CAST(ascii(substr(key, i + 1, 1)) AS BIGINT))),
        lambda c, b: list_reduce(list_prepend(xor(c, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
          lambda v, bit: xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384 ELSE 0 END))))"""


def _oracle() -> str:
    """SQL of the contract: rows one after the other, four states a conversation, cheapest and least kept."""
    states = range(4)
    far = "{'c': 1000000000, 'a': '', 't': ''}"

    def inserted(q: int, base: list[str]) -> list[str]:
        """Candidates for state q after up to two inserts, from the states in `base`."""
        out = [base[q]]
        for p in states:
            reached, steps, turns = p, "", ""
            for _ in range(2):
                role, reached = NEXT[reached]
                steps, turns = steps + "I", turns + f" || chr(10) || '{NAMES[role]}:'"
                if reached == q:
                    cost = INSERT * len(steps)
                    out.append(f"{{'c': {base[p]}.c + {cost}, 'a': {base[p]}.a || '{steps}', 't': {base[p]}.t{turns}}}")
        return out

    own = [f"s{q}" for q in states]
    best = lambda options: f"list_min([{', '.join(options)}])"
    widened = ", ".join(f"{best(inserted(q, own))} AS s{q}" for q in states)
    moved = []
    for q in states:
        options = [f"{{'c': s{q}.c + {DELETE}, 'a': s{q}.a || 'D', 't': s{q}.t}}"]
        for p in states:
            role, state = NEXT[p]
            if state == q:
                options.append(
                    f"CASE WHEN gone THEN {far} ELSE {{'c': s{p}.c + {REROLE} + more, 'a': s{p}.a || 'R', "
                    f"'t': s{p}.t || chr(10) || '{NAMES[role]}:' || text}} END"
                )
        for p, (role, state) in [*NEXT.items(), (START, ("s", SYSTEM))]:
            if state == q:
                options.append(
                    f"CASE WHEN gone OR left(role, 1) <> '{role}' THEN {far} ELSE {{'c': s{p}.c + more, "
                    f"'a': s{p}.a || 'K', 't': s{p}.t || chr(10) || role || ':' || text}} END"
                )
        moved.append(f"{best(options)} AS s{q}")
    faulty = f"""
  read AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, row_number() OVER () AS id,
      coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
  sums AS (SELECT id, {_CRC} % 20 AS kind FROM read),
  hurt AS (SELECT conv_id, turn, id, kind, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
      CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM read JOIN sums USING (id) WHERE kind <> 0),
  rows AS (SELECT *, 0 AS copy FROM hurt UNION ALL SELECT *, 1 FROM hurt WHERE kind = 3),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, id, copy) AS i,
      rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS worded FROM rows),
  judged AS (SELECT *, worded = '' AS blank,
      worded <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
      lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal
    FROM ranked),
  faults AS (SELECT *, blank OR duplicate AS gone,
      NOT blank AND NOT duplicate AND right(worded, 1) NOT IN ('.', '!', '?') AS truncated,
      CASE WHEN NOT blank AND NOT duplicate AND right(worded, 1) NOT IN ('.', '!', '?') THEN {TRUNCATED} ELSE 0 END AS more
    FROM judged),
  convs AS (SELECT DISTINCT conv_id FROM conversations)"""
    begin = ", ".join(f"{{'c': 0, 'a': '', 't': ''}} AS s{q}" if q == START else f"{far} AS s{q}" for q in states)
    return f"""
WITH RECURSIVE {faulty},
  walk AS (SELECT conv_id, CAST(0 AS BIGINT) AS n, {begin} FROM convs
    UNION ALL
    SELECT conv_id, n, {', '.join(moved)} FROM (
      SELECT w.conv_id, f.i AS n, f.role, f.text, f.gone, f.more, {widened}
      FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.n + 1)),
  ends AS (SELECT conv_id, {best([f'ended.s{q}' for q in ACCEPTED])} AS e FROM (
      SELECT conv_id, n, {widened} FROM walk
      QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) = 1) ended),
  counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
      count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
      count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal FROM faults GROUP BY conv_id)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(e.e.c AS BIGINT) AS cost, e.e.a AS audit, sha256(substr(e.e.t, 2)) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id"""


ORACLE = _oracle()
