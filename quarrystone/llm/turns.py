"""Conversation structure repair: the cheapest edits that make turns a dialogue.

A conversation's rows, by turn, are edited until the initials of their roles read
``(s?(ua)+)?``: perhaps a system turn, then user and assistant in turns. Keep costs
0, Rerole to user or assistant 1, Delete 2, Insert of an empty turn 5; rows that
are truncated cost 5 more unless they are deleted; blank and duplicate rows must be
deleted. Of the cheapest edits those whose initials are least in ASCII are taken.

The grammar has four states: nothing yet, after s, after u, after a. Spark deals
rows out by (conversation, stretch of turns) and sorts them, and in each batch
DuckDB runs a recursive query: every recursion advances one turn of all stretches
at once and keeps the least (cost, audit) for each state. It starts from every
state, so a stretch yields a small matrix from the state before it to the state
behind it, and a long conversation is cut into as many stretches as it needs. The
same kind of query, one stretch for each recursion, joins the matrices of a
conversation. Within one state and place all audits end with a row's edit, so none
is the beginning of another, and the least of parts gives the least whole.

Duplicates are found by counts of (conversation, role, hash of text), summed up
before they are shuffled. Texts are shuffled once, for the repaired turns, behind
their conversation's audit, and are streamed.

Defined cases: null roles and texts are one space, null turns come first, null ids
are one conversation; rows of equal turn come in the order of role and then of
the text's MD5; roles of other initials can be reroled or deleted; further columns
are ignored; an empty table gives an empty result; a conversation without rows has
zeros, an empty audit and no turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import materialize, ship

STRETCH = 256  # turns dealt out together, and rows that one matrix covers
SPACES = " \t\n\x0b\f\r"
#: Classes of initials, and the costs of edits.
INITIALS = "sua"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FINE, CUT, GONE = 0, 1, 2  # faults of a row: none, truncated, blank or duplicate
START, SYSTEM, USER, ASSISTANT = range(4)  # states of the grammar
OTHER = len(INITIALS)
FIRST = -(1 << 63)


def _next(state: int, initial: str) -> int | None:
    """The state behind a turn of that initial; None where the grammar has none."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if state == USER else None


def _least(found: list[tuple[tuple, int, str]]) -> list[tuple]:
    best: dict[tuple, tuple[int, str]] = {}
    for key, cost, letters in found:
        best[key] = min(best.get(key, (cost, letters)), (cost, letters))
    return [(*k, *v) for k, v in sorted(best.items())]


def _with_inserts(state: int) -> Iterator[tuple[int, int, str]]:
    """(state, cost, letters) after none, one or two inserts; more lead back to the same states."""
    cost, letters = 0, ""
    for _ in range(3):
        yield state, cost, letters
        state = ASSISTANT if state == USER else USER
        cost, letters = cost + INSERT, letters + "I"


def moves() -> list[tuple[int, int, int, int, str]]:
    """(kind, state, then, cost, letters): the cheapest way over one row of each kind; kind = 3 * initial + fault."""
    found = []
    for initial, fault, state in product(range(OTHER + 1), (FINE, CUT, GONE), range(4)):
        for at, cost, letters in _with_inserts(state):
            edits = [(at, DELETE, "D")]
            if fault != GONE:
                more = TRUNCATED if fault == CUT else 0
                edits.append((ASSISTANT if at == USER else USER, REROLE + more, "R"))
                kept = _next(at, INITIALS[initial]) if initial < OTHER else None
                if kept is not None:
                    edits.append((kept, KEEP + more, "K"))
            found += [((3 * initial + fault, state, then), cost + c, letters + e) for then, c, e in edits]
    return _least(found)


#: (cost, letters) to end a dialogue from each state.
ENDS = {START: (0, ""), ASSISTANT: (0, ""), USER: (INSERT, "I"), SYSTEM: (2 * INSERT, "II")}

#: A step is a turn of a stretch, or a stretch of a conversation: one recursion takes it in all parts.
_OVER = """WITH RECURSIVE step(part, entry, state, i, cost, audit) AS (
  SELECT part, entry, state, 0, cost, audit FROM base
  UNION ALL
  SELECT part, entry, onto, i + 1, best.cost, best.audit FROM (
    SELECT s.part, s.entry, m.onto, s.i, min({'cost': s.cost + m.cost, 'audit': s.audit || m.letters}) AS best
    FROM step s JOIN turns t ON t.part = s.part AND t.i = s.i JOIN moves m ON m.kind = t.kind AND m.state = s.state
    GROUP BY s.part, s.entry, m.onto, s.i)
)
SELECT part, entry, state, cost, audit FROM step JOIN sizes USING (part) WHERE i = n ORDER BY part, entry, state"""


def _connection():  # noqa: ANN202
    import duckdb

    return duckdb.connect(config={"threads": 1, "memory_limit": "512MB", "temp_directory": ""})


def _put(con, name: str, columns: dict[str, tuple[pa.DataType, list]]) -> None:  # noqa: ANN001
    con.register(name, pa.table({k: pa.array(v, t) for k, (t, v) in columns.items()}))


def _solved(con, base: list[tuple], turns: list[tuple], sizes: list[tuple], steps: list[tuple]) -> list[tuple]:  # noqa: ANN001
    """Rows (part, entry, state, cost, audit) of the recursion; turns: (part, i, kind), steps: (kind, state, then, cost, letters)."""
    col = lambda rows, k: [r[k] for r in rows]
    i, s = pa.int64(), pa.string()
    _put(con, "base", {n: (t, col(base, k)) for k, (n, t) in enumerate((("part", i), ("entry", i), ("state", i), ("cost", i), ("audit", s)))})
    _put(con, "turns", {n: (i, col(turns, k)) for k, n in enumerate(("part", "i", "kind"))})
    _put(con, "sizes", {n: (i, col(sizes, k)) for k, n in enumerate(("part", "n"))})
    _put(con, "moves", {n: (t, col(steps, k)) for k, (n, t) in enumerate((("kind", i), ("state", i), ("onto", i), ("cost", i), ("letters", s)))})
    return con.execute(_OVER).fetchall()


_MATRIX = "array<struct<state:int,then:int,cost:long,audit:string>>"
_PIECE = f"stretch long, no long, blank long, duplicate long, truncated long, illegal long, head string, tail string, low long, high long, turns long, ways {_MATRIX}"


def _legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def _stretches(name: str, kind: str) -> tuple[Callable, str]:
    """A function over sorted slim rows that gives a row for each stretch, and its schema.

    Slim rows: (id, stretch, turn, role, h, initial, blank, late, cut).
    """
    schema = f"`{name}` {kind}, {_PIECE}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con, steps = _connection(), moves()
        before: tuple | None = None  # the row ahead: it tells copies and turns that are counted already
        no = 0
        for b in batches:
            pieces: list[dict] = []
            turns: list[tuple] = []
            for conv, stretch, turn, role, h, initial, blank, late, cut in zip(*(c.to_pylist() for c in b.columns), strict=True):
                own = (conv, turn, role, h)
                p = pieces[-1] if pieces else None
                if p is None or p["key"] != (conv, stretch) or p["n"] == STRETCH:
                    p = {"key": (conv, stretch), "no": no, "n": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "head": initial, "tail": None, "low": None, "high": None, "turns": 0}
                    pieces.append(p)
                    no += 1
                fault = "blank" if blank else "duplicate" if late or own == before else "truncated" if cut else None
                if fault:
                    p[fault] += 1
                p["illegal"] += p["tail"] is not None and not _legal(p["tail"], initial)
                p["tail"] = initial
                if turn is not None:
                    p["turns"] += before is None or before[:2] != (conv, turn)
                    p["low"], p["high"] = turn if p["low"] is None else p["low"], turn
                place = INITIALS.find(initial) if initial else -1
                turns.append((len(pieces) - 1, p["n"], 3 * (place if place >= 0 else OTHER) + (CUT if fault == "truncated" else GONE if fault else FINE)))
                p["n"] += 1
                before = own
            base = [(k, s, s, 0, "") for k in range(len(pieces)) for s in range(4)]
            ways: list[list[dict]] = [[] for _ in pieces]
            for part, entry, state, cost, audit in _solved(con, base, turns, [(k, p["n"]) for k, p in enumerate(pieces)], steps):
                ways[part].append({"state": entry, "then": state, "cost": cost, "audit": audit})
            names = ["no", "blank", "duplicate", "truncated", "illegal", "head", "tail", "low", "high", "turns"]
            kinds = {"head": pa.string(), "tail": pa.string()}
            held = {k: pa.array([p[k] for p in pieces], kinds.get(k, pa.int64())) for k in names}
            matrix = pa.array(ways, pa.list_(pa.struct([("state", pa.int32()), ("then", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))
            ids = pa.array([p["key"][0] for p in pieces], b.schema[0].type)
            yield pa.record_batch([ids, pa.array([p["key"][1] for p in pieces], pa.int64()), *held.values(), matrix], [name, "stretch", *names, "ways"])

    return run, schema


_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _joined(name: str, kind: str) -> tuple[Callable, str]:
    """A function over sorted stretches that gives a row for each conversation, and its schema."""
    schema = f"`{name}` {kind}, {_RESULT}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = _connection()
        open_: dict | None = None  # the conversation that the next batch may go on with

        def told(done: list[dict], id_type: pa.DataType) -> pa.RecordBatch:
            out = []
            for c in done:
                cost, audit = min((cost + ENDS[s][0], audit + ENDS[s][1]) for s, (cost, audit) in c["states"].items())
                gaps = c["high"] - c["low"] + 1 - c["turns"] if c["low"] is not None else 0
                out.append((c["id"], gaps, *(c[k] for k in _COUNTS), cost, audit))
            types = [id_type, *[pa.int64()] * 6, pa.string()]
            return pa.record_batch([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], [name, "gaps", *_COUNTS, "cost", "audit"])

        id_type = None
        for b in batches:
            id_type = b.schema[0].type
            held: list[dict] = [open_] if open_ else []
            parts: list[list] = [[]] if open_ else []
            for r in b.to_pylist():
                if not held or held[-1]["id"] != r[name]:
                    held.append({"id": r[name], **dict.fromkeys(_COUNTS, 0), "tail": None, "low": None, "high": None, "turns": 0, "states": {START: (0, "")}})
                    parts.append([])
                c = held[-1]
                for k in _COUNTS:
                    c[k] += r[k]
                c["illegal"] += c["tail"] is not None and not _legal(c["tail"], r["head"])
                c["tail"] = r["tail"]
                c["turns"] += r["turns"]
                if r["low"] is not None:
                    c["low"], c["high"] = r["low"] if c["low"] is None else c["low"], r["high"]
                parts[-1].append(r["ways"])
            base = [(k, START, s, cost, audit) for k, c in enumerate(held) for s, (cost, audit) in c["states"].items()]
            turns, steps, kind_ = [], [], 0
            for k, ways in enumerate(parts):
                for i, matrix in enumerate(ways):
                    turns.append((k, i, kind_))
                    steps += [(kind_, w["state"], w["then"], w["cost"], w["audit"]) for w in matrix]
                    kind_ += 1
            states: list[dict] = [{} for _ in held]
            for part, _, state, cost, audit in _solved(con, base, turns, [(k, len(w)) for k, w in enumerate(parts)], steps):
                states[part][state] = cost, audit
            for c, s in zip(held, states, strict=True):
                c["states"] = s
            open_ = held.pop() if held else None
            if held:
                yield told(held, id_type)
        if open_:
            yield told([open_], id_type)

    return run, schema


def _slim(rows: DataFrame) -> DataFrame:
    """Rows as stretches need them: no texts; late: the same role and text stand at an earlier turn."""
    bare = F.rtrim("text", F.lit(SPACES))
    turn_key = F.coalesce("turn", F.lit(FIRST))
    marked = rows.select(
        "id",
        F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(FIRST)).alias("stretch"),
        "turn",
        "role",
        "h",
        F.left("role", F.lit(1)).alias("initial"),
        (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        turn_key.alias("turn_key"),
    )
    first = marked.groupBy("id", "role", "h").agg(F.min("turn_key").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    first = first.select(F.col("id").alias("of"), F.col("role").alias("first_role"), F.col("h").alias("first_h"), "first")
    met = marked.join(first, F.col("id").eqNullSafe(F.col("of")) & (F.col("role") == F.col("first_role")) & (F.col("h") == F.col("first_h")), "left")
    late = F.coalesce(F.col("turn_key") > F.col("first"), F.lit(False))
    return met.select("id", "stretch", "turn", "role", "h", "initial", "blank", late.alias("late"), "cut")


def prepared(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(id, turn, role, text, h); nulls of role and text are one space, h is the MD5 of the text."""
    plain = lambda c: F.coalesce(F.col(c), F.lit(" "))
    rows = conversations.select(F.col(id_col).alias("id"), F.col(turn_col).cast("long").alias("turn"), plain(role_col).alias("role"), plain(text_col).alias("text"))
    return rows.select("*", F.unhex(F.md5("text")).alias("h"))


def audits(rows: DataFrame) -> DataFrame:
    """(id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation of prepared rows."""
    ship(rows.sparkSession)
    kind = rows.schema["id"].dataType.simpleString()
    dealt = _slim(rows).repartition("id", "stretch").sortWithinPartitions("id", "stretch", F.col("turn").asc_nulls_first(), "role", "h")
    run, schema = _stretches("id", kind)
    pieces = dealt.mapInArrow(run, schema).repartition("id").sortWithinPartitions("id", "stretch", "no")
    run, schema = _joined("id", kind)
    return pieces.mapInArrow(run, schema)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, dict | None, list[tuple[str, str]], bool]]:
    """(id, result, turns, whether the conversation ends), in stretches of what a batch holds.

    Rows: (id, mark, turn, role, text, ...): mark 0 is the result of a conversation,
    1 its rows, 2 tells of one that may have no rows.
    """
    now: dict | None = None

    def inserted(c: dict) -> Iterator[tuple[str, str]]:
        while c["at"] < len(c["audit"]) and c["audit"][c["at"]] == "I":
            c["at"] += 1
            yield turned(c, "", "")

    def turned(c: dict, role: str, text: str) -> tuple[str, str]:
        if not role:
            role = "assistant" if c["asked"] else "user"
        c["asked"] = not c["asked"] if role[0] != "s" else False
        return role, text

    for b in batches:
        out: list[tuple[str, str]] = []
        for r in b.to_pylist():
            if now is None or now["id"] != r["id"]:
                if now is not None:
                    yield now["id"], now["result"], [*out, *inserted(now)], True
                    out = []
                result = r if r["mark"] == 0 else None
                now = {"id": r["id"], "result": result, "audit": result["audit"] if result else "", "at": 0, "asked": False}
            if r["mark"] == 1:
                out += inserted(now)
                edit = now["audit"][now["at"]]
                now["at"] += 1
                if edit != "D":
                    out.append(turned(now, r["role"] if edit == "K" else "", r["text"]))
        if now is not None and out:
            yield now["id"], now["result"], out, False
    if now is not None:
        yield now["id"], now["result"], [*inserted(now)], True


def _streamed(rows: DataFrame, found: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Each conversation's result, then its rows by turn, then perhaps a mark, in one partition."""
    kind = rows.schema["id"].dataType
    none = lambda name, t: F.lit(None).cast(t).alias(name)
    results = ("gaps", *_COUNTS, "cost", "audit")
    order = ("turn", "role", "text", "h")
    types = {"role": "string", "text": "string", "h": "binary", "audit": "string"}
    empty = lambda names: [none(n, types.get(n, "long")) for n in names]
    every = found.select("id", F.lit(0).alias("mark"), *empty(order), *results).unionByName(rows.select("id", F.lit(1).alias("mark"), *order, *empty(results)))
    if ids is not None:
        every = every.unionByName(ids.select(F.col("id").cast(kind), F.lit(2).alias("mark"), *empty(order), *empty(results)))
    return every.repartition("id").sortWithinPartitions("id", "mark", F.col("turn").asc_nulls_first(), "role", "h")


def repair(rows: DataFrame) -> DataFrame:
    """(id, position, role, text): the repaired turns of prepared rows."""
    found = materialize(audits(rows), "audits", compact=True)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type, at = None, 0

        def typed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal id_type
            for b in source:
                id_type = b.schema[0].type
                yield b

        for conv, _, turns, ended in _edited(typed(batches)):
            n = len(turns)
            yield pa.record_batch([pa.array([conv] * n, id_type), pa.array(range(at, at + n), pa.int64()), pa.array([t[0] for t in turns], pa.string()), pa.array([t[1] for t in turns], pa.string())], ["id", "position", "role", "text"])
            at = 0 if ended else at + n

    return _streamed(rows, found, None).mapInArrow(run, f"id {kind}, position long, role string, text string")


def digests(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation.

    The hash is of the repaired turns as ``role:text``, joined by newlines; it is
    fed as the turns stream by. ids: conversations that are to be told of even if
    rows has none of them.
    """
    found = materialize(audits(rows), "audits", compact=True)
    kind = rows.schema["id"].dataType.simpleString()
    names = ("gaps", *_COUNTS, "cost")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type = None

        def typed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal id_type
            for b in source:
                id_type = b.schema[0].type
                yield b

        def told(out: list[tuple]) -> pa.RecordBatch:
            types = [id_type, *[pa.int64()] * len(names), pa.string(), pa.string()]
            return pa.record_batch([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], ["id", *names, "audit", "repaired_sha256"])

        sha, between, out = hashlib.sha256(), "", []
        for conv, result, turns, ended in _edited(typed(batches)):
            for role, text in turns:
                sha.update(f"{between}{role}:{text}".encode())
                between = "\n"
            if ended:
                out.append((conv, *((result[k] for k in names) if result else [0] * len(names)), result["audit"] if result else "", sha.hexdigest()))
                sha, between = hashlib.sha256(), ""
                if len(out) == 4096:
                    yield told(out)
                    out = []
        if out:
            yield told(out)

    return _streamed(rows, found, ids).mapInArrow(run, f"id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def damaged(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows with a known damage, by crc32 of ``id:turn`` modulo 20, under their own names; and the ids of those that are dropped.

    0 drops a row, 1 empties its text, 2 takes its full stops, question and
    exclamation marks, 3 repeats it, 4 makes its role user; null fields are one space.
    """
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(plain(id_col), F.lit(":"), plain(turn_col)).cast("binary")) % 20
    rows = conversations.select(F.col(id_col), F.col(turn_col), plain(role_col).alias(role_col), plain(text_col).alias(text_col), code.alias("_damage"))
    kind: Column = F.col("_damage")
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text_col, ".!?", "")).otherwise(F.col(text_col))
    role = F.when(kind == 4, "user").otherwise(F.col(role_col))
    kept = rows.where("_damage <> 0").select(F.col(id_col), F.col(turn_col), role.alias(role_col), text.alias(text_col), F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("_copy")).drop("_copy")
    return kept, rows.where("_damage = 0").select(F.col(id_col).alias("id")).distinct()
