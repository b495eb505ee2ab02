"""Conversation structure repair (operator 13).

The cheapest edits that give a conversation the shape "system at most once, then
user and assistant in turn" are a shortest path in a graph of (rows used, state).
A path's weight is one whole number: its high digits are the cost, its low
digits the edits' letters in order, a fixed number of places filled with
zeros at the end. The least number is then the cheapest path and, of those,
the one with the ASCII-least audit; an ordinary minimum over whole numbers decides.

Rows of a conversation pass through tasks as sorted streams. Only a byte and a
hash per row are held; texts never are. Long conversations are solved
in segments, whose ends get their costs from a pass over the costs alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_engine.llm.common import crc32_sql, need_columns, release_tokenizers

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Letters by digit; 0 is the padding. In ASCII order.
LETTERS = " DIKR"
_D, _I, _K, _R = 1, 2, 3, 4
_DIGIT = 3
#: Rows of a conversation that are solved with one number.
SEGMENT = 512
#: Rows handed on at a time.
BATCH = 2000
SPACES = " \t\n\x0b\x0c\r"

#: States: nothing yet, after system, after user, after assistant. Rows: other role, s, u, a.
_START, _S, _U, _A = range(4)
#: State after a row of a role that fits; what a rerole or insert leads to.
_FITS = {(_START, 1): _S, (_START, 2): _U, (_S, 2): _U, (_U, 3): _A, (_A, 2): _U}
_NEXT = (_U, _U, _A, _U)
_MUST, _CUT = 4, 8


def _layer(base: list[int], inserted) -> list[int]:
    """Weights before a row from those without an insert first. From user an
    insert leads to assistant and back, so two in a row never pay there."""
    user = min(base[_U], inserted(base[_A]))
    assistant = min(base[_A], inserted(base[_U]))
    return [min(base[_START], inserted(user)), min(base[_S], inserted(user)), user, assistant]


def _solve(codes: bytes, ends: list[int], last: bool) -> list[tuple[int, str]]:
    """Cost and audit of a stretch of rows from each of the four states. ``ends``
    are the costs that follow after each state; the last stretch ends by the rule."""
    bits = _DIGIT * (3 * len(codes) + 3)
    low = (1 << bits) - 1

    def step(letter: int, cost: int, w: int) -> int:
        return (((w >> bits) + cost) << bits) | (letter << (bits - _DIGIT)) | ((w & low) >> _DIGIT)

    inserted = lambda w: step(_I, INSERT, w)
    if last:
        accepted = inserted(0)
        weights = [0, inserted(accepted), accepted, 0]
    else:
        weights = [c << bits for c in ends]
    for code in reversed(codes):
        more = TRUNCATED if code & _CUT else 0
        base = []
        for state in range(4):
            w = step(_D, DELETE, weights[state])
            if not code & _MUST:
                w = min(w, step(_R, REROLE + more, weights[_NEXT[state]]))
                to = _FITS.get((state, code & 3))
                if to is not None:
                    w = min(w, step(_K, KEEP + more, weights[to]))
            base.append(w)
        weights = _layer(base, inserted)
    out = []
    for w in weights:
        digits = f"{w & low:0{bits // _DIGIT}o}".rstrip("0")
        out.append((w >> bits, "".join(LETTERS[int(d)] for d in digits)))
    return out


def _costs(codes: bytes, segment: int) -> list[list[int]]:
    """Costs that follow after each state, at the start of every segment but
    the first. An insert before a segment's first row belongs to that segment,
    so two paths through a segment never are one the beginning of the other."""
    weights, found = [0, 2 * INSERT, INSERT, 0], []
    for i in range(len(codes) - 1, 0, -1):
        code = codes[i]
        more = TRUNCATED if code & _CUT else 0
        base = []
        for state in range(4):
            w = DELETE + weights[state]
            if not code & _MUST:
                w = min(w, REROLE + more + weights[_NEXT[state]])
                to = _FITS.get((state, code & 3))
                if to is not None:
                    w = min(w, KEEP + more + weights[to])
            base.append(w)
        weights = _layer(base, lambda w: w + INSERT)
        if i % segment == 0:
            found.append(weights)
    return found[::-1]


def cheapest(codes: bytes, segment: int = SEGMENT) -> tuple[int, str]:
    """Cost and audit of a conversation from its rows' codes: role (0 other,
    1 system, 2 user, 3 assistant), plus 4 if it must go, plus 8 if cut short."""
    ends = _costs(codes, segment)
    cost, audit, state = 0, [], _START
    for k, at in enumerate(range(0, max(1, len(codes)), segment)):
        part = codes[at : at + segment]
        total, letters = _solve(part, ends[k] if k < len(ends) else [], k == len(ends))[state]
        cost = total if k == 0 else cost
        audit.append(letters)
        rows = iter(part)
        for letter in letters:
            if letter == "I":
                state = _NEXT[state]
                continue
            code = next(rows)
            if letter != "D":
                state = _NEXT[state] if letter == "R" else _FITS[state, code & 3]
    return cost, "".join(audit)


def ordered(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy) as sorted streams: a conversation is in
    one partition, by turn (nulls first), role, MD5 sum of the text, copy. ``rows``
    may hold a column ``first`` that comes before all."""
    lead = ["first"] if "first" in rows.columns else []
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *lead, "turn", "role", "text_md5", "copy")


def _coded(rows: DataFrame) -> DataFrame:
    """Rows without their texts: what a row tells about itself."""
    body = F.rtrim("text", F.lit(SPACES))
    role = F.substring("role", 1, 1)
    code = F.when(role == "s", 1).when(role == "u", 2).when(role == "a", 3).otherwise(0)
    same = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    return rows.select(
        "conv_id", "turn", "role", "text_md5", "copy", code.cast("int").alias("code"), (body == "").alias("blank"),
        (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("cut"), same.alias("same"),
    )


def _audited(segment: int):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tokenizers()
        out: list[tuple] = []

        def closed():
            gaps = last_turn - first_turn + 1 - turns if turns else 0
            out.append((conv, gaps, *faults, illegal, *cheapest(bytes(codes), segment)))

        def batch_of(found):
            types = [pa.int64()] * 7 + [pa.string()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found), types)], names=names)

        begun, conv, codes, seen = False, None, bytearray(), set()
        faults, illegal, turns, first_turn, last_turn = [0, 0, 0], 0, 0, None, None
        for batch in batches:
            for c, turn, code, blank, cut, same in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "turn", "code", "blank", "cut", "same"))):
                if not begun or c != conv:
                    if begun:
                        closed()
                    begun, conv, codes, seen = True, c, bytearray(), set()
                    faults, illegal, turns, first_turn, last_turn = [0, 0, 0], 0, 0, None, None
                if turn is not None and turn != last_turn:
                    first_turn = turn if first_turn is None else first_turn
                    last_turn, turns = turn, turns + 1
                if codes and (codes[-1] & 3, code) not in ((1, 2), (2, 3), (3, 2)):
                    illegal += 1
                fault = 0 if blank else 1 if same in seen else 2 if cut else None
                if fault is not None:
                    faults[fault] += 1
                seen.add(same)
                codes.append(code | (_MUST if fault in (0, 1) else 0) | (_CUT if fault == 2 else 0))
            if len(out) >= BATCH:
                yield batch_of(out)
                out.clear()
        if begun:
            closed()
        if out:
            yield batch_of(out)

    return audit


def audits(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, text_md5,
    copy; only conv_id and turn may be null): ``conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit``."""
    return ordered(_coded(rows)).mapInArrow(_audited(segment), "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string")


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired rows from a stream that has each conversation's audit before its rows."""
    out: list[tuple] = []

    def batch_of(found):
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found), types)], names=["conv_id", "place", "edit", "role", "text"])

    roles, classes = {_U: "user", _A: "assistant"}, {"s": 1, "u": 2, "a": 3}
    conv, letters, at, state, place = None, "", 0, _START, 0

    def inserts():
        nonlocal at, state, place
        while at < len(letters) and letters[at] == "I":
            state = _NEXT[state]
            out.append((conv, place, "I", roles[state], ""))
            at, place = at + 1, place + 1

    for batch in batches:
        for c, first, role, text, audit in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "first", "role", "text", "audit"))):
            if first == 0:
                inserts()
                conv, letters, at, state, place = c, audit, 0, _START, 0
                continue
            inserts()
            letter = letters[at]
            at += 1
            if letter != "D":
                state = _NEXT[state] if letter == "R" else _FITS[state, classes[role[:1]]]
                out.append((conv, place, letter, roles[state] if letter == "R" else role, text))
                place += 1
            if len(out) >= BATCH:
                yield batch_of(out)
                out.clear()
    inserts()
    if out:
        yield batch_of(out)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows that the audits ``found`` leave: ``conv_id, place, edit, role,
    text``; a conversation's rows follow each other in one partition."""
    none = lambda kind: F.lit(None).cast(kind)
    heads = found.select("conv_id", F.lit(0).alias("first"), none("bigint").alias("turn"), none("string").alias("role"), none("string").alias("text"), none("string").alias("text_md5"), none("int").alias("copy"), "audit")
    body = rows.select("conv_id", F.lit(1).alias("first"), "turn", "role", "text", "text_md5", "copy", none("string").alias("audit"))
    return ordered(heads.union(body)).mapInArrow(_applied, "conv_id bigint, place bigint, edit string, role string, text string")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, sums, h = [], [], None
    for batch in batches:
        for conv, place, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "place", "role", "text"))):
            if place == 0:
                sums += [h.hexdigest()] if h else []
                ids.append(conv)
                h = hashlib.sha256()
            h.update(f"{chr(10) if place else ''}{role}:{text}".encode())
    if h:
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array([*sums, h.hexdigest()])], names=["conv_id", "repaired_sha256"])


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage, by crc32 of ``conv_id:turn`` modulo 20. Nulls read
    as one space, in that key too; null ids and turns stay null otherwise."""
    need_columns(conversations, "conv_id", "turn", "role", "text")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), blank("role").alias("role"), blank("text").alias("text"),
        F.pmod(F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")), F.lit(20)).alias("what"),
    ).where("what != 0")
    text = F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("what") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.withColumn("text_md5", F.md5(F.col("text").cast("binary")))


def repair(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per conv_id of ``conversations`` after its damage: ``conv_id,
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Rows are taken by turn (nulls first); rows that share a turn by role, then
    by the MD5 sum of the text; equal rows are interchangeable (the later ones are
    duplicates). A null conv_id is one conversation. A row whose role is empty or
    begins with another letter than s, u or a cannot be kept as it is. A
    conversation without rows after the damage has zeros, an empty audit and the hash
    of the empty string. Other columns are ignored; an empty table gives no rows.
    Texts of any length pass through as streams; a conversation's audit is one
    string, which bounds the memory of the task that has it.
    """
    rows = damaged(conversations)
    found = audits(rows, segment)
    sums = repaired(rows, found).mapInArrow(_hashed, "conv_id bigint, repaired_sha256 string")
    ids = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    key = lambda df: df.withColumnRenamed("conv_id", "of")
    out = ids.join(key(found), F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    out = out.join(key(sums), F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def _oracle_sql() -> str:
    """The same rows in DuckDB: weights are strings there, six digits of cost
    and the audit, folded over the rows from the last to the first."""
    step = lambda letter, cost, w: f"(lpad((substr({w}, 1, 6)::INTEGER + {cost})::VARCHAR, 6, '0') || '{letter}' || substr({w}, 7))"
    worst = "'999999'"
    states = {"e": ("u", {"s": "s", "u": "u"}), "s": ("u", {"u": "u"}), "u": ("a", {"a": "a"}), "a": ("u", {"u": "u"})}
    more = f"x.cut * {TRUNCATED}"
    base = {}
    for name, (to, fits) in states.items():
        keep = " ".join(f"WHEN x.must = 0 AND x.k = '{k}' THEN {step('K', f'{KEEP} + {more}', f'acc.{t}')}" for k, t in fits.items())
        rerole = f"CASE WHEN x.must = 0 THEN {step('R', f'{REROLE} + {more}', f'acc.{to}')} ELSE {worst} END"
        base[name] = f"least({step('D', DELETE, f'acc.{name}')}, {rerole}, CASE {keep} ELSE {worst} END)"
    fields = "k := '', must := 0, cut := 0"
    # two folds a row: the row itself, then inserts before it
    consumed = "struct_pack(" + ", ".join(f"{n} := {b}" for n, b in base.items()) + f", {fields})"
    user, assistant = f"least(acc.u, {step('I', INSERT, 'acc.a')})", f"least(acc.a, {step('I', INSERT, 'acc.u')})"
    inserted = f"struct_pack(e := least(acc.e, {step('I', INSERT, user)}), s := least(acc.s, {step('I', INSERT, user)}), u := {user}, a := {assistant}, {fields})"
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    end = f"struct_pack(e := '000000', s := '00000{2 * INSERT}II', u := '00000{INSERT}I', a := '000000', {fields})"
    role = "CASE WHEN l.st IN ('e', 's', 'a') THEN 'user' ELSE 'assistant' END"
    shown = f"CASE WHEN c IN ('I', 'R') THEN {role} ELSE rs[l.i].role END || ':' || CASE WHEN c = 'I' THEN '' ELSE rs[l.i].text END"
    after = f"CASE WHEN c = 'D' THEN l.st WHEN c IN ('I', 'R') THEN left({role}, 1) ELSE left(rs[l.i].role, 1) END"
    walk = f"struct_pack(c := '', i := l.i + CASE WHEN c = 'I' THEN 0 ELSE 1 END, st := {after}, out := CASE WHEN c = 'D' THEN l.out ELSE coalesce(l.out || chr(10), '') || {shown} END)"
    return f"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS what FROM conversations
), d AS (
  SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN what = 1 THEN '' WHEN what = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN what = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM r WHERE what <> 0
), o AS (
  SELECT *, rtrim(text, {space}) AS body, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM d
), f AS (
  SELECT *, CASE WHEN body = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
         coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1), 'su') NOT IN ('su', 'ua', 'au') AS bad FROM o
), g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (bad) AS illegal,
         list(struct_pack(role := role, text := text) ORDER BY i) AS rs,
         list(struct_pack(e := '', s := '', u := '', a := '', k := CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END,
                          must := (fault IN ('b', 'd'))::INTEGER, cut := (fault = 't')::INTEGER) ORDER BY i DESC) AS back
  FROM f GROUP BY conv_id
), w AS (
  SELECT *, list_reduce(list_prepend({end}, flatten(list_transform(back, lambda x: [x, {end}]))),
                        lambda acc, x: CASE WHEN x.k <> '' THEN {consumed} ELSE {inserted} END).e AS best FROM g
), p AS (
  SELECT *, substr(best, 1, 6)::BIGINT AS cost, substr(best, 7) AS audit FROM w
), q AS (
  SELECT *, list_reduce(list_prepend(struct_pack(c := '', i := 1, st := 'e', out := NULL::VARCHAR),
                        list_transform(CASE WHEN audit = '' THEN [] ELSE string_split(audit, '') END, lambda a: struct_pack(c := a, i := 1, st := '', out := NULL::VARCHAR))),
                        lambda l, y: list_transform([y.c], lambda c: {walk})[1]).out AS out FROM p
), ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(out, '')) AS repaired_sha256
FROM ids LEFT JOIN q ON ids.conv_id IS NOT DISTINCT FROM q.conv_id
"""


ORACLE_SQL = _oracle_sql()
