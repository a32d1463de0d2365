"""Conversation structure repair by weighted CYK interval parsing.

The role initials of a repaired conversation are to be ``(s?(ua)+)?``.  A symbol of the
repair grammar is a pair of states, "this span leads from p to q", so that all its rules
have the binary form of Chomsky, N[p,q] -> N[p,r] N[r,q], beside the terminal ones for a
turn that is kept, reroled or deleted.  Insertions are a closure: they lead from state to
state over the empty span.  Each span has a cell per symbol, the minimum of (cost, audit).
Cells are combined bottom-up by span length.  The rules hold for every split of a span and
the minimum does not depend on the split, so each span is split in the middle only: that makes
the work linear in the turns, and lets Spark parse blocks of a long conversation apart and
combine their cells afterwards.

Two audits of equal cost in one cell never are one the beginning of the other (the longer
one would have more insertions, and so cost more): the least audit of a span is therefore made of
least audits of its parts.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cafetal.llm.common import fresh, materialise, numbered, slices

# Costs of the edits, and the automaton of (s?(ua)+)? with states
# 0 nothing yet, 1 after s, 2 after u, 3 after a (0 and 3 may end).
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FINAL = (0, 3)
N = 4
BLANKS = " \t\n\x0b\f\r"
LONG = 2**63 - 1

_BLOCK = 8  # bits: turns parsed in one piece
_FAN = 6  # bits: pieces combined at a time
_CACHED = 16  # turns up to which a span's cells are remembered

Cell = list  # of N * N (cost, audit), or None where no edits lead from p to q


def product(left: Cell, right: Cell) -> Cell:
    """Cells of a span from those of its two parts."""
    out = [None] * (N * N)
    for p in range(N):
        for q in range(N):
            best = None
            for r in range(N):
                a, b = left[p * N + r], right[r * N + q]
                if a is not None and b is not None:
                    cost = a[0] + b[0]
                    if best is None or cost <= best[0]:
                        got = (cost, a[1] + b[1])
                        best = got if best is None else min(best, got)
            out[p * N + q] = best
    return out


def _closure() -> Cell:
    """Cells of the empty span: insertions only."""
    out = [None] * (N * N)
    for p in range(N):
        reach = {p: 0}
        todo = [p]
        for at in todo:
            for role in "ua":
                to = STEP.get((at, role))
                if to is not None and to not in reach:
                    reach[to] = reach[at] + 1
                    todo.append(to)
        for q, n in reach.items():
            out[p * N + q] = (INSERT * n, "I" * n)
    return out


CLOSURE = _closure()


def deletes(n: int) -> Cell:
    """Cells of ``n`` turns that have to go; D sorts before I, so insertions come last."""
    return [c and (c[0] + DELETE * n, "D" * n + c[1]) for c in CLOSURE]


def leaf(kind: str) -> Cell:
    """Cells of one turn: s, u, a, x (no legal role), in upper case if truncated; d if it has to go."""
    if kind == "d":
        return deletes(1)
    more = TRUNCATED if kind.isupper() else 0
    turn = [None] * (N * N)
    for p in range(N):
        turn[p * N + p] = (DELETE, "D")
        found = [(STEP.get((p, kind.lower())), (more, "K"))]
        found += [(STEP.get((p, role)), (more + REROLE, "R")) for role in "ua"]
        for q, cell in found:
            if q is not None:
                turn[p * N + q] = min(cell, turn[p * N + q] or cell)
    return product(product(CLOSURE, turn), CLOSURE)


@lru_cache(maxsize=1 << 15)
def span(kinds: str) -> Cell:
    """Cells of a short span, remembered."""
    if len(kinds) == 1:
        return leaf(kinds)
    half = 1 << (len(kinds) - 1).bit_length() - 1
    return product(span(kinds[:half]), span(kinds[half:]))


def combine(cells: list[Cell]) -> Cell:
    """Cells of neighbouring spans combined pair by pair, short spans first."""
    while len(cells) > 1:
        cells = [product(*cells[i:i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0] if cells else CLOSURE


def parse(turns: list[tuple[str, int]]) -> Cell:
    """Cells of the turns, given as (kind of the first copy, copies); all further copies have to go."""
    cells, text = [], []

    def flush():
        kinds = "".join(text)
        text.clear()
        cells.extend(span(kinds[i:i + _CACHED]) for i in range(0, len(kinds), _CACHED))

    for kind, n in turns:
        text.append(kind)
        if n - 1 <= _CACHED:
            text.append("d" * (n - 1))
        else:
            flush()
            cells.append(deletes(n - 1))
    flush()
    return combine(cells)


def answer(cell: Cell) -> tuple[int, str]:
    return min(cell[q] for q in FINAL)


def _blank_ended(text: str) -> Column:
    return F.rtrim(F.col(text), F.lit(BLANKS))


_PIECE = ("__at long, __edge string, __illegal long, __lo long, __hi long, __turns long, __blank long, __dup long, "
          "__trunc long, __cost array<long>, __audit array<string>")
_PIECE_NAMES = [f.split()[0] for f in _PIECE.split(", ")]
_SUMS = ("__blank", "__dup", "__trunc")


def _joined(pieces: list[dict]) -> dict:
    """One piece from the pieces of neighbouring stretches of a conversation, in order."""
    out = dict(pieces[0])
    for p in pieces[1:]:
        for k in ("__illegal", *_SUMS):
            out[k] += p[k]
        out["__illegal"] += out["__edge"][1] + p["__edge"][0] not in ("su", "ua", "au")
        out["__edge"] = out["__edge"][0] + p["__edge"][1]
        out["__turns"] += p["__turns"] - (p["__lo"] is not None and out["__hi"] == p["__lo"])
        out["__lo"] = p["__lo"] if out["__lo"] is None else out["__lo"]
        out["__hi"] = out["__hi"] if p["__hi"] is None else p["__hi"]
    return out


def _packed(cell: Cell) -> dict:
    return {"__cost": [c and c[0] for c in cell], "__audit": [c and c[1] for c in cell]}


def _unpacked(piece: dict) -> Cell:
    return [None if c is None else (c, a) for c, a in zip(piece["__cost"], piece["__audit"], strict=True)]


def _block(rows: list[dict]) -> dict:
    """The piece of a stretch of turns in order."""
    one = [{"__at": r["__g"], "__edge": r["__role"] * 2, "__illegal": r["__n"] - 1, "__lo": r["__turn"],
            "__hi": r["__turn"], "__turns": int(r["__turn"] is not None), **{k: r[k] for k in _SUMS}} for r in rows]
    return _joined(one) | _packed(parse([(r["__kind"], r["__n"]) for r in rows]))


def _merge(pieces: list[dict]) -> dict:
    return _joined(pieces) | (_packed(combine([_unpacked(p) for p in pieces])) if len(pieces) > 1 else {})


def _each(conv: str, schema: pa.Schema, make):
    def run(batches):
        for b in slices(batches, 256):
            convs, groups = b.column(0), b.column(1).to_pylist()
            made = [make(g) for g in groups]
            yield pa.RecordBatch.from_arrays(
                [convs.cast(schema.field(0).type), *(pa.array([m[f.name] for m in made], f.type) for f in list(schema)[1:])],
                schema=schema)
    return run


def _stream(schema: pa.Schema, turns: bool):
    """Walk sorted rows (the verdict of a conversation, then its turns) and apply the audit.

    Holds one audit and one hash, never a conversation.
    """
    def run(batches):
        verdict, out = None, []
        audit, at, state, place, sha = "", 0, 0, 0, None

        def emit(role, text, edit):
            nonlocal state, place
            state = STEP[state, role[:1]]
            if turns:
                out.append((verdict[0], place, role, text, edit))
            else:
                sha.update((("\n" if place else "") + f"{role}:{text}").encode())
            place += 1

        def inserts():
            nonlocal at
            while audit.startswith("I", at):
                at += 1
                emit("assistant" if state == 2 else "user", "", "insert")

        def close():
            if verdict is not None:
                inserts()
                if not turns:
                    out.append((*verdict, audit, sha.hexdigest()))

        def batch():
            done = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out.clear()
            return done

        for b in slices(batches, 1024):
            cols = [b.column(i).to_pylist() for i in range(b.num_columns)]
            for conv, side, role, text, n, found, *counts in zip(*cols, strict=True):
                if side < 0:
                    close()
                    verdict, audit, at, state, place, sha = (conv, *counts), found, 0, 0, 0, hashlib.sha256()
                    continue
                while n:
                    inserts()
                    if audit.startswith("D" * n, at):
                        at += n
                        break
                    edit = audit[at]
                    at += 1
                    n -= 1
                    if edit == "K":
                        emit(role, text, "keep")
                    elif edit == "R":
                        emit("assistant" if state == 2 else "user", text, "rerole")
            if out:
                yield batch()
        close()
        if out:
            yield batch()
    return run


def _order(c: str) -> Column:
    return F.col(c).asc_nulls_first()


def _rows(conversations: DataFrame, copies: Column) -> DataFrame:
    """The turns with their copies and a key of role and text, by which equal ones are known and rows of one turn ordered."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return (conversations.select(F.col("conv_id").alias("__conv"), F.col("turn").cast("long").alias("__turn"),
                                 role.alias("__role"), text.alias("__text"), copies.cast("long").alias("__n"))
            .filter("__n > 0")
            .withColumn("__key", F.unhex(F.sha2(F.concat(F.length("__role").cast("string"), F.lit(":"), "__role", "__text"), 256))))


def _turns(rows: DataFrame) -> DataFrame:
    """Distinct turns with their number of copies, fault and place; their texts stay behind."""
    body = _blank_ended("__text")
    start = F.substring("__role", 1, 1)
    seen = rows.select("__conv", "__turn", "__key", "__n", (body == "").alias("__void"),
                       (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("__cut"),
                       F.when(start.isin("s", "u", "a"), start).otherwise("x").alias("__start"))
    seen = seen.groupBy("__conv", "__turn", "__key").agg(
        F.sum("__n").alias("__n"), *(F.max(c).alias(c) for c in ("__void", "__cut", "__start")))
    # the first of equal turns, per conversation: partial minima, then a join on a key that no two rows share
    first = (seen.groupBy("__conv", "__key")
             .agg(F.min(F.struct(F.col("__turn").isNotNull().alias("there"), F.col("__turn").alias("turn"))).alias("__first"))
             .select(F.col("__conv").alias("__c"), F.col("__key").alias("__k"), F.col("__first.turn").alias("__t"),
                     F.lit(True).alias("__is_first")))
    rows = seen.join(first, F.col("__conv").eqNullSafe(F.col("__c")) & (F.col("__key") == F.col("__k"))
                     & F.col("__turn").eqNullSafe(F.col("__t")), "left").drop("__c", "__k", "__t")
    blank, is_first = F.col("__void"), F.coalesce("__is_first", F.lit(False))
    again = F.col("__n") - is_first.cast("long")
    cut, start = F.col("__cut"), F.col("__start")
    rows = (rows.withColumn("__blank", F.when(blank, F.col("__n")).otherwise(0))
            .withColumn("__dup", F.when(blank, 0).otherwise(again))
            .withColumn("__trunc", (~blank & is_first & cut).cast("long"))
            .withColumn("__kind", F.when(blank | ~is_first, "d").when(cut, F.upper(start)).otherwise(start))
            .drop("__is_first", "__void", "__cut"))
    return numbered(rows, [_order(c) for c in ("__conv", "__turn", "__key")], "__g", "conversation-turns")


def _verdicts(turns: DataFrame) -> DataFrame:
    """Per conversation: counts of faults, cost and audit."""
    conv = turns.schema["__conv"].dataType
    schema = T.StructType([T.StructField("__conv", conv), *T._parse_datatype_string(_PIECE).fields])
    arrow = pa.schema([("__conv", pa.int64() if isinstance(conv, T.LongType) else pa.int32()
                        if isinstance(conv, T.IntegerType) else pa.string()),
                       *((n, pa.string() if n == "__edge" else pa.list_(pa.int64()) if n == "__cost"
                          else pa.list_(pa.string()) if n == "__audit" else pa.int64()) for n in _PIECE_NAMES)])
    total = turns.count()

    def gathered(df, columns, shift):
        key = F.shiftright("__at", shift)
        return (df.groupBy("__conv", key.alias("__b"))
                .agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("__rows")).select("__conv", "__rows"))

    rows = turns.withColumn("__at", F.col("__g"))
    columns = ["__g", "__turn", F.col("__start").alias("__role"), "__kind", "__n", *_SUMS]
    shift = _BLOCK
    pieces = gathered(rows, columns, shift).mapInArrow(_each("__conv", arrow, _block), schema)
    while 1 << shift < total:
        shift += _FAN
        # at most 2 ** _FAN pieces a group, so a conversation of any length is combined by many tasks
        pieces = gathered(materialise(pieces, "conversation-pieces"), _PIECE_NAMES, shift).mapInArrow(
            _each("__conv", arrow, _merge), schema)
    best = F.array_min(F.array(*(F.struct(F.col("__cost")[q].alias("cost"), F.col("__audit")[q].alias("audit"))
                                 for q in FINAL)))
    width = F.col("__hi").cast("decimal(38,0)") - F.col("__lo") + 1 - F.col("__turns")
    gaps = F.when(F.col("__lo").isNull(), 0).otherwise(F.least(F.lit(LONG), width)).cast("long")
    return (pieces.withColumn("__best", best)
            .select("__conv", gaps.alias("gaps"), F.col("__blank").alias("blank"), F.col("__dup").alias("duplicate"),
                    F.col("__trunc").alias("truncated"), F.col("__illegal").alias("illegal"),
                    F.col("__best.cost").alias("cost"), F.col("__best.audit").alias("audit")))


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _walked(conversations: DataFrame, copies: Column, turns: bool) -> DataFrame:
    rows = _rows(conversations, copies)
    # written once: every count below it is used twice, and the walk should not parse again
    verdicts = materialise(_verdicts(_turns(rows)), "conversation-verdicts")
    heads = verdicts.select("__conv", F.lit(-1).alias("__side"), F.lit("").alias("__role"), F.lit("").alias("__text"),
                            F.lit(0).cast("long").alias("__n"), "audit", *_COUNTS, F.lit(None).cast("long").alias("__turn"),
                            F.lit(None).cast("binary").alias("__key"))
    body = rows.select("__conv", F.lit(0).alias("__side"), "__role", "__text", "__n", F.lit(None).cast("string").alias("audit"),
                       *(F.lit(None).cast("long").alias(c) for c in _COUNTS), "__turn", "__key")
    # the only shuffle of the texts; the order is that of the places, so copies come one after the other
    sorted_rows = (heads.unionAll(body).repartition("__conv")
                   .sortWithinPartitions(_order("__conv"), "__side", _order("__turn"), "__key").drop("__turn", "__key"))
    conv = rows.schema["__conv"].dataType
    id_type = pa.int64() if isinstance(conv, T.LongType) else pa.int32() if isinstance(conv, T.IntegerType) else pa.string()
    if turns:
        arrow = [("conv_id", id_type), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]
        more = "place long, role string, text string, edit string"
    else:
        arrow = [("conv_id", id_type), *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string()),
                 ("repaired_sha256", pa.string())]
        more = ", ".join([*(f"{c} long" for c in _COUNTS), "audit string, repaired_sha256 string"])
    schema = T.StructType([T.StructField("conv_id", conv), *T._parse_datatype_string(more).fields])
    return sorted_rows.mapInArrow(_stream(pa.schema(arrow), turns), schema)


def repair(conversations: DataFrame, copies: Column | None = None) -> DataFrame:
    """The cheapest repair of each conversation: counts of faults, ``cost``, ``audit`` and ``repaired_sha256``.

    Turns are taken by ``turn`` (nulls first; rows of one turn by a hash of role and text), a null role or text is one
    blank, a null ``conv_id`` is a conversation like any other.  ``copies`` says how often a row stands there
    (once if not given; a conversation all of whose rows stand there zero times has no row here).
    Repeated rows are counted, not multiplied.  ``gaps`` ends at the largest long.
    Other columns of the table, whatever their names, are not looked at.  An empty table gives no rows.

    Blocks of 256 turns are parsed apart and their cells combined 64 at a time, so a conversation that holds a
    third of all rows is many tasks' work.  Only the hash, which is sequential by nature, and the audit, one string
    by contract, pass one task per conversation: there its turns stream by and are never held.
    """
    return _walked(conversations, F.lit(1) if copies is None else copies, False)


def repaired_turns(conversations: DataFrame, copies: Column | None = None) -> DataFrame:
    """The repaired turns: ``conv_id``, ``place`` from 0, ``role``, ``text`` and the ``edit`` that gave them."""
    return _walked(conversations, F.lit(1) if copies is None else copies, True)


def damage(conversations: DataFrame) -> tuple[DataFrame, str]:
    """Rows damaged by crc32(``conv_id:turn``) modulo 20, and the name of the column that counts their copies."""
    name, = fresh(conversations, "__copies")
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return (conversations.withColumn(name, F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1))
            .withColumn("text", F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text))
            .withColumn("role", F.when(fate == 4, "user").otherwise(role))), name


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Damage the conversations, repair them and return a row for every original one."""
    damaged, copies = damage(conversations)
    damaged = damaged.select("conv_id", "turn", "role", "text", copies)
    got = repair(damaged, F.col(copies))
    gone = damaged.groupBy("conv_id").agg(F.max(copies).alias("__most")).filter("__most = 0")
    zeros = gone.select("conv_id", *(F.lit(0).cast("long").alias(c) for c in _COUNTS), F.lit("").alias("audit"),
                        F.lit(hashlib.sha256(b"").hexdigest()).alias("repaired_sha256"))
    return got.unionByName(zeros)


# The same in SQL: a row after the other, all states at once, insertions before each row and at the end.
ORACLE = r"""
WITH RECURSIVE keyed AS (
  SELECT *, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                           lambda c: ascii(c)::BIGINT) AS bytes FROM conversations
), fated AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b: list_reduce(
           [xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1))))) % 20 AS fate FROM keyed
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM fated
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS pos,
         regexp_replace(text, '[\x20\x09-\x0D]+\z', '') AS body FROM damaged
), marked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS seen FROM numbered
), faults AS (
  SELECT *, body = '' AS blank, body <> '' AND seen AS again, body <> '' AND NOT seen AND right(body, 1) NOT IN ('.', '!', '?') AS cut,
         left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM marked
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (pos > 1 AND before || r NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n
  FROM faults GROUP BY conv_id
), step(p, r, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), inserts(p, q, k, made) AS (
  SELECT p, p, 0, '' FROM range(4) t(p) UNION ALL
  VALUES (0, 2, 1, chr(10) || 'user:'), (0, 3, 2, chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 2, 1, chr(10) || 'user:'),
         (1, 3, 2, chr(10) || 'user:' || chr(10) || 'assistant:'), (2, 3, 1, chr(10) || 'assistant:'), (3, 2, 1, chr(10) || 'user:')
), edits AS (
  SELECT conv_id, pos, 4 AS cost, 'D' AS edit, NULL AS r, '' AS made FROM faults UNION ALL
  SELECT conv_id, pos, CASE WHEN cut THEN 3 ELSE 0 END, 'K', r, chr(10) || role || ':' || text FROM faults WHERE NOT blank AND NOT again
  UNION ALL SELECT conv_id, pos, CASE WHEN cut THEN 6 ELSE 3 END, 'R', left(full_role, 1), chr(10) || full_role || ':' || text
  FROM faults, (VALUES ('user'), ('assistant')) t(full_role) WHERE NOT blank AND NOT again
), parsed AS (
  SELECT conv_id, 0::BIGINT AS pos, 0 AS state, {'cost': 0::BIGINT, 'audit': '', 'made': ''} AS best FROM counts
  UNION ALL
  SELECT s.conv_id, e.pos, coalesce(t.q, i.q), min({'cost': s.best.cost + 3 * i.k + e.cost, 'audit': s.best.audit || repeat('I', i.k) || e.edit,
         'made': s.best.made || i.made || e.made})
  FROM parsed s JOIN edits e ON e.conv_id IS NOT DISTINCT FROM s.conv_id AND e.pos = s.pos + 1 JOIN inserts i ON i.p = s.state
  LEFT JOIN step t ON t.p = i.q AND t.r = e.r WHERE e.edit = 'D' OR t.q IS NOT NULL
  GROUP BY s.conv_id, e.pos, coalesce(t.q, i.q)
), ended AS (
  SELECT s.conv_id, min({'cost': s.best.cost + 3 * i.k, 'audit': s.best.audit || repeat('I', i.k), 'made': s.best.made || i.made}) AS best
  FROM parsed s JOIN counts c ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND c.n = s.pos JOIN inserts i ON i.p = s.state
  WHERE i.q IN (0, 3) GROUP BY s.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.best.cost, 0) AS cost,
       coalesce(e.best.audit, '') AS audit, sha256(substr(coalesce(e.best.made, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
