"""Conversation structure repair: the cheapest edits that make turns alternate, found by Hirschberg's divide and conquer.

A repaired conversation is empty, or an optional system turn and then user and assistant turns in alternation. What may come
next depends on one of four states: nothing yet, after a system turn, after a user turn, after an assistant turn. A row of
the conversation is a step between states; so is a whole chunk of rows, and one that is known by its 4 x 4 least costs can
stand in for its rows. The same code thus finds the states between chunks, and those between the rows of a chunk: costs
from the front and from the back meet in the middle, the crossing state is chosen there, and both halves are solved alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallywatch.llm import common

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: What edits cost, and what a row that is kept or given a role costs more if it is cut off.
REROLE_COST, DELETE_COST, INSERT_COST, CUT_COST = 3, 4, 3, 3
#: Rows, and characters, of a conversation that are solved and held together.
CHUNK_ROWS, CHUNK_CHARS = 512, 4_000_000

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
_NEXT = (USER, USER, ASSISTANT, USER)
_FINE, _CUT, _GONE = range(3)  # a row that may stay, that may stay but is cut off, that must go
_KINDS = "sua"

#: A step: (state before, state after, cost, audit), at most one for two states; audits are compared where costs are equal.
Step = tuple[tuple[int, int, int, object], ...]


def _inserts(state: int) -> list[tuple[int, int, str]]:
    """(state, cost, audit) after up to two inserts; three lead where one does."""
    one = _NEXT[state]
    return [(state, 0, ""), (one, INSERT_COST, INSERT), (_NEXT[one], 2 * INSERT_COST, 2 * INSERT)]


def _row_step(kind: int, fault: int) -> Step:
    """The step of a row, with the inserts before it. ``kind``: place of its role's initial in ``_KINDS``, 3 for any other."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for before in range(4):
        for state, cost, audit in _inserts(before):
            ways = [(state, DELETE_COST, DELETE)]
            if fault != _GONE:
                more = CUT_COST if fault == _CUT else 0
                ways.append((_NEXT[state], REROLE_COST + more, REROLE))
                if (kind == 0 and state == NOTHING) or (kind in (1, 2) and _NEXT[state] == kind + 1):
                    ways.append((kind + 1, more, KEEP))
            for after, own, edit in ways:
                new = (cost + own, audit + edit)
                best[before, after] = min(best.get((before, after), new), new)
    return tuple((s, t, cost, audit) for (s, t), (cost, audit) in sorted(best.items()))


def row_code(kind: int, fault: int) -> str:
    return chr(ord("a") + 3 * kind + fault)


STEPS: dict[str, Step] = {row_code(kind, fault): _row_step(kind, fault) for kind in range(4) for fault in range(3)}
#: From the state after the last row to the end.
END: Step = ((NOTHING, NOTHING, 0, ""), (SYSTEM, NOTHING, 2 * INSERT_COST, 2 * INSERT), (USER, NOTHING, INSERT_COST, INSERT), (ASSISTANT, NOTHING, 0, ""))


def forward(steps: Sequence[Step], start: int) -> dict[int, tuple[int, int]]:
    """For each state that can be reached: least cost, and the rank of its least audit among the states'.

    Audits of equally many rows are never the beginning of one another, as each ends with a row's own edit. So their order
    is settled by what they are, not by what follows, and ranks stand for them.
    """
    reached = {start: (0, 0)}
    for step in steps:
        best: dict[int, tuple] = {}
        for s, t, cost, audit in step:
            if s in reached:
                new = (reached[s][0] + cost, reached[s][1], audit)
                if t not in best or new < best[t]:
                    best[t] = new
        order = {t: rank for rank, t in enumerate(sorted(best, key=lambda t: best[t][1:]))}
        reached = {t: (new[0], order[t]) for t, new in best.items()}
    return reached


def backward(steps: Sequence[Step], end: int) -> dict[int, int]:
    """For each state from which ``end`` can be reached, the least cost."""
    left = {end: 0}
    for step in reversed(steps):
        now: dict[int, int] = {}
        for s, t, cost, _ in step:
            if t in left and (s not in now or cost + left[t] < now[s]):
                now[s] = cost + left[t]
        left = now
    return left


def crossings(steps: Sequence[Step], start: int, end: int) -> list[int]:
    """The states between steps on the cheapest way from ``start`` to ``end``, of equally cheap ones the audit-least."""
    if len(steps) < 2:
        return []
    half = len(steps) // 2
    front, back = forward(steps[:half], start), backward(steps[half:], end)
    middle = min((cost + back[s], rank, s) for s, (cost, rank) in front.items() if s in back)[2]
    return [*crossings(steps[:half], start, middle), middle, *crossings(steps[half:], middle, end)]


def folded(steps: Sequence[Step]) -> Step:
    """A step that stands for all of ``steps``; its audits are ranks, comparable where the state before is the same."""
    return tuple((s, t, cost, rank) for s in range(4) for t, (cost, rank) in sorted(forward(steps, s).items()))


def _solve(codes: str, start: int, end: int) -> tuple[int, tuple[str, ...]]:
    """Cost, and audit of each row, of a chunk between two states."""
    steps = [STEPS[c] for c in codes]
    states = [start, *crossings(steps, start, end), end]
    found = [next((cost, audit) for s, t, cost, audit in step if (s, t) == pair) for step, pair in zip(steps, zip(states, states[1:], strict=False), strict=True)]
    return sum(c for c, _ in found), tuple(a for _, a in found)


_solve_short = lru_cache(maxsize=50_000)(_solve)


def solved(codes: str, start: int, end: int) -> tuple[int, tuple[str, ...]]:
    return (_solve_short if len(codes) <= 32 else _solve)(codes, start, end)


def last_state(steps: Sequence[Step], start: int = NOTHING) -> int:
    """The state before the end of a conversation that begins at ``start``."""
    return crossings([folded(steps), END], start, NOTHING)[0] if steps else start


def edited(roles: Sequence[str], texts: Sequence[str], audits: Sequence[str], start: int) -> Iterator[tuple[str, str]]:
    """The repaired turns of a chunk."""
    state = start
    for role, text, audit in zip(roles, texts, audits, strict=True):
        for edit in audit:
            if edit == DELETE:
                continue
            state = SYSTEM if edit == KEEP and state == NOTHING and role[:1] == "s" else _NEXT[state]
            yield (role if edit == KEEP else ROLES[state]), ("" if edit == INSERT else text)


def closing(state: int) -> tuple[int, str]:
    return next((cost, audit) for s, _, cost, audit in END if s == state)


# ---- on tables --------------------------------------------------------------------------------

_SPACE = " \t\n\x0b\x0c\r"
_CHUNKS = (
    "conv string, conv_id long, part int, chunk long, blank long, duplicate long, truncated long, illegal long, first string, last string, codes string, "
    "cost long, audit string, sha256 string, roles array<string>, texts array<string>, steps array<long>"
)
_BORDERS = "conv string, part int, chunk long, start int, end int"
_RESULT = "conv string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _key() -> Column:
    """conv_id as text, '' for null: an integer is never that."""
    return F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv")


def with_duplicates(turns: DataFrame) -> DataFrame:
    """Adds ``repeats``: whether the conversation has a row of this role and text before. Rows need ``row``, a number of their own."""
    same = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    keyed = turns.withColumn("same", same)
    firsts = keyed.groupBy("conv", "same").agg(F.min(F.struct("turn", "row")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    firsts = common.stored(firsts.select("conv", "same", F.col("first.row").alias("first_row"), "n"), "turn-repeats")
    joined = common.join_unique(keyed, firsts, ["conv", "same"], "n", "left")
    return joined.withColumn("repeats", F.coalesce(F.col("first_row") != F.col("row"), F.lit(False))).drop("same", "first_row", "n")


def _flat(step: Step) -> list[int]:
    return [x for edge in step for x in edge]


def _step(flat: Sequence[int]) -> Step:
    whole = [int(x) for x in flat]
    return tuple(zip(whole[0::4], whole[1::4], whole[2::4], whole[3::4], strict=True))


def _digest(turns: Iterator[tuple[str, str]], digest, begun: bool) -> bool:
    """Adds the turns to a digest, joined by newlines; whether it has any."""
    for role, text in turns:
        digest.update((("\n" if begun else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        begun = True
    return begun


def _closing_turns(state: int) -> Iterator[tuple[str, str]]:
    for edit in closing(state)[1]:
        state = _NEXT[state]
        yield ROLES[state], ""


def chunks(turns: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows of conversations in order, cut into chunks: counts, what the chunk costs from any state to any other, and its rows.

    Rows are dealt by ranges of (conversation, turn), so a conversation with any share of the rows is the work of many tasks.
    A conversation that is one chunk and does not touch a border of its part is solved at once: it has an audit and a digest
    instead of rows.
    """
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text", "row"]
    last = F.right(F.rtrim("text", F.lit(_SPACE)), F.lit(1))
    fault = F.when(last == "", "b").when(F.col("repeats"), "d").when(last.isin(".", "!", "?"), "").otherwise("t")
    dealt = turns.select("conv", "conv_id", "turn", "role", "text", fault.alias("fault"), "row").repartitionByRange(*order).sortWithinPartitions(*order)
    schema = to_arrow_schema(T.StructType.fromDDL(_CHUNKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rows = common.arrow_rows(batches, ["conv", "conv_id", "role", "text", "fault"])

        def made() -> Iterator[tuple]:
            number, n_runs, row = 0, 0, next(rows, None)
            while row is not None:
                conv, held, size, n_chunks, before = row[0], [], 0, 0, None
                while row is not None and row[0] == conv:
                    if held and (len(held) >= chunk_rows or size + len(row[3]) > CHUNK_CHARS):
                        yield _chunk(held, part, number, before, False)
                        before, held, size, number, n_chunks = held[-1], [], 0, number + 1, n_chunks + 1
                    held.append(row)
                    size += len(row[3])
                    row = next(rows, None)
                yield _chunk(held, part, number, before, n_runs > 0 and row is not None and not n_chunks)
                number, n_runs = number + 1, n_runs + 1

        yield from common.arrow_batches(made(), schema, 200)

    return dealt.mapInArrow(run, _CHUNKS)


def _chunk(rows: list[tuple], part: int, number: int, before: tuple | None, whole: bool) -> tuple:
    faults = [r[4] for r in rows]
    initials = [r[2][:1] for r in rows]
    pairs = zip([before[2][:1], *initials] if before else initials, initials if before else initials[1:], strict=False)
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in pairs)
    kinds = [_KINDS.find(i) if i and i in _KINDS else 3 for i in initials]
    codes = "".join(row_code(k, _GONE if f in ("b", "d") else _CUT if f == "t" else _FINE) for k, f in zip(kinds, faults, strict=True))
    counts = faults.count("b"), faults.count("d"), faults.count("t"), illegal
    head = (rows[0][0], rows[0][1], part, number, *counts, initials[0], initials[-1], codes)
    steps = [STEPS[c] for c in codes]
    if not whole:
        return (*head, None, None, None, [r[2] for r in rows], [r[3] for r in rows], _flat(folded(steps)))
    end = _end_of(codes) if len(codes) <= 32 else last_state(steps)
    cost, audits = solved(codes, NOTHING, end)
    digest = hashlib.sha256()
    begun = _digest(edited([r[2] for r in rows], [r[3] for r in rows], audits, NOTHING), digest, False)
    _digest(_closing_turns(end), digest, begun)
    more, audit = closing(end)
    return (*head, cost + more, "".join(audits) + audit, digest.hexdigest(), None, None, None)


@lru_cache(maxsize=50_000)
def _end_of(codes: str) -> int:
    return last_state([STEPS[c] for c in codes])


def borders(open_chunks: DataFrame) -> DataFrame:
    """The states at both ends of each chunk. A task gets the chunks of a conversation in one part, or one row for each part."""
    steps = open_chunks.select("conv", "part", "chunk", "steps")

    def run_step(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        return pd.DataFrame({"conv": rows["conv"].iloc[:1], "part": rows["part"].iloc[:1], "steps": [_flat(folded([_step(x) for x in rows["steps"]]))]})

    def across_parts(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        states = [NOTHING, *crossings([*(_step(x) for x in rows["steps"]), END], NOTHING, NOTHING)]
        return pd.DataFrame({"conv": rows["conv"], "part": rows["part"], "from": states[:-1], "to": states[1:]})

    def inside_part(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        start, end = int(rows["from"].iloc[0]), int(rows["to"].iloc[0])
        states = [start, *crossings([_step(x) for x in rows["steps"]], start, end), end]
        return pd.DataFrame({"conv": rows["conv"], "part": rows["part"], "chunk": rows["chunk"], "start": states[:-1], "end": states[1:]})

    runs = steps.groupBy("conv", "part").applyInPandas(run_step, "conv string, part int, steps array<long>")
    ends = runs.groupBy("conv").applyInPandas(across_parts, "conv string, part int, from int, to int")
    return steps.join(ends, ["conv", "part"]).groupBy("conv", "part").applyInPandas(inside_part, _BORDERS)


def _joined(open_chunks: DataFrame) -> DataFrame:
    """One row per conversation from its chunks: they are streamed in order, and only one is held."""
    dealt = open_chunks.repartition("conv").sortWithinPartitions("conv", "part", "chunk")
    schema = to_arrow_schema(T.StructType.fromDDL(_RESULT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "part", "blank", "duplicate", "truncated", "illegal", "first", "last", "codes", "roles", "texts", "start", "end"]
        rows = common.arrow_rows(batches, names)

        def made() -> Iterator[tuple]:
            row = next(rows, None)
            while row is not None:
                conv, counts, cost, audit, digest, begun, part, last = row[0], [0, 0, 0, 0], 0, [], hashlib.sha256(), False, None, ""
                while row is not None and row[0] == conv:
                    counts = [a + b for a, b in zip(counts, row[2:6], strict=True)]
                    if part is not None and part != row[1]:  # inside a part, a chunk has counted the step into it
                        counts[3] += last + row[6] not in ("su", "ua", "au")
                    own, audits = solved(row[8], row[11], row[12])
                    begun = _digest(edited(row[9], row[10], audits, row[11]), digest, begun)
                    cost, part, last, state = cost + own, row[1], row[7], row[12]
                    audit.append("".join(audits))
                    row = next(rows, None)
                _digest(_closing_turns(state), digest, begun)
                more, tail = closing(state)
                yield conv, *counts, cost + more, "".join(audit) + tail, digest.hexdigest()

        yield from common.arrow_batches(made(), schema, 200)

    return dealt.mapInArrow(run, _RESULT)


def repaired(conversations: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of each conversation that has rows.

    Rows are taken by turn (nulls first), then role and text. A row's first fault counts: blank, duplicate (role and text
    seen before in the conversation), truncated (its last character but white space is none of ``.!?``). A null role or
    text is one space; rows of a null conv_id are one conversation; repeated rows are duplicates; an empty table gives no
    rows; other columns are ignored.
    """
    turns = conversations.select(
        _key(), F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    )
    turns = common.stored(turns.withColumn("row", F.monotonically_increasing_id()), "turns")
    cut = common.stored(chunks(with_duplicates(turns), chunk_rows), "turn-chunks")
    done = cut.filter("audit IS NOT NULL").select("conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("sha256").alias("repaired_sha256"))
    unsolved = cut.filter("audit IS NULL")
    found = common.stored(borders(unsolved), "turn-borders")
    results = done.unionByName(_joined(unsolved.join(found, ["conv", "part", "chunk"])))
    distinct_turns = turns.groupBy("conv", "conv_id", "turn").agg(F.lit(1))
    gaps = distinct_turns.groupBy("conv", "conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    return gaps.join(results, "conv").drop("conv")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults chosen by the crc32 of conv_id and turn: rows dropped, emptied, cut, repeated, or made the user's."""
    space = F.lit(" ")
    said = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(said) % 20).alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return rows.filter("fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = common.table(spark, sf_dir, "conversations")
    found = repaired(damaged(conversations)).withColumn("conv", _key()).drop("conv_id")
    zeros = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    named = conversations.select("conv_id").distinct().withColumn("conv", _key())
    return named.join(found, "conv", "left").select(
        "conv_id", *zeros.values(), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")
    )


OP11_SQL = r"""
WITH RECURSIVE bits(n, k, c) AS (
  SELECT n, 0, n FROM range(0, 256) AS r(n)
  UNION ALL SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM bits WHERE k < 8
),
crc AS (SELECT list(c ORDER BY n) AS entries FROM bits WHERE k = 8),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    [4294967295] || [ord(x) for x in string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '')] AS bytes
  FROM conversations
),
hurt AS (
  SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(bytes, lambda a, b: xor(a >> 8, entries[(xor(a, b) & 255) + 1]))) % 20 AS fault
  FROM named, crc
),
copied AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(0, CASE fault WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hurt WHERE fault <> 0
),
placed AS (
  SELECT coalesce(CAST(conv_id AS VARCHAR), '') AS conv, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM copied
),
judged AS (
  SELECT *, right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS final,
    row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) > 1 AS again, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY pos) AS previous
  FROM placed
),
faulty AS (
  SELECT *, CASE WHEN final = '' THEN 'b' WHEN again THEN 'd' WHEN final IN ('.', '!', '?') THEN '' ELSE 't' END AS fault,
    CASE initial WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 ELSE 0 END AS kind
  FROM judged
),
counted AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (pos > 1 AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n
  FROM faulty GROUP BY conv
),
follows(s, t, name) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
inserts AS (
  SELECT s, s AS t, 0 AS cost, '' AS audit, '' AS body FROM follows
  UNION ALL SELECT s, t, 3, 'I', name || ':' || chr(10) FROM follows
  UNION ALL SELECT a.s, b.t, 6, 'II', a.name || ':' || chr(10) || b.name || ':' || chr(10) FROM follows a JOIN follows b ON a.t = b.s
),
edits AS (
  SELECT s, t AS u, t, 'D' AS edit, NULL AS kind, 4 AS cost, '' AS name, i.cost AS before, audit, body FROM inserts i
  UNION ALL SELECT i.s, i.t, f.t, 'R', NULL, 3, f.name, i.cost, audit, body FROM inserts i JOIN follows f ON i.t = f.s
  UNION ALL SELECT i.s, i.t, f.t, 'K', f.t, 0, NULL, i.cost, audit, body FROM inserts i JOIN follows f ON i.t = f.s
  UNION ALL SELECT i.s, i.t, 1, 'K', 1, 0, NULL, i.cost, audit, body FROM inserts i WHERE i.t = 0
),
ways(conv, pos, state, best) AS (
  SELECT conv, CAST(0 AS BIGINT), 0, {'cost': 0, 'audit': '', 'body': ''} FROM counted
  UNION ALL
  SELECT w.conv, f.pos, e.t, min({
    'cost': w.best.cost + e.before + e.cost + CASE WHEN e.edit <> 'D' AND f.fault = 't' THEN 3 ELSE 0 END,
    'audit': w.best.audit || e.audit || e.edit,
    'body': w.best.body || e.body || CASE WHEN e.edit = 'D' THEN '' ELSE coalesce(e.name, f.role) || ':' || f.text || chr(10) END})
  FROM ways w JOIN faulty f ON f.conv = w.conv AND f.pos = w.pos + 1
  JOIN edits e ON e.s = w.state AND (e.kind IS NULL OR e.kind = f.kind) AND (e.edit = 'D' OR f.fault NOT IN ('b', 'd'))
  GROUP BY w.conv, f.pos, e.t
),
ended AS (
  SELECT c.conv, min({'cost': w.best.cost + i.cost, 'audit': w.best.audit || i.audit, 'body': w.best.body || i.body}) AS best
  FROM counted c JOIN ways w ON w.conv = c.conv AND w.pos = c.n JOIN inserts i ON i.s = w.state
  WHERE i.t = 3 OR (i.s = 0 AND i.t = 0) GROUP BY c.conv
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.audit, '') AS audit,
  sha256(coalesce(left(best.body, length(best.body) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv = coalesce(CAST(o.conv_id AS VARCHAR), '') LEFT JOIN ended e ON e.conv = c.conv
"""
