"""Conversation repair against a plain left-to-right search over whole audits."""

import hashlib
import random
import re

import compare
from pyspark.sql import functions as F

from tallywatch.llm import turn_repair as R


def plain(rows):
    """(blank, duplicate, truncated, illegal, cost, audit, digest) of (role, text) rows, keeping every best way as a whole."""
    faults, seen = [], set()
    for role, text in rows:
        inked = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("b" if not inked else "d" if (role, text) in seen else "" if inked[-1] in ".!?" else "t")
        seen.add((role, text))
    follows = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def inserted(ways):
        out = dict(ways)
        for _ in range(2):
            for state, (cost, audit, said) in list(out.items()):
                to = follows[state]
                new = (cost + 3, audit + "I", (*said, f"{name[to]}:"))
                if to not in out or new < out[to]:
                    out[to] = new
        return out

    def better(ways, state, new):
        if state not in ways or new < ways[state]:
            ways[state] = new

    ways = {"": (0, "", ())}
    for (role, text), fault in zip(rows, faults, strict=True):
        after = {}
        # Ways before an insert may be cheaper, or equal and less, after it: keep all (state, way) pairs with up to two inserts.
        starts = [(s, w) for s, w in ways.items()]
        for _ in range(2):
            starts += [(follows[s], (c + 3, a + "I", (*t, f"{name[follows[s]]}:"))) for s, (c, a, t) in starts]
        for state, (cost, audit, said) in starts:
            better(after, state, (cost + 4, audit + "D", said))
            if fault not in ("b", "d"):
                more = 3 if fault == "t" else 0
                to = follows[state]
                better(after, to, (cost + 3 + more, audit + "R", (*said, f"{name[to]}:{text}")))
                initial = role[:1]
                if initial == to or (initial == "s" and state == ""):
                    better(after, initial, (cost + more, audit + "K", (*said, f"{role}:{text}")))
        ways = after
    ends = [ways[s] for s in ("", "a") if s in ways] + [w for s, w in inserted({s: w for s, w in ways.items() if s}).items() if s == "a"]
    cost, audit, said = min(ends)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()


def random_rows(seed, n):
    pick = random.Random(seed)
    roles, texts = ["system", "user", "assistant", "user", "assistant", "tool", ""], ["Yes.", "no", " \t", "", "Well!", "why?", "so\n", "a b. "]
    return [(pick.choice(roles), pick.choice(texts) if pick.random() < 0.4 else f"said {pick.random()}{pick.choice(['.', '', '!'])}") for _ in range(n)]


def solve(rows, cut):
    """The operator's own steps on one conversation, in chunks of ``cut`` rows."""
    faults, seen = [], set()
    codes = ""
    for role, text in rows:
        inked = text.rstrip(" \t\n\x0b\x0c\r")
        gone = not inked or (role, text) in seen
        seen.add((role, text))
        kind = "sua".find(role[:1]) if role[:1] and role[:1] in "sua" else 3
        codes += R.row_code(kind, 2 if gone else 0 if inked[-1] in ".!?" else 1)
    parts = [codes[i : i + cut] for i in range(0, len(codes), cut)]
    steps = [R.folded([R.STEPS[c] for c in p]) for p in parts]
    states = [0, *R.crossings([*steps, R.END], 0, 0)]
    cost, audit = 0, ""
    for part, start, end in zip(parts, states, states[1:], strict=False):
        own, audits = R.solved(part, start, end)
        cost, audit = cost + own, audit + "".join(audits)
    more, tail = R.closing(states[-1])
    return cost + more, audit + tail


def test_audits_are_cheapest_and_least_in_chunks_of_any_size():
    for seed in range(400):
        rows = random_rows(seed, 1 + seed % 13)
        want = plain(rows)[4:6]
        assert re.fullmatch("[DIKR]+", want[1])
        for cut in (1, 2, 5, 100):
            assert solve(rows, cut) == want, (rows, cut)


def table(spark, conversations):
    rows = [(conv, turn, role, text, "own", 7) for conv, said in conversations.items() for turn, (role, text) in enumerate(said)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string, part int")


def test_tables_with_a_hot_conversation_and_many_parts(spark):
    said = {k: random_rows(k, 1 + k % 9) for k in range(60)} | {1000: random_rows(1000, 400)}
    for chunk_rows in (3, R.CHUNK_ROWS):
        found = {r["conv_id"]: r for r in R.repaired(table(spark, said).repartition(5), chunk_rows).collect()}
        assert len(found) == len(said)
        for conv, rows in said.items():
            r = found[conv]
            assert (r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) == plain(rows), conv
            assert r.gaps == 0


def test_nulls_ties_and_empty_tables(spark):
    rows = [
        (None, None, None, None), (None, 3, "user", "Hi."), (1, None, "user", "First."), (1, 5, "assistant", "Last."), (1, 9, "assistant", "Last."),
        (2, 1, "user", "same?"), (2, 1, "user", "same?"), (2, 1, "assistant", "tie."), (3, 4, "user", None), (4, None, "system", "alone."), (5, 1, "user", "word " * 30_000 + "."),
    ]
    schema = "conv_id long, turn long, role string, text string"
    found = {r["conv_id"]: r for r in R.repaired(spark.createDataFrame(rows, schema)).collect()}
    assert (found[None].blank, found[None].audit, found[None].gaps) == (1, "DKI", 0)
    assert (found[1].gaps, found[1].duplicate, found[1].audit) == (3, 1, "KKD")
    assert (found[2].duplicate, found[2].illegal, found[2].audit) == (1, 1, plain([("assistant", "tie."), ("user", "same?"), ("user", "same?")])[5])
    assert (found[3].blank, found[3].audit, found[3].cost) == (1, "D", 4)
    assert (found[4].gaps, found[4].audit) == (0, "D")
    assert found[5].audit == "KI"
    assert R.repaired(spark.createDataFrame([], schema)).count() == 0


def test_query_equals_sql_with_odd_rows(spark, tmp_path, tiny):
    own = spark.read.parquet(f"{tiny}/conversations.parquet").select("conv_id", "turn", "role", "text")
    odd = [(None, None, None, None), (None, 2, "user", "x"), (70_001, None, "user", None), (70_001, 3, None, "Yes."), (70_002, 1, "", "?"), (70_003, -4, "user", "ü你 "), (70_003, 9, "assistant", "ok.")]
    own.unionByName(spark.createDataFrame(odd, own.schema)).coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = compare.duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert compare.differences(R.op11_turn_repair(spark, str(tmp_path)), con, R.OP11_SQL) is None


def test_damage_by_checksum(spark):
    import zlib

    rows = [(c, t, "assistant", "One. Two!") for c in range(30) for t in range(8)]
    out = R.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).groupBy("conv_id", "turn").agg(F.count("*").alias("n"), F.first("role").alias("role"), F.first("text").alias("text"))
    found = {(r.conv_id, r.turn): (r.n, r.role, r.text) for r in out.collect()}
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{c}:{t}".encode()) % 20
        want = None if fault == 0 else (2 if fault == 3 else 1, "user" if fault == 4 else role, "" if fault == 1 else "One Two" if fault == 2 else text)
        assert found.get((c, t)) == want
