"""Packing, mixing, sharding, chat formatting, helpers and the pipeline."""

import math
import random
from collections import Counter, defaultdict

import compare
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tallywatch.llm import chat_format as cf
from tallywatch.llm import common, mixing, packing, queries, sharding
from tallywatch.llm.chat_template import TemplateError, compile_template, fold, parse


def test_registered():
    numbers = {name.split("_")[0] for name in entry.queries() if name.startswith("op")}
    assert numbers == {f"op{n}" for n in range(1, 14)} and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, tiny, name):
    assert compare.differences(queries.QUERIES[name](spark, tiny), compare.duck(tiny), queries.ORACLE[name]) is None


def slow_best_fit(items, capacity):
    bins, where = [], {}
    rests = []
    for at, (words, *_) in enumerate(items):
        whole, rest = divmod(words, capacity)
        bins += [[0, set(), set()] for _ in range(whole)]
        if rest or not whole:
            rests.append((-rest, at))
    for rest, at in sorted(rests):
        _, source, cluster = items[at]
        fits = [(b[0], k) for k, b in enumerate(bins) if b[1] and b[0] >= -rest and source not in b[1] and cluster not in b[2]]
        if fits:
            k = min(fits)[1]
        else:
            bins.append([capacity, set(), set()])
            k = len(bins) - 1
        bins[k][0] += rest
        bins[k][1].add(source)
        bins[k][2].add(cluster)
        where[at] = k
    return where


def test_packing_is_tightest_compatible_fit():
    rng = random.Random(6)
    items = [(rng.randint(0, 150), rng.choice("aaabcdef"), rng.randint(0, 60)) for _ in range(300)]
    places = packing.pack_group(items, 100)
    assert {at: p[-1][2] for at, p in enumerate(places) if p[-1][1] < 100} == {k: v for k, v in slow_best_fit(items, 100).items()}


def test_packed_plan_is_whole_and_free_of_conflicts(docs, odd):
    rng = random.Random(9)
    rows = [(i, "w " * rng.randint(0, 120) + f"x{i % 40}", f"s{i % 3}") for i in range(300)]
    plan = packing.packed(docs(*rows), capacity=64, group_rows=100).toPandas()
    text = {i: t.split() for i, t, _ in rows}
    for doc, parts in plan.groupby("doc_id"):
        spans = sorted(zip(parts.first_word, parts.n_words, strict=True))
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False)) and sum(n for _, n in spans) == len(text[doc])
    for _, b in plan.groupby("bin"):
        ends = sorted(zip(b.bin_offset, b.bin_offset + b.n_words, strict=True))
        assert all(x[1] <= y[0] for x, y in zip(ends, ends[1:], strict=False)) and ends[-1][1] <= 64 and not b.source.duplicated().any()
    whole = packing.packed(odd)
    assert Counter(r.doc_id for r in whole.filter("first_word = 0").collect()) == Counter(r.doc_id for r in odd.collect())
    assert packing.packed_texts(odd, whole).count() == whole.count() and packing.packed(odd.limit(0)).count() == 0


def test_poisson_inverse():
    u = (np.arange(20_000) + 0.5) / 20_000
    for rate in (0.3, 1.0, 7.5, 900.0):
        k = mixing.poisson_inverse(u, np.full(len(u), rate))
        assert abs(k.mean() - rate) < 0.02 * rate + 0.001 and abs(k.var() - rate) < 0.03 * rate and (np.diff(k) >= 0).all()
    assert mixing.poisson_inverse(np.array([math.exp(-2) - 1e-9, math.exp(-2) + 1e-9]), np.array([2.0, 2.0])).tolist() == [0, 1]


def test_mixture_has_the_target_weights(docs, odd):
    table = docs(*[(i, "x" * 99, "big" if i % 4 else "small") for i in range(4000)])
    got = mixing.mixed(table, weights={"big": 1, "small": 1}).groupBy("source_key").count().collect()
    assert all(abs(r["count"] - 2000) < 200 for r in got)
    assert mixing.mixed(odd, epochs=3.0).filter("n_copies < 1").count() == 0 and mixing.mixed(odd.limit(0)).count() == 0


def test_mixture_draws_rows_not_ids(spark, tmp_path):
    """Null, repeated and unique ids, null texts and sources, equal rows, and columns named like the operator's own."""
    rows = [(None if i % 3 == 0 else 5 if i % 7 == 1 else i, None if i % 50 == 1 else "same" if i % 6 == 0 else f"text {i}", f"s{i % 4}" if i % 11 else None) for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    con = compare.duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert compare.differences(mixing.op3_poisson_mixing(spark, str(tmp_path)), con, mixing.OP3_SQL) is None
    names = ["_rows", "n_same", "key", "number", "own", "part", "place", "n_rows"]
    out = mixing.mixed(table.selectExpr("*", *(f"'{n}' AS {n}" for n in names)))
    assert {tuple(r) for r in out.select(*names).distinct().collect()} == {tuple(names)}
    assert abs(out.filter("doc_id IS NULL").count() - 1000) < 150


def slow_shards(groups, shards):
    """Smallest possible largest shard, for groups in order, with those above an equal share alone."""
    left, alone = sorted(groups.values(), reverse=True), 0
    while len(left) > 0 and alone < shards - 1 and left[0] * (shards - alone) > sum(left):
        left, alone = left[1:], alone + 1
    sizes = [s for s in groups.values()]
    for big in sorted(groups.values(), reverse=True)[:alone]:
        sizes.remove(big)
    for capacity in range(max(sizes, default=0), sum(sizes) + 1):
        used, room = 0, 0
        for s in sizes:
            if s > room:
                used, room = used + 1, capacity
            room -= s
        if used <= shards - alone:
            return alone, capacity
    return alone, 0


@pytest.mark.parametrize("hot", [0, 60])
def test_shards_are_minimax(docs, hot):
    rng = random.Random(hot)
    rows = [(i, f"{rng.randint(0, 99)}" * rng.randint(1, 30)) for i in range(150)] + [(1000 + i, "hot " * 9) for i in range(hot)]
    groups = defaultdict(int)
    for _, t in sorted(rows):
        groups[t] += len(t) + 8
    got = sharding.sharded(docs(*rows), 6).toPandas().merge(docs(*rows).toPandas()[["doc_id", "text"]])
    assert len(got) == len(rows) and (got.groupby("text").shard.nunique() == 1).all()
    assert (got.groupby("shard").slot.apply(sorted).apply(lambda x: x == list(range(len(x))))).all()
    alone, best = slow_shards(groups, 6)
    assert got[got.shard >= alone].groupby("shard")["size"].sum().max() == best


def test_cuts_are_found_in_fine_steps(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELLS", 16)
    rng = random.Random(3)
    sizes = [rng.randint(1, 50) for _ in range(500)]
    ends = np.cumsum(sizes).tolist()
    cuts = sharding.Prefix(spark.createDataFrame([(e,) for e in ends], "end long"), ends[-1], 7).cuts(-(-ends[-1] // 7))
    _, best = slow_shards(dict(enumerate(sizes)), 7)
    assert max(b - a for a, b in zip([0, *cuts], cuts, strict=False)) == best and cuts[-1] == ends[-1]


def test_shard_odd_rows(odd):
    assert sharding.sharded(odd).count() == odd.count() and sharding.sharded(odd.limit(0)).count() == 0


def test_template_language():
    run = lambda source, **values: "".join(p for p, _ in compile_template(source, cf.FILTERS)(values))
    assert run("{% for x in xs %}{{ loop.index }}{{ x }}{% if loop.last %}.{% elif x == 'b' %};{% else %},{% endif %}{% endfor %}", xs=["a", "b", "c"]) == "1a,2b;3c."
    assert run("{{ a.b['c'] ~ 1 }}{{ not a.z and true }}", a={"b": {"c": "x"}}) == "x1True"
    assert fold(parse("a{{ 'x' ~ 1 }}b{% if 1 == 2 %}no{% else %}yes{% endif %}"), {}) == parse("ax1byes")
    for wrong in ("{% for x in %}", "{% if a %}", "{{ a b }}", "{% import os %}", "{{ a|nothing }}"):
        with pytest.raises(TemplateError):
            run(wrong, a=1)
    with pytest.raises(TemplateError):
        run("{{ a.real }}", a=1)


def test_chat_round_trip_with_control_strings(spark):
    parts = ["\\", "#", "###", "</turn>", "### assistant: ", "\n", "é", "a: b", ""]
    rng = random.Random(1)
    rows = [(i // 3, i % 3, rng.choice(["user", "assistant", "a: b\\", ""]), "".join(rng.choice(parts) for _ in range(6))) for i in range(300)]
    table = spark.createDataFrame([*rows, (None, 0, None, None), (7, 1, "user", None)], "conv_id long, turn long, role string, text string")
    con = compare.duck("/nowhere")
    con.register("conversations", table.toPandas().astype({"conv_id": "Int64"}))
    assert compare.differences(cf.read_back(cf.format_pieces(cf.with_extra(table))), con, cf.OP7_SQL) is None
    whole = cf.formatted(cf.format_pieces(table.filter("conv_id = 0"))).first()
    assert [cf.unescape(whole.text[s["start"]:s["end"]]) for s in whole.learned_spans] == [t for _, _, r, t in rows[:3] if r == "assistant"]
    assert cf.format_pieces(table.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 440)] + [(900, k) for k in range(901, 960)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def test_pipeline_stages(spark, tiny, odd):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = common.stored(stage(spark, docs, tiny), "test-stage")
        assert k == 4 or out.columns == docs.columns
        assert out.count() > 0
        docs = out
    assert docs.groupBy("bin").sum("n_words").agg({"sum(n_words)": "max"}).first()[0] <= packing.CAPACITY
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, odd, tiny).columns == odd.columns
