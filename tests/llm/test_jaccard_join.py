import random

import numpy as np
import pytest

from tallywatch.llm import jaccard_join as jj


def shingles(text, width):
    words = (text or "").lower().split()
    return {tuple(words[k:k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} if words else set()


def brute(rows, width, part, of):
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and of * len(a & sets[j]) >= part * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows))


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    rows = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([2, 5, 12, 40, 150]))]
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 25)):
                copy[rng.randrange(len(copy))] = word()
            rows.append((len(rows), " ".join(copy[: len(copy) - rng.randint(0, len(copy) // 20)])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("width", "part", "of"), [(3, 9, 10), (5, 4, 5)])
def test_equals_brute_force(docs, width, part, of):
    rows = corpus(width)
    got = jj.grouped(docs(*rows), width, part, of).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute(rows, width, part, of)


def test_linked_sets_share_a_key_and_sketches_bound_the_difference():
    rng = np.random.default_rng(3)
    for rule in (jj.Rule(3, 9, 10), jj.Rule(5, 4, 5)):
        for n in (9, 10, 19, 30, 100, 333, 2000):
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            for lost in range(0, rule.differing(2 * n) + 1, max(1, n // 30)):
                b = np.unique(np.concatenate((a[lost // 2:], rng.integers(0, 2**63, lost // 2, dtype=np.uint64))))
                shared = len(np.intersect1d(a, b))
                if len(a) != len(b) or shared < len(a):
                    if rule.of * shared >= rule.part * (len(a) + len(b) - shared):
                        assert set(rule.keys(a).tolist()) & set(rule.keys(b).tolist())
                sa, sb = rule.sketch(a), rule.sketch(b)
                size = min(len(sa), len(sb))
                apart = int(np.bitwise_count(jj._folded(sa, size) ^ jj._folded(sb, size)).sum())
                assert apart <= len(a) + len(b) - 2 * shared


def test_one_row_of_each_group_stays(docs):
    text = "a b c d e f g h i j k l m n o p q r s t"
    table = docs((3, text), (2, text), (2, text), (9, "quite another text of several words here"), (4, None), (5, ""))
    left = jj.one_per_group(table)
    assert left.columns == table.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 4, 5, 9]


def test_odd_rows(odd):
    got = jj.grouped(odd)
    assert got.count() == odd.count()
    assert {r.component_id for r in got.filter("doc_id = 5").collect()} == {5}
    assert jj.grouped(odd.limit(0)).count() == 0
    assert jj.one_per_group(odd).filter("doc_id = 5").count() == 2


def test_elements_of_sets_that_cannot_link_are_not_moved(docs, monkeypatch):
    stored, seen = jj.common.stored, {}

    def counted(df, name):
        held = stored(df, name)
        seen.setdefault(name, []).append(held.count())
        return held

    monkeypatch.setattr(jj.common, "stored", counted)
    half = " ".join(f"both{i}" for i in range(150))
    table = docs(*[(k, half + "".join(f" own{k}x{i}" for i in range(150))) for k in range(3)])
    assert sorted(r.component_id for r in jj.grouped(table).collect()) == [0, 1, 2]
    assert seen["jaccard-members"][0] > 0 and seen["jaccard-segments"] == [12]
    assert seen["jaccard-elements"] == [0, 0, 0]


def test_keys_and_elements_of_many_sets_are_handed_on_together(spark, monkeypatch):
    rule = jj.Rule(5, 4, 5)
    sets = [(i, jj.tokens_of(" ".join(f"w{i * j % 97}x{j}" for j in range(40 + i % 7)), 5)) for i in range(300)]
    emit = jj._Keys(rule)
    expected = [(k, i) for i, tokens in sets for k in rule.keys(tokens).view("int64").tolist()]
    segments = jj._Segments(rule, jj.common.IdFilter(spark.range(300), "id"))
    elements = [(i, k, len(t)) for i, t in sets for k in range(jj.FRAGMENTS)]
    for held, most in ((10**6, 1), (500, len(expected) // 500 + 1)):
        monkeypatch.setattr(jj, "KEYS_HELD", held)
        monkeypatch.setattr(jj, "BYTES_HELD", held)
        batches = list(emit.batches(iter(sets)))
        assert len(batches) <= most
        assert [row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True)] == expected
        batches = list(segments.batches(iter(sets)))
        assert len(batches) <= (1 if held > 500 else len(sets))
        assert [row for b in batches for row in zip(*(c.to_pylist() for c in b.columns[:3]), strict=True)] == elements
        assert b"".join(b for x in batches for b in x.column("elements").to_pylist()) == b"".join(t.tobytes() for _, t in sets)
    assert list(emit.batches(iter([]))) == list(segments.batches(iter([]))) == []
