"""Source divergence against exact sums in plain Python."""

import re
from collections import Counter, defaultdict

import pytest

from tallywatch.llm import source_divergence as D


def plain(rows, least_docs, top):
    """rows: (lang, source, text)."""
    words = [(lang or "", source or "", re.findall(D.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for lang, source, text in rows]
    in_docs, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in words:
        in_docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    kept = {lang: sorted(t for t, n in c.items() if n >= least_docs) for lang, c in in_docs.items()}

    def share(count, lang):
        total = sum(count[t] for t in kept[lang])
        return {t: 1 + D.UNIT * (count[t] + 2) // (total + 2 * len(kept[lang])) for t in kept[lang]}

    shares = {g: share(c, g[0]) for g, c in counts.items()}
    whole = {lang: share(sum((c for g, c in counts.items() if g[0] == lang), Counter()), lang) for lang in kept}
    out = set()
    for (lang, source), p in shares.items():
        pairs = [(s, sum((p[t] - q[t]) ** 2 // (p[t] + q[t]) for t in p)) for (other, s), q in shares.items() if other == lang and s != source]
        own = [(t, (p[t] - whole[lang][t]) ** 2 // (p[t] + whole[lang][t])) for t in p if counts[lang, source][t] and p[t] > whole[lang][t]]
        for part, items, most in (("pair", pairs, len(pairs)), ("term", own, top)):
            for rank, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most], 1):
                out.add((lang, source, part, item, value, rank))
    return out


ROWS = [(lang, f"s{i % n}", text) for lang, n, texts in (
    ("en", 4, ["The cat sat. The CAT ran", "a dog, a Dog; the dog", "Été café the", "numb3rs and under_score"]),
    ("fr", 2, ["le chat", "le chien le", "你好 le"]),
) for i in range(24) for text in [texts[(i * i + i // 3) % len(texts)]]] + [
    (None, None, None), ("", "x", "only one"), ("de", "a", "rare words"), ("de", "b", ""), ("fr", None, "le chat " * 2000), ("en", "empty", " 12 "), ("e", "a", "nüx"),
]


@pytest.mark.parametrize("model_terms", [D.MODEL_TERMS, 0])
def test_equals_plain_sums(spark, model_terms):
    table = spark.createDataFrame([(1, *r, 5, "v") for r in ROWS], "doc_id int, lang string, source string, text string, n int, vector string")
    for least_docs, top in ((5, 10), (100, 5)) if model_terms else ((2, 3),):
        found = {tuple(r) for r in D.audited(table, least_docs, top, model_terms).collect()}
        assert found == plain(ROWS, least_docs, top)


def test_many_sources_are_paired_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(D, "SOURCES_PER_BLOCK", 3)
    rows = [("en", f"s{i % 11}", f"word{'abc'[i % 3]} common {'x' * (i % 5)}") for i in range(60)]
    found = {tuple(r) for r in D.audited(spark.createDataFrame(rows, "lang string, source string, text string"), 3).collect()}
    assert found == plain(rows, 3, 10)


def test_empty_table(spark):
    assert D.audited(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


def test_terms_are_counted_before_they_are_sent(spark, monkeypatch):
    rows = [("en", f"s{i % 2}", "the same words again and the same words") for i in range(400)]
    table = spark.createDataFrame(rows, "lang string, source string, text string").repartition(4)
    sent = D.worded(table, 10)
    weighed = [(r["source"], r["weight"], t) for r in sent.filter("weight > 0").collect() for t in r["terms"]]
    found = Counter()
    for source, weight, term in weighed:
        found[source, term] += weight
    assert found == {(f"s{k}", f"en\x00{t}"): 200 * n for k in range(2) for t, n in Counter(rows[0][2].split()).items()}
    assert len(weighed) < 1000  # the texts have 3,200 terms
    stand_ins = Counter(t for r in sent.filter("weight <= 0").collect() for t in r["terms"])
    assert all(10 <= n <= 10 * 5 for n in stand_ins.values())
    assert {tuple(r) for r in D.audited(table).collect()} == plain(rows, 10, 10)


def test_digits_add_up():
    counts = Counter({b"a": 1, b"b": 6, b"c": 2**40 + 5})
    out = Counter()
    for weight, terms in D._by_digit(counts):
        for t in terms:
            out[t] += weight
    assert out == counts and list(D._by_digit(Counter())) == []
