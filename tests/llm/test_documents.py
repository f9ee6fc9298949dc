"""Quality rules, license scan, sentence spans and fingerprints."""

import hashlib
import random
import re

import numpy as np
import pytest

from tallywatch.llm import fingerprints as fp
from tallywatch.llm import license_scan as ls
from tallywatch.llm import quality_rules as qr
from tallywatch.llm import sentence_dedup as sd

SPACE = r"[^\x20\x09-\x0D]+"


def counts(text):
    words = re.findall(SPACE, text or "")
    lines = (text or "").split("\n")
    dup = sum(bool(re.search(SPACE, x)) and x in lines[:k] for k, x in enumerate(lines))
    windows = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    again = {k + i for k, w in enumerate(windows) if windows.count(w) > 1 for i in range(5)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(again)]


@pytest.mark.parametrize("text", [None, "", " \n", "a b c d e a b c d e f\na\n a\na", "é#1 *x\x0b$y z\n\n" * 3, "ab " * 11])
def test_base_counts(text):
    assert qr.statistics(text)[0] == counts(text)


def test_trees_learn_and_stay_monotone():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] < 0.5) & (x[:, 1] > 0.2)).astype(float)
    trees = qr.fit_trees(x, y, [-1, 1, 0], rounds=20)
    assert ((trees.scores(x) > 0.5) == (y > 0.5)).mean() > 0.97
    grid = np.repeat(rng.random((50, 3)), 40, axis=0)
    for f, sign in ((0, -1), (1, 1)):
        moved = grid.copy()
        moved[:, f] = np.tile(np.linspace(0, 1, 40), 50)
        assert (sign * np.diff(trees.scores(moved).reshape(50, 40), axis=1) >= -1e-12).all()


def test_quality_on_labelled_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = qr.judge(table, qr.fit(table, labels)).join(labels, "doc_id").toPandas()
    good = rows[rows.quality == 1]
    assert good[~good.base_failed].kept.mean() > 0.99 and rows[rows.quality == 0].kept.mean() < 0.1


def test_quality_odd_rows(odd, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert qr.fit(odd, none) is None
    judged = qr.judge(odd, None).collect()
    assert len(judged) == odd.count() and not any(r.kept for r in judged if r.n_words < 10)
    kept = qr.keep_good(odd, None)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in judged)
    assert qr.judge(odd.limit(0), None).count() == 0


def places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = {label: [k for k in range(len(words)) if words[k:k + len(p.split())] == p.split()] for p, label in ls.BASE_PHRASES}
    return len(words), {label: at for label, at in found.items() if at}


@pytest.mark.parametrize("text", [
    None, "", "The MIT-License and the Apache License; the GNU general public license.", "mit mit license license", "general public general public license mit",
    "Released under the MIT License. " * 40, "é mit licensé MIT License",
])
def test_base_phrases(text):
    automaton = ls.Automaton.build(ls.TEMPLATES, ls.BASE_PHRASES)
    words = ls.words_of(text)
    found, _ = ls.scan(automaton, words)
    assert (len(words), found) == places(text)


def test_statistics_equal_brute_force():
    rng = random.Random(2)
    word = lambda: rng.choice("abc")
    templates = [("t", " ".join(word() for _ in range(12))) for _ in range(3)]
    automaton = ls.Automaton.build(templates, [])
    runs = {tuple(w[i:j]) for _, t in templates for w in [t.encode().split()] for i in range(12) for j in range(i + 1, 13)}
    text = " ".join(rng.choice("abcd") for _ in range(300)).encode().split()
    got = {at: length for at, _, length in automaton.statistics(text)}
    for at in range(len(text)):
        longest = max((k for k in range(1, 13) if at - k + 1 >= 0 and tuple(text[at - k + 1:at + 1]) in runs), default=0)
        assert got.get(at, 0) == longest


def test_changed_template_is_still_covered(docs, odd):
    notice = ls.TEMPLATES[1][1].split()
    notice[20:22] = ["other"]
    row = ls.scan_documents(docs((1, "before " + " ".join(notice) + " after"))).first()
    assert row.labels == "mit" and row.n_base == 0 and 0.8 < row.score < 1 and (row.spans[0]["first"], row.spans[0]["last"]) == (1, len(notice))
    assert ls.scan_documents(odd).count() == odd.count() and ls.scan_documents(odd.limit(0)).count() == 0


def test_shared_run_counts_for_every_template(docs):
    text = "This work is licensed under the Creative Commons Attribution 4.0 International License"
    row = ls.scan_documents(docs((1, text))).first()
    assert row.labels == "cc-by" and row.score == pytest.approx(12 / 13)


def test_each_template_matches_as_if_alone():
    every = [*ls.TEMPLATES, *((label, text) for text, label in ls.BASE_PHRASES)]
    automaton = ls.Automaton.build(ls.TEMPLATES, ls.BASE_PHRASES)
    alone = [ls.Automaton.build([t], []) for t in every]
    words = [ls.words_of(t) for _, t in every]
    grams = [{tuple(w[i:i + 3]) for i in range(len(w) - 2)} for w in words]
    pairs = [(a, b) for a in range(len(every)) for b in range(len(every)) if a != b and grams[a] & grams[b]]
    assert pairs
    texts = []
    for a, b in pairs:
        for at in range(len(words[a])):
            # One word of a template changed: to a foreign one, or to each that goes on in the other template.
            others = {words[b][p + 1] for p in range(len(words[b]) - 1) if at and words[b][p] == words[a][at - 1]}
            texts += [[*words[a][:at], w, *words[a][at + 1:]] for w in {b"other", *others}]
        texts.append([*words[a], *words[b]])
    for text in texts:
        want = sorted(((k, *span[1:]) for k, one in enumerate(alone) for span in ls.scan(one, text)[1]), key=lambda s: (s[1], s[2], s[0]))
        assert ls.scan(automaton, text)[1] == want


def test_passage_in_unpunctuated_text_is_found_at_every_offset():
    rng = random.Random(6)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    for _ in range(5):
        passage = prose(51)
        first = sd.sentences(f"{prose(3)} {passage} {prose(20)}")
        hashes, ends = sd.spans(first)
        known = set(hashes[ends > np.arange(len(ends))].tolist())
        for offset in range(40):
            before, after = prose(offset), prose(offset % 7)
            text = f"{before} {passage} {after}".strip()
            parts = sd.sentences(text)
            gone = sd.covered(parts, known)
            assert "".join(s for s, _ in parts) == text and gone.any()
            assert set(" ".join(s for (s, _), g in zip(parts, gone, strict=True) if g).split()) <= set(passage.split())


def test_passage_without_spaces_or_ascii_ends_goes(docs):
    rng = random.Random(7)
    prose = lambda n: "".join("".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(12)) + "\u3002" for _ in range(n))
    passage, run = prose(5), "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(90))
    rows = [(1, prose(2) + passage + prose(2)), (2, (own := prose(3)) + passage), (3, prose(1) + run), (4, "\u4e00\u4e8c\u4e09" + run)]
    got = {r.doc_id: r for r in sd.deduplicated(docs(*rows)).collect()}
    assert got[1].n_removed == got[3].n_removed == 0
    assert got[2].text == own and len(got[4].text) < 40


def test_repeated_passage_goes_and_clean_text_stays(docs):
    rng = random.Random(4)
    prose = lambda n: " ".join(" ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(9)).capitalize() + "." for _ in range(n))
    passage = prose(7)
    rows = [(i, f"{prose(4)}\n{passage}\n{prose(3)}" if i % 2 else prose(8)) for i in range(20)]
    got = {r.doc_id: r for r in sd.deduplicated(docs(*rows)).collect()}
    for i, text in rows:
        left = text.replace(passage + "\n", "") if i % 2 and i > 1 else text
        assert got[i].text == left and (got[i].n_removed > 0) == (left != text)


def test_spans_equal_brute_force(docs):
    rng = random.Random(8)
    stock = [" ".join(rng.choice("abcdefghijkl") * 3 for _ in range(rng.randint(1, 20))) + "." for _ in range(12)]
    rows = [(i, " ".join(rng.choice(stock) for _ in range(rng.randint(0, 9)))) for i in range(25)]
    seen, want = set(), {}
    for i, text in rows:
        parts, gone, own = sd.sentences(text), set(), []
        assert "".join(s for s, _ in parts) == text
        for a in range(len(parts)):
            b = next((b for b in range(a + sd.LEAST_SENTENCES, len(parts) + 1) if sum(n for _, n in parts[a:b]) >= sd.LEAST_WORDS), None)
            if b:
                span = tuple(" ".join(s.split()) for s, _ in parts[a:b])
                if span in seen or span in own:
                    gone |= set(range(a, b))
                own.append(span)
        seen |= set(own)
        want[i] = sorted(gone)
    assert {r.doc_id: r.removed for r in sd.deduplicated(docs(*rows)).collect()} == want


def test_each_row_is_a_document(docs):
    passage = "One sentence of eight words stands in here. Another one of nine words stands right behind it. "
    rows = [(k, f"{passage}Row {j} of key {k} ends here.") for k in (None, 3) for j in range(3)]
    rows += [rows[0], rows[0], rows[4]]
    got = sd.deduplicated(docs(*rows)).collect()
    assert len(got) == len(rows) and sum(passage in r.text for r in got) == 1
    assert all(sum(t.split(". ")[-1] in r.text for r in got if r.doc_id == k) >= 1 for k, t in rows)


def test_sentence_odd_rows(odd):
    got = sd.deduplicated(odd)
    assert got.count() == odd.count() and sd.deduplicated(odd.limit(0)).count() == 0
    assert all(r.text == "" for r in got.filter("doc_id IN (1, 2)").collect())


def test_edits_and_neighbours(docs, odd):
    texts = ["Alpha beta. Gamma delta.\nEpsilon zeta eta. Theta.", "Iota kappa.\nLambda mu nu. Xi omicron.", "é"]
    got = sorted(fp.edited_pairs(docs(*enumerate(texts))).collect())
    for i, row in enumerate(got):
        text, after = texts[i], texts[(i + 1) % 3]
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (row.fingerprint == row.edited_fingerprint) == (edited == text)
        assert 0 <= row.near_next <= row.near_edited <= 1
    pairs = fp.with_next(odd).collect()
    order = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    want = [(r.doc_id, r.text or "", (order[(k + 1) % len(order)].text or "")) for k, r in enumerate(order)]
    assert sorted(map(str, map(tuple, pairs))) == sorted(map(str, want))
    assert fp.edited_pairs(odd.limit(0)).count() == 0
