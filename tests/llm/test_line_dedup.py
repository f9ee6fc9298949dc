import random

from pyspark.sql import functions as F

from tallywatch.llm import line_dedup as ld


def within_one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k:] == b[k + 1:] or (len(a) == len(b) and a[k + 1:] == b[k + 1:])


def brute(rows):
    """doc_id -> text left, by comparing every line with every line."""
    firsts = {}
    for doc, text in sorted(rows):
        for at, (_, alike) in enumerate(ld.lines_of(text)):
            if alike:
                firsts.setdefault(alike, (doc, at))
    near = {a for a in firsts for b in firsts if a != b and firsts[b] < firsts[a] and min(len(a), len(b)) >= ld.NEAR_CHARS and within_one_edit(a, b)}
    return {
        doc: "\n".join(line for at, (line, alike) in enumerate(ld.lines_of(text)) if not alike or (alike not in near and firsts[alike] == (doc, at)))
        for doc, text in rows
    }


def test_equals_brute_force(docs):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcd ") for _ in range(rng.randint(18, 40))).strip() or "x" for _ in range(30)]

    def edited(line):
        k, how = rng.randrange(len(line)), rng.randrange(4)
        return [line, line[:k] + line[k + 1:], line[:k] + "z" + line[k:], line[:k] + "y" + line[k + 1:]][how]

    rows = [(i, "\n".join(edited(rng.choice(base)) for _ in range(rng.randint(0, 8)))) for i in range(60)]
    got = {r.doc_id: r.text for r in ld.deduplicated(docs(*rows)).collect()}
    assert got == brute(rows)


def test_half_keys_meet_for_every_single_edit():
    rng = random.Random(1)
    for n in (20, 21, 50):
        s = "".join(rng.choice("ab") for _ in range(n))
        for k in range(n):
            for t in (s[:k] + s[k + 1:], s[:k] + "c" + s[k:], s[:k] + "c" + s[k + 1:]):
                assert set(ld.half_keys(s)) & set(ld.half_keys(t))


def test_variants_are_those_of_the_shortened_lines():
    line = "abcadef gh"
    whole, without = ld.variants(line)
    for k in range(len(line)):
        assert ld.variants(line[:k] + line[k + 1:])[0] == without[k]


def test_a_hot_line_and_its_near_copies_go_once(docs):
    line = "this line stands in every document of all"
    rows = [(i, f"{line if i % 3 else line + '!'}\nown words of document number {i} {'x' * i}") for i in range(200)]
    left = ld.deduplicated(docs(*rows)).filter(F.col("text").contains("this line")).collect()
    assert [r.doc_id for r in left] == [0]


def test_odd_rows(odd):
    got = ld.deduplicated(odd)
    assert got.columns == [*odd.columns, "n_lines", "n_removed", "n_near"] and got.count() == odd.count()
    assert [r.text for r in got.filter("doc_id = 5").collect()].count("the same line of text here\nand another line of it") == 1
    assert [r.text for r in got.filter("doc_id = 6").collect()] == ["and one more line"]
    assert ld.deduplicated(odd.limit(0)).count() == 0


def test_columns_may_have_any_name_and_short_lines_a_limit_of_their_own(spark):
    names = ["doc", "hash", "own", "line", "at", "gone", "near", "again", "n", "_doc", "_hash"]
    rows = [(i, "ab\nab\nlong enough to compare with others") for i in range(3)]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *(f"'{n}' AS {n}" for n in names))
    got = ld.deduplicated(table, least_chars=1).collect()
    assert {tuple(r[n] for n in names) for r in got} == {tuple(names)}
    assert sorted((r.doc_id, r.text, r.n_removed) for r in got) == [(0, "ab\nlong enough to compare with others", 1), (1, "", 3), (2, "", 3)]


def test_each_row_is_a_document(docs):
    """Rows under one id or none: one keeps a shared line, whatever row it is; copies of a row keep nothing."""
    shared, near = "this line stands in every row of all", "this line stands in every row of all!"
    rows = [(k, f"{shared if j % 2 else near}\nown words of key {k} row number {chr(97 + j) * 12}") for k in (None, 3) for j in range(6)]
    rows += [(None, rows[0][1])] * 3 + [(3, rows[7][1])] * 2 + [(4, "a line that only one row has"), (None, None)]
    got = ld.deduplicated(docs(*rows))
    assert got.count() == len(rows) and got.columns == [*docs(*rows).columns, "n_lines", "n_removed", "n_near"]
    left = [line for r in got.collect() for line in (r.text or "").split("\n") if line]
    assert sorted(x for x in left if not x.startswith("this line")) == sorted({x for _, t in rows if t for x in t.split("\n") if not x.startswith("this line")})
    assert sum(x in (shared, near) for x in left) == 1
    assert got.filter("doc_id IS NULL AND text IS NULL").count() == 1


def test_lines_that_no_other_can_be_near_are_not_sent(docs):
    rng = random.Random(7)
    lines = ["".join(rng.choice("abcdefgh") for _ in range(40)) for _ in range(2000)]
    texts = docs(*((i, "\n".join(lines[5 * i : 5 * i + 5])) for i in range(400))).selectExpr("doc_id AS doc", "xxhash64(text) AS hash", "text")
    wanted = ld._lines(texts, ld.LEAST_CHARS, ld.NEAR_CHARS).filter("doc = 7 AND at = 2")
    sent = ld._texts(texts, ld.NEAR_CHARS, ld.common.IdFilter(wanted.select(ld._place().alias("place")), "place")).collect()
    assert lines[37] in [r.alike for r in sent] and len(sent) < 20


def test_a_filter_on_what_was_removed_does_not_clean_texts_again(docs):
    out = ld.deduplicated(docs((1, "one line of text that repeats\nx"), (2, "one line of text that repeats"))).filter("n_removed = 0 OR length(text) > 0")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert [(r.doc_id, r.text, r.n_removed) for r in out.collect()] == [(1, "one line of text that repeats\nx", 0)]
