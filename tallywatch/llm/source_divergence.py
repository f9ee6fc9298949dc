"""Source divergence audit: how far the sources of a language stand apart in their words, and by which words."""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch.llm import common

#: Documents of its language in which a term must stand.
LEAST_DOCS = 10
#: Rank up to which a group's own terms are reported.
TOP_TERMS = 10
#: Shares are whole numbers of this.
UNIT = 1_000_000_000
#: Distinct terms up to which a fitted vocabulary (of fewer terms) is held by the driver and each executor. With more, the
#: same sums are aggregated from (term, count) rows.
MODEL_TERMS = 4_000_000
#: Sources of a language that one task pairs with the rows of another source.
SOURCES_PER_BLOCK = 256

# Fixed value: what a term is. It can't hold the character that separates it from its language.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SEPARATOR = "\x00"
#: Stands in a vocabulary so that none is empty; it is not the term of a language.
_MARK = "\x00\x00"


# In UTF-8 a character from U+0080 on has no byte below 0x80, so bytes are cut as characters would be.
_BETWEEN = bytes(b for b in range(128) if not re.match(TERM, chr(b)))
_CUT = bytes.maketrans(_BETWEEN + string.ascii_uppercase.encode(), b" " * len(_BETWEEN) + string.ascii_lowercase.encode())
#: Terms of an Arrow batch, and distinct terms that a task counts before it sends what it has.
TERMS_PER_BATCH, TERMS_HELD = 200_000, 300_000


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text, both in UTF-8."""
    return text.translate(_CUT).split()


def _listed(of_rows: list[list[bytes]]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in of_rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(list(chain.from_iterable(of_rows)), type=pa.binary()).view(pa.string()))


def _by_digit(counts: Counter) -> Iterator[tuple[int, list[bytes]]]:
    """(2^k, the terms whose count has that binary digit): the sum over all is the counts."""
    values = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
    terms = np.array(list(counts), dtype=object)
    for k in range(int(values.max(initial=0)).bit_length()):
        yield 1 << k, terms[values >> k & 1 == 1].tolist()


def worded(docs: DataFrame, least_docs: int) -> DataFrame:
    """What a vocabulary and sums need of the documents' terms, each with its language before it: lang, source ('' for null),
    weight, terms (distinct in a row).

    Rows of weight 1, 2, 4, ... of a group (lang, source) add up to its counts. Rows of weight 0 stand for documents: in each piece of
    work, a term is in as many of them as in documents of its language, up to ``least_docs``, so that it is in ``least_docs``
    of all these rows exactly if it is in so many documents. The first of them has every term of the piece: its weight is -1.
    Rows are dealt and sorted by group, and a group of any size is dealt over tasks; each group has a row.
    """
    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("weight", pa.int64()), ("terms", pa.list_(pa.string()))])

    def batch(held: list[tuple]) -> pa.RecordBatch:
        langs, sources, weights, terms = zip(*held, strict=True)
        names = [pa.array(x, type=pa.binary()).view(pa.string()) for x in (langs, sources)]
        return pa.RecordBatch.from_arrays([*names, pa.array(weights, type=pa.int64()), _listed(terms)], schema=schema)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        as_bytes = (pa.RecordBatch.from_arrays([b.column(c).cast(pa.binary()) for c in ("lang", "source", "text")], ["lang", "source", "text"]) for b in batches)
        counts, in_docs = Counter(), Counter()
        at = None

        def of_group() -> Iterator[tuple]:
            prefix = at[0] + SEPARATOR.encode()
            yield (*at, 1, [])
            for weight, terms in _by_digit(counts):
                yield (*at, weight, [prefix + t for t in terms])
            counts.clear()

        def of_lang() -> Iterator[tuple]:
            prefix = at[0] + SEPARATOR.encode()
            left, n = list(in_docs.items()), 0
            while left and n < least_docs:
                yield (*at, 0 if n else -1, [prefix + t for t, _ in left])
                n += 1
                left = [x for x in left if x[1] > n]
            in_docs.clear()

        for lang, source, text in common.arrow_rows(as_bytes, ["lang", "source", "text"]):
            if at is not None and (lang, source) != at:
                yield from of_group()
                if lang != at[0]:
                    yield from of_lang()
            at = lang, source
            terms = terms_of(text)
            counts.update(terms)
            in_docs.update(set(terms))
            if len(counts) > TERMS_HELD:
                yield from of_group()
            if len(in_docs) > TERMS_HELD:
                yield from of_lang()
        if at is not None:
            yield from of_group()
            yield from of_lang()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n = 0
        for piece in pieces(batches):
            held.append(piece)
            n += len(piece[3]) + 1
            if n >= TERMS_PER_BATCH:
                yield batch(held)
                held, n = [], 0
        if held:
            yield batch(held)

    rows = docs.select(lang, source, common.text_or_empty().alias("text"), F.monotonically_increasing_id().alias("row"))
    dealt = rows.repartitionByRange("lang", "source", "row").sortWithinPartitions("lang", "source").select("lang", "source", "text")
    return dealt.mapInArrow(run, "lang string, source string, weight long, terms array<string>")


#: Rows of ``worded`` that stand for documents.
_DOCUMENT = "weight <= 0"


def _sums_by_model(docs: DataFrame, least_docs: int) -> tuple[DataFrame, DataFrame]:
    """(term, lang, item) of the vocabulary, and (lang, source, term, n): sums of the sparse vectors of each group's rows, by their weights.

    A term carries its language, so one fit gives every language its own vocabulary, with its own document frequencies.
    """
    spark = docs.sparkSession
    mark = spark.range(least_docs).select(F.array(F.lit(_MARK)).alias("terms"))
    model = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(least_docs), vocabSize=2**31 - 1).fit(docs.filter(_DOCUMENT).select("terms").unionByName(mark))
    named = [(i, *t.rsplit(SEPARATOR, 1)) for i, t in enumerate(model.vocabulary) if t != _MARK]
    vocabulary = spark.createDataFrame(named, "term int, lang string, item string")
    # Sums over two numbers are Spark's fastest; a group's number stands for its names until then.
    groups = common.stored(docs.select("lang", "source").distinct().withColumn("group", F.monotonically_increasing_id()), "divergence-numbers")
    sparse = F.unwrap_udt("vector")
    vectors = model.transform(docs.filter("weight > 0")).select("lang", "source", "weight", sparse.alias("vector")).join(groups, ["lang", "source"])
    entries = vectors.select("group", "weight", F.inline(F.arrays_zip(F.col("vector.indices").alias("term"), F.col("vector.values").alias("n"))))
    sums = common.stored(entries.groupBy("group", "term").agg(F.sum(F.col("n").cast("long") * F.col("weight")).alias("n")), "divergence-group-sums")
    return vocabulary, sums.join(groups, "group").select("lang", "source", "term", "n")


def _sums_by_rows(docs: DataFrame, least_docs: int) -> tuple[DataFrame, DataFrame]:
    """The same from rows, for vocabularies of any size: no list of terms is held anywhere."""
    in_docs = docs.filter(_DOCUMENT).select("lang", F.explode("terms").alias("term")).groupBy("lang", "term").agg(F.count("*").alias("docs"))
    kept = common.stored(in_docs.filter(F.col("docs") >= least_docs).select("term", "lang", F.expr("substring(term, char_length(lang) + 2)").alias("item")), "divergence-vocabulary")
    sums = docs.filter("weight > 0").select("lang", "source", "weight", F.explode("terms").alias("term")).groupBy("lang", "source", "term").agg(F.sum("weight").alias("n"))
    return kept, sums.join(kept.select("term"), "term", "left_semi")


def _with_share(rows: DataFrame, count: str, name: str) -> DataFrame:
    """Adds 1 + floor(UNIT * (count + 2) / (total + 2 * terms)), exact for any count; null in a language without terms."""
    return rows.withColumn(name, F.expr(
        f"1 + ((cast({count} AS decimal(19, 0)) + 2) * {UNIT}BD) div nullif(cast(total AS decimal(20, 0)) + 2 * cast(terms AS decimal(20, 0)), 0)"
    ))


def _apart(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


def _against(rows: DataFrame, groups: DataFrame, langs: DataFrame, keys: list[str]) -> DataFrame:
    """Each row with the rows of ``groups`` that have its keys, a block of sources at a time, so that a key is many tasks' work."""
    blocks = langs.select("lang", "blocks")
    left = rows.join(blocks, "lang").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = groups.join(blocks, "lang").withColumn("block", F.expr("cast(pmod(xxhash64(other), blocks) AS int)"))
    return left.drop("blocks").join(right.drop("blocks"), [*keys, "block"]).drop("block")


def audited(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, model_terms: int = MODEL_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: how far each group (lang, source) is from each other source of its language
    (part ``pair``), and the terms that it has more of than its language (part ``term``, up to rank ``top_terms``).

    A language keeps the terms that stand in at least ``least_docs`` of its documents. A group's share of a term is smoothed
    and rounded to whole numbers of ``UNIT``; two shares p and q are (p - q)^2 / (p + q) apart, rounded down.

    Pairs are evaluated sparsely. Terms that neither source has add the same amount each; what the terms of one source add
    against zero counts of the other depends on their shares only, so equal shares are counted once; only terms that both
    have meet in a join, once per unordered pair.

    A null lang, source or text is ''; a group without terms has its pairs, of value 0 if its language keeps none; repeated
    rows and ids are documents of their own; an empty table gives no rows; other columns are ignored.
    """
    docs = common.stored(worded(docs, least_docs), "divergence-words")
    distinct_terms = docs.filter("weight < 0").select(F.explode("terms").alias("term")).agg(F.approx_count_distinct("term")).first()[0]
    vocabulary, sums = (_sums_by_model if distinct_terms <= model_terms else _sums_by_rows)(docs, least_docs)
    sums = common.stored(sums, "divergence-sums")
    vocabulary = common.stored(vocabulary, "divergence-items")
    sizes = vocabulary.groupBy("lang").agg(F.count("*").alias("terms"))
    totals = sums.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = groups.fillna(0, ["total", "terms"])
    groups = common.stored(_with_share(groups, "0", "p0"), "divergence-groups")
    langs = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("terms").alias("terms"), F.expr(f"cast(ceil(count(*) / {SOURCES_PER_BLOCK}) AS int)").alias("blocks"))
    langs = common.stored(langs, "divergence-langs")  # a row per language: Spark knows its size and need not shuffle what meets it
    shares = common.stored(_with_share(sums.join(groups, ["lang", "source"]), "n", "p").select("lang", "source", "term", "p", "p0"), "divergence-shares")

    of_lang = sums.groupBy("lang", "term").agg(F.sum("n").alias("n")).join(langs, "lang")
    above = shares.join(_with_share(of_lang, "n", "q").select("term", "q"), "term").filter("p > q").withColumn("value", F.expr(_apart("p", "q")))
    above = above.join(vocabulary.select("term", "item"), "term").select("lang", "source", F.lit("term").alias("part"), "item", "value")
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    above = above.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= top_terms)

    others = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("q0"))
    neither = _against(groups, others, langs, ["lang"]).filter("source <> other").select("lang", "source", "other", F.expr(f"coalesce(terms * ({_apart('p0', 'q0')}), 0L)").alias("value"))
    alike = shares.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("times"))
    one = _against(alike, others, langs, ["lang"]).filter("source <> other").select("lang", "source", "other", F.expr(f"times * ({_apart('p', 'q0')} - {_apart('p0', 'q0')})").alias("value"))
    there = shares.select("lang", F.col("source").alias("other"), "term", F.col("p").alias("q"), F.col("p0").alias("q0"))
    both = _against(shares, there, langs, ["lang", "term"]).filter("source < other").select(
        "lang", "source", "other", F.expr(f"{_apart('p', 'q')} - {_apart('p', 'q0')} - {_apart('p0', 'q')} + {_apart('p0', 'q0')}").alias("value")
    ).groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    half = one.unionByName(both)
    back = half.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value")
    pairs = neither.unionByName(half).unionByName(back).groupBy("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item")).agg(F.sum("value").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(first))
    return pairs.unionByName(above)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(common.table(spark, sf_dir, "documents"))


OP13_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS text
  FROM documents
),
words AS (SELECT doc, lang, source, unnest(regexp_extract_all(text, '{TERM}')) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= {LEAST_DOCS}),
sizes AS (SELECT lang, count(*) AS terms FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
grid AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, terms FROM groups JOIN kept USING (lang) JOIN sizes USING (lang) LEFT JOIN counts USING (lang, source, term)
),
shares AS (
  SELECT lang, source, term, n, 1 + ({UNIT}::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * terms) AS p FROM grid
),
in_lang AS (SELECT lang, term, sum(n) AS n, max(terms) AS terms FROM grid JOIN (SELECT DISTINCT lang FROM groups) USING (lang) GROUP BY lang, term),
lang_shares AS (SELECT lang, term, 1 + ({UNIT}::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * terms) AS q FROM in_lang),
apart AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS BIGINT) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
),
own AS (
  SELECT lang, source, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value FROM shares JOIN lang_shares USING (lang, term) WHERE n > 0 AND p > q
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM own)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank FROM pairs
UNION ALL SELECT lang, source, 'term', item, value, CAST(rank AS INT) FROM ranked WHERE rank <= {TOP_TERMS}
"""
