"""Document fingerprints: Merkle trees over paragraphs and sections. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch.llm import common

#: Documents in a block of neighbours, on average, and most blocks (their first ids are held by the driver).
BLOCK_ROWS, MOST_BLOCKS = 4000, 8192
#: First digits of a paragraph's hash that end a section: one paragraph in eight.
SECTION_ENDS = "01"


def _sections(text: Column) -> Column:
    """Hashes of the sections. Content says where a section ends, so an edit moves no later border."""
    marked = F.transform(F.split(text, "\n"), lambda p: F.regexp_replace(F.md5(p), f"^([{SECTION_ENDS}].*)$", "$1|"))
    return F.transform(F.split(F.array_join(marked, ""), r"\|"), lambda s: F.md5(s))


def _leaves(text: Column) -> Column:
    """Distinct short hashes of the sentences, the lowest level of the tree."""
    said = F.filter(F.transform(F.split(text, r"[.!?\n]+"), lambda s: F.trim(s)), lambda s: s != "")
    return F.array_distinct(F.transform(said, lambda s: F.substring(F.md5(s), 1, 8)))


def tree(text: Column) -> Column:
    """root, sections and leaves of a text. Roots are equal exactly if the texts are."""
    sections = _sections(text)
    return F.struct(F.sha2(F.array_join(sections, ""), 256).alias("root"), sections.alias("sections"), _leaves(text).alias("leaves"))


def fingerprint(of: Column) -> Column:
    """The tree as a string: root, sections (16 digits each), leaves (8 digits each)."""
    short = F.transform(of["sections"], lambda s: F.substring(s, 1, 16))
    return F.concat_ws(":", of["root"], F.array_join(short, ""), F.array_join(of["leaves"], ""))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else the shared part of both trees' leaves (Jaccard)."""
    shared, whole = F.size(F.array_intersect(a["leaves"], b["leaves"])), F.size(F.array_union(a["leaves"], b["leaves"]))
    return F.when(a["root"] == b["root"], 1.0).when(whole == 0, 0.0).otherwise(shared / whole)


def changed_sections(a: Column, b: Column) -> Column:
    """Positions (from 0) of the sections of ``a`` that ``b`` does not have: where the edits are."""
    at = F.transform(a["sections"], lambda s, i: F.when(F.array_contains(b["sections"], s), F.lit(-1)).otherwise(i))
    return F.filter(at, lambda i: i >= 0)


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id and tree of every row; a null text is empty. No shuffle."""
    return docs.select("doc_id", tree(common.text_or_empty()).alias("tree"))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and next_text: the text of the next document by (doc_id, text), after the last that of the first.

    Ids are cut into blocks at their quantiles. Each block also gets the first document of the block behind it, so one
    shuffle by block gives every row its neighbour, and no task holds more than a block.
    """
    spark = docs.sparkSession
    lowest = F.lit(-(2**63)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text")).withColumn("id", F.coalesce("doc_id", lowest))
    n = rows.count()
    if not n:
        return rows.select("doc_id", "text", F.col("text").alias("next_text"))
    blocks = min(MOST_BLOCKS, common.blocks_for(spark, n, BLOCK_ROWS))
    at = F.array(*[F.lit(k / blocks) for k in range(1, blocks)]) if blocks > 1 else F.array(F.lit(0.5))
    borders = rows.select(F.percentile_approx("id", at, 10 * blocks)).first()[0]
    block = F.size(F.filter(F.lit(sorted(set(borders))).cast("array<bigint>"), lambda b: b <= F.col("id")))
    rows = rows.withColumn("block", block)
    first = sorted((b, lo) for b, lo in rows.groupBy("block").agg(F.min("id")).collect())  # as many rows as blocks
    ahead = [(lo, first[k - 1][0] if k else first[-1][0], int(k == 0)) for k, (_, lo) in enumerate(first)]
    moved = rows.drop("block").join(F.broadcast(spark.createDataFrame(ahead, "id long, block int, wraps int")), "id")
    both = rows.withColumns({"wraps": F.lit(0), "guest": F.lit(False)}).unionByName(moved.withColumn("guest", F.lit(True)))
    window = Window.partitionBy("block").orderBy("wraps", "id", "text")
    return both.withColumn("next_text", F.lead("text").over(window)).filter(~F.col("guest")).select("doc_id", "text", "next_text")


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Every document with its edited text, whose last quarter comes from the next document, and their fingerprints.

    Any row gives one row, repeated ones and null ids (which come first) too; an empty table gives none; other columns are
    ignored. Texts are shuffled once.
    """
    pairs = with_next(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - quarter), F.substring("next_text", F.lit(1), quarter))
    trees = pairs.withColumn("edited", edited).select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        tree(F.col("text")).alias("own"), tree(F.col("edited")).alias("new"), tree(F.col("next_text")).alias("next"),
    )
    own, new = F.col("own"), F.col("new")
    return trees.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(own).alias("fingerprint"), fingerprint(new).alias("edited_fingerprint"),
        likeness(own, new).alias("near_edited"), likeness(own, F.col("next")).alias("near_next"),
        F.size(own["sections"]).alias("n_sections"), F.size(changed_sections(own, new)).alias("n_changed_sections"),
    )


def op9_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_pairs(common.table(spark, sf_dir, "documents"))


def _tree_sql(text: str, name: str) -> str:
    return f"""
    list_transform(str_split(array_to_string(list_transform(str_split({text}, chr(10)),
      lambda p: CASE WHEN substr(md5(p), 1, 1) IN ('0', '1') THEN md5(p) || '|' ELSE md5(p) END), ''), '|'), lambda s: md5(s)) AS {name}_sections,
    list_transform(list_filter(list_transform(regexp_split_to_array({text}, '[.!?\\n]+'), lambda s: trim(s)), lambda s: s <> ''), lambda s: substr(md5(s), 1, 8)) AS {name}_all"""


def _print_sql(name: str) -> str:
    return f"""sha256(array_to_string({name}_sections, '')) || ':' || array_to_string(list_transform({name}_sections, lambda s: substr(s, 1, 16)), '')
    || ':' || array_to_string({name}_leaves, '')"""


def _near_sql(a: str, b: str) -> str:
    return f"""CASE WHEN sha256(array_to_string({a}_sections, '')) = sha256(array_to_string({b}_sections, '')) THEN 1.0
    WHEN len({a}_leaves) + len({b}_leaves) = 0 THEN 0.0
    ELSE len(list_intersect({a}_leaves, {b}_leaves))::DOUBLE / len(list_distinct(list_concat({a}_leaves, {b}_leaves))) END"""


def _first_seen_sql(name: str) -> str:
    return f"list_filter({name}_all, lambda x, i: list_position({name}_all, x) = i) AS {name}_leaves"


OP9_SQL = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
pairs AS (
  SELECT doc_id, text, length(text) AS n_chars, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text
  FROM docs WINDOW w AS (ORDER BY doc_id, text ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
),
edits AS (SELECT *, left(text, n_chars - n_chars // 4) || left(next_text, n_chars // 4) AS edited FROM pairs),
trees AS (SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, {_tree_sql('text', 'own')}, {_tree_sql('edited', 'new')}, {_tree_sql('next_text', 'next')} FROM edits),
leaves AS (SELECT *, {_first_seen_sql('own')}, {_first_seen_sql('new')}, {_first_seen_sql('next')} FROM trees)
SELECT doc_id, n_chars, edited_sha256, {_print_sql('own')} AS fingerprint, {_print_sql('new')} AS edited_fingerprint,
  {_near_sql('own', 'new')} AS near_edited, {_near_sql('own', 'next')} AS near_next,
  CAST(len(own_sections) AS INTEGER) AS n_sections,
  CAST(len(list_filter(own_sections, lambda s: NOT list_contains(new_sections, s))) AS INTEGER) AS n_changed_sections
FROM leaves
"""
