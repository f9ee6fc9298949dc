"""The corpus pipeline: documents are judged, cleaned, made unique, mixed and packed, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm import common, jaccard_join, line_dedup, mixing, packing, quality_rules


def _held(docs: DataFrame, own: list[str]) -> DataFrame:
    """``docs`` with all columns but ``own`` put away in one, so that no name of theirs can clash with a stage's."""
    spare = "_" * (1 + max(map(len, docs.columns)))  # no column has this name; a struct needs a field
    return docs.select(*own, F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in own), F.lit(0).alias(spare)).alias("_rest"))


def _restored(held: DataFrame, columns: list[str], own: list[str]) -> DataFrame:
    return held.select(*(F.col(c) if c in own else F.col("_rest").getField(c).alias(c) for c in columns))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the trees reject go; the trees are fitted on this stage's own input."""
    common.ship_package(spark)
    return quality_rules.keep_good(docs, quality_rules.fit(docs, common.table(spark, sf_dir, "labels")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of lines go; a document of which nothing is left goes too. n_chars follows the text."""
    common.ship_package(spark)
    own = ["doc_id", "text", "n_chars"]
    cleaned = line_dedup.deduplicated(_held(docs, own)).filter("n_removed = 0 OR length(text) > 0")
    return _restored(cleaned, docs.columns, own)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, similarity 0.8 or more."""
    common.ship_package(spark)
    return jaccard_join.one_per_group(docs, width=5, part=4, of=5)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate and its own hash say, in a global random order."""
    common.ship_package(spark)
    own = ["doc_id", "text", "source"]
    return _restored(mixing.mixed(_held(docs, own)), docs.columns, own)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces with their bins, places and texts."""
    common.ship_package(spark)
    return packing.packed_texts(docs, packing.packed(docs))


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: Trees, edit distances and components are not expressible in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written before the next one reads it, so a lost executor costs one stage at most."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
