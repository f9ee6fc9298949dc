"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tallywatch.llm import chat_format, fingerprints, jaccard_join, license_scan, line_dedup, mixing, packing, quality_rules, sentence_dedup, sharding, source_divergence, token_files, turn_repair
from tallywatch.llm.common import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def shipped(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    fn.__name__: shipped(fn)
    for fn in (
        line_dedup.op1_line_dedup, packing.op2_best_fit_packing, mixing.op3_poisson_mixing, quality_rules.op4_quality_trees,
        sentence_dedup.op5_sentence_spans, license_scan.op6_license_scan, chat_format.op7_chat_format,
        sharding.op8_minimax_shards, fingerprints.op9_merkle_fingerprints, jaccard_join.op10_ngram_jaccard,
        turn_repair.op11_turn_repair, token_files.op12_token_files, source_divergence.op13_source_divergence,
    )
}
ORACLE: dict[str, str] = {
    "op3_poisson_mixing": mixing.OP3_SQL, "op7_chat_format": chat_format.OP7_SQL, "op9_merkle_fingerprints": fingerprints.OP9_SQL,
    "op11_turn_repair": turn_repair.OP11_SQL,
    "op13_source_divergence": source_divergence.OP13_SQL,
}
