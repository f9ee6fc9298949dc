"""Mixing sources to target weights: Poisson replication and a global shuffle."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm import common

#: Default target: a source's weight is its size to this power, which lifts small sources.
POWER = 0.7
#: Size of the mixture, times the size of the input.
EPOCHS = 1.0
SEED = 17

_HEX = 13  # hexadecimal digits of a hash that make a uniform number: 52 bits
_KEY_HEX = 15


def _digits(text: Column, n: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, n), 16, 10).cast("long")


def poisson_inverse(u: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """Smallest k whose Poisson(rate) distribution function reaches u, elementwise, for u in (0, 1)."""
    out = np.zeros(len(u), dtype=np.int64)
    for r in np.unique(rate):
        at = rate == r
        if not r > 0:
            continue
        spread = 14 * math.sqrt(r) + 40  # less than 1e-30 of the distribution lies beyond
        k = np.arange(max(0, math.floor(r - spread)), math.ceil(r + spread) + 1)
        log_factorial = np.array([math.lgamma(x + 1) for x in k])
        reached = np.cumsum(np.exp(k * math.log(r) - r - log_factorial))
        out[at] = k[0] + np.searchsorted(reached, u[at], side="left")
    return out


def _copies(u: Column, rate: Column) -> Column:
    @F.pandas_udf("long")
    def inverse(u, rate):
        import pandas as pd

        return pd.Series(poisson_inverse(u.to_numpy(dtype=float), rate.to_numpy(dtype=float)))

    return inverse(u, rate)


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, power: float = POWER, epochs: float = EPOCHS) -> DataFrame:
    """source_key, rows, size and rate: how often a document of the source is repeated on average.

    A source's size is the characters of all its texts plus one per row, so empty texts count too. With ``weights``, sources
    that it does not name get weight 0. A null source is the source ''.
    """
    sizes = docs.groupBy(F.coalesce("source", F.lit("")).alias("source_key")).agg(
        F.count("*").alias("rows"), F.sum(F.coalesce(F.char_length("text"), F.lit(0)) + 1).alias("size")
    )
    if weights is None:
        weight = F.pow(F.col("size").cast("double"), F.lit(power))
    else:
        named = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
        weight = F.coalesce(F.create_map(*named)[F.col("source_key")], F.lit(0.0)) if named else F.lit(0.0)
    sizes = common.stored(sizes.withColumn("weight", weight), "source-sizes")
    whole, all_weight = sizes.agg(F.sum("size"), F.sum("weight")).first()
    goal = float(whole or 0) * epochs / float(all_weight) if all_weight else 0.0
    return sizes.withColumn("rate", F.col("weight") * F.lit(goal) / F.col("size"))


def mixed(docs: DataFrame, weights: dict[str, float] | None = None, power: float = POWER, epochs: float = EPOCHS, seed: int = SEED) -> DataFrame:
    """``docs`` with source_key, rate, n_copies, copy and shuffle_key, one row per copy, in a global random order.

    A document's count inverts the Poisson distribution with its source's rate at a number hashed from seed, doc_id, text, source
    and the row's number among rows that are equal in these, so every row is a draw of its own, whatever its id, and a run
    gives the same copies on any cluster. Sources with over a thousandth of the rows are looked up by broadcast (there are at
    most a thousand), so a hot source is never gathered. A null text has size 1; an empty table gives none. Columns of
    ``docs`` named like the new ones are replaced; others may have any name.
    """
    new = ["source_key", "rate", "n_copies", "copy", "shuffle_key"]
    kept = docs.drop(*new)
    rates = source_rates(docs, weights, power, epochs).select("source_key", F.col("rows").alias("n_rows"), "rate")
    said = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(common.text_or_empty()), F.coalesce("source", F.lit("")))
    held = kept.select(F.struct(*(F.col(f"`{c}`") for c in kept.columns)).alias("own"), F.coalesce("source", F.lit("")).alias("source_key"), F.md5(said).alias("key"))
    held = common.numbered(held, "key")
    own = F.concat_ws(":", F.lit(str(seed)), "key", F.col("number").cast("string"))
    u = (_digits(own, _HEX).cast("double") + 0.5) / float(16**_HEX)
    counted = common.join_unique(held, rates, ["source_key"], "n_rows").drop("n_rows").withColumn("n_copies", _copies(u, F.col("rate")))
    copies = counted.filter("n_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_copies"))))
    keyed = copies.withColumn("shuffle_key", _digits(F.concat_ws(":", own, F.col("copy").cast("string")), _KEY_HEX))
    return keyed.repartitionByRange(F.col("shuffle_key")).sortWithinPartitions("shuffle_key", "key", "number", "copy").select("own.*", *new)


def op3_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixed(docs).select("doc_id", F.col("source_key").alias("source"), F.round("rate", 6).alias("rate"), "n_copies", "copy", "shuffle_key")


OP3_SQL = f"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(length(text), 0) + 1 AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, '')) || ':' || coalesce(source, '')) AS key
  FROM documents
),
numbered AS (SELECT *, '{SEED}:' || key || ':' || (row_number() OVER (PARTITION BY key) - 1) AS own FROM docs),
sizes AS (SELECT source, CAST(sum(size) AS DOUBLE) AS size, pow(CAST(sum(size) AS DOUBLE), {POWER}) AS weight FROM docs GROUP BY source),
rates AS (SELECT source, weight * ((SELECT sum(size) FROM sizes) * {EPOCHS} / (SELECT sum(weight) FROM sizes)) / size AS rate FROM sizes),
reached AS (
  SELECT source, rate, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p
  FROM rates, range(0, 200) AS r(k)
),
drawn AS (SELECT own, doc_id, source, (CAST('0x' || substr(md5(own), 1, {_HEX}) AS BIGINT) + 0.5) / {16**_HEX}.0 AS u FROM numbered),
counted AS (SELECT own, doc_id, source, min(rate) AS rate, min(k) AS n_copies FROM drawn JOIN reached USING (source) WHERE p >= u GROUP BY own, doc_id, source)
SELECT doc_id, source, round(rate, 6) AS rate, n_copies, c.copy AS copy,
  CAST('0x' || substr(md5(own || ':' || c.copy), 1, {_KEY_HEX}) AS BIGINT) AS shuffle_key
FROM counted, LATERAL (SELECT unnest(range(1, n_copies + 1)) AS copy) AS c
"""
