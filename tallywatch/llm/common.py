"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch.session import scratch_path

#: A key is hot when it holds more than one in so many rows; so there are at most that many hot keys.
HOT_SHARE = 1000
#: Rows of metadata (not texts) that one task handles at a time.
ROWS_PER_BLOCK = 500_000
#: Rows of an Arrow batch that are Python values at the same time.
ROWS_AT_ONCE = 256

ODD = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the shared scratch folder and read back: lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def blocks_for(spark: SparkSession, rows: int, per_block: int = ROWS_PER_BLOCK) -> int:
    """Partitions that grow with the rows, never fewer than the session shuffles into."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / per_block))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def join_unique(left: DataFrame, right: DataFrame, keys: list[str], count: str, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right``, which has one row per key and the key's rows in ``count``.

    Keys with more than a thousandth of all rows are at most a thousand, so that part of ``right`` is broadcast and its
    rows are not shuffled; the others go through a shuffle join, in which no key is large. Both inputs are read more
    than once: pass stored tables. ``how`` is ``inner`` or ``left``; keys must not be null.
    """
    total = right.agg(F.sum(count)).first()[0] or 0
    hot = right.filter(F.col(count) * HOT_SHARE > total)
    cold = right.filter(F.col(count) * HOT_SHARE <= total)
    at_hot = left.join(F.broadcast(hot), keys, "inner")
    at_cold = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys, how)
    return at_hot.unionByName(at_cold)


def copies_marked(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``rows`` with ``again``: false for one row of each key, true for its other rows. Rows are numbered in a stored table."""
    held = stored(rows.withColumn("_row", F.monotonically_increasing_id()), name)
    firsts = held.groupBy(*keys).agg(F.min("_row").alias("_row")).select("_row", F.lit(False).alias("again"))
    return held.join(firsts, "_row", "left").withColumn("again", F.coalesce("again", F.lit(True))).drop("_row")


def numbered(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``number``: 0 for a row alone with its key, else gapless from 0 among the rows of the key.

    Only rows of repeated keys are dealt, by ranges of (key, row), so that a key with any share of the rows is many tasks'
    work; a row's number is its place in its range after the sizes of the key's earlier ranges. The key must not be null.
    """
    repeats = stored(rows.groupBy(key).agg(F.count("*").alias("n_same")).filter("n_same > 1"), "repeated-keys")
    joined = join_unique(rows, repeats, [key], "n_same", "left")
    alone = joined.filter("n_same IS NULL").drop("n_same").withColumn("number", F.lit(0).cast("long"))
    dealt = joined.filter("n_same IS NOT NULL").drop("n_same").withColumn("row", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(key, "row").sortWithinPartitions(key, "row").withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id())
    dealt = stored(dealt.drop("row"), "repeated-rows")
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = dealt.groupBy(key, "part").agg(F.min("place").alias("first"), F.count("*").alias("n_rows"))
    ranges = ranges.select(key, "part", "first", F.coalesce(F.sum("n_rows").over(earlier), F.lit(0)).alias("before"))
    ranges = stored(ranges, "repeated-ranges")
    several = join_salted(dealt, ranges, [key, "part"], ["place"]).withColumn("number", F.col("place") - F.col("first") + F.col("before"))
    return alone.unionByName(several.select(*alone.columns))


def arrow_rows(batches: Iterable[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    """The rows of Arrow batches as Python values; nulls are None and integers stay whole. Few rows are held as such at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield from zip(*(batch.column(c).slice(at, ROWS_AT_ONCE).to_pylist() for c in columns), strict=True)


def arrow_batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift and multiply), elementwise."""
    x = values ^ (values >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` neighbouring items; none if there are fewer."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        out = mixed(out * ODD + hashes[k : k + n])
    return out


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct ``width``-word shingles; a shorter text is one shingle, an empty one has none."""
    return np.unique(window_hashes(hashes, min(width, len(hashes)))) if len(hashes) else hashes


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def spark_hash(values: np.ndarray) -> np.ndarray:
    """Spark's ``xxhash64`` of long values: the published XXH64 of their eight bytes with seed 42."""
    # The five primes of XXH64.
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    x = _rotated(values.view(np.uint64) * p2, 31) * p1 ^ (p5 + np.uint64(42 + 8))
    x = _rotated(x, 27) * p1 + p4
    x = (x ^ (x >> np.uint64(33))) * p2
    x = (x ^ (x >> np.uint64(29))) * p3
    return x ^ (x >> np.uint64(32))


class IdFilter:
    """A bitmap of hashed 64-bit ids that tells tasks which rows can be skipped; it errs only towards keeping a row.

    It has 16 bits per id, but never more than ``MOST_BITS`` (8 MB), whatever the number of ids.
    """

    MOST_BITS = 1 << 26

    def __init__(self, ids: DataFrame, column: str):
        spark = ids.sparkSession
        n = max(1, ids.count())
        bits = 1 << min(max(16, math.ceil(math.log2(16 * n))), self.MOST_BITS.bit_length() - 1)
        slot = F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(bits))
        words = (
            ids.select(slot.alias("slot"))
            .select(F.shiftright("slot", 5).alias("word"), F.expr("shiftleft(1L, cast(slot % 32 AS int))").alias("bit"))
            .groupBy("word").agg(F.bit_or("bit").alias("bits"))
        )
        bitmap = np.zeros(bits // 32, dtype=np.uint32)
        found = words.toPandas()
        bitmap[found["word"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64).astype(np.uint32)
        self._bitmap = spark.sparkContext.broadcast(bitmap)
        self._bits = bits

    def local_test(self):
        """The same for one 64-bit id in a task, given as a signed integer."""
        many = self.local_tests()
        return lambda value: bool(many(np.array([value], dtype=np.int64))[0])

    def local_tests(self):
        """The same for an array of ids."""
        bitmap, bits = self._bitmap, self._bits

        def known(values: np.ndarray) -> np.ndarray:
            at = (spark_hash(values) & np.uint64(bits - 1)).astype(np.int64)
            return (bitmap.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1

        return known

    def test(self, column: str) -> Column:
        bitmap, bits = self._bitmap, self._bits

        @F.pandas_udf("boolean")
        def known(slots):
            import pandas as pd

            at = slots.to_numpy(dtype=np.int64)
            return pd.Series((bitmap.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1)

        return known(F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(bits)))


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, once per Spark application, for clusters on which it is not installed."""
    import os
    import shutil
    import tempfile

    import tallywatch

    sc = spark.sparkContext
    if getattr(sc, "_tallywatch_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(tallywatch.__file__))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="tallywatch-code-"), "tallywatch_code"), "zip", os.path.dirname(root), os.path.basename(root))
    sc.addPyFile(archive)
    sc._tallywatch_shipped = True


def join_salted(left: DataFrame, right: DataFrame, keys: list[str], spread_by: list[str]) -> DataFrame:
    """Inner join with ``right``, which has one row per key, for right rows too large to broadcast.

    Keys with over a thousandth of the left rows (at most a thousand keys) are cut into salts by a hash of ``spread_by``, and
    only their right rows are repeated per salt. ``left`` is read more than once: pass a stored table.
    """
    counts = left.groupBy(*keys).count()
    total = left.count()
    hot = stored(counts.filter(F.col("count") * HOT_SHARE > total).select(*keys, F.ceil(F.col("count") * HOT_SHARE / F.lit(max(1, total))).cast("int").alias("_salts")), "hot-keys")
    hot = F.broadcast(hot)
    salted = left.join(hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts")
    copies = right.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return salted.join(copies, [*keys, "_salt"]).drop("_salt")


def components(edges: DataFrame) -> DataFrame:
    """node and root (its component's smallest node) for every node of the edges (a, b), by large-star and small-star steps.

    Each step replaces a node's edges by edges to the smallest node it knows; minima come from aggregates and are joined
    back with hot nodes broadcast, so a node with very many neighbours is never gathered. Every step is a stored table.
    """
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "edges-least")
        large = join_unique(both, least, ["a"], "n").filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        large = stored(large, "edges-large")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "edges-least")
        small = join_unique(large, least, ["a"], "n").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        # Done when all are stars: no child has two parents, and no parent is a child.
        n, children = edges.agg(F.count("*"), F.count_distinct("a")).first()
        if n == children and not edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count():
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
