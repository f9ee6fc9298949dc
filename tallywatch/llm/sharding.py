"""Sharding by minimax contiguous partition over ordered groups of equal texts. DataFrame operations only."""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch.llm import common

SHARDS = 24
#: Bytes that a row takes besides its text.
ROW_BYTES = 8
#: Cells of the histograms that locate the cuts; the driver holds a few numbers for each cell and no groups.
CELLS = 1 << 14


class Prefix:
    """What the driver knows of the running sizes of the ordered groups: cells with their first and last value.

    A cell with at most two values is known exactly. In others a lookup has a lower and an upper bound; cells that
    matter are read again, in finer steps, until both agree.
    """

    def __init__(self, ends: DataFrame, total: int, parts: int):
        self.ends, self.total, self.parts = ends, total, parts
        self.cells: list[tuple[int, int, int]] = []
        self.refine([(0, total)])

    def refine(self, ranges: list[tuple[int, int]]) -> None:
        """Read the values in each range (both ends included) in finer cells, four at least; replaces the cells in there."""
        cells = max(4, CELLS // len(ranges))
        cell: Column = F.lit(None).cast("long")
        near: Column = F.lit(False)
        first = 0
        for a, b in ranges:
            inside = F.col("end").between(a, b)
            width = -(-(b - a + 1) // cells)
            near = near | inside
            cell = F.when(inside, F.floor((F.col("end") - a) / width) + first).otherwise(cell)
            first += (b - a) // width + 1
        found = self.ends.filter(near).groupBy(cell.alias("cell")).agg(F.min("end"), F.max("end"), F.count("*")).collect()
        kept = [c for c in self.cells if not any(a <= c[0] and c[1] <= b for a, b in ranges)]
        self.cells = sorted(kept + [(lo, hi, n) for _, lo, hi, n in found])
        self.starts = [c[0] for c in self.cells]

    def before(self, target: int, upper: bool) -> int:
        """A bound of the largest value up to ``target``."""
        k = bisect_right(self.starts, target) - 1
        if k < 0:
            return 0
        lo, hi, n = self.cells[k]
        return hi if target >= hi else target if upper and n > 2 else lo

    def fill(self, capacity: int, upper: bool) -> list[int]:
        """Ends of the shards when each in turn takes all that fits."""
        out, at = [], 0
        for _ in range(self.parts):
            at = self.before(at + capacity, upper)
            out.append(at)
        return out

    def least(self, low: int, upper: bool) -> int:
        """Smallest capacity with which the shards reach the end, by binary search."""
        high = max(low, self.total)
        while low < high:
            middle = (low + high) // 2
            if self.fill(middle, upper)[-1] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def cuts(self, low: int) -> list[int]:
        """Ends of the shards at the smallest feasible capacity, which is ``low`` at least."""
        while True:
            a, b = self.least(low, True), self.least(low, False)
            from_, to = [0, *self.fill(a, False)[:-1]], [0, *self.fill(b, True)[:-1]]
            open_ = [c for c in self.cells if c[2] > 2 and any(c[0] <= t + b and c[1] > f + a for f, t in zip(from_, to, strict=True))]
            if not open_:
                return self.fill(b, False)
            ranges: list[tuple[int, int]] = []
            for lo, hi, _ in open_:  # neighbours become one range
                if ranges and self.starts[bisect_right(self.starts, ranges[-1][1])] == lo:
                    ranges[-1] = ranges[-1][0], hi
                else:
                    ranges.append((lo, hi))
            self.refine(ranges)


def _ordered(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the identity of each row's text: 64-bit hash, CRC and size together."""
    text = common.text_or_empty()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"),
    )


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row; the largest shard is as small as it can be.

    Equal texts are one group and stay together, in a run of slots. Groups larger than an equal share get a shard each
    (no partition can do better); the others are ordered by their smallest doc_id, which does not move when
    rows are added behind, and cut where the smallest feasible capacity says. A null text is empty; a null doc_id comes first; repeated rows
    each get a slot; an empty table gives no rows; other columns are ignored.

    Texts are read once and never shuffled. Running sizes come from a range-partitioned table in two levels, within a block and
    over the blocks, so no task sees more than a block; large groups may lie across blocks.
    """
    spark = docs.sparkSession
    key = ["text_hash", "text_crc32", "size"]
    rows = common.stored(_ordered(docs), "shard-rows")
    groups = common.stored(rows.groupBy(*key).agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "shard-groups")
    n_rows, total = groups.agg(F.sum("n"), F.sum(F.col("n") * F.col("size"))).first()
    if not n_rows:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))

    # Groups above an equal share of what is left: fewer than there are shards, so the driver can hold them.
    largest = groups.orderBy(F.desc(F.col("n") * F.col("size")), *key).limit(shards).collect()
    alone, left = [], total
    for g in largest:
        if len(alone) == shards - 1 or g.n * g.size * (shards - len(alone)) <= left:
            break
        alone.append(g)
        left -= g.n * g.size
    rank = F.lit(len(alone))
    for k, g in enumerate(alone):
        rank = F.when((F.col("text_hash") == g.text_hash) & (F.col("text_crc32") == g.text_crc32) & (F.col("size") == g.size), F.lit(k)).otherwise(rank)

    order = ["own", "first", "text_hash", "text_crc32", "size"]
    joined = common.join_unique(rows, groups, key, "n").withColumn("own", rank)
    blocks = common.blocks_for(spark, n_rows)
    dealt = joined.repartitionByRange(blocks, *order, "doc_id").withColumn("block", F.spark_partition_id())
    dealt = common.stored(dealt, "shard-order")

    # Within a block: rank of each row, and running size of the groups, each counted whole where it begins.
    this = F.struct(*order)
    about = dealt.groupBy("block").agg(F.min(this).alias("lo"), F.max(this).alias("hi"), F.count("*").alias("n"))
    about = sorted(about.collect(), key=lambda b: b.block)  # as many rows as blocks
    carried = [b.block for a, b in zip(about, about[1:], strict=False) if a.hi == b.lo]
    window = Window.partitionBy("block").orderBy(*order, "doc_id")
    before = F.lag(this).over(window)
    begins = F.when(F.row_number().over(window) == 1, ~F.col("block").isin(carried) if carried else F.lit(True)).otherwise(~before.eqNullSafe(this))
    running = dealt.withColumn("begins", begins)
    to_here = window.rowsBetween(Window.unboundedPreceding, 0)
    running = running.withColumn("end", F.sum(F.when(F.col("begins"), F.col("n") * F.col("size")).otherwise(F.lit(0))).over(to_here))
    running = running.withColumn("at", F.row_number().over(window).cast("long") - 1)
    running = common.stored(running.select("doc_id", "size", "text_crc32", "own", "block", "begins", "end", "at"), "shard-running")

    # Over the blocks: what lies before each.
    totals = {b: (n, end) for b, n, end in running.groupBy("block").agg(F.count("*"), F.max("end")).collect()}
    offsets, n_before, size_before = [], 0, 0
    for b in sorted(totals):
        offsets.append((b, n_before, size_before))
        n_before, size_before = n_before + totals[b][0], size_before + totals[b][1]
    shift = spark.createDataFrame(offsets, "block int, at_0 long, end_0 long")
    whole = running.join(F.broadcast(shift), "block").withColumn("at", F.col("at") + F.col("at_0"))
    whole = whole.withColumn("end", F.col("end") + F.col("end_0") - (total - left))

    parts = shards - len(alone)
    ends = whole.filter((F.col("own") == len(alone)) & F.col("begins")).select("end")
    cuts = Prefix(ends, left, parts).cuts(max(1, -(-left // parts))) if left else []
    shard = F.col("own").cast("int")
    for cut in cuts[:-1]:
        shard = shard + F.when((F.col("own") == len(alone)) & (F.col("end") > cut), 1).otherwise(0)
    placed = whole.withColumn("shard", shard.cast("int"))
    starts = F.broadcast(placed.groupBy("shard").agg(F.min("at").alias("start")))  # one row per shard
    return placed.join(starts, "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("at") - F.col("start")).alias("slot"))


def op8_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(common.table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
