"""Best-fit packing of documents into fixed-size sequences, without two of one source or duplicate cluster in a bin."""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm import common

#: Words that a bin holds.
CAPACITY = 2048
#: Documents that are packed together, on average. Bins do not reach across such groups.
GROUP_ROWS = 4096

#: Bins of one group are numbered from group * BINS_PER_GROUP.
BINS_PER_GROUP = 1 << 40

WORD = r"[^\x20\x09-\x0D]+"
PLAN = "doc_id long, text_hash long, copy long, piece long, source string, first_word long, n_words long, bin long, bin_offset long"


def pack_group(items: list[tuple[int, str, int]], capacity: int) -> list[list[tuple[int, int, int, int]]]:
    """Places of each item (words, source, cluster) as (first word, words, bin, offset).

    Items longer than a bin fill bins of their own and only their rest is packed. Rests are placed from the largest to the
    smallest (ties by position in the list). Open bins are sorted by residual and carry bitmaps of their sources and duplicate clusters; the
    search starts at the tightest bin that is large enough and goes on to its successors until neither bitmap conflicts.
    """
    source_bit: dict[str, int] = {}
    cluster_bit: dict[int, int] = {}
    for _, source, cluster in items:
        source_bit.setdefault(source, 1 << len(source_bit))
        cluster_bit[cluster] = cluster_bit.get(cluster, 0) + 1
    repeated = [c for c, n in cluster_bit.items() if n > 1]  # a cluster of one conflicts with nothing
    cluster_bit = {c: 1 << k for k, c in enumerate(repeated)}
    places: list[list] = [[] for _ in items]
    bins = 0
    rests = []
    for at, (words, *_) in enumerate(items):
        whole, rest = divmod(words, capacity)
        for k in range(whole):
            places[at].append((k * capacity, capacity, bins, 0))
            bins += 1
        if rest or not whole:
            rests.append((-rest, at, whole * capacity))
    free: list[tuple[int, int]] = []  # (residual, bin), sorted
    used: dict[int, list[int]] = {}  # by bin: bitmaps of sources and clusters
    for rest, at, first in sorted(rests):
        size = -rest
        _, source, cluster = items[at]
        s, c = source_bit[source], cluster_bit.get(cluster, 0)
        k = bisect_left(free, (size, -1))
        while k < len(free) and (used[free[k][1]][0] & s or used[free[k][1]][1] & c):
            k += 1
        if k < len(free):
            residual, b = free.pop(k)
            used[b][0] |= s
            used[b][1] |= c
        else:
            residual, b = capacity, bins
            bins += 1
            used[b] = [s, c]
        places[at].append((first, size, b, capacity - residual))
        insort(free, (residual - size, b))
    return places


def packed(docs: DataFrame, capacity: int = CAPACITY, cluster: str | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """A plan row for each piece of each document: its words [first_word, first_word + n_words) go to ``bin`` at ``bin_offset``.

    Only sizes, sources and clusters are dealt, by hash, into groups of about ``group_rows``, which grow in number and not
    in size; a source or cluster with a third of all rows is spread over all groups. ``cluster`` names a column with
    duplicate clusters; without it, texts that are equal but for case and spacing are a cluster.

    Rows that agree in doc_id, text, source and cluster are copies 1, 2, ... of one document. A null text is empty, an empty text is one
    piece of no words, a null source is ''; null ids stay null; an empty table gives no rows; other columns are ignored.
    """
    text = common.text_or_empty()
    alike = F.xxhash64(F.lower(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.coalesce("source", F.lit("")).alias("source"),
        (F.xxhash64(cluster) if cluster else alike).alias("cluster"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    items = common.stored(
        rows.groupBy("doc_id", "text_hash", "source", "cluster", "words").count()
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("count")))).drop("count"),
        "pack-items",
    )
    groups = max(1, -(-items.count() // group_rows))
    dealt = items.withColumn("group", F.pmod(F.xxhash64("doc_id", "text_hash", "copy", "source"), F.lit(groups)))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "text_hash", "copy", "source", "cluster"], ignore_index=True)
        placed = pack_group(list(zip(frame["words"].tolist(), frame["source"].tolist(), frame["cluster"].tolist(), strict=True)), capacity)
        at = [(i, k, *place) for i, places in enumerate(placed) for k, place in enumerate(places)]
        out = frame.iloc[[x[0] for x in at]][["doc_id", "text_hash", "copy", "source"]].reset_index(drop=True)
        base = int(frame["group"].iloc[0]) * BINS_PER_GROUP
        for name, values in (("piece", 1), ("first_word", 2), ("n_words", 3), ("bin_offset", 5)):
            out[name] = [x[values] for x in at]
        out["bin"] = [base + x[4] for x in at]
        return out[[c.split()[0] for c in PLAN.split(", ")]].astype({"doc_id": "Int64"})

    return dealt.groupBy("group").applyInPandas(pack, PLAN)


def packed_texts(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan with each piece's text: the whole text of an unsplit document, else the piece's words joined by spaces."""
    text = common.text_or_empty()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).dropDuplicates(["doc_id", "text_hash"])
    known = F.col("plan.doc_id").eqNullSafe(F.col("texts.doc_id")) & (F.col("plan.text_hash") == F.col("texts.text_hash"))
    whole = (F.col("first_word") == 0) & (F.col("n_words") == F.regexp_count("text", F.lit(WORD)))
    words = F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), (F.col("first_word") + 1).cast("int"), F.col("n_words").cast("int"))
    return plan.alias("plan").join(texts.alias("texts"), known).select("plan.*", F.when(whole, F.col("text")).otherwise(F.array_join(words, " ")).alias("text"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(common.table(spark, sf_dir, "documents"))
