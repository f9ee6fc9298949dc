"""N-gram Jaccard join by vertical partitioning, and the groups of documents that its links connect."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch.llm import common

#: Fragments of the n-gram order in which the overlap of a pair is counted.
FRAGMENTS = 4
#: Members of a key that one task compares at a time with as many others.
BLOCK = 512
#: Keys, and bytes of elements, that a task gathers before it hands them on: a batch for each set would be very many.
KEYS_HELD, BYTES_HELD = 50_000, 2_000_000
#: Bits of a parity sketch, at most.
MOST_BITS = 8192


@dataclass(frozen=True)
class Rule:
    """Sets of ``width``-word shingles link if ``of`` * intersection >= ``part`` * union."""

    width: int
    part: int
    of: int

    def differing(self, sizes: int) -> int:
        """Most elements in one set only, for linked sets with ``sizes`` elements together."""
        return (self.of - self.part) * sizes // (self.of + self.part)

    def level(self, n: int) -> tuple[int, int, int]:
        """(level, largest size in it, largest size in the level below); linked sets are at most one level apart."""
        level, low, below = 0, 1, 0
        while (upper := low * self.of // self.part + 1) <= n:
            level, below, low = level + 1, upper - 1, upper
        return level, upper - 1, below

    def fragments(self, largest: int) -> tuple[int, int]:
        """(most differing elements, fragments) for pairs whose smaller set is in the level that ends at ``largest``."""
        most = self.differing(largest + largest * self.of // self.part)
        return most, most + 2 + most // 7

    def keys(self, tokens: np.ndarray) -> np.ndarray:
        """Hashes of the set's fragments of the n-gram order, for the set's own level and the one below.

        Linked sets differ in fewer elements than there are fragments, so a whole fragment is the same in both. It
        is a fragment with elements, unless both have so many empty ones as the differences leave over; such
        sets give keys for their empty fragments too.
        """
        level, largest, below = self.level(len(tokens))
        out = []
        for base, top in ((level, largest), (level - 1, below)):
            most, parts = self.fragments(top) if top else (0, 0)
            if not most:  # only equal sets link
                continue
            which = ((tokens >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            borders = np.searchsorted(which, np.arange(parts + 1, dtype=np.uint64))
            sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(common.mixed(tokens), dtype=np.uint64)))
            content = sums[borders[1:]] - sums[borders[:-1]]
            size = np.diff(borders)
            name = np.arange(parts, dtype=np.uint64) + np.uint64((base + 1) << 40)
            keys = common.mixed(common.mixed(content + size.astype(np.uint64)) + common.mixed(name))
            empty = size == 0
            out.append(keys if empty.sum() >= parts - most else keys[~empty])
        return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)

    def sketch(self, tokens: np.ndarray) -> bytes:
        """Parities of the elements in hashed slots. Two sketches differ in at most as many bits as the sets in elements."""
        most, _ = self.fragments(self.level(len(tokens))[1])
        bits = min(MOST_BITS, 1 << max(6, (4 * most).bit_length()))
        slots = np.bincount((common.mixed(tokens + np.uint64(1)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
        return np.packbits((slots & 1).astype(np.uint8), bitorder="little").tobytes()


def tokens_of(text: str | None, width: int) -> np.ndarray:
    """The text's set in the global order, which is that of the shingles' hashes."""
    return common.shingle_set(common.word_hashes((text or "").encode("utf-8", "surrogatepass").lower().split()), width)


def set_id(tokens: np.ndarray) -> int:
    """64-bit identity of a set; sets of the same identity are taken as equal."""
    return int(np.array([xxhash.xxh3_64_intdigest(tokens.tobytes())], dtype=np.uint64).view(np.int64)[0])


def _map(docs: DataFrame, emit, schema: pa.Schema, ddl: str) -> DataFrame:
    """``emit.batches`` of (set id, tokens) for sets that the task has not seen lately."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        seen: set[int] = set()
        for batch in batches:
            for text in batch.column("text"):
                tokens = emit.tokens(text.as_py())
                if not len(tokens) or (sid := set_id(tokens)) in seen:
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(sid)
                yield sid, tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from emit.batches(sets(batches))

    return docs.mapInArrow(run, ddl)


class _Keys:
    schema, ddl = pa.schema([("key", pa.int64()), ("sid", pa.int64())]), "key long, sid long"

    def __init__(self, rule: Rule):
        self.rule = rule

    def tokens(self, text: str | None) -> np.ndarray:
        return tokens_of(text, self.rule.width)

    def batches(self, sets: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        sids, held, n_held = [], [], 0

        def batch() -> pa.RecordBatch:
            of = np.repeat(np.array(sids, dtype=np.int64), [len(k) for k in held])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(held).view(np.int64)), pa.array(of)], schema=self.schema)

        for sid, tokens in sets:
            keys = self.rule.keys(tokens)
            sids.append(sid)
            held.append(keys)
            n_held += len(keys)
            if n_held >= KEYS_HELD:
                yield batch()
                sids, held, n_held = [], [], 0
        if n_held:
            yield batch()


class _Segments(_Keys):
    """The sets that have a key in common with another: size and sketch (with fragment 0), elements by fragment."""

    schema = pa.schema([("sid", pa.int64()), ("fragment", pa.int32()), ("n", pa.int64()), ("sketch", pa.binary()), ("elements", pa.binary())])
    ddl = "sid long, fragment int, n long, sketch binary, elements binary"

    def __init__(self, rule: Rule, wanted: common.IdFilter):
        super().__init__(rule)
        self.maybe = wanted.local_test()

    def batches(self, sets: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n_bytes = 0
        for sid, tokens in sets:
            if not self.maybe(sid):
                continue
            which = (tokens >> np.uint64(64 - FRAGMENTS.bit_length() + 1)).astype(np.int64)
            held += [(sid, k, len(tokens), self.rule.sketch(tokens) if k == 0 else None, tokens[which == k].tobytes()) for k in range(FRAGMENTS)]
            n_bytes += tokens.nbytes + MOST_BITS // 8
            if n_bytes >= BYTES_HELD:
                yield from common.arrow_batches(held, self.schema)
                held, n_bytes = [], 0
        yield from common.arrow_batches(held, self.schema)


def _overlap(a, b):
    import pandas as pd

    return pd.Series([len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) for x, y in zip(a, b, strict=True)], dtype="int64")


def linked(pairs: DataFrame, segments: DataFrame, rule: Rule) -> DataFrame:
    """a, b and link of each pair: the overlap is counted in each fragment on its own and summed per pair.

    ``segments`` may have a set's rows more than once. Only those of sets in a pair are shuffled.
    """
    count = F.pandas_udf(_overlap, "long")
    pairs = common.stored(pairs, "jaccard-asked")
    asked = common.IdFilter(pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct(), "sid")
    segments = segments.filter(asked.test("sid")).select("sid", "fragment", "n", "elements").dropDuplicates(["sid", "fragment"])
    segments = common.stored(segments, "jaccard-elements")
    cut = common.stored(pairs.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1)))), "jaccard-pairs")
    of_a = segments.select(F.col("sid").alias("a"), "fragment", F.col("n").alias("n_a"), F.col("elements").alias("in_a"))
    of_b = segments.select(F.col("sid").alias("b"), "fragment", F.col("n").alias("n_b"), F.col("elements").alias("in_b"))
    left = common.stored(common.join_salted(cut, of_a, ["a", "fragment"], ["b"]), "jaccard-left")
    partial = common.join_salted(left, of_b, ["b", "fragment"], ["a"]).select("a", "b", "n_a", "n_b", count("in_a", "in_b").alias("shared"))
    whole = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("shared").alias("shared"))
    union = F.col("n_a") + F.col("n_b") - F.col("shared")
    return whole.select("a", "b", (F.lit(rule.of) * F.col("shared") >= F.lit(rule.part) * union).alias("link"))


def _pivot_pairs(members: DataFrame, first: DataFrame) -> DataFrame:
    """Each set with one other: of the earliest sets of its keys, the one with which it shares most keys."""
    placed = members.join(first, "sid")
    least = placed.groupBy("key").agg(F.min(F.struct("doc", "sid")).alias("pivot"), F.count("*").alias("n")).select("key", F.col("pivot.sid").alias("b"), "n")
    least = common.stored(least, "jaccard-pivots")
    shared = common.join_unique(members, least, ["key"], "n").filter("sid <> b").groupBy("sid", "b").count()
    return shared.groupBy("sid").agg(F.max(F.struct("count", "b")).alias("best")).select(F.col("sid").alias("a"), F.col("best.b").alias("b"))


def _folded(sketch: bytes, size: int) -> np.ndarray:
    """The sketch with fewer slots: its halves laid over each other."""
    parts = np.frombuffer(sketch, dtype=np.uint8).reshape(-1, size)
    return np.bitwise_xor.reduce(parts, axis=0)


def near_in_block(rows: list[tuple], rule: Rule, best_only: bool) -> Iterator[tuple[int, int]]:
    """Pairs of different components that may link by size and sketch. ``rows``: sid, component, size, sketch.

    No linked pair is missed: sketches differ in no more bits than the sets in elements. ``best_only`` gives the nearest of each row.
    """
    sid = np.array([r[0] for r in rows], dtype=np.int64)
    root = np.array([r[1] for r in rows], dtype=np.int64)
    n = np.array([r[2] for r in rows], dtype=np.int64)
    size = min(len(r[3]) for r in rows)
    sketch = np.stack([_folded(r[3], size) for r in rows]).view(np.uint64)
    for at in range(0, len(rows), 64):
        to = slice(at, at + 64)
        apart = np.zeros((len(sid[to]), len(sid)), dtype=np.int64)
        for word in range(sketch.shape[1]):
            apart += np.bitwise_count(sketch[to, None, word] ^ sketch[None, :, word])
        most = (rule.of - rule.part) * (n[to, None] + n[None, :]) // (rule.of + rule.part)
        small, large = np.minimum(n[to, None], n[None, :]), np.maximum(n[to, None], n[None, :])
        near = (root[to, None] != root[None, :]) & (apart <= most) & (rule.part * large <= rule.of * small)
        if best_only:
            some = np.flatnonzero(near.any(axis=1))
            nearest = np.where(near, apart, np.iinfo(np.int64).max)[some].argmin(axis=1)
            yield from zip(np.maximum(sid[to][some], sid[nearest]).tolist(), np.minimum(sid[to][some], sid[nearest]).tolist(), strict=True)
        else:
            i, j = np.nonzero(near)
            a, b = sid[to][i], sid[j]
            yield from zip(a[a > b].tolist(), b[a > b].tolist(), strict=True)


def may_link(n_a: int, in_a: bytes, n_b: int, in_b: bytes, rule: Rule) -> bool:
    """Whether sizes and sketches leave it open that two sets link."""
    size = min(len(in_a), len(in_b))
    apart = int(np.bitwise_count(_folded(in_a, size) ^ _folded(in_b, size)).sum())
    return apart <= rule.differing(n_a + n_b) and rule.part * max(n_a, n_b) <= rule.of * min(n_a, n_b)


def _open_pairs(pairs: DataFrame, sketches: DataFrame, rule: Rule) -> DataFrame:
    """The pairs that size and sketch do not rule out, so that the elements of the others are never moved."""
    @F.pandas_udf("boolean")
    def is_open(n_a, in_a, n_b, in_b):
        import pandas as pd

        return pd.Series([may_link(*pair, rule) for pair in zip(n_a.tolist(), in_a, n_b.tolist(), in_b, strict=True)], dtype="bool")

    of_a = sketches.select(F.col("sid").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("in_a"))
    of_b = sketches.select(F.col("sid").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("in_b"))
    left = common.stored(pairs.join(of_a, "a"), "jaccard-sketched")
    return common.join_salted(left, of_b, ["b"], ["a"]).filter(is_open("n_a", "in_a", "n_b", "in_b")).select("a", "b")


def _block_pairs(members: DataFrame, roots: DataFrame, sketches: DataFrame, rule: Rule, best_only: bool) -> DataFrame:
    """Pairs of sets that share a key, are not connected yet, and may link.

    Keys with the same members are one. A key's members are cut into blocks by hash, and each pair of blocks is one piece of
    work, so a key shared by very many sets is spread and no task holds more than two blocks.
    """
    rooted = common.stored(members.join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid")), "jaccard-rooted")
    about = rooted.groupBy("key").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n"),
        F.sum(F.xxhash64("sid").cast("decimal(20,0)")).alias("s1"), F.sum(F.xxhash64("sid", F.lit(1)).cast("decimal(20,0)")).alias("s2"),
    ).filter("lo < hi")
    chosen = common.stored(about.groupBy("n", "s1", "s2").agg(F.min("key").alias("key")).select("key", "n"), "jaccard-open")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("sid", F.lit(2)), F.col("blocks")).cast("int")
    dealt = (
        common.join_unique(rooted, chosen, ["key"], "n").withColumn("blocks", blocks).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "sid", "root")
    )
    work = dealt.join(sketches, "sid").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            held: list[tuple] = []
            at = None
            for key, i, j, *row in common.arrow_rows(batches, ["key", "i", "j", "sid", "root", "n", "sketch"]):
                if (key, i, j) != at:
                    if len(held) > 1:
                        yield from near_in_block(held, rule, best_only)
                    held, at = [], (key, i, j)
                held.append(tuple(row))
            if len(held) > 1:
                yield from near_in_block(held, rule, best_only)

        yield from common.arrow_batches(found(), schema, 20_000)

    return work.mapInArrow(compare, "a long, b long").distinct()


def links(docs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) between set ids whose components are those of all links between different sets.

    Sets meet by equal fragments of the n-gram order. First each is compared with an early set of its keys, then with the
    nearest of another component, and last with every set of another component that size and sketch do not rule
    out. Pairs inside a component need no comparison, so a large group of near copies costs a few links per member.
    """
    texts = docs.select("text")
    keys = _map(texts, emit := _Keys(rule), emit.schema, emit.ddl)
    by_key = Window.partitionBy("key").orderBy("sid")
    first = F.first("sid").over(by_key.rowsBetween(Window.unboundedPreceding, 0))
    after = F.lead("sid").over(by_key)
    met = keys.repartition("key").withColumns({"first": first, "after": after}).filter("sid <> first OR sid <> after")
    members = common.stored(met.select("key", "sid").distinct(), "jaccard-members")
    wanted = common.IdFilter(members.select("sid").distinct(), "sid")
    segments = _map(texts, emit := _Segments(rule, wanted), emit.schema, emit.ddl)
    segments = common.stored(segments, "jaccard-segments")
    sketches = common.stored(segments.filter("fragment = 0").select("sid", "n", "sketch").dropDuplicates(["sid"]), "jaccard-sketches")
    checked = common.stored(linked(_open_pairs(_pivot_pairs(members, sets), sketches, rule), segments, rule), "jaccard-checked")
    for best_only in (True, False):
        known = common.components(checked.filter("link").select("a", "b")).select(F.col("node").alias("sid"), "root")
        pairs = _block_pairs(members, known, sketches, rule, best_only)
        pairs = common.stored(pairs.join(checked.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), ["a", "b"], "left_anti"), "jaccard-near")
        checked = common.stored(checked.unionByName(linked(pairs, segments, rule)), "jaccard-checked")
    return checked.filter("link").select("a", "b")


def grouped(docs: DataFrame, width: int = 5, part: int = 4, of: int = 5) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id (the smallest doc_id that links reach) and root, for every row of ``docs``.

    ``root`` names the component itself; it differs between components even where rows of different texts share a doc_id.

    A text is its set of distinct ``width``-word shingles, with A-Z lower-cased; a shorter text is one shingle, and an empty or
    null one is linked with nothing. Documents link if ``of`` * intersection >= ``part`` * union.

    Every row gives a row, repeated ones too; a null doc_id counts as larger than all others and is its component's id
    only if there is no other; an empty table gives no rows; other columns are ignored.
    """
    rule = Rule(width, part, of)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("sid", pa.int64())])

    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sized() -> Iterator[tuple]:
            for doc_id, code, text in common.arrow_rows(batches, ["doc_id", "text_hash", "text"]):
                tokens = tokens_of(text, width)  # of one text at a time
                yield doc_id, code, len(tokens), set_id(tokens)

        yield from common.arrow_batches(sized(), schema)

    sized = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(size, "doc_id long, text_hash long, n_shingles long, sid long")
    sets = common.stored(sized, "jaccard-sets")
    some = sets.filter("n_shingles > 0")
    first = common.stored(some.groupBy("sid").agg(F.min("doc_id").alias("doc"), F.count("*").alias("n")), "jaccard-first")
    found = common.components(links(rows, first.select("sid", "doc"), rule)).select(F.col("node").alias("sid"), "root")
    rooted = first.join(found, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    rooted = common.stored(rooted, "jaccard-roots")
    least = rooted.groupBy("root").agg(F.min("doc").alias("component_id"), F.sum("n").alias("n"))
    named = common.join_unique(rooted.select("sid", "root"), common.stored(least, "jaccard-least"), ["root"], "n").select("sid", "root", "component_id")
    named = common.stored(named.join(first.select("sid", "n"), "sid"), "jaccard-named")
    linked_rows = common.join_unique(some, named, ["sid"], "n").select("doc_id", "text_hash", "n_shingles", "component_id", "root")
    alone = sets.filter("n_shingles = 0").select("doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("root"))
    return linked_rows.unionByName(alone)


def one_per_group(docs: DataFrame, width: int = 5, part: int = 4, of: int = 5) -> DataFrame:
    """``docs`` with one row of each component, the first by (doc_id, hash of the text); texts without words all stay.

    Rows that are not in question are passed on without a shuffle.
    """
    groups = common.stored(grouped(docs, width, part, of), "jaccard-groups")
    row = F.struct(F.coalesce(F.col("doc_id"), F.lit(2**63 - 1)).alias("d"), "text_hash")
    keyed = groups.select(row.alias("row"), "root")
    kept = keyed.filter("root IS NOT NULL").groupBy("root").agg(F.min("row").alias("kept")).select("kept.*")
    kept = kept.unionByName(keyed.filter("root IS NULL").select("row.*").distinct())
    rows = keyed.groupBy("row.d", "row.text_hash").count().join(kept.withColumn("keep", F.lit(True)), ["d", "text_hash"], "left")
    open_ = common.stored(rows.filter("keep IS NULL OR count > 1").withColumn("code", F.xxhash64("d", "text_hash")), "jaccard-verdicts")
    maybe = common.IdFilter(open_, "code")
    d, h = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)), F.xxhash64(common.text_or_empty())
    named = docs.withColumns({"_d": d, "_h": h}).withColumn("_code", F.xxhash64("_d", "_h")).withColumn("_maybe", maybe.test("_code"))
    verdict = open_.select(F.col("d").alias("_d"), F.col("text_hash").alias("_h"), F.coalesce("keep", F.lit(False)).alias("_keep"))
    judged = named.filter("_maybe").join(verdict, ["_d", "_h"], "left")
    single = judged.filter("_keep IS NULL")
    several = judged.filter("_keep").dropDuplicates(["_d", "_h"])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return named.filter("NOT _maybe").select(*columns).unionByName(single.select(*columns)).unionByName(several.select(*columns))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(common.table(spark, sf_dir, "documents"), width=3, part=9, of=10).select("doc_id", "n_shingles", "component_id")
