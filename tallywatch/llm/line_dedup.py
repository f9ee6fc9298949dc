"""Line dedup by a deletion-neighbourhood join: of lines within one edit of each other, the earliest stays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm import common

#: Characters (spaces in runs count once) from which a line is compared at all, and from which one edit is allowed.
#: Shorter lines are what many texts have in common by their form; 0 and 2 are the least values.
LEAST_CHARS, NEAR_CHARS = 10, 20
#: Insertions, deletions or replacements of a character; the neighbourhood is built for one.
EDITS = 1

#: Stands for a null doc_id: before all others.
NO_ID = -(2**63)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_SEED = np.uint64(0x632BE59BD9B4E019)


def lines_of(text: str | None, least_chars: int = LEAST_CHARS) -> list[tuple[str, str]]:
    """Each line as it is, and as it is compared: with single spaces, or '' if it is too short."""
    out = []
    for line in (text or "").split("\n"):
        alike = " ".join(line.split())
        out.append((line, alike if len(alike) >= least_chars else ""))
    return out


def line_hash(alike: str) -> bytes:
    """128 bits that stand for the line."""
    return xxhash.xxh3_128_digest(alike.encode("utf-8", "surrogatepass"))


def half_keys(alike: str) -> list[int]:
    """Hashes of which two lines within one edit share at least one: one half of the shorter line is whole in both."""
    n = len(alike)
    keys = []
    for shorter in (n, n - 1):
        h = shorter // 2
        keys.append(xxhash.xxh3_64_intdigest(f"{shorter}<{alike[:h]}".encode("utf-8", "surrogatepass")))
        keys.append(xxhash.xxh3_64_intdigest(f"{shorter}>{alike[n - (shorter - h):]}".encode("utf-8", "surrogatepass")))
    return keys


def variants(alike: str) -> tuple[int, np.ndarray]:
    """Hash of the line, and of the line without its k-th character for each k, in time linear in its length."""
    n = len(alike)
    chars = common.mixed(np.frombuffer(alike.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) + _SEED)
    powers = np.full(n, _BASE, dtype=np.uint64)
    powers[0] = 1
    terms = chars * np.multiply.accumulate(powers)[::-1]
    before = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(terms, dtype=np.uint64)))
    whole = before[-1]
    without = before[:-1] * _BASE_INVERSE + (whole - before[1:])
    return int(common.mixed(np.array([whole]) ^ np.uint64(n))[0]), common.mixed(without ^ np.uint64(n - 1))


def _signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def _map(docs: DataFrame, emit, schema: pa.Schema, ddl: str, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for doc in common.arrow_rows(batches, ["doc", "hash", "text"]) for row in emit(*doc))
        yield from common.arrow_batches(rows, schema, size)

    return docs.mapInArrow(run, ddl)


def _lines(docs: DataFrame, least_chars: int, near_chars: int) -> DataFrame:
    """line (hash), doc and hash of the document, at (first place in it), times and the half keys, for each distinct line of each document."""
    def emit(doc: int, text_hash: int, text: str) -> Iterator[tuple]:
        own: dict[str, list[int]] = {}
        for at, (_, alike) in enumerate(lines_of(text, least_chars)):
            if alike:
                own.setdefault(alike, [at, 0])[1] += 1
        for alike, (at, times) in own.items():
            keys = [_signed(k) for k in half_keys(alike)] if len(alike) >= near_chars else None
            yield line_hash(alike), doc, text_hash, at, times, keys

    schema = pa.schema([("line", pa.binary()), ("doc", pa.int64()), ("hash", pa.int64()), ("at", pa.int64()), ("times", pa.int64()), ("halves", pa.list_(pa.int64()))])
    return _map(docs, emit, schema, "line binary, doc long, hash long, at long, times long, halves array<bigint>", 10_000)


def _place() -> Column:
    """64 bits that stand for a line at its place."""
    head = F.expr("cast(conv(hex(substring(line, 1, 8)), 16, -10) AS long)")
    return head.bitwiseXOR(F.xxhash64("doc", "hash")).bitwiseXOR(F.col("at"))


def _texts(docs: DataFrame, near_chars: int, wanted: common.IdFilter) -> DataFrame:
    """doc, hash, at and text of each line that can be near another, if its place may be among the wanted ones."""
    schema = pa.schema([("doc", pa.int64()), ("hash", pa.int64()), ("at", pa.int64()), ("alike", pa.string())])
    test = wanted.local_tests()

    def kept(held: list[tuple]) -> Iterator[tuple]:
        heads = np.frombuffer(b"".join(line_hash(row[3])[:8] for row in held), dtype=">i8").astype(np.int64)
        places = heads ^ np.array([row[4] for row in held], dtype=np.int64) ^ np.array([row[2] for row in held], dtype=np.int64)
        return (held[i][:4] for i in np.flatnonzero(test(places)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            held: list[tuple] = []
            for doc, text_hash, own, text in common.arrow_rows(batches, ["doc", "hash", "own", "text"]):
                held.extend((doc, text_hash, at, alike, own) for at, (_, alike) in enumerate(lines_of(text, near_chars)) if alike)
                if len(held) >= 2_000:
                    yield from kept(held)
                    held = []
            if held:
                yield from kept(held)

        yield from common.arrow_batches(rows(), schema, 2_000)

    return docs.select("doc", "hash", F.xxhash64("doc", "hash").alias("own"), "text").mapInArrow(run, "doc long, hash long, at long, alike string")


def _emitted(candidates: DataFrame) -> DataFrame:
    """Variants of the candidates, without the characters in a half that they share: those can't be what differs.

    ``at`` is the position of the missing character, -1 for the whole line.
    """
    schema = pa.schema([("variant", pa.int64()), ("at", pa.int32()), ("id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        rows = 0

        def batch() -> pa.RecordBatch:
            ids = np.repeat(np.array([x[0] for x in held], dtype=np.int64), [len(x[1]) for x in held])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[1] for x in held])), pa.array(np.concatenate([x[2] for x in held])), pa.array(ids)], schema=schema)

        for own, alike, head, tail in common.arrow_rows(batches, ["id", "alike", "head", "tail"]):
            n = len(alike)
            whole, without = variants(alike)
            at = np.arange(0 if tail else (n - 1) // 2, n if head else n // 2 + 1)
            held.append((own, np.concatenate((np.array([whole], dtype=np.uint64), without[at])).view(np.int64), np.concatenate(([-1], at)).astype(np.int32)))
            rows += len(at) + 1
            if rows > 50_000:
                yield batch()
                held, rows = [], 0
        if held:
            yield batch()

    return candidates.select("id", "alike", "head", "tail").mapInArrow(run, "variant long, at int, id long")


def near_lines(docs: DataFrame, nodes: DataFrame, near_chars: int = NEAR_CHARS) -> DataFrame:
    """Lines that are within one edit of an earlier one: line and other.

    ``nodes`` has every distinct line with its first place. Lines that share no half with another can't be near one; of the
    others the texts are written once, and all else is done on that table. They emit a variant for each character they
    could lose. Lines that share a variant with the same position differ in that character; a line that is another's
    variant lacks one. For each such set only its earliest line matters, so sets are reduced by aggregation, never
    paired; the pairs that remain, a few per line, are checked by edit distance.

    Variants are emitted twice: all of them as (variant, id) to find those that two lines have, and then those only.
    """
    halves = nodes.filter("halves IS NOT NULL").select("line", F.posexplode("halves").alias("side", "half")).withColumn("side", F.col("side") % 2)
    shared = halves.groupBy("half").agg(F.min("line").alias("a"), F.max("line").alias("b"), F.count("*").alias("n")).filter("a < b").drop("a", "b")
    shared = common.stored(shared, "line-halves")
    near = common.join_unique(halves, shared, ["half"], "n").groupBy("line").agg(F.max(F.col("side") == 0).alias("head"), F.max(F.col("side") == 1).alias("tail"))
    wanted = common.stored(nodes.select("line", "doc", "hash", "at").join(near, "line"), "line-candidates")
    places = ["doc", "hash", "at"]
    # Lines that can't be at one of the places are not sent anywhere, however many places there are; the join decides.
    at_places = common.IdFilter(wanted.select(_place().alias("place")), "place")
    found = _texts(docs, near_chars, at_places).join(wanted, places).dropDuplicates(["line"])  # equal rows have the same line there
    texts = common.stored(found.withColumn("id", F.monotonically_increasing_id()), "line-texts")
    two = _emitted(texts).groupBy("variant").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b").select("variant")
    met = common.stored(two, "line-met")
    rows = common.stored(_emitted(texts).join(met, "variant", "left_semi").distinct(), "line-variants")
    ranked = rows.join(texts.select("id", F.struct("doc", "hash", "at", "line").alias("first")), "id")
    # A line that has lost a character, against the line that is what remains of it.
    ends = ranked.groupBy("variant").agg(
        F.min(F.when(F.col("at") == -1, F.struct("first", "id"))).alias("whole"), F.min(F.when(F.col("at") >= 0, F.struct("first", "id"))).alias("cut"),
        F.count("*").alias("n"),
    ).filter("whole IS NOT NULL AND cut IS NOT NULL")
    # Lines that differ in the character at one place.
    swaps = ranked.filter("at >= 0").groupBy("variant", "at").agg(F.min(F.struct("first", "id")).alias("least"), F.count("*").alias("n")).filter("n > 1")
    ends, swaps = common.stored(ends, "line-ends"), common.stored(swaps, "line-swaps")
    by_end = common.join_unique(rows, ends, ["variant"], "n").select("id", F.when(F.col("at") == -1, F.col("cut")).otherwise(F.col("whole")).alias("other"))
    by_swap = common.join_unique(rows.filter("at >= 0"), swaps, ["variant", "at"], "n").select("id", F.col("least").alias("other"))
    pairs = by_end.unionByName(by_swap).select("id", F.col("other.id").alias("other"), F.col("other.first").alias("first")).distinct()
    own = texts.select("id", "line", "alike", F.struct("doc", "hash", "at", "line").alias("own_first"))
    checked = pairs.join(own, "id").filter("first < own_first").select("line", "alike", "other")
    checked = checked.join(texts.select(F.col("id").alias("other"), F.col("line").alias("other_line"), F.col("alike").alias("other_alike")), "other")
    return checked.filter(F.levenshtein("alike", "other_alike", EDITS) >= 0).select("line", F.col("other_line").alias("other"))


def deduplicated(docs: DataFrame, least_chars: int = LEAST_CHARS, near_chars: int = NEAR_CHARS) -> DataFrame:
    """``docs`` with the text's later lines removed, n_chars of what is left, and n_lines, n_removed, n_near.

    Each row is a document, in the order of (doc_id, hash of the text, copy number); a null doc_id comes first. A line goes if
    the same line stands in an earlier document or before it in its own, or if any line within one edit of it has its first
    place earlier. Each line is judged against all lines, kept or not, so the result does not depend on an order of work.
    Lines under ``least_chars`` characters always stay; under ``near_chars`` only equal lines count.

    Of rows that share a doc_id or have none, the later ones lose what they share; of equal rows, one keeps what it may. A
    null text is empty and stays null; an empty table gives no rows; columns of ``docs`` named n_lines, n_removed or n_near
    are replaced, others may have any name.
    """
    docs = docs.drop("n_lines", "n_removed", "n_near")
    key = ["doc", "hash"]
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("own"), "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(common.text_or_empty()).alias("hash"),
    )
    texts = rows.select(*key, common.text_or_empty().alias("text"))
    lines = common.stored(_lines(texts, least_chars, near_chars), "lines")
    nodes = lines.groupBy("line").agg(F.min(F.struct("doc", "hash", "at", "halves")).alias("first"), F.count("*").alias("n")).select("line", "first.*", "n")
    nodes = common.stored(nodes, "line-nodes")
    near = near_lines(texts, nodes, near_chars).select("line").distinct().withColumn("near", F.lit(True))
    judged = nodes.select("line", F.col("doc").alias("first_doc"), F.col("hash").alias("first_hash"), "n").join(near, "line", "left").filter("near OR n > 1")
    judged = common.stored(judged.withColumn("near", F.coalesce("near", F.lit(False))), "line-verdicts")
    gone = common.join_unique(lines.select("line", *key), judged, ["line"], "n").filter("near OR doc > first_doc OR (doc = first_doc AND hash > first_hash)")
    repeated = lines.filter("times > 1").select(F.lit(None).cast("binary").alias("line"), *key, F.lit(False).alias("near"))
    marked = gone.select("line", *key, "near").unionByName(repeated).groupBy(*key).agg(F.collect_set("line").alias("gone"), F.collect_set(F.when(F.col("near"), F.col("line"))).alias("near"))
    copies = rows.groupBy(*key).count().filter("count > 1")
    marked = common.stored(marked.join(copies, key, "full").withColumn("n", F.coalesce("count", F.lit(1))).drop("count"), "line-marks")
    single = common.join_unique(rows, marked, key, "n", "left").filter("n IS NULL OR n = 1").withColumn("again", F.lit(False))
    copied = common.stored(marked.filter("n > 1"), "line-copied-marks")  # mostly empty, and then no text is shuffled for it
    several = common.copies_marked(common.join_unique(rows, copied, key, "n"), key, "line-copies").select(*single.columns)
    out = _without(single.unionByName(several), least_chars)
    made = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return out.select(*(made.get(c, F.col("own").getField(c)).alias(c) for c in docs.columns), "n_lines", "n_removed", "n_near")


def _without(rows: DataFrame, least_chars: int) -> DataFrame:
    """The rows' texts without the lines that are gone, none of them if ``gone`` is null; ``again``: an equal row before this
    one has had all its lines."""
    schema = pa.struct([("text", pa.string()), ("n_lines", pa.int64()), ("n_removed", pa.int64()), ("n_near", pa.int64())])

    def cleaned(t: str | None, g: list[bytes] | None, m: list[bytes] | None, a: bool) -> tuple:
        if g is None and not a:
            return t, (t or "").count("\n") + 1, 0, 0
        gone, near = set(g or ()), set(m or ())
        lines, kept, seen, n_near = lines_of(t, least_chars), [], set(), 0
        for line, alike in lines:
            h = line_hash(alike) if alike else None
            if alike and (a or h in gone or h in seen):
                n_near += h in near
                continue
            seen.add(h)
            kept.append(line)
        return None if t is None else "\n".join(kept), len(lines), len(lines) - len(kept), n_near

    # Few rows are Python values at a time. Nondeterministic for Spark, so that a filter on its columns is not computed by a second call.
    @F.arrow_udf("text string, n_lines long, n_removed long, n_near long")
    def clean(text: pa.Array, gone: pa.Array, near: pa.Array, again: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text, gone, near, again], ["text", "gone", "near", "again"])
        out = (cleaned(*row) for row in common.arrow_rows([batch], ["text", "gone", "near", "again"]))
        parts = [b.to_struct_array() for b in common.arrow_batches(out, pa.schema(list(schema)), common.ROWS_AT_ONCE)]
        return pa.concat_arrays([p.cast(schema) for p in parts]) if parts else pa.array([], type=schema)

    held = rows.select("own", clean.asNondeterministic()("text", "gone", "near", "again").alias("clean"))
    return held.select("own", "clean.text", "clean.n_lines", "clean.n_removed", "clean.n_near")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicated(docs).select("doc_id", "text", "n_lines", "n_removed", "n_near")
