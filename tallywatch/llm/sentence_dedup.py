"""Substring dedup: sliding sentence spans. Sentences that a repeated span covers are removed but for its first place."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm import common

#: A span is the shortest run from a sentence on that has so many sentences and words.
LEAST_SENTENCES, LEAST_WORDS = 2, 16
#: A longer sentence is cut at words that its own content chooses: at least one of any ``CUT_WITHIN`` words in a row.
MOST_WORDS, CUT_WITHIN = 16, 8

#: Stands for a null doc_id: before all others.
NO_ID = -(2**63)

# Sentence ends of scripts that do not use the ASCII ones (Arabic, Devanagari, Ethiopic, Burmese, Khmer, CJK, full width).
_ENDS = ".!?\n\u061f\u06d4\u0964\u0965\u1362\u104a\u104b\u17d4\u17d5\u2026\u203c\u2047-\u2049\u3002\uff01\uff0e\uff1f\uff61"
# Scripts written without spaces (Thai, Lao, Burmese, Khmer; Chinese and Japanese with their punctuation). Two characters count as a word.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u2fdf\u3001-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff01-\uffef\U00020000-\U0003ffff"

_SENTENCE = re.compile(rf"[^{_ENDS}]+[{_ENDS.replace(chr(10), '')}]*\s*|[{_ENDS}]+\s*")
_UNIT = re.compile(rf"[{_UNSPACED}]\s*|[^\s{_UNSPACED}]+\s*|\s+")
_PLAIN_UNIT = re.compile(r"\S+\s*|\s+")  # the same for ASCII
_DENSE = re.compile(rf"[{_UNSPACED}]")
_LETTER = re.compile(r"\w")


def _spaced(piece: str) -> bool:
    return piece.isascii() or not _DENSE.search(piece)


def _words(piece: str) -> int:
    """Words between spaces; of scripts without spaces, two characters count as one."""
    if _spaced(piece):
        return len(piece.split())
    return len(_DENSE.sub(" ", piece).split()) + (len(_DENSE.findall(piece)) + 1) // 2


def _cuts(hashes: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Where to cut rows of words of these sizes, laid end to end: behind each word with the least hash of some ``CUT_WITHIN`` in a row.

    Whether a word is one depends on the words up to ``CUT_WITHIN`` - 1 before and after it and not on its place, so the same
    passage has the same cuts inside, wherever it stands. The ends of the rows are cuts too.
    """
    ends = np.cumsum(sizes)
    starts = len(hashes) - CUT_WITHIN + 1
    if starts <= 0:
        return ends
    least, at = hashes[:starts].copy(), np.zeros(starts, dtype=np.int64)
    for k in range(1, CUT_WITHIN):  # of equal words the last one counts
        here = hashes[k : k + starts]
        no_more = here <= least
        at[no_more] = k
        least = np.minimum(least, here)
    row = np.repeat(np.arange(len(sizes)), sizes)
    inside = row[:starts] == row[CUT_WITHIN - 1 :]
    cut = np.zeros(len(hashes) + 1, dtype=bool)
    cut[(at + np.arange(starts))[inside] + 1] = True
    cut[ends] = True
    return np.flatnonzero(cut)


def _cut(pieces: list[str]) -> list[list[tuple[str, int, str]]]:
    """The parts of each long sentence, each with its words and the part as it is hashed."""
    units: list[str] = []
    bare: list[str] = []
    sizes, spaced = [], []
    for piece in pieces:
        spaced.append(plain := _spaced(piece))
        found = (_PLAIN_UNIT if plain else _UNIT).findall(piece)
        sizes.append(len(found))
        units += found
        if not plain:
            bare += [u.strip() for u in found]
        elif found[0].isspace():
            bare += ["", *piece.split()]
        else:
            bare += piece.split()
    cuts = iter(_cuts(common.word_hashes([u.encode("utf-8", "surrogatepass") for u in bare]), sizes).tolist())
    out, a = [], 0
    for size, plain in zip(sizes, spaced, strict=True):
        parts, end = [], a + size
        while a < end:
            b = next(cuts)
            part = "".join(units[a:b])
            if plain and bare[a]:
                parts.append((part, b - a, " ".join(bare[a:b])))
            else:
                parts.append((part, _words(part), " ".join(part.split())))
            a = b
        out.append(parts)
    return out


def _parsed(text: str) -> list[tuple[str, int, str]]:
    """(sentence, words, the sentence with single spaces) in order."""
    out: list[list] = []  # sentence, words, with single spaces, what stays with it
    for piece in _SENTENCE.findall(text):
        if out and not _LETTER.search(piece):
            out[-1][3] += piece
        else:
            words = piece.split()
            out.append([piece, len(words) if _spaced(piece) else _words(piece), " ".join(words), ""])
    cut = iter(_cut([x[0] for x in out if x[1] > MOST_WORDS]))
    parts: list[tuple[str, int, str]] = []
    for piece, words, bare, rest in out:
        if words > MOST_WORDS:
            parts += next(cut)
            piece, words, bare = parts.pop()
        parts.append((piece + rest, words, " ".join((piece + rest).split())) if rest else (piece, words, bare))
    return parts


def sentences(text: str) -> list[tuple[str, int]]:
    """(sentence, words) in order; joined, they are the text. Pieces without a word stay with the sentence before them."""
    return [(s, words) for s, words, _ in _parsed(text)]


def spans(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """For each sentence from which a span begins: the span's hash and the sentence after it, else (0, own position).

    ``parts`` are (sentence, words), with the sentence in single spaces behind them if it is known.
    """
    n = len(parts)
    hashes = np.zeros(n, dtype=np.uint64)
    ends = np.arange(n)
    if not n:
        return hashes, ends
    own = common.word_hashes([(bare[0] if bare else " ".join(s.split())).encode("utf-8", "surrogatepass") for s, _, *bare in parts])
    words = np.concatenate(([0], np.cumsum([p[1] for p in parts])))
    last = np.maximum(np.searchsorted(words, words[:-1] + LEAST_WORDS, side="left"), ends + LEAST_SENTENCES)
    at = np.flatnonzero(last <= n)
    sizes = last[at] - at
    ends[at] = last[at]
    folded, size = sizes.astype(np.uint64), 0
    while len(at):  # all spans take their next sentence at once; the shortest are done first
        folded = common.mixed(folded * common.ODD + own[at + size])
        size += 1
        more = sizes > size
        if not more.all():
            hashes[at[~more]] = folded[~more]
            at, sizes, folded = at[more], sizes[more], folded[more]
    return hashes, ends


def covered(parts: list[tuple], repeated: set[int]) -> np.ndarray:
    """Which sentences to remove: under a span that is ``repeated`` elsewhere before, or that this text had before."""
    hashes, ends = spans(parts)
    at = np.flatnonzero(ends > np.arange(len(ends)))
    later = np.ones(len(at), dtype=bool)
    later[np.unique(hashes[at], return_index=True)[1]] = False
    if repeated:
        later |= np.isin(hashes[at], np.fromiter(repeated, dtype=np.uint64, count=len(repeated)))
    return under(len(parts), at[later] * _SIZES + ends[at[later]] - at[later])


#: A span's place in its text in one number: the first sentence, and how many it covers.
_SIZES = 64
_PARTS = pa.schema([
    ("doc_id", pa.int64()), ("doc", pa.int64()), ("text", pa.string()), ("hash", pa.int64()), ("lengths", pa.list_(pa.int32())),
    ("spans", pa.list_(pa.struct([("span", pa.int64()), ("place", pa.int64())]))),
])
_PARTS_DDL = "doc_id long, doc long, text string, hash long, lengths array<int>, spans array<struct<span:long,place:long>>"
#: Rows and characters that a task holds at a time.
_ROWS, _CHARS = 500, 4_000_000


def _lists(arrays: list[np.ndarray]) -> tuple[pa.Array, np.ndarray]:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.array(offsets), np.concatenate(arrays)


def _parts_batch(rows: list[tuple]) -> pa.RecordBatch:
    *plain, lengths, found, places = zip(*rows, strict=True)
    offsets, flat = _lists(lengths)
    span_offsets, flat_spans = _lists(found)
    structs = pa.StructArray.from_arrays([pa.array(flat_spans.view(np.int64)), pa.array(np.concatenate(places))], fields=list(_PARTS.field("spans").type.value_type))
    arrays = [*(pa.array(c, type=f.type) for c, f in zip(plain, _PARTS, strict=False)), pa.ListArray.from_arrays(offsets, pa.array(flat)), pa.ListArray.from_arrays(span_offsets, structs)]
    return pa.RecordBatch.from_arrays(arrays, schema=_PARTS)


def _parted(docs: DataFrame) -> DataFrame:
    """Each row with the lengths of its sentences and its spans: the only time that texts are cut."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        chars = 0
        for batch in batches:
            for at in range(batch.num_rows):
                doc_id, doc, text, code = (batch.column(c)[at].as_py() for c in ("doc_id", "doc", "text", "hash"))
                parts = _parsed(text)
                hashes, ends = spans(parts)
                first = np.flatnonzero(ends > np.arange(len(ends)))
                held.append((doc_id, doc, text, code, np.array([len(p[0]) for p in parts], dtype=np.int32), hashes[first], first * _SIZES + (ends[first] - first)))
                chars += len(text)
                if len(held) >= _ROWS or chars >= _CHARS:
                    yield _parts_batch(held)
                    held, chars = [], 0
        if held:
            yield _parts_batch(held)

    return docs.mapInArrow(run, _PARTS_DDL)


def _later_places(parts: DataFrame) -> DataFrame:
    """row and place of all places of repeated spans but each span's first one, in the order (doc, hash, row, place)."""
    found = parts.select("row", "doc", F.inline("spans"))
    repeated = found.groupBy("span").agg(F.min("doc").alias("first_doc"), F.count("*").alias("n")).filter("n > 1")
    at = common.stored(common.join_unique(found, common.stored(repeated, "sentence-repeats"), ["span"], "n"), "sentence-places")
    # Only a span that its first document has twice, or several rows of that id have, needs more than the id.
    first = at.filter("doc = first_doc").select("span", "row", "place")
    tied = common.stored(first.groupBy("span").agg(F.count("*").alias("n")).filter("n > 1"), "sentence-tied")
    tied = common.join_unique(first, tied, ["span"], "n").drop("n").join(parts.select("row", "hash"), "row")
    tied = common.stored(tied.select("span", F.struct("hash", "row", "place").alias("at")), "sentence-tied-places")
    least = common.stored(tied.groupBy("span").agg(F.min("at").alias("least"), F.count("*").alias("n")), "sentence-tied-first")
    again = common.join_unique(tied, least, ["span"], "n").filter("at > least").select("at.row", "at.place")
    return at.filter("doc > first_doc").select("row", "place").unionByName(again)


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, text without the repeated sentences, n_sentences, n_removed and removed (their positions, from 0).

    Each row is a document, in the order of (doc_id, hash of the text, copy number); a null doc_id comes before all others. The
    first place of a span is the one in the first document, and in it the first; all others are removed. A null
    text is empty; an empty table gives no rows; other columns are ignored.

    Texts are cut once and stored with their spans. Spans are counted with map-side combining, and the few with over a
    thousandth of all places are looked up by broadcast, so no span is hot in a shuffle; a row's places are as many as its own
    sentences. Texts meet their places in one join by row.
    """
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc.alias("doc"), common.text_or_empty().alias("text")).withColumn("hash", F.xxhash64("text"))
    parts = common.stored(_parted(rows).withColumn("row", F.monotonically_increasing_id()), "sentence-parts")
    gone = _later_places(parts).groupBy("row").agg(F.collect_list("place").alias("places"))
    return _without(parts.select("row", "doc_id", "text", "lengths").join(gone, "row", "left"))


def under(n: int, places: np.ndarray) -> np.ndarray:
    """Which of ``n`` sentences lie under a span at one of these places."""
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, places // _SIZES, 1)
    np.add.at(edges, places // _SIZES + places % _SIZES, -1)
    return np.cumsum(edges[:-1]) > 0


def _without(rows: DataFrame) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_sentences", pa.int64()), ("n_removed", pa.int64()), ("removed", pa.list_(pa.int32()))])

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = {name: batch.column(name) for name in batch.schema.names}
        touched = column["places"].is_valid().to_numpy(zero_copy_only=False)
        texts, removed = [], [np.empty(0, dtype=np.int32)] * batch.num_rows
        for at in np.flatnonzero(touched).tolist():
            text, lengths, places = column["text"][at].as_py(), column["lengths"][at].values.to_numpy(), column["places"][at].values.to_numpy()
            gone = under(len(lengths), places)
            removed[at] = np.flatnonzero(gone).astype(np.int32)
            ends = np.cumsum(lengths)
            edges = np.flatnonzero(np.diff(gone, prepend=True, append=True)).tolist()  # kept runs
            texts.append("".join(text[ends[a] - lengths[a] : ends[b - 1]] for a, b in zip(edges[::2], edges[1::2], strict=True)))
        text = pc.replace_with_mask(column["text"], pa.array(touched), pa.array(texts, type=pa.string())) if texts else column["text"]
        n_removed = np.array([len(x) for x in removed], dtype=np.int64)
        offsets, flat = _lists(removed)
        sizes = pc.list_value_length(column["lengths"]).cast(pa.int64())
        return pa.RecordBatch.from_arrays([column["doc_id"], text, sizes, pa.array(n_removed), pa.ListArray.from_arrays(offsets, pa.array(flat))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                yield clean(batch.slice(at, _ROWS))

    return rows.mapInArrow(run, "doc_id long, text string, n_sentences long, n_removed long, removed array<int>")


def op5_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(common.table(spark, sf_dir, "documents"))
