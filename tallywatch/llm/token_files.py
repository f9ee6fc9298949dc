"""Token files: documents as token ids, in order of doc_id, in range-coded blocks."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch.llm import common, id_coder

#: The id that ends a document, and bits that hold any id of the vocabulary.
END_ID, ID_BITS = 1, 16
#: Ids that a task codes side by side; what is held in memory is bounded by it.
IDS_HELD = 8_000_000
#: Distinct words that a task remembers, as they stand and as the tokenizer gets them.
WORDS_HELD, BARE_HELD = 200_000, 1_000_000
#: Bytes of text that are cut into pieces at a time.
BYTES_AT_ONCE = 4_000_000

# Letters of Latin-1 and marks after them; no apostrophe, which the tokenizer joins to some letters.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)\Z")
_BEYOND_ASCII = [c for c in map(chr, range(0xDF, 0x100)) if c.isalpha()]  # the lower ones of those letters

# Pieces of a plain text in lower case: what the tokenizer's expression finds, which white space never joins.
_PIECES = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")
_SPACE, _LETTER, _DIGIT, _MARK, _ODD = range(5)


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """For each byte of UTF-8, what it is and what it is in lower case. Beyond ASCII the letters of Latin-1 are plain, 0xC3 and a second
    byte, and all else is odd; so is "<", with which the tokenizer's special tokens begin."""
    kind, lower = np.full(256, _ODD, dtype=np.uint8), np.arange(256, dtype=np.uint8)
    kind[list(b"\t\n\r ")] = _SPACE
    kind[0x21:0x7F] = _MARK
    kind[ord("0") : ord("9") + 1] = _DIGIT
    kind[ord("<")] = _ODD
    for first, end in ((ord("A"), ord("Z") + 1), (ord("a"), ord("z") + 1), (0x80, 0xC0), (0xC3, 0xC4)):
        kind[first:end] = _LETTER
    lower[ord("A") : ord("Z") + 1] += 32
    lower[0x80:0x9F] += 32
    return kind, lower


_KIND, _LOWER = _classes()

BLOCK_COLUMNS = """
    part int, block long, first long, n_ids long, documents array<struct<doc_id: bigint, place: bigint, piece: bigint, n_ids: bigint, last: boolean>>, payload binary
"""
_DOCUMENT = pa.struct([("doc_id", pa.int64()), ("place", pa.int64()), ("piece", pa.int64()), ("n_ids", pa.int64()), ("last", pa.bool_())])
_BLOCKS = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()), ("documents", pa.list_(_DOCUMENT)), ("payload", pa.binary())])


class _Words(dict):
    """Ids of whatever stands between spaces, as bytes, each asked of the tokenizer once while it is remembered.

    The tokenizer cuts at white space, so a text's ids are those of its parts between spaces. It also cuts between letters and
    the marks that follow them, and lowers letters, so that "Word," needs only "word" and ",". Anything else is
    given to it as it stands. For other tokenizers than ``word_bpe_49k`` pass ``by_word=False``.

    A word of lower letters, or a run of marks, is one piece to the tokenizer, which changes nothing in it but spells its letters
    as bytes. So spelt, it is given to the tokenizer's model, which costs a quarter of a call for a text.

    Many texts at once are cut into such pieces as bytes, and each distinct piece is looked up once; texts with other characters
    go part by part.
    """

    def __init__(self, tokenizer, by_word: bool):
        self.tokenizer, self.by_word, self.bare = tokenizer, by_word, {}
        if by_word:
            self.model = tokenizer.model
            self.spelt = str.maketrans({c: "".join(piece for piece, _ in tokenizer.pre_tokenizer.pre_tokenize_str(c)) for c in _BEYOND_ASCII})

    def ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _bare(self, word: str) -> bytes:
        found = self.bare.get(word)
        if found is None:
            if len(self.bare) >= BARE_HELD:
                self.bare.clear()
            pieces = self.model.tokenize(word if word.isascii() else word.translate(self.spelt))
            found = self.bare[word] = struct.pack(f"<{len(pieces)}I", *(p.id for p in pieces))
        return found

    def __missing__(self, part: str) -> bytes:
        plain = _PLAIN.match(part)
        found = self.ids(part) if plain is None else self._bare(plain[1].lower()) + (self._bare(plain[2]) if plain[2] else b"")
        if len(self) >= WORDS_HELD:
            self.clear()
        self[part] = found
        return found

    def of_text(self, text: str) -> np.ndarray:
        if not self.by_word:
            return np.frombuffer(self.ids(text), dtype="<u4")
        return np.frombuffer(b"".join(map(self.__getitem__, text.replace("\n", " ").split(" "))), dtype="<u4")

    def of_texts(self, texts: pa.StringArray) -> Iterator[np.ndarray]:
        """The ids of each text, none of which is null; ``BYTES_AT_ONCE`` of them, or one text, are cut at a time."""
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        first = 0
        while first < len(texts):
            least = sizes[first - 1] + BYTES_AT_ONCE if first else BYTES_AT_ONCE
            end = max(first + 1, int(np.searchsorted(sizes, least, side="right")))
            yield from self._of_some(texts.slice(first, end - first))
            first = end

    def _of_some(self, texts: pa.StringArray) -> Iterator[np.ndarray]:
        if not self.by_word:
            yield from map(self.of_text, texts.to_pylist())
            return
        text, ends = _bytes_of(texts)
        kind = _KIND[text]
        odd = kind == _ODD
        odd[1:] |= (text[:-1] == 0xC3) & ((text[1:] == 0x97) | (text[1:] == 0xB7))  # the two signs among those letters
        is_odd = np.zeros(len(texts), dtype=bool)
        is_odd[np.searchsorted(ends, np.flatnonzero(odd), side="right")] = True
        if is_odd.any():
            text, ends = _bytes_of(texts.filter(pa.array(~is_odd)))
            plain = self._of_plain(text, ends, _KIND[text])
            for at, alone in enumerate(is_odd.tolist()):
                yield self.of_text(texts[at].as_py()) if alone else next(plain)
        else:
            yield from self._of_plain(text, ends, kind)

    def _of_plain(self, text: np.ndarray, ends: np.ndarray, kind: np.ndarray) -> Iterator[np.ndarray]:
        """The same for texts of plain characters, given as their bytes one after the other, where each ends, and what each byte is."""
        starts = (kind == _DIGIT) | (kind != np.concatenate((kind[:1] ^ 1, kind[:-1])))
        begins = np.concatenate(([0], ends[:-1]))
        first = begins[begins < ends]
        starts[first] = True
        # An apostrophe alone and the letters after it are one piece here, which may hold two of the tokenizer's.
        mark = np.flatnonzero((text[:-1] == ord("'")) & starts[:-1] & (kind[1:] == _LETTER))
        starts[mark + 1] = False
        starts[first] = True  # no piece goes on into the next text
        inside = kind != _SPACE
        starts &= inside
        offsets = np.append(np.flatnonzero(starts[inside]), np.count_nonzero(inside)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(_LOWER[text[inside]])).dictionary_encode()
        own = self._of_pieces(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, own), dtype=np.int64, count=len(own)) // 4
        which = pieces.indices.to_numpy()
        n = sizes[which]
        after = np.concatenate(([0], np.cumsum(n)))
        places = np.repeat((np.cumsum(sizes) - sizes)[which] - after[:-1], n) + np.arange(after[-1])
        ids = np.frombuffer(b"".join(own), dtype="<u4")[places]
        cuts = after[np.searchsorted(np.flatnonzero(starts), np.concatenate((begins, ends[-1:])))].tolist()
        return (ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False))

    def _of_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, most of which are known. One with an apostrophe before its letters is remembered whole."""
        own = list(map(self.bare.get, pieces))
        for at in [at for at, found in enumerate(own) if found is None]:
            piece = pieces[at]
            if piece[0] != "'":
                own[at] = self._bare(piece)
            else:
                own[at] = self.bare[piece] = b"".join(map(self._bare, _PIECES.findall(piece)))
        return own


def _bytes_of(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each ends."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    offsets, values = texts.buffers()[1:]
    if not len(ends) or not ends[-1]:
        return np.empty(0, dtype=np.uint8), ends
    first = int(np.frombuffer(offsets, dtype=np.int32)[texts.offset])
    return np.frombuffer(values, dtype=np.uint8)[first : first + ends[-1]], ends


_LOADED: dict[tuple[str, bool], _Words] = {}


def _words(tokenizer_file: str, by_word: bool) -> _Words:
    """The same object for all tasks of a worker, so that words are asked once."""
    if (tokenizer_file, by_word) not in _LOADED:
        from tokenizers import Tokenizer

        _LOADED[tokenizer_file, by_word] = _Words(Tokenizer.from_file(tokenizer_file), by_word)
    return _LOADED[tokenizer_file, by_word]


def _blocks(documents: Iterator[tuple[int | None, np.ndarray]], part: int, block_ids: int, id_bits: int) -> Iterator[pa.RecordBatch]:
    """The blocks of one file. A document may go over several; all but a file's last one are full."""
    first = place = number = n_held = 0
    ids: list[np.ndarray] = []
    inside: list[dict] = []
    room = block_ids
    full: list[tuple[np.ndarray, list[dict]]] = []

    def coded() -> pa.RecordBatch:
        nonlocal first, number, n_held, full
        sizes = [len(i) for i, _ in full]
        firsts = first + np.concatenate(([0], np.cumsum(sizes)))[:-1]
        columns = [[part] * len(full), range(number, number + len(full)), firsts.tolist(), sizes, [d for _, d in full], id_coder.encode([i for i, _ in full], id_bits)]
        first, number, n_held, full = first + sum(sizes), number + len(full), 0, []
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, _BLOCKS.types, strict=True)], schema=_BLOCKS)

    for doc_id, own in documents:
        at = piece = 0
        while at < len(own):
            some = own[at : at + room]
            at, room = at + len(some), room - len(some)
            ids.append(some)
            inside.append({"doc_id": doc_id, "place": place, "piece": piece, "n_ids": len(some), "last": at == len(own)})
            piece += 1
            if not room:
                full.append((np.concatenate(ids), inside))
                ids, inside, room, n_held = [], [], block_ids, n_held + block_ids
                if n_held >= IDS_HELD:
                    yield coded()
        place += 1
    if ids:
        full.append((np.concatenate(ids), inside))
    if full:
        yield coded()


def coded(docs: DataFrame, tokenizer_file: str, end_id: int = END_ID, id_bits: int = ID_BITS, block_ids: int = id_coder.BLOCK_IDS, by_word: bool = True) -> DataFrame:
    """Blocks of the documents' ids, each document with ``end_id`` after it, in ascending order of (doc_id, text).

    A row is a block: part (its file), block and first (its number, and the ids before it in the file), n_ids, documents (in
    order: doc_id, place in the file, ids in this block, whether they are its last) and payload. Parts follow each other in
    order of doc_id; a task holds ``IDS_HELD`` ids and one Arrow batch of texts. Written as Parquet, each part is a file.

    A null doc_id comes first; a null text is empty, so only its end id is written; rows of one doc_id are documents of their
    own, and however many there are, they are dealt over parts; an empty table gives no blocks; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text"), F.monotonically_increasing_id().alias("row"))
    dealt = rows.repartitionByRange("doc_id", F.xxhash64("text"), "row").sortWithinPartitions("doc_id", F.xxhash64("text"), "text").select("doc_id", "text")
    end = np.array([end_id], dtype="<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(tokenizer_file, by_word)

        def documents() -> Iterator[tuple[int | None, np.ndarray]]:
            for batch in batches:
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), words.of_texts(batch.column("text").cast(pa.string())), strict=True):
                    yield doc_id, np.concatenate((ids, end))

        yield from _blocks(documents(), TaskContext.get().partitionId(), block_ids, id_bits)

    return dealt.mapInArrow(run, BLOCK_COLUMNS)


def read_pieces(blocks: DataFrame, with_ids: bool = True) -> DataFrame:
    """The decoded blocks as pieces of documents: part, place (the document in its part), doc_id, piece, last, first (ids
    before it in the part), n_ids, crc32, and the ids themselves unless ``with_ids`` is off.

    Any block can be read alone; a damaged one raises an error.
    """
    fields = [("part", pa.int32()), ("place", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int64()), ("last", pa.bool_()), ("first", pa.int64()), ("n_ids", pa.int64()), ("crc32", pa.int64())]
    ddl = "part int, place long, doc_id long, piece long, last boolean, first long, n_ids long, crc32 long"
    schema = pa.schema([*fields, ("ids", pa.list_(pa.int64()))] if with_ids else fields)
    most = IDS_HELD // 8 if with_ids else IDS_HELD

    def pieces(rows: list[tuple]) -> Iterator[tuple]:
        for (part, first, documents, _), ids in zip(rows, id_coder.decode([r[3] for r in rows]), strict=True):
            if len(ids) != sum(d["n_ids"] for d in documents):
                raise ValueError("a block does not hold its documents")
            held = memoryview(ids.astype("<u4").tobytes())
            at = 0
            for d in documents:
                end = at + d["n_ids"]
                row = part, d["place"], d["doc_id"], d["piece"], d["last"], first + at, d["n_ids"], zlib.crc32(held[4 * at : 4 * end])
                yield (*row, ids[at:end].tolist()) if with_ids else row
                at = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n_ids = 0
        for n, *row in common.arrow_rows(batches, ["n_ids", "part", "first", "documents", "payload"]):
            held.append(tuple(row))
            n_ids += n
            if n_ids >= most:
                yield from common.arrow_batches(pieces(held), schema)
                held, n_ids = [], 0
        if held:
            yield from common.arrow_batches(pieces(held), schema)

    return blocks.mapInArrow(run, ddl + (", ids array<bigint>" if with_ids else ""))


def _times(a: int, b: int) -> int:
    """Product of two polynomials over bits modulo that of crc32; the highest bit is the constant term."""
    out = 0
    for _ in range(32):
        if a & 0x80000000:
            out ^= b
        a = a << 1 & 0xFFFFFFFF
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


@lru_cache(maxsize=10_000)
def _shift(length: int) -> int:
    """x to the 8 * length, which moves a checksum over so many bytes."""
    out, power = 0x80000000, 0x00800000  # 1, and x to the 8
    while length:
        if length & 1:
            out = _times(out, power)
        power, length = _times(power, power), length >> 1
    return out


def crc32_joined(pieces: Iterable[tuple[int, int]]) -> int:
    """The crc32 of bytes that come in pieces, from each piece's crc32 and length."""
    out = 0
    for crc, length in pieces:
        out = _times(out, _shift(length)) ^ crc
    return out


def read_documents(blocks: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of every document, from its blocks.

    Documents inside one block are done where it is decoded. Of the others only checksums meet, which are joined as the ids
    would have been. Starts are those in the part plus the sizes of earlier parts, one row for each file.
    """
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    pieces = read_pieces(blocks, with_ids=False)

    @F.pandas_udf("long")
    def joined(parts):
        return parts.map(lambda held: crc32_joined((int(p["crc32"]), 4 * int(p["n_ids"])) for p in held))

    whole = (F.col("piece") == 0) & F.col("last")
    pieces = common.stored(pieces, "token-pieces")
    ready = pieces.filter(whole).select("part", "doc_id", "first", "n_ids", "crc32")
    cut = pieces.filter(~whole).groupBy("part", "place", "doc_id").agg(
        F.min("first").alias("first"), F.sum("n_ids").alias("n_ids"), F.sort_array(F.collect_list(F.struct("piece", "n_ids", "crc32"))).alias("parts")
    ).select("part", "doc_id", "first", "n_ids", joined("parts").alias("crc32"))
    return ready.unionByName(cut).join(offsets, "part").select(
        "doc_id", (F.col("first") + F.col("offset")).alias("start"), F.col("n_ids").alias("n_tokens"), F.col("crc32").alias("ids_crc32")
    )


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = common.stored(coded(common.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")), "token-files")
    return read_documents(files)
