"""Token files: the coder by round trips, the operator against direct tokenization."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallywatch.llm import id_coder, token_files

FILE = public_tokenizers.path("word_bpe_49k.json")


def own_ids(text):
    return [*Tokenizer.from_file(FILE).encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("bits", [1, 5, 8, 12, 16, 17, 24, 25, 32])
def test_round_trip(bits):
    rng = np.random.default_rng(bits)
    most = min(1 << bits, 2**32 - 1)
    blocks = [rng.integers(0, most, n, dtype=np.uint32) for n in (0, 1, 2, 3, 200, 777)]
    blocks += [np.full(500, most - 1, dtype=np.uint32), np.resize(np.arange(min(3, most), dtype=np.uint32), 300), np.minimum(rng.zipf(1.5, 3000), most - 1).astype(np.uint32)]
    coded = id_coder.encode(blocks, bits)
    for ids, back in zip(blocks, id_coder.decode(coded), strict=True):
        assert ids.tolist() == back.tolist()
    # A block is the same whatever it is coded with, and can be read alone.
    assert id_coder.encode([blocks[5]], bits)[0] == coded[5]
    assert id_coder.decode([coded[5]])[0].tolist() == blocks[5].tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 300), max_size=60), max_size=6))
def test_round_trip_of_any_blocks(lists):
    blocks = [np.array(x, dtype=np.uint32) for x in lists]
    assert [b.tolist() for b in id_coder.decode(id_coder.encode(blocks, 9))] == lists


def test_repeated_ids_are_coded_in_few_bits_and_damage_is_found():
    ids = np.resize(np.array([7, 1000, 40_000, 12, 7, 3], dtype=np.uint32), 2048)
    block = id_coder.encode([ids], 16)[0]
    assert len(block) < 200
    for at in (0, 6, len(block) // 2, len(block) - 1):
        with pytest.raises(ValueError):
            id_coder.decode([block[:at] + bytes([block[at] ^ 4]) + block[at + 1 :]])
    with pytest.raises(ValueError):
        id_coder.decode([block[:10]])
    with pytest.raises(ValueError):
        id_coder.encode([np.array([70_000], dtype=np.uint32)], 16)


TEXTS = st.text(alphabet=st.one_of(st.sampled_from("aBcd's.,!?;: \n\t\r' \x1c ́ΣéE<|>1290"), st.characters(exclude_categories=["Cs"])), max_size=40)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_ids_by_word_are_the_ids_of_the_text(text):
    for t in (text, text + " <|endoftext|> It's WORD,word.. don't.", text.upper()):
        assert [*token_files._words(FILE, True).of_text(t), 1] == own_ids(t)


def expected(rows):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(own_ids(text), dtype="<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("block_ids", [1, 7, 2048])
def test_files_read_back(spark, docs, block_ids):
    rows = [(9, "The last one. " * 9), (-3, "first, with a minus"), (4, None), (5, ""), (6, "word " * 3000), (7, "你好, café!"), (2**40, "far")]
    blocks = token_files.coded(docs(*rows), FILE, block_ids=block_ids)
    held = token_files.common.stored(blocks, "blocks")
    assert sorted(map(tuple, token_files.read_documents(held).collect())) == sorted(expected(rows))
    assert held.filter(f"n_ids > {block_ids}").count() == 0
    ids = {}
    for r in sorted(token_files.read_pieces(held).collect(), key=lambda r: (r.part, r.place, r.piece)):
        ids.setdefault(r.doc_id, []).extend(r.ids)
    assert ids == {i: own_ids(t) for i, t in rows}


def test_repeated_and_null_ids_stand_apart_and_are_dealt(spark, docs, odd):
    found = sorted(token_files.read_documents(token_files.common.stored(token_files.coded(odd, FILE), "blocks")).collect(), key=lambda r: r.start)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(r.n_tokens for r in found) == sorted(len(own_ids(t)) for _, t in rows)
    assert [r.doc_id for r in found] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    start = 0
    for r in found:
        assert r.start == start
        start += r.n_tokens
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    many = docs(*[(None, f"text {i % 5}") for i in range(2000)])
    parts = [r.n for r in token_files.common.stored(token_files.coded(many, FILE), "blocks").selectExpr("part", "size(documents) AS n").groupBy("part").sum("n").toDF("part", "n").collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) > 1 and max(parts) < 1500
    assert token_files.read_documents(token_files.common.stored(token_files.coded(docs(*[]), FILE), "blocks")).count() == 0


@given(st.lists(st.binary(max_size=40), max_size=6))
def test_joined_checksums(pieces):
    assert token_files.crc32_joined((zlib.crc32(p), len(p)) for p in pieces) == zlib.crc32(b"".join(pieces))


def test_words_of_letters_and_marks_cost_no_call_for_a_text():
    class Counting:
        def __init__(self, inner):
            self.inner, self.model, self.pre_tokenizer, self.calls = inner, inner.model, inner.pre_tokenizer, 0

        def encode(self, *args, **options):
            self.calls += 1
            return self.inner.encode(*args, **options)

    tokenizer = Counting(Tokenizer.from_file(FILE))
    words = token_files._Words(tokenizer, by_word=True)
    text = "The theand\netémentouier, ÀÖØ öß÷ heouor$$$ Straße. ontiinha!? " + " ".join(map(chr, range(0xC0, 0x100)))
    ids = words.of_text(text.replace("\u00d7", "").replace("\u00f7", "")).tolist()
    assert tokenizer.calls <= 1  # for the empty parts
    assert [*ids, 1] == own_ids(text.replace("\u00d7", "").replace("\u00f7", ""))


def test_few_words_remembered_give_the_same_ids(monkeypatch):
    monkeypatch.setattr(token_files, "WORDS_HELD", 6)
    monkeypatch.setattr(token_files, "BARE_HELD", 3)
    text = " ".join(f"w{'abcdefg'[i % 7]} the, und {'xyz'[i % 3]}é." for i in range(50))
    words = token_files._Words(Tokenizer.from_file(FILE), by_word=True)
    assert [*words.of_text(text).tolist(), 1] == own_ids(text)
    assert len(words) <= 6


WHOLE = Tokenizer.from_file(FILE)


def ids_of_whole(texts):
    return [[*WHOLE.encode(t, add_special_tokens=False).ids, 1] for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(TEXTS, st.text(alphabet="aBcé'É.3 \n\t×sTrelm<", max_size=30)), max_size=6))
def test_ids_of_many_texts_are_those_of_each(texts):
    texts = [*texts, "It's WE'LL don't''s 'tis 'é ..'s a'sun", "", "Straße ÀÖØ 1234's!?", "a×b÷c", "x<|endoftext|>y", *(t + " it's" for t in texts)]
    words = token_files._words(FILE, True)
    for held in (pa.array(texts, pa.string()), pa.array(["cut off", *texts, "é"], pa.string()).slice(1, len(texts))):
        assert [[*i.tolist(), 1] for i in words.of_texts(held)] == ids_of_whole(texts)


def test_texts_are_cut_few_at_a_time(monkeypatch):
    texts = [f"Word{'abcde'[i % 5]}, it's {i}é" if i % 4 else "" for i in range(60)] + [" ", "\n"]
    for size in (1, 17, 100, 10**6):
        monkeypatch.setattr(token_files, "BYTES_AT_ONCE", size)
        assert [[*i.tolist(), 1] for i in token_files._words(FILE, True).of_texts(pa.array(texts))] == ids_of_whole(texts)
    assert list(token_files._words(FILE, True).of_texts(pa.array([], pa.string()))) == []


def test_plain_pieces_are_looked_up_once_for_many_texts(monkeypatch):
    words = token_files._Words(Tokenizer.from_file(FILE), by_word=True)
    asked = []
    monkeypatch.setattr(token_files._Words, "_bare", lambda self, word, bare=token_files._Words._bare: asked.append(word) or bare(self, word))
    texts = ["The word, THE WORD. it's"] * 50
    assert [[*i.tolist(), 1] for i in words.of_texts(pa.array(texts))] == ids_of_whole(texts)
    assert sorted(asked) == ["'s", ",", ".", "it", "the", "word"]


def test_an_id_is_one_coding_step_and_its_lower_bits_stand_apart(monkeypatch):
    steps = []
    monkeypatch.setattr(id_coder._Coder, "narrow", lambda self, k, start, size, narrow=id_coder._Coder.narrow: steps.append(k) or narrow(self, k, start, size))
    ids = np.random.default_rng(3).integers(0, 1 << 16, 300, dtype=np.uint32)
    block = id_coder.encode([ids], 16)[0]
    assert steps == [1] * 300
    assert id_coder.decode([block])[0].tolist() == ids.tolist()
    assert len(block) < 300 * 2 + 60  # random ids cost what they have


def test_a_piece_with_an_apostrophe_is_asked_once():
    words = token_files._Words(Tokenizer.from_file(FILE), by_word=True)
    texts = ["it's 'quoted 'tis", "'Quoted, ' 'tis 'a' ''s"]
    assert [[*ids.tolist(), 1] for ids in words.of_texts(pa.array(texts))] == [own_ids(t) for t in texts]
    assert np.frombuffer(words.bare["'quoted"], dtype="<u4").tolist() == own_ids("'quoted")[:-1]
    known = dict(words.bare)
    assert [[*ids.tolist(), 1] for ids in words.of_texts(pa.array(texts[::-1]))] == [own_ids(t) for t in texts[::-1]]
    assert words.bare == known


def test_tables_hold_ids_in_as_few_bytes_as_they_need():
    assert [id_coder._Model(3, bits).two.itemsize for bits in (1, 16, 17, 32)] == [2, 2, 4, 4]
    assert id_coder._Model(3, 16).one.itemsize == 2


def test_a_carry_goes_over_any_number_of_words():
    coder = id_coder._Coder(2, 6)
    held = coder.words.reshape(2, 7)
    held[0, 1:5], held[1, 1:3] = [7, 2**32 - 1, 2**32 - 1, 2**32 + 5], [1, 2]  # the last word of the first lane has met a carry
    coder.n_words[:] = 4, 2
    assert coder.ended()[:, :6].tolist() == [[8, 0, 0, 5, 0, 0], [1, 2, 0, 0, 0, 0]]


def test_ids_that_stand_for_unknown_ones_come_back():
    rng = np.random.default_rng(5)
    for bits, most in ((16, 2**16 - 1), (32, 2**32 - 2)):
        blocks = [np.full(3000, most, dtype=np.uint32), rng.choice(np.array([0, most, most - 1], dtype=np.uint32), 2500), np.resize(np.array([most, 0], dtype=np.uint32), 70)]
        assert [b.tolist() for b in id_coder.decode(id_coder.encode(blocks, bits))] == [b.tolist() for b in blocks]
