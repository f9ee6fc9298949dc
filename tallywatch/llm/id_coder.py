"""Adaptive context-mixing range coder for token ids. Blocks are coded independently, many side by side in numpy lanes.

An id is predicted from the two ids before it, from the one before it, and from all ids of the block so far (orders 2, 1
and 0). Adaptive weights, one set for each state of the predictions, mix the three: the coder codes which order predicts the
id, and, where only order 0 does, in the same step the id's range under the adaptive frequencies of 256 ranges of ids. Ids are
equal inside a range, so their bits below it are not coded but stand by themselves. All arithmetic is on integers, so that
every machine decodes what any other has coded.

A block is: magic, bits of an id, number of ids, crc32 of the ids (as little-endian 32-bit numbers), number of ids that only
order 0 predicts, 32-bit code words, the lower bits of those ids, and the crc32 of all that. A damaged block raises
``ValueError``.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Ids in a block. Models start anew in each, so any block can be read alone.
BLOCK_IDS = 2048
MAGIC = b"IDB3"

_HEAD = struct.Struct("<4sBxxxIII")
_WEIGHT_BITS, _RANGE_BITS = np.uint64(16), 12  # of the shares of orders, and of those of ranges inside what order 0 has
_LEAST_RANGE, _WORD, _LOW_WORD = np.uint64(1 << 32), np.uint64(32), np.uint64((1 << 32) - 1)
_SLOTS_1, _SLOTS_2 = 1024, 2048
_FIRST_RENEWAL, _RENEW, _STEP = 64, 1024, 4  # frequencies are renewed at the powers of 2 from the first and then each so many ids; what one occurrence adds
_RANGES = 256  # ranges of ids


def _weights(both: int, two: int) -> np.uint32:
    """The share of orders 1 and 2 together and, in the low 16 bits, that of order 2."""
    return np.uint32(both << 16 | two)


# The weights at first, by whether order 2 knows an id, and whether order 1 says another. An order that says nothing keeps the least share.
_AT_FIRST = (_weights(64, 32), _weights(1 << 15, 32), _weights((1 << 15) + 32, 1 << 15), _weights(3 << 14, 1 << 15))
# A weight loses 1/16 and gains 1/16 of its aim, which depends on the order that was right. So shares stay above 0, and order 0 keeps over 512.
_SIXTEENTH = np.uint32(0x0FFF0FFF)
_TWO_RIGHT, _ONE_RIGHT, _NONE_RIGHT = _weights(4063, 4061), _weights(4063, 2), _weights(4, 2)


def _kind(id_bits: int) -> type:
    """What ids are held as: small tables are read faster."""
    return np.uint16 if id_bits <= 16 else np.uint32


class _Model:
    """The state of ``lanes`` blocks: slots of orders 1 and 2, mixing weights, counts. Coder and decoder move it alike."""

    def __init__(self, lanes: int, id_bits: int):
        rows = np.arange(lanes)
        kind = _kind(id_bits)
        self.unknown = np.iinfo(kind).max  # also an id, with the least share: both sides read it alike
        self.rows_0, self.rows_1, self.rows_2, self.rows_4 = rows * _RANGES, rows * _SLOTS_1, rows * _SLOTS_2, rows * 4
        self.before, self.last = np.zeros(lanes, dtype=np.uint32), np.zeros(lanes, dtype=np.uint32)  # hashes of the two ids before
        self.one, self.two = np.full(lanes * _SLOTS_1, self.unknown, dtype=kind), np.full(lanes * _SLOTS_2, self.unknown, dtype=kind)
        self.weights = np.tile(np.array(_AT_FIRST, dtype=np.uint32), lanes)
        self.counts = np.ones((lanes, _RANGES), dtype=np.int32)
        self.spans = np.empty(0, dtype=np.uint32)  # of each range its start and, in the low 16 bits, its share
        self.renewed = 0

    def renew(self, step: int, ids: np.ndarray, new: np.ndarray, below: int) -> bool:
        """The frequencies with the ids before ``step``, when it is time for it."""
        if step % _RENEW and (step < _FIRST_RENEWAL or step & (step - 1)):
            return False
        since, self.renewed = slice(self.renewed, step), step
        lanes = len(self.counts)
        at = np.flatnonzero(new[since])
        found = (ids[since].reshape(-1).take(at) >> below) + at % lanes * _RANGES
        self.counts += (np.bincount(found, minlength=lanes * _RANGES) * _STEP).astype(np.int32).reshape(lanes, _RANGES)
        shares = self.counts * np.int32((1 << _RANGE_BITS) - _RANGES) // self.counts.sum(axis=1, keepdims=True, dtype=np.int32) + np.int32(1)
        # What rounding leaves over goes to the last range, so that any value lies in one.
        shares[:, -1] += (1 << _RANGE_BITS) - shares.sum(axis=1, dtype=np.int32)
        self.shares = shares.reshape(-1)
        self.spans = ((np.cumsum(shares, axis=1, dtype=np.int32) - shares) << 16 | shares).view(np.uint32).reshape(-1)
        return True

    def predict(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the first ``k`` lanes: the ids that orders 2 and 1 predict, the share of order 2, and that of both together."""
        last = self.last[:k]
        self.at_one = (last >> np.uint32(22)).astype(np.int64)
        self.at_one += self.rows_1[:k]
        self.at_two = (((self.before[:k] ^ last) * np.uint32(0xC2B2AE35)) >> np.uint32(21)).astype(np.int64)
        self.at_two += self.rows_2[:k]
        two, one = self.two.take(self.at_two, mode="clip"), self.one.take(self.at_one, mode="clip")
        state = (two != self.unknown).view(np.int8)
        state += state
        state += (one != two).view(np.int8)
        self.at_weight = self.rows_4[:k] + state
        self.held = self.weights.take(self.at_weight, mode="clip")
        return two, one, *_halves(self.held)

    def span(self, k: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Share and start of the ranges ``at``."""
        return _halves(self.spans.take(self.rows_0[:k] + at, mode="clip"))

    def learn(self, k: int, ids: np.ndarray, by_two: np.ndarray, new: np.ndarray) -> None:
        aim = np.where(new, _NONE_RIGHT, np.where(by_two, _TWO_RIGHT, _ONE_RIGHT))
        aim += self.held
        aim -= (self.held >> np.uint32(4)) & _SIXTEENTH
        self.weights[self.at_weight] = aim
        self.two[self.at_two] = ids
        self.one[self.at_one] = ids
        last = self.last[:k]
        np.right_shift(last, np.uint32(7), out=self.before[:k])
        np.multiply(ids, np.uint32(0x9E3779B1), out=last)


def _halves(held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The low and the high 16 bits."""
    return (held & np.uint32(0xFFFF)).astype(np.uint64), (held >> np.uint32(16)).astype(np.uint64)


def _lookup(model: _Model) -> np.ndarray:
    """For each value of a share the range that it lies in, lane by lane."""
    return np.repeat(np.tile(np.arange(_RANGES, dtype=np.uint8), len(model.counts)), model.shares)


def _borders(wide: np.ndarray, first: np.ndarray, both: np.ndarray) -> np.ndarray:
    """Makes the shares of orders parts of ``wide``; what a unit of a range's share is, inside what order 0 has."""
    unit = wide >> _WEIGHT_BITS
    first *= unit
    both *= unit
    return (wide - both) >> np.uint64(_RANGE_BITS)


def _interval(first: np.ndarray, both: np.ndarray, unit: np.ndarray, share: np.ndarray, start: np.ndarray, by_two: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of what is coded; its arguments don't last."""
    start *= unit
    start += both
    share *= unit
    both -= first
    return np.where(new, start, np.where(by_two, np.uint64(0), first)), np.where(new, share, np.where(by_two, first, both))


class _Coder:
    """Range coder, one per lane: 64-bit low and range, 32 bits leave at a time. Carries are counted on the word before and passed on at the end."""

    def __init__(self, lanes: int, room: int):
        self.low, self.range = np.zeros(lanes, dtype=np.uint64), np.full(lanes, (1 << 64) - 1, dtype=np.uint64)
        self.room = room
        self.rows, self.n_words = np.arange(lanes) * (room + 1) + 1, np.zeros(lanes, dtype=np.int64)
        self.words = np.zeros(lanes * (room + 1), dtype=np.uint64)  # a lane's first takes no carry: what is coded is below 1

    def narrow(self, k: int, start: np.ndarray, size: np.ndarray) -> None:
        low, wide = self.low[:k], self.range[:k]
        wide[:] = size
        low += start
        carried = np.flatnonzero(low < start)
        if len(carried):
            self.words[self.rows.take(carried) + self.n_words.take(carried) - 1] += np.uint64(1)
        moving = np.flatnonzero(wide < _LEAST_RANGE)
        self.shift(moving, low)
        wide[moving] = wide.take(moving) << _WORD

    def shift(self, lanes: np.ndarray, low: np.ndarray) -> None:
        own, n = low.take(lanes), self.n_words.take(lanes)
        self.words[self.rows.take(lanes) + n] = own >> _WORD
        self.n_words[lanes] = n + 1
        low[lanes] = own << _WORD

    def ended(self) -> np.ndarray:
        """The words of each lane, of which the first ``n_words`` count."""
        lanes = np.arange(len(self.low))
        for _ in range(2):
            self.shift(lanes, self.low)
        words = self.words.reshape(len(lanes), self.room + 1)
        for at in range(int(self.n_words.max(initial=0)), 1, -1):
            words[:, at - 1] += words[:, at] >> _WORD
        return words[:, 1:].astype("<u4")


def _packed(values: np.ndarray, bits: int) -> bytes:
    if bits % 8 == 0:
        return values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : bits // 8].tobytes()
    return np.packbits(((values[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)).astype(np.uint8)).tobytes()


def _unpacked(held: bytes, n: int, bits: int) -> np.ndarray:
    if bits % 8 == 0:
        out = np.zeros((n, 4), dtype=np.uint8)
        out[:, : bits // 8] = np.frombuffer(held, dtype=np.uint8).reshape(n, bits // 8)
        return out.view("<u4").reshape(-1)
    found = np.unpackbits(np.frombuffer(held, dtype=np.uint8), count=n * bits).reshape(n, bits)
    return (found.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


def encode(blocks: list[np.ndarray], id_bits: int = 32) -> list[bytes]:
    """Each block of ids (below 2^id_bits, and below 2^32 - 1) as bytes."""
    by_length = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    lengths = np.array([len(blocks[i]) for i in by_length], dtype=np.int64)
    if any((block >> np.uint32(id_bits)).any() for block in blocks if id_bits < 32):
        raise ValueError(f"an id does not fit {id_bits} bits")
    ids = np.zeros((int(lengths.max(initial=0)), len(blocks)), dtype=_kind(id_bits))
    for lane, i in enumerate(by_length):
        ids[: len(blocks[i]), lane] = blocks[i]
    below = max(0, id_bits - 8)
    model, coder = _Model(len(blocks), id_bits), _Coder(len(blocks), len(ids) + 4)
    alone = np.zeros(ids.shape, dtype=bool)  # ids that only order 0 predicts
    for step, now in enumerate(ids):
        k = int(np.searchsorted(-lengths, -step, side="left"))
        model.renew(step, ids, alone, below)
        now = now[:k]
        two, one, first, both = model.predict(k)
        by_two = now == two
        new = now != one
        new &= ~by_two
        alone[step, :k] = new
        unit = _borders(coder.range[:k], first, both)
        coder.narrow(k, *_interval(first, both, unit, *model.span(k, now >> below), by_two, new))
        model.learn(k, now, by_two, new)
    words = coder.ended()
    out: list[bytes] = [b""] * len(blocks)
    mask = np.uint32((1 << below) - 1)
    alone = np.ascontiguousarray(alone.T)
    for lane, i in enumerate(by_length):
        own = np.asarray(blocks[i], dtype=np.uint32)
        lower = own[alone[lane, : len(own)]] & mask
        head = _HEAD.pack(MAGIC, id_bits, len(own), zlib.crc32(own.astype("<u4").tobytes()), len(lower))
        body = head + words[lane, : coder.n_words[lane]].tobytes() + _packed(lower, below)
        out[i] = body + struct.pack("<I", zlib.crc32(body))
    return out


def decode(blocks: list[bytes]) -> list[np.ndarray]:
    """The ids of each block."""
    heads = []
    for block in blocks:
        if len(block) < _HEAD.size + 4 or struct.unpack("<I", block[-4:])[0] != zlib.crc32(block[:-4]) or block[:4] != MAGIC:
            raise ValueError("damaged block of ids")
        heads.append(_HEAD.unpack_from(block)[1:])
    out: list[np.ndarray] = [np.empty(0, dtype=np.uint32)] * len(blocks)
    for id_bits in {h[0] for h in heads}:
        chosen = sorted((i for i, h in enumerate(heads) if h[0] == id_bits), key=lambda i: -heads[i][1])
        decoded = _decoded([blocks[i] for i in chosen], np.array([heads[i][1] for i in chosen]), [heads[i][3] for i in chosen], id_bits)
        for i, ids in zip(chosen, decoded, strict=True):
            if zlib.crc32(ids.astype("<u4").tobytes()) != heads[i][2]:
                raise ValueError("damaged block of ids")
            out[i] = ids
    return out


def _decoded(blocks: list[bytes], lengths: np.ndarray, alone_in: list[int], id_bits: int) -> list[np.ndarray]:
    """The same for blocks of one id width, longest first."""
    ids = np.zeros((int(lengths.max(initial=0)), len(blocks)), dtype=_kind(id_bits))
    below = max(0, id_bits - 8)
    ends = [len(b) - 4 - (n * below + 7) // 8 for b, n in zip(blocks, alone_in, strict=True)]
    if any(end < _HEAD.size + 8 for end in ends):
        raise ValueError("damaged block of ids")
    lower = np.concatenate([*(_unpacked(b[end:-4], n, below) for b, end, n in zip(blocks, ends, alone_in, strict=True)), np.zeros(1, dtype=np.uint32)]).astype(ids.dtype)
    next_lower = np.concatenate(([0], np.cumsum(alone_in, dtype=np.int64)))[:-1]
    words = [np.frombuffer(b, dtype="<u4", offset=_HEAD.size, count=(end - _HEAD.size) // 4) for b, end in zip(blocks, ends, strict=True)]
    model = _Model(len(blocks), id_bits)
    next_word = np.cumsum([0, *map(len, words)])[:-1]
    words = np.concatenate([*words, np.zeros(1, dtype=np.uint32)]).astype(np.uint64)
    codes = words.take(next_word) << _WORD | words.take(next_word + 1)
    next_word += 2
    ranges = np.full(len(blocks), (1 << 64) - 1, dtype=np.uint64)
    most = np.uint64((1 << _RANGE_BITS) - 1)
    rows = np.arange(len(blocks)) << _RANGE_BITS
    alone = np.zeros(ids.shape, dtype=bool)
    for step in range(len(ids)):
        k = int(np.searchsorted(-lengths, -step, side="left"))
        if model.renew(step, ids, alone, below):
            lookup = _lookup(model)
        code, wide = codes[:k], ranges[:k]
        two, one, first, both = model.predict(k)
        unit = _borders(wide, first, both)
        by_two, new = code < first, code >= both
        # Where an order predicts the id, the range means nothing.
        share = np.minimum((code - both) // unit, most).view(np.int64)
        share += rows[:k]
        at = lookup.take(share, mode="clip")
        share, start = model.span(k, at)
        own = (at.astype(lower.dtype) << below) | lower.take(next_lower[:k], mode="clip")
        next_lower[:k] += new
        now = np.where(new, own, np.where(by_two, two, one))
        start, wide[:] = _interval(first, both, unit, share, start, by_two, new)
        code -= start
        moving = np.flatnonzero(wide < _LEAST_RANGE)
        at_word = next_word.take(moving)
        code[moving] = code.take(moving) << _WORD | words.take(at_word, mode="clip")
        wide[moving] = np.maximum(wide.take(moving), np.uint64(1)) << _WORD
        next_word[moving] = at_word + 1
        ids[step, :k] = now
        alone[step, :k] = new
        model.learn(k, now, by_two, new)
    ids = ids.T.astype(np.uint32, order="C")
    return [ids[lane, :n].copy() for lane, n in enumerate(lengths.tolist())]
