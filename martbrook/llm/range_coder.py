"""Adaptive context-mixing range coder for token ids, in blocks that stand alone.

A block starts with an empty model and has a checksum, so any one can be read without the others. That
also lets many blocks be coded side by side: a step handles the next id of all of them with a few
operations on arrays.

Orders 2, 1 and 0 predict the next id: the id that last followed the two, or the one, before it, or, where
neither has been seen, the block's most frequent id. Each order says how likely the prediction is right, order 0
from how often one was that is, or is not, the most frequent id, orders 1 and 2 from how often the entry was; their probabilities are mixed by weights that follow how well each has done. An id that
is not predicted is coded by order 0: its number of bits by adaptive frequencies, then its bits. Decisions go
into a range coder of 48 bits that puts out words of 16 bits. Only integers and basic float operations are
used, so every machine decodes what another has coded. The coder's numbers are whole and below 2**53, so that they
are held as floats: processors divide, multiply and round these several at a time, and 64-bit integers not.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 1024
#: Blocks coded side by side; bounds the memory of a call (about 25 kB a block).
LANES = 8192
CLASSES = 17
MOST_ID = (1 << CLASSES) - 2

_ONE = 1 << 16
_LOW, _TOP, _WORD = 2.0 ** 32, 2.0 ** 48, 2.0 ** 16
_SLOTS = 1024
_STATES, _BITS = 8, 3
_MIX = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], dtype=np.uint32)
_RATE = 5
_UP = (1 << _RATE) - 1
_SPREAD = _ONE - CLASSES
_CLASS_OF = np.repeat(np.arange(CLASSES, dtype=np.uint8), 1 << np.arange(CLASSES))  # of id + 1, from 1 on
_INNER = np.arange(1, CLASSES, dtype=np.uint16)[:, None]
_PLACES = 2.0 ** (16 - np.arange(CLASSES))  # the share of one id of a class


def _chosen(mask: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """``one`` where all bits of the mask are set, ``other`` where none is."""
    one = one ^ other
    one &= mask
    one ^= other
    return one


def _narrow(size: np.ndarray, width: np.ndarray, which: np.ndarray) -> None:
    """Set sizes to widths where ``which`` is 1, not 0; all are whole numbers, so this is exact."""
    width -= size
    width *= which
    size += width


class _Model:
    """What all lanes have learnt so far. Arrays of several rows have one for each order, or class."""

    def __init__(self, lanes: int, steps: int = BLOCK):
        self.lane = np.arange(lanes)
        self.base = (self.lane * _SLOTS).astype(np.uint32)
        self.bases = np.stack([self.base, self.base + np.uint32(lanes * _SLOTS)])
        self.rows = (self.lane * 3 + np.arange(3)[:, None]).astype(np.int32) * (2 * _STATES)
        #: An id and, in its lowest bits, how often it was right.
        self.entries = np.zeros((2, lanes * _SLOTS), dtype=np.int32)
        self.cells = self.entries.reshape(-1)
        #: How often ids occurred, by a hash, and the most frequent id with its count.
        self.counts = np.zeros(lanes * _SLOTS, dtype=np.uint16 if steps < _ONE else np.int32)
        self.often, self.most = np.zeros(lanes, dtype=np.int32), np.zeros(lanes, dtype=np.int32)
        self.rates = np.full(lanes * 3 * 2 * _STATES, _ONE // 2, dtype=np.uint16)
        self.weights = np.full((3, lanes), 1.0 / 3)
        self.last = np.zeros(lanes, dtype=np.int32)
        self.before = np.zeros(lanes, dtype=np.int32)
        steps = (np.arange(CLASSES + 1) * _SPREAD // CLASSES).astype(np.uint16)
        self.classes = np.repeat(steps[:, None], lanes, axis=1)
        self.scratch = np.empty((3, CLASSES - 1, lanes), dtype=np.uint16)

    def predict(self) -> tuple[np.ndarray, np.ndarray]:
        """The candidate id of each lane, and the share of the range that a hit gets."""
        last, before = self.last.astype(np.uint32), self.before.astype(np.uint32)  # products modulo 2**32
        slots = np.empty(self.bases.shape, np.uint32)
        np.right_shift(last * _MIX[0], 7, out=slots[0])
        np.right_shift(last * _MIX[1] ^ before * _MIX[2], 9, out=slots[1])
        slots &= _SLOTS - 1
        slots += self.bases
        self.slots = slots.astype(np.intp)
        self.found = self.cells.take(self.slots)
        trust1, trust2 = self.trust = self.found & _STATES - 1
        id1, id2 = self.known = self.found >> _BITS
        seen1, seen2 = -self.found >> 31  # all bits, or none
        guess = _chosen(seen2, id2, _chosen(seen1, id1, self.often))
        states = self.rows.copy()
        states[0] += self.often == guess
        states[1:] += self.trust
        states[1] += (id1 != guess).view(np.int8) << _BITS
        states[2] += (id1 == id2).view(np.int8) << _BITS
        self.states = states.astype(np.intp)
        self.chances = np.maximum(self.rates.take(self.states), np.uint16(32))
        w = self.weights
        parts = w * self.chances
        share = parts[0] + parts[1]
        share += parts[2]
        whole = w[0] + w[1]
        whole += w[2]
        share /= whole
        np.floor(share, out=share)
        return guess, np.minimum(np.maximum(share, 64, out=share), _ONE - 64, out=share)

    def learn(self, ids: np.ndarray, hit: np.ndarray) -> None:
        ids = ids.astype(np.int32, copy=False)
        # Modulo 2**16, -x is _ONE - x; with all bits turned, x - 1, and turned again after the shift, it rounds down.
        turn = hit.astype(np.uint16) - np.uint16(1)
        self.rates[self.states] = self.chances + ((-self.chances ^ turn) >> _RATE ^ turn)
        w = self.weights
        w *= (self.chances ^ turn) - turn
        whole = w[0] + w[1]
        whole += w[2]
        w /= whole
        np.maximum(w, 0.02, out=w)
        found, trust = self.found, self.trust
        less = _chosen(1 - trust >> 31, found - (trust + 1 >> 1), (ids << _BITS) + 1)
        self.cells[self.slots] = _chosen((self.known ^ ids) - 1 >> 31, np.minimum(found + 1, found | _STATES - 1), less)
        slot = (self.base + (ids.astype(np.uint32) * _MIX[0] >> 13 & _SLOTS - 1)).astype(np.intp)
        count = self.counts.take(slot)
        count += 1
        self.counts[slot] = count
        count = count.astype(np.int32)
        self.often, self.most = _chosen(self.most - 1 - count >> 31, ids, self.often), np.maximum(count, self.most)
        self.before, self.last = self.last, ids

    def place(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in the range the class of each lane begins, and its share."""
        at = kinds * np.intp(len(self.lane)) + self.lane
        classes = self.classes.reshape(-1)
        first = classes.take(at)
        return first + kinds, classes.take(at + len(self.lane)) - first + np.uint16(1)

    def learn_class(self, kinds: np.ndarray, missed: np.ndarray) -> None:
        """Kinds of ids, for the lanes that missed."""
        # Modulo 2**16: up by (_SPREAD - row) >> _RATE above a kind, else down by row >> _RATE, rounded up.
        rows, (above, change, part) = self.classes[1:CLASSES], self.scratch
        np.subtract(kinds.astype(np.uint16), _INNER, out=above)
        np.right_shift(above.view(np.int16), 15, out=above.view(np.int16))  # all bits above, else none
        np.bitwise_xor(rows, above, out=change)
        np.bitwise_and(above, np.uint16(_UP + _ONE - 1 - _SPREAD), out=part)
        change -= part
        change += np.uint16(_UP)
        change >>= _RATE
        change ^= above
        change -= above
        change &= -missed.astype(np.uint16)
        rows -= change


def _encode(ids: np.ndarray) -> list[bytes]:
    """Code rows of equal length side by side."""
    lanes, steps = ids.shape
    model = _Model(lanes, steps)
    low, size = np.zeros(lanes), np.full(lanes, _TOP)
    # Words above 16 bits are settled at the end.
    out, at = np.zeros((3 * steps + 4) * lanes, dtype=np.int32), np.arange(lanes)

    def put(first, share, which=None):
        nonlocal low
        whole = size * (1 / _WORD)
        np.floor(whole, out=whole)
        if which is None:
            np.multiply(whole, share, out=size)
        else:
            _narrow(size, whole * share, which)
            whole *= which
        whole *= first
        low += whole
        short = size < _LOW
        high = low * (1 / _LOW)
        np.floor(high, out=high)
        out[at] = high.astype(np.int32)
        scale = np.where(short, _WORD, 1.0)
        np.multiply(size, scale, out=size)
        high *= short
        high *= _LOW
        low -= high
        low *= scale
        np.add(at, lanes, out=at, where=short)

    columns = np.ascontiguousarray(ids.T, dtype=np.int32)
    for now in columns:
        guess, share = model.predict()
        hit = now == guess
        put(np.where(hit, 0, share), np.where(hit, share, _ONE - share))
        missed = ~hit
        if missed.any():
            kind, passed = _CLASS_OF.take(now), missed.astype(np.float64)
            put(*model.place(kind), passed)
            share = _PLACES.take(kind)
            put((now + 1) * share - _ONE, share, passed)
            model.learn_class(kind, missed)
        model.learn(now, hit)
    for _ in range(3):
        high = np.floor(low / _LOW)
        out[at] = high.astype(np.int32)
        low = (low - high * _LOW) * _WORD
        at += lanes
    words = out.reshape(-1, lanes)[:at.max() // lanes]
    for k in range(len(words) - 1, 0, -1):
        words[k - 1] += words[k] >> 16
    words = np.ascontiguousarray(words.T, dtype="<u2")
    return [row[:n].tobytes() for row, n in zip(words, (at // lanes).tolist())]


def _decode(data: list[bytes], steps: int) -> np.ndarray:
    lanes, longest = len(data), max(map(len, data)) // 2 + 3
    words = np.frombuffer(b"".join(part.ljust(2 * longest, b"\0") for part in data), "<u2")
    words = np.ascontiguousarray(words.reshape(lanes, longest).T).reshape(-1)
    model = _Model(lanes, steps)
    code = words[:lanes] * _LOW + words[lanes:2 * lanes] * _WORD + words[2 * lanes:3 * lanes]
    size, at = np.full(lanes, _TOP), np.arange(3 * lanes, 4 * lanes)
    out = np.empty((steps, lanes), dtype=np.int32)

    def whole_of():
        whole = size * (1 / _WORD)
        return np.floor(whole, out=whole)

    def shift():
        short = size < _LOW
        scale = np.where(short, _WORD, 1.0)
        np.multiply(size, scale, out=size)
        np.multiply(code, scale, out=code)
        np.add(code, words.take(at, mode="clip") * short, out=code)
        np.add(at, lanes, out=at, where=short)

    with np.errstate(over="ignore"):  # of damaged data
        for step in range(steps):
            guess, share = model.predict()
            whole = whole_of()
            share *= whole
            hit = code < share
            missed = ~hit
            whole *= _ONE
            whole -= share
            np.subtract(code, share, out=code, where=missed)
            np.copyto(size, np.where(hit, share, whole))
            shift()
            now = guess
            if missed.any():
                passed = missed.astype(np.float64)
                whole = whole_of()
                where = np.minimum(np.floor(code / whole), _ONE - 1).astype(np.uint16)
                kind = np.add.reduce((model.classes[1:CLASSES] + _INNER <= where).view(np.uint8), axis=0, dtype=np.uint8)
                first, share = model.place(kind)
                _narrow(size, whole * share, passed)
                whole *= passed
                code -= whole * first
                shift()
                whole = whole_of()
                share = _PLACES.take(kind)
                rest = np.floor(np.minimum(np.floor(code / whole), _ONE - 1) / share)
                _narrow(size, whole * share, passed)
                whole *= passed
                whole *= rest * share
                code -= whole
                shift()
                now = np.where(missed, (rest + _ONE / share).astype(np.int32) - np.int32(1), guess)
                model.learn_class(kind, missed)
            model.learn(now, hit)
            out[step] = now
    return np.ascontiguousarray(out.T)


def checksum(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian 32-bit numbers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def _groups(count: int) -> list[range]:
    """Blocks in as few groups as ``LANES`` allows, of about one size: a step costs its calls, however few its lanes."""
    groups = -(-count // LANES)
    ends = [count * k // groups for k in range(groups + 1)] if groups else []
    return [range(*pair) for pair in zip(ends, ends[1:])]


def encode_blocks(ids: np.ndarray, block: int = BLOCK) -> list[tuple[int, int, bytes]]:
    """(number of ids, checksum, data) of each block; only the last may be shorter."""
    ids = np.asarray(ids)
    if len(ids) and (ids.min() < 0 or ids.max() > MOST_ID):
        raise ValueError(f"ids must lie between 0 and {MOST_ID}")
    count = -(-len(ids) // block)
    padded = np.zeros(count * block, dtype=np.int32)
    padded[:len(ids)] = ids
    rows, out = padded.reshape(count, block), []
    for group in _groups(count):
        for k, data in zip(group, _encode(rows[group.start:group.stop])):
            part = ids[k * block:(k + 1) * block]
            out.append((len(part), checksum(part), data))
    return out


def decode_blocks(blocks: list[tuple[int, int, bytes]], block: int = BLOCK) -> np.ndarray:
    """Ids of blocks as :func:`encode_blocks` returns them; any of its blocks will do."""
    parts = []
    for group in _groups(len(blocks)):
        some = blocks[group.start:group.stop]
        for (n, check, _), row in zip(some, _decode([b[2] for b in some], block)):
            if checksum(row[:n]) != check:
                raise ValueError("a block is damaged")
            parts.append(row[:n])
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)
