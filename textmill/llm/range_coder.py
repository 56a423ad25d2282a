"""Token-ID files: an adaptive context-mixing range coder in independent, checksummed blocks.

A block predicts each id from the ids before it: the id last seen after the two previous ones
(order 2) or after the previous one (order 1). Three adaptive probabilities that this guess is right
(by the confidence of order 2, of order 1, and by the order-0 frequency of the guess) are mixed in
the logistic domain with weights that learn; the mix drives a binary arithmetic decision. A wrong
guess is followed by the id under the order-0 frequencies of the file, kept in its header.

Every block starts from a fresh model and has its own payload and CRC-32, so any one can be decoded
alone. Blocks of a file are coded side by side: one numpy step codes the next id of all blocks. All
arithmetic is in integers, so files read the same on every machine.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"CMR1"
BLOCK, LEAST_BLOCK, LANES = 4096, 256, 1024
SLOT_BITS = 12  # contexts per order and block
FREQ_BITS = 20  # order-0 frequencies add up to 2 ** 20; vocabularies must be smaller
FLAG_BITS = 12

_x = np.arange(-2047, 2048)
#: logistic curve and its inverse on 12 bits, rounded once to integers
SQUASH = np.clip(np.rint(4096 / (1 + np.exp(-_x / 256.0))), 1, 4095).astype(np.int64)
STRETCH = np.clip(np.rint(256 * np.log((np.arange(4096) + 0.5) / (4095.5 - np.arange(4096)))), -2047, 2047).astype(np.int64)

_ONE, _LOW32, _S16, _S48 = np.uint64(1), np.uint64(0xFFFFFFFF), np.uint64(16), np.uint64(48)
_SMALL = np.uint64(1 << 32)


class CorruptBlock(ValueError):
    """A block or header does not match its checksum."""


class _Coder:
    """Carry-less range coder, 64-bit state and 16-bit output, for many lanes at once."""

    def __init__(self, lanes: int, words: np.ndarray, reading: bool):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
        self.words, self.at, self.reading = words, np.zeros(lanes, np.int64), reading
        if reading:
            self.code = np.zeros(lanes, np.uint64)
            for _ in range(4):
                self._shift_in(np.arange(lanes))

    def _shift_in(self, lanes) -> None:
        self.code[lanes] = (self.code[lanes] << _S16) | self.words[lanes, self.at[lanes]].astype(np.uint64)
        self.at[lanes] += 1

    def peek(self, lanes, bits: int) -> np.ndarray:
        share = self.range[lanes] >> np.uint64(bits)
        return np.minimum((self.code[lanes] - self.low[lanes]) // share, np.uint64((1 << bits) - 1)).astype(np.int64)

    def step(self, lanes, start, size, bits: int) -> None:
        share = self.range[lanes] >> np.uint64(bits)
        low = self.low[lanes] + start.astype(np.uint64) * share
        width = size.astype(np.uint64) * share
        self.low[lanes], self.range[lanes] = low, width
        while True:
            same = ((low ^ (low + width)) >> _S48) == 0
            small = width < _SMALL
            some = np.flatnonzero(same | small)
            if not len(some):
                return
            tight = small[some] & ~same[some]
            low, width, lanes = low[some], width[some], lanes[some]
            width = np.where(tight, (~low + _ONE) & _LOW32, width)
            if self.reading:
                self._shift_in(lanes)
            else:
                self.words[lanes, self.at[lanes]] = (low >> _S48).astype(np.uint16)
                self.at[lanes] += 1
            low, width = low << _S16, width << _S16
            self.low[lanes], self.range[lanes] = low, width

    def finish(self) -> None:
        lanes = np.arange(len(self.low))
        for k in (48, 32, 16, 0):
            self.words[lanes, self.at] = (self.low >> np.uint64(k)).astype(np.uint16)
            self.at += 1


class _Model:
    """Fresh predictions for each lane; guesses and learns one id per call."""

    def __init__(self, lanes: int, classes: np.ndarray):
        slots = lanes << SLOT_BITS
        self.classes = classes  # order-0 class of an id, 0 to 15
        self.guess = [np.zeros(slots, np.int32), np.zeros(slots, np.int32)]
        self.sure = [np.zeros(slots, np.int8), np.zeros(slots, np.int8)]
        self.hit = np.full((lanes, 32), 1 << 15, np.int64)  # 0-7 order 2, 8-15 order 1, 16-31 order 0
        self.weight = np.full((lanes, 3), 26000, np.int64)
        self.last, self.before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.base = np.arange(lanes, dtype=np.int64) << SLOT_BITS

    def predict(self, n: int):
        """Of the first ``n`` lanes: the guess, whether there is one, and its probability."""
        last, before, base = self.last[:n], self.before[:n], self.base[:n]
        mask = (1 << SLOT_BITS) - 1
        self.at1 = base + ((last * 40503 >> 4) & mask)
        self.at2 = base + ((last * 40503 + before * 22695477 >> 5) & mask)
        g1, s1 = self.guess[0][self.at1], self.sure[0][self.at1]
        g2, s2 = self.guess[1][self.at2], self.sure[1][self.at2]
        guess = np.where(s2 > 0, g2, g1)
        agree = (g1 == g2).astype(np.int64)
        lanes = np.arange(n)
        self.cells = np.stack([s2 * 2 + agree, 8 + s1 * 2 + agree, 16 + self.classes[guess]])
        chance = self.hit[lanes, self.cells]
        self.inputs = STRETCH[chance >> 4]
        mixed = (self.weight[:n].T * self.inputs).sum(axis=0) >> 16
        self.p = SQUASH[np.clip(mixed, -2047, 2047) + 2047]
        self.chance, self.lanes = chance, lanes
        return guess, (s1 > 0) | (s2 > 0), self.p

    def learn(self, n: int, ids: np.ndarray, flagged: np.ndarray, right: np.ndarray) -> None:
        error = np.where(flagged, (right.astype(np.int64) << 12) - self.p, 0)
        self.weight[:n] += (self.inputs * error >> 10).T
        toward = ((right.astype(np.int64) << 16) - right - self.chance) >> 5
        self.hit[self.lanes, self.cells] = self.chance + np.where(flagged, toward, 0)
        for order, at in ((0, self.at1), (1, self.at2)):
            old, sure = self.guess[order][at], self.sure[order][at]
            same = (old == ids) & (sure > 0)
            replace = ~same & (sure < 2)
            self.guess[order][at] = np.where(replace, ids, old)
            self.sure[order][at] = np.where(same, np.minimum(sure + 1, 3), np.where(replace, 1, sure >> 1))
        self.before[:n] = self.last[:n]
        self.last[:n] = ids


def _frequencies(counts: np.ndarray) -> np.ndarray:
    """Whole frequencies of at least 1 that add up to 2 ** FREQ_BITS."""
    spare = (1 << FREQ_BITS) - len(counts)
    freq = 1 + counts * spare // counts.sum()
    freq[np.argmax(counts)] += (1 << FREQ_BITS) - freq.sum()
    return freq


def _tables(symbols: np.ndarray, freq: np.ndarray):
    classes = np.zeros(int(symbols.max()) + 1, np.int64)
    classes[symbols] = np.minimum(np.log2(freq).astype(np.int64), 15)
    return np.cumsum(freq) - freq, classes


def _code(sizes: np.ndarray, symbols, freq, ids: np.ndarray | None, words: np.ndarray) -> np.ndarray:
    """Encode ``ids`` (lanes x steps) into ``words``, or decode ``words`` where ``ids`` is None.

    Lanes are sorted by size, longest first. Returns the words used per lane, or the ids.
    """
    lanes, steps = len(sizes), int(sizes[0])
    start, classes = _tables(symbols, freq)
    reading = ids is None
    coder, model = _Coder(lanes, words, reading), _Model(lanes, classes)
    if reading:
        ids = np.zeros((lanes, steps), np.int64)
        place_of = np.repeat(np.arange(len(freq)), freq)
    else:
        rank = np.zeros(len(classes), np.int64)
        rank[symbols] = np.arange(len(symbols))
    for t in range(steps):
        n = int(np.searchsorted(-sizes, -t, side="left"))  # lanes longer than t
        guess, known, p = model.predict(n)
        flagged = np.flatnonzero(known)
        right = np.zeros(n, bool)
        if reading:
            if len(flagged):
                right[flagged] = coder.peek(flagged, FLAG_BITS) < p[flagged]
        else:
            now = ids[:n, t]
            right[flagged] = guess[flagged] == now[flagged]
        if len(flagged):
            own, q = right[flagged], p[flagged]
            coder.step(flagged, np.where(own, 0, q), np.where(own, q, (1 << FLAG_BITS) - q), FLAG_BITS)
        missed = np.flatnonzero(~right)
        if len(missed):
            place = place_of[coder.peek(missed, FREQ_BITS)] if reading else rank[now[missed]]
            coder.step(missed, start[place], freq[place], FREQ_BITS)
        if reading:
            now = guess.astype(np.int64)
            if len(missed):
                now[missed] = symbols[place]
            ids[:n, t] = now
        model.learn(n, now, known, right)
    if reading:
        return ids
    coder.finish()
    return coder.at


def _packed(array: np.ndarray, kind: str) -> bytes:
    return zlib.compress(array.astype(kind).tobytes(), 6)


def encode_file(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """One file: header, directory of documents, order-0 table, directory of blocks, blocks."""
    ids = np.asarray(ids, np.int64)
    symbols, counts = np.unique(ids, return_counts=True)
    freq = _frequencies(counts) if len(ids) else np.zeros(0, np.int64)
    block = int(np.clip(-(-len(ids) // 512), LEAST_BLOCK, BLOCK))
    parts, used, sums = [], [], []
    for begin in range(0, len(ids), block * LANES):
        group = ids[begin : begin + block * LANES]
        lanes = -(-len(group) // block)
        grid = np.zeros(lanes * block, np.int64)
        grid[: len(group)] = group
        grid = grid.reshape(lanes, block)
        lengths = np.full(lanes, block)
        lengths[-1] = len(group) - (lanes - 1) * block
        words = np.zeros((lanes, 3 * block + 8), np.uint16)
        ends = _code(lengths, symbols, freq, grid, words)
        for lane in range(lanes):
            parts.append(words[lane, : ends[lane]].astype("<u2").tobytes())
            sums.append(zlib.crc32(grid[lane, : lengths[lane]].astype("<u4").tobytes()))
            used.append(ends[lane])
    known = np.array([i is not None for i in doc_ids], bool)
    tables = [
        _packed(np.diff(np.array([i if i is not None else 0 for i in doc_ids], np.int64), prepend=0), "<i8"),
        _packed(np.packbits(known), "u1"),
        _packed(np.asarray(sizes), "<u8"),
        _packed(np.diff(symbols, prepend=0), "<u4"),
        _packed(freq, "<u4"),
        _packed(np.array(used, np.int64), "<u4"),
        _packed(np.array(sums, np.int64), "<u4"),
    ]
    head = struct.pack("<QQI7I", len(doc_ids), len(ids), block, *map(len, tables)) + b"".join(tables)
    return MAGIC + struct.pack("<II", len(head), zlib.crc32(head)) + head + b"".join(parts)


def _header(data: bytes):
    if data[:4] != MAGIC:
        raise CorruptBlock("not a token file")
    size, crc = struct.unpack_from("<II", data, 4)
    head = data[12 : 12 + size]
    if zlib.crc32(head) != crc:
        raise CorruptBlock("the header does not match its checksum")
    documents, total, block, *lengths = struct.unpack_from("<QQI7I", head)
    at, tables = struct.calcsize("<QQI7I"), []
    for length, kind in zip(lengths, ("<i8", "u1", "<u8", "<u4", "<u4", "<u4", "<u4")):
        tables.append(np.frombuffer(zlib.decompress(head[at : at + length]), kind).astype(np.int64))
        at += length
    return documents, total, block, tables, 12 + size


def decode_file(data: bytes, blocks: range | None = None) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Ids of the documents, their sizes, and all token ids; raises :class:`CorruptBlock`.

    With ``blocks`` only those are decoded, and only their token ids are returned.
    """
    documents, total, block, tables, begin = _header(data)
    deltas, bits, sizes, symbols, freq, used, sums = tables
    symbols = np.cumsum(symbols)
    known = np.unpackbits(bits.astype(np.uint8))[:documents].astype(bool)
    doc_ids = [int(i) if k else None for i, k in zip(np.cumsum(deltas), known)]
    places = begin + 2 * (np.cumsum(used) - used)
    wanted = np.arange(len(used)) if blocks is None else np.array(blocks, np.int64)
    out = []
    for first in range(0, len(wanted), LANES):
        group = wanted[first : first + LANES]
        lengths = np.minimum(total - group * block, block)
        words = np.zeros((len(group), int(used[group].max()) + 8), np.uint16)
        for lane, b in enumerate(group):
            words[lane, : used[b]] = np.frombuffer(data, "<u2", used[b], places[b])
        order = np.argsort(-lengths, kind="stable")
        grid = _code(lengths[order], symbols, freq, None, words[order])
        grid = grid[np.argsort(order)]
        for lane, b in enumerate(group):
            ids = grid[lane, : lengths[lane]]
            if zlib.crc32(ids.astype("<u4").tobytes()) != sums[b]:
                raise CorruptBlock(f"block {b} does not match its checksum")
            out.append(ids)
    return doc_ids, sizes, np.concatenate(out) if out else np.zeros(0, np.int64)
