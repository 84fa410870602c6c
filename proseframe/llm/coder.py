"""An adaptive context-mixing range coder for token ids, in independent checksummed blocks.

A block is cut into lanes that advance together, one id per lane and step, so
each step is a handful of array operations. Each lane has a range coder of its
own; the model is shared by the block and learns after each step from all
lanes. It mixes three predictions of the next id with weights learned for each
pair of confidences: the id that last followed the same two ids (order 2), the
one that last followed the same id (order 1), and the adaptive frequencies of
ids (order 0). All arithmetic is on integers, so any machine decodes alike.

Block: magic, then little-endian uint32s: ids, lanes, steps, alphabet, CRC-32 of
the ids, CRC-32 of these numbers and of all that follows; then the number of
16-bit words of each lane and the words.
"""

from __future__ import annotations

import zlib

import numpy as np

MAGIC = b"PFB1"
LANES = 8192
BLOCK = 1 << 21
#: bits of the mixing weights, of the order-0 frequencies, of both
WEIGHT, ZERO = 16, 20
BOTH = WEIGHT + ZERO
LOW_RANGE = np.uint64(1 << 48)
SHIFT, FOUR, TOP_WORD = np.uint64(16), np.uint64(4), np.uint64(48)
HASH = 1 << 16
TOP = 7
#: what a confidence changes by after a miss (0 and 1: the prediction is replaced instead), then after a hit
STEP = np.array([0, 0, -1, -2, -2, -3, -3, -4] + [1] * 7 + [0], dtype=np.int64)
REBUILD = 16


class CorruptBlock(ValueError):
    """A block whose checksum or size does not fit its bytes."""


class Mixer:
    """The shared model of a block. ``look`` gives the step's intervals, ``learn`` updates it with the ids that came."""

    def __init__(self, alphabet: int, lanes: int, decodes: bool = False):
        if alphabet >= 1 << (ZERO - 1):
            raise ValueError("ids must be below 2**19")
        self.alphabet = alphabet
        self.after_two = np.zeros(HASH, dtype=np.int64)  # id * 8 + confidence
        self.after_one = np.zeros(alphabet + 1, dtype=np.int64)
        self.seen = np.zeros(alphabet, dtype=np.int64)
        self.fresh: list[np.ndarray] = []
        self.zones = np.zeros((2 * (TOP + 1) ** 2, 3), dtype=np.int64)  # literal, order 1, order 2
        self.zones[:] = (2, 1, 1)
        self.previous = np.full(lanes, alphabet, dtype=np.int64)
        self.before = np.full(lanes, alphabet, dtype=np.int64)
        self.step = 0
        self.decodes = decodes
        self.rebuild()

    def rebuild(self) -> None:
        if self.fresh:
            self.seen += np.bincount(np.concatenate(self.fresh), minlength=self.alphabet)
            self.fresh = []
        total = max(1, int(self.seen.sum()))
        share = self.share = 1 + self.seen * ((1 << ZERO) - self.alphabet) // total
        self.starts = np.zeros(self.alphabet + 1, dtype=np.int64)
        np.cumsum(share, out=self.starts[1:])
        if self.decodes:  # the id at each place of the order-0 scale
            self.at = np.repeat(np.arange(self.alphabet, dtype=np.int32), share)

    def look(self, lanes: int) -> None:
        if self.step < REBUILD and self.step & (self.step - 1) == 0 or self.step % REBUILD == 0:
            self.rebuild()
        p1, p2 = self.previous[:lanes], self.before[:lanes]
        self.h = ((p2 * 0x9E3779B1 + p1 * 0x85EBCA6B) >> 13) & (HASH - 1)
        self.e2, self.e1 = self.after_two[self.h], self.after_one[p1]
        self.c2, self.k2, self.c1, self.k1 = self.e2 >> 3, self.e2 & 7, self.e1 >> 3, self.e1 & 7
        self.context = (self.k2 * (TOP + 1) + self.k1) * 2 + (self.c1 == self.c2)
        if self.step % 4 == 0 or self.step < REBUILD:
            total = self.zones.sum(axis=1)
            one = self.zones[:, 1] * ((1 << WEIGHT) - 256) // total
            two = self.zones[:, 2] * ((1 << WEIGHT) - 256) // total
            at = np.arange(len(total))
            one[(at // 2 % (TOP + 1) == 0) | (at % 2 == 1)] = 0
            two[at // (2 * (TOP + 1)) == 0] = 0
            self.one, self.literal = one, (1 << WEIGHT) - one - two
        self.w1, self.w0 = self.one[self.context], self.literal[self.context]

    def learn(self, ids: np.ndarray, zone: np.ndarray) -> None:
        lanes = len(ids)
        self.zones += np.bincount(self.context * 3 + zone, minlength=self.zones.size).reshape(self.zones.shape)
        self.fresh.append(ids[zone == 0])
        own = ids * 8 + 1
        p1 = self.previous[:lanes]
        for table, at, entry, guess, sure in ((self.after_two, self.h, self.e2, self.c2, self.k2), (self.after_one, p1, self.e1, self.c1, self.k1)):
            right, firm = guess == ids, sure > 1
            table[at] = np.where(right | firm, entry + STEP[sure + (TOP + 1) * right], own)
        self.before[:lanes] = p1
        self.previous[:lanes] = ids
        self.step += 1


def _layout(n: int) -> tuple[int, int]:
    steps = max(1, -(-n // LANES), min(n, 64))
    return -(-n // steps), steps


def _active(n: int, lanes: int, steps: int) -> list[int]:
    last = n - (lanes - 1) * steps
    return [lanes if t < last else lanes - 1 for t in range(steps)]


def encode_block(ids: np.ndarray) -> bytes:
    """The block of at most ``BLOCK`` ids."""
    n = len(ids)
    if not n:
        head = np.zeros(5, dtype="<u4").tobytes()
        return MAGIC + head + zlib.crc32(head).to_bytes(4, "little")
    lanes, steps = _layout(n)
    alphabet = int(ids.max()) + 1
    grid = np.zeros(lanes * steps, dtype=np.int64)
    grid[:n] = ids
    grid = grid.reshape(lanes, steps).T.copy()
    model = Mixer(alphabet, lanes)
    low, span = np.zeros(lanes, dtype=np.uint64), np.full(lanes, 2**64 - 1, dtype=np.uint64)
    room = 3 * steps + 5
    words, begin = np.zeros(lanes * room, dtype=np.uint16), np.arange(lanes) * room
    at = begin.copy()  # the next word of each lane
    for step, k in enumerate(_active(n, lanes, steps)):
        model.look(k)
        x = grid[step, :k]
        w0, w1 = model.w0, model.w1
        zone = (model.c1 == x) & (w1 > 0)
        zone = zone.astype(np.int64)
        zone[(model.c2 == x) & (model.k2 > 0)] = 2
        start, width = w0 * model.starts[x], w0 * model.share[x]
        hit = np.flatnonzero(zone)
        two, low0, low1 = zone[hit] == 2, w0[hit], w1[hit]
        start[hit] = (low0 + two * low1) << ZERO
        width[hit] = np.where(two, (1 << WEIGHT) - low0 - low1, low1) << ZERO
        unit = span[:k] >> np.uint64(BOTH)
        add = unit * start.astype(np.uint64)
        now = low[:k] + add
        carry = np.flatnonzero(now < add)
        if len(carry):
            back = at[carry] - 1
            while len(back):
                words[back] += 1
                back = back[words[back] == 0] - 1
        low[:k] = now
        span[:k] = unit * width.astype(np.uint64)
        # a word is put down in every lane, but only those that are short of range move on
        short = span[:k] < LOW_RANGE
        shift = short.astype(np.uint64) << FOUR
        words[at[:k]] = (low[:k] >> TOP_WORD).astype(np.uint16)
        at[:k] += short
        low[:k] <<= shift
        span[:k] <<= shift
        still = np.flatnonzero(span[:k] < LOW_RANGE)
        while len(still):
            words[at[still]] = (low[still] >> TOP_WORD).astype(np.uint16)
            at[still] += 1
            low[still] <<= SHIFT
            span[still] <<= SHIFT
            still = still[span[still] < LOW_RANGE]
        model.learn(x, zone)
    for shift in (48, 32, 16, 0):
        words[at] = ((low >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
        at += 1
    used = at - begin
    kept = np.arange(room) < used[:, None]
    body = used.astype("<u4").tobytes() + words.reshape(lanes, room)[kept].astype("<u2").tobytes()
    head = np.array([n, lanes, steps, alphabet, zlib.crc32(ids.astype("<u4").tobytes())], dtype="<u4").tobytes()
    return b"".join([MAGIC, head, zlib.crc32(body, zlib.crc32(head)).to_bytes(4, "little"), body])


def decode_block(data: bytes) -> np.ndarray:
    """The ids of a block; :class:`CorruptBlock` if its bytes were changed or cut."""
    if data[:4] != MAGIC or len(data) < 28:
        raise CorruptBlock("no block here")
    n, lanes, steps, alphabet, crc_ids, crc_body = map(int, np.frombuffer(data, "<u4", 6, 4))
    body = data[28:]
    if zlib.crc32(body, zlib.crc32(data[4:24])) != crc_body:
        raise CorruptBlock("checksum of the block does not fit")
    if not n:
        return np.zeros(0, dtype=np.int64)
    used = np.frombuffer(body, "<u4", lanes).astype(np.int64)
    words = np.concatenate([np.frombuffer(body, "<u2", offset=4 * lanes), np.zeros(8, dtype="<u2")]).astype(np.uint64)
    at, last = np.concatenate([[0], np.cumsum(used)[:-1]]), len(words) - 1
    code = np.zeros(lanes, dtype=np.uint64)
    for _ in range(4):
        code = code << SHIFT | words[at]
        at += 1
    span = np.full(lanes, 2**64 - 1, dtype=np.uint64)
    model = Mixer(alphabet, lanes, decodes=True)
    grid = np.zeros((steps, lanes), dtype=np.int64)
    for step, k in enumerate(_active(n, lanes, steps)):
        model.look(k)
        w0, w1 = model.w0, model.w1
        unit = span[:k] >> np.uint64(BOTH)
        place = (code[:k] // unit).astype(np.int64)
        zone1 = w0 << ZERO
        zone2 = zone1 + (w1 << ZERO)
        zone = (place >= zone1).astype(np.int64) + (place >= zone2)
        literal = model.at[np.minimum(place // w0, len(model.at) - 1)]
        x = np.where(zone == 2, model.c2, np.where(zone == 1, model.c1, literal))
        start, width = w0 * model.starts[x], w0 * model.share[x]
        hit = np.flatnonzero(zone)
        two, low1, low2 = zone[hit] == 2, zone1[hit], zone2[hit]
        start[hit] = np.where(two, low2, low1)
        width[hit] = np.where(two, (1 << BOTH) - low2, low2 - low1)
        code[:k] -= unit * start.astype(np.uint64)
        span[:k] = unit * width.astype(np.uint64)
        short = (span[:k] < LOW_RANGE).astype(np.uint64)
        shift = short << FOUR
        code[:k] = code[:k] << shift | words[np.minimum(at[:k], last)] * short
        at[:k] += short.astype(np.int64)
        span[:k] <<= shift
        still = np.flatnonzero(span[:k] < LOW_RANGE)
        while len(still):
            code[still] = code[still] << SHIFT | words[np.minimum(at[still], last)]
            at[still] += 1
            span[still] <<= SHIFT
            still = still[span[still] < LOW_RANGE]
        grid[step, :k] = x
        model.learn(x, zone)
    ids = grid.T.reshape(-1)[:n]
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc_ids:
        raise CorruptBlock("checksum of the ids does not fit")
    return ids
