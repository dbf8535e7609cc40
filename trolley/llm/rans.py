"""Static range asymmetric numeral system over whole arrays of symbols.

LANES coders share a segment's words: symbol i belongs to lane i modulo LANES, so a step of the coder works on LANES
symbols at once. States are 64-bit, renormalised by 32-bit words. Segments are coded independently; a segment's
states are its checkpoint, so any segment can be decoded on its own.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np

SCALE = 20  # frequencies add up to 2**SCALE
LANES = 512
SEGMENT = 1 << 17
LOW = np.uint64(1 << 31)  # states stay at or above
WORD = np.uint64(32)
BITS = np.uint64(SCALE)
MASK = np.uint64((1 << SCALE) - 1)


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to add up to 2**SCALE; every symbol that occurs keeps at least 1."""
    present = np.flatnonzero(counts)
    assert len(present) <= 1 << (SCALE - 1), "too many different symbols"
    scaled = np.zeros(len(counts), np.int64)
    if not len(present):
        return scaled
    room, total = (1 << SCALE) - len(present), int(counts.sum())
    scaled[present] = [1 + int(c) * room // total for c in counts[present]]
    scaled[counts.argmax()] += (1 << SCALE) - scaled.sum()
    return scaled


class Coder:
    def __init__(self, scaled: np.ndarray):
        self.frequency = scaled.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(scaled)[:-1]]).astype(np.uint64)
        self._symbol: np.ndarray | None = None

    @property
    def symbol(self) -> np.ndarray:
        """The symbol of each of the 2**SCALE slots."""
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(len(self.frequency), dtype=np.uint32), self.frequency.astype(np.int64))
        return self._symbol

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """States (the checkpoint) and words of one segment."""
        x = np.full(LANES, LOW)
        words = []
        for t in range((len(ids) - 1) // LANES, -1, -1):
            own = ids[t * LANES : (t + 1) * LANES]
            f, c, lanes = self.frequency[own], self.start[own], x[: len(own)]
            full = lanes >= f << np.uint64(63 - SCALE)
            if full.any():
                words.append(lanes[full].astype("<u4"))  # keeps the low 32 bits
                lanes[full] >>= WORD
            whole, rest = np.divmod(lanes, f)
            lanes[:] = (whole << BITS) + rest + c
        return x.astype("<u8").tobytes(), b"".join(w.tobytes() for w in reversed(words))

    def decode(self, n: int, states: bytes, packed: bytes) -> np.ndarray:
        x = np.frombuffer(states, "<u8").astype(np.uint64)
        words = np.frombuffer(packed, "<u4").astype(np.uint64)
        out = np.empty(n, np.uint32)
        at = 0
        for begin in range(0, n, LANES):
            lanes = x[: min(LANES, n - begin)]
            slot = lanes & MASK
            own = self.symbol[slot]
            out[begin : begin + len(own)] = own
            lanes[:] = self.frequency[own] * (lanes >> BITS) + slot - self.start[own]
            low = lanes < LOW
            k = int(np.count_nonzero(low))
            if k:
                lanes[low] = (lanes[low] << WORD) | words[at : at + k]
                at += k
        if at != len(words) or (x != LOW).any():
            raise ValueError("the segment does not decode to its end")
        return out

    def encode_segments(self, ids: np.ndarray) -> list[tuple[int, bytes, bytes, int]]:
        """``(symbols, states, words, crc32 of both)`` of each segment."""
        parts = [ids[k : k + SEGMENT] for k in range(0, len(ids), SEGMENT)]
        coded = [(len(part), *self.encode(part)) for part in parts]
        return [(n, states, words, crc32(words, crc32(states))) for n, states, words in coded]

    def decode_segment(self, n: int, states: bytes, words: bytes, checksum: int) -> np.ndarray:
        if crc32(words, crc32(states)) != checksum:
            raise ValueError("a segment's checksum is wrong")
        return self.decode(n, states, words)
