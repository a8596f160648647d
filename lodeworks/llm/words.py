"""Words of a column of texts as numpy arrays.

A word is a maximal run of characters other than space and the control characters 9 to 13. In UTF-8
these are single bytes, so runs can be found on bytes. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
# Folded words: runs of ASCII letters and digits and of characters beyond ASCII, A to Z in lower case.
_FOLDED_BLANK = np.array([not (chr(b).isalnum() or b > 127) for b in range(256)])
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15
_STEP_BACK = pow(_STEP, -1, 2**64)
_powers: dict[int, np.ndarray] = {}

#: Texts are taken in slices of about this many bytes, so that arrays stay small.
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits (a bijection)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE_BYTES), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts of the slice
    rows: int
    row: np.ndarray  # row of each word
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte behind it
    first: np.ndarray  # index of each row's first word; one more entry than rows

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """64 bits per word, equal for equal words in every process."""
        out = np.empty(len(self.start), np.uint64)
        at = 0
        while at < len(self.start):
            low = self.start[at]
            stop = max(at + 1, int(np.searchsorted(self.end, low + 2 * SLICE_BYTES)))
            high = self.end[stop - 1]
            if high - low > 4 * SLICE_BYTES:  # one word beyond all measure
                out[at] = _hash_long(self.data[low:high])
                at += 1
                continue
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(_BYTE_VALUES[self.data[low:high]] * _power(_STEP, high - low), out=sums[1:])
            s, e = self.start[at:stop] - low, self.end[at:stop] - low
            out[at:stop] = (sums[e] - sums[s]) * _power(_STEP_BACK, high - low + 1)[s]
            at = stop
        return mix(out)

    def grams(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each run of n words within one row, and the index of its first word."""
        m = len(hashes) - n + 1
        if m <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        acc = hashes[:m].copy()
        for k in range(1, n):
            acc *= U64(0xD6E8FEB86659FD93)
            acc += hashes[k : k + m]
        inside = np.flatnonzero(self.row[:m] == self.row[n - 1 :])
        return mix(acc[inside]), inside


def _hash_long(data: np.ndarray) -> np.uint64:
    total, scale = 0, 1
    for at in range(0, len(data), SLICE_BYTES):
        part = data[at : at + SLICE_BYTES]
        total += scale * int((_BYTE_VALUES[part] * _power(_STEP, len(part))).sum(dtype=np.uint64))
        scale = scale * pow(_STEP, len(part), 2**64) % 2**64
    return np.uint64(total % 2**64)


def slices(texts: pa.Array, limit: int = SLICE_BYTES, folded: bool = False, apart: bool = True) -> Iterator[tuple[int, int, Words]]:
    """(first row, row behind the last, their words) for consecutive slices of whole texts.

    ``folded`` leaves out punctuation and the case of ASCII letters, and takes each character of scripts
    without spaces for a word unless ``apart`` is false.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        stop = min(stop, len(texts))
        part, bounds = data[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at]
        yield at, stop, _split(_FOLD[part], bounds, _FOLDED_BLANK, _unspaced(part) if apart else None) if folded else _split(part, bounds, _BLANK)
        at = stop


def _unspaced(data: np.ndarray) -> np.ndarray:
    """First byte of, and byte behind, each character of scripts without spaces: Thai, Lao, Tibetan,
    Myanmar, Khmer, kana and ideographs."""
    lead = np.flatnonzero(data >= 0xE0)
    a, b = data[lead], data[np.minimum(lead + 1, len(data) - 1)]
    own = (a == 0xE0) & (b >= 0xB8) | (a == 0xE1) & ((b <= 0x81) | (b == 0x9E) | (b == 0x9F)) | (a == 0xE2) & (b >= 0xBA)
    own |= (a >= 0xE3) & (a <= 0xE9) | (a == 0xEF) & ((b >= 0xA4) & (b <= 0xAB) | (b == 0xBD) | (b == 0xBE)) | (a == 0xF0) & (b >= 0xA0)
    begin = lead[own]
    return np.unique(np.concatenate([begin, begin + np.where(data[begin] >= 0xF0, 4, 3)]))


def _split(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray, more_cuts: np.ndarray | None = None) -> Words:
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~blank[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = ~inside
    ends[0] = False
    ends[1:] &= inside[:-1]
    # Texts stand back to back: a word ends where its text does, and the next one starts there.
    cuts = offsets[1:-1] if more_cuts is None else np.concatenate([offsets[1:-1], more_cuts])
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    joined = cuts[inside[cuts] & inside[cuts - 1]]
    starts[joined] = True
    ends[joined] = True
    start, end = np.flatnonzero(starts), np.flatnonzero(ends)
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, len(offsets) - 1, row, start, end, first)
