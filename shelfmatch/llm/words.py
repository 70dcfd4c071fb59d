"""Words and windows of words as 64-bit hashes, for whole Arrow columns at once.

A word is a run of bytes other than ASCII white space, as in ``[^\\x20\\x09-\\x0D]+``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_S29, _S32 = np.uint64(29), np.uint64(32)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _S32)) * _C
    h = (h ^ (h >> _S29)) * _B
    return h ^ (h >> _S32)


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a followed by b; the order counts."""
    return mix(a * _A + (b ^ (b >> _S29)) * _B)


def flat(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the place where each begins and ends. Null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], texts.type)
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = texts.buffers()
    places = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[places[0] : places[-1]], places - places[0]


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts
    start: np.ndarray  # of each word
    length: np.ndarray
    first: np.ndarray  # of each text, the index of its first word; one more at the end

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """Eight bytes a step, so that almost all words take one or two."""
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(self.data) + 1, "<u8", padded, strides=(1,))
        h = mix(self.length.astype(np.uint64) * _A)
        todo, at, rest = np.arange(len(h)), self.start, self.length
        while todo.size:
            h[todo] = mix((h[todo] + _A) ^ (eight[at] & _MASK[np.minimum(rest, 8)]))
            more = rest > 8
            todo, at, rest = todo[more], at[more] + 8, rest[more] - 8
        return h

    def fits(self, length: int) -> np.ndarray:
        """For each word, whether a window of that many words of its text begins there."""
        n = int(self.first[-1])
        return np.arange(n) + length <= np.repeat(self.first[1:], np.diff(self.first))

    def kept(self, keep: np.ndarray) -> pa.Array:
        """Of each text the words marked, joined by one space."""
        words = np.flatnonzero(keep)
        length = self.length[words]
        to = np.zeros(len(words) + 1, np.int64)
        np.cumsum(length + 1, out=to[1:])
        out = np.full(to[-1], 32, np.uint8)
        move = np.repeat(to[:-1] - self.start[words], length)
        source = np.arange(int(length.sum())) + np.repeat(
            self.start[words] - (np.cumsum(length) - length), length
        )
        out[source + move] = self.data[source]
        bounds = to[np.searchsorted(words, self.first)]
        empty = np.diff(bounds) == 0
        ends = np.where(empty, bounds[1:], bounds[1:] - 1)
        whole = out.tobytes()
        return pa.array(
            [whole[a:b].decode() for a, b in zip(bounds[:-1].tolist(), ends.tolist())], pa.string()
        )


def split_words(texts: pa.Array | pa.ChunkedArray, lower: bool = False) -> Words:
    """``lower`` lower-cases A to Z."""
    data, places = flat(texts)
    if lower:
        data = LOWER[data]
    inside = ~_SPACE[data]
    joined = np.zeros(len(data) + 1, bool)  # whether the byte before belongs to the same word
    joined[1:-1] = inside[:-1] & inside[1:] if len(data) else False
    joined[places] = False
    start = np.flatnonzero(inside & ~joined[:-1])
    end = np.flatnonzero(inside & ~joined[1:]) + 1
    return Words(data, start, end - start, np.searchsorted(start, places))


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each place on, by doubling: two windows of half the length.

    Windows over the end of a text are among them; ``Words.fits`` tells which are not.
    """
    if length == 1:
        return hashes
    half = (length + 1) // 2
    part = windows(hashes, half)
    n = max(0, len(hashes) - length + 1)
    return combine(part[:n], part[length - half : length - half + n])
