"""Words of many texts at once: bounds and 64-bit hashes as numpy arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
# A-Z as a-z, and the low bytes of a number: none, one ... all eight.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)
# ASCII white space: a word is a run of other bytes.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_P = U64(0x9E3779B97F4A7C15)
_Q = U64(0xD1342543DE82EF95)


class _Powers:
    """Powers of an odd number modulo 2**64 and of its inverse; grown when asked for more."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, U64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, U64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            for name, factor in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, factor, U64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=U64))
        return self.up[:n], self.down[:n]


_word_powers = _Powers(_Q)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@dataclass
class Words:
    """Words of a run of texts.

    ``begin`` and ``end`` are byte positions in ``data``; ``first`` has, for each
    text, the number of its first word, and one entry more; ``doc`` names each
    word's text.
    """

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray
    doc: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def _hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of words, eight bytes at a time.

    Each eight bytes are mixed with their place before they are added up, so no arrangement of equal parts gives
    equal sums, as it would in a polynomial modulo a power of two.
    """
    eights = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    length = end - begin
    hashes = mix(eights[begin] & _LOW_BYTES[np.minimum(length, 8)])
    longer = np.flatnonzero(length > 8)
    if len(longer):
        more = (length[longer] - 1) >> 3
        start = np.cumsum(more) - more
        place = np.arange(more.sum()) - np.repeat(start, more) + 1
        at = np.repeat(begin[longer], more) + 8 * place
        rest = eights[at] & _LOW_BYTES[np.minimum(np.repeat(end[longer], more) - at, 8)]
        hashes[longer] += np.add.reduceat(mix(rest ^ mix(place.astype(U64) * _P)), start)
    return mix(hashes + length.astype(U64) * U64(0xA0761D6478BD642F))


def words(texts: pa.Array, lower: bool = False) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the texts with their hashes; ``lower`` takes A-Z as a-z."""
    texts = texts.cast(pa.binary()).fill_null(b"")
    if texts.offset or texts.buffers()[2] is None:
        texts = pa.array(texts.to_pylist(), pa.binary())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int32, n + 1).astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8, int(offsets[-1])) if raw is not None else np.zeros(0, np.uint8)
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(n + 1, np.int64), none, np.zeros(0, U64))
    solid = ~_SPACE[data]
    edge = np.ones(len(data), bool)
    edge[1:] = ~solid[:-1]
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True
    begin = np.flatnonzero(solid & edge)
    edge[:] = True
    edge[:-1] = ~solid[1:]
    edge[offsets[1:][offsets[1:] > 0] - 1] = True
    end = np.flatnonzero(solid & edge) + 1
    hashes = _hashes(_LOWER[data] if lower else data, begin, end)
    first = np.searchsorted(begin, offsets)
    doc = np.repeat(np.arange(n), np.diff(first))
    return Words(data, begin, end, first, doc, hashes)


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different hashes, ascending, a place of each, and each hash's place among them; only the different ones are sorted."""
    coded = pa.array(hashes).dictionary_encode()
    codes, every = coded.indices.to_numpy(), coded.dictionary.to_numpy()
    seen = np.empty(len(every), np.int64)
    seen[codes] = np.arange(len(codes))
    order = np.argsort(every)
    rank = np.empty(len(every), np.int32)
    rank[order] = np.arange(len(every), dtype=np.int32)
    return every[order], seen[order], rank[codes]


def windows(found: Words, size: int) -> np.ndarray:
    """Hash of ``size`` words from every word on; meaningless where a text ends before.  See ``inside``."""
    n = len(found.hashes)
    up, down = _word_powers(n + size)
    sums = np.zeros(n + size + 1, U64)
    np.cumsum(np.concatenate([found.hashes * up[:n], np.zeros(size, U64)]), out=sums[1:])
    return mix((sums[size : n + size] - sums[:n]) * down[:n] + U64(size))


def inside(found: Words, size: int) -> np.ndarray:
    """True for a word from which ``size`` words of its own text follow."""
    return np.arange(len(found.hashes)) + size <= found.first[1:][found.doc]


def whole(found: Words) -> np.ndarray:
    """A hash of each text's whole word sequence."""
    n = len(found.hashes)
    up, down = _word_powers(n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum(found.hashes * up[:n], out=sums[1:])
    a, b = found.first[:-1], found.first[1:]
    return mix((sums[b] - sums[a]) * down[a] + (b - a).astype(U64) * U64(0xE7037ED1A0B428DB))


def covered(starts: np.ndarray, size: int, total: int) -> np.ndarray:
    """Marks of the ``total`` words that lie in a window of ``size`` words from one of ``starts``."""
    change = np.zeros(total + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + size, total), -1)
    return np.cumsum(change[:-1]) > 0


def planes(values: np.ndarray) -> bytes:
    """64-bit numbers by byte significance: equal high bytes lie together and compress away."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel().astype(U64)
