"""Word n-grams of texts as 64-bit hashes, and MinHash signatures of their sets."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_RANDOM = np.random.default_rng(2024)
_FACTORS = _RANDOM.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

# Words are hashed many at a time: a word's hash is the sum of its bytes' random numbers times powers
# of an odd number, taken from running sums over the whole block.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_LETTER = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LETTER[65:91] = _LETTER[97:123]  # A to Z count as a to z
_LETTER[_SPACE] = 0
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_BLOCK = 1 << 20
_LONG = 256  # longer words are hashed one by one


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, by doubling."""
    out = []
    for base in (_BASE, _INVERSE):
        powers = np.ones(_BLOCK + 1, dtype=np.uint64)
        filled = 1
        while filled <= _BLOCK:
            step = np.uint64(pow(base, filled, 2**64))
            n = min(filled, _BLOCK + 1 - filled)
            powers[filled : filled + n] = powers[:n] * step
            filled += n
        out.append(powers)
    return out[0], out[1]


def _hash_block(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the words of a block, which has at most _BLOCK bytes and ends at a word's end."""
    powers, inverses = _powers()
    buffer = np.frombuffer(data, dtype=np.uint8)
    space = np.concatenate(([True], _SPACE[buffer], [True]))
    starts = np.flatnonzero(space[:-1] & ~space[1:])
    ends = np.flatnonzero(~space[:-1] & space[1:])
    sums = np.zeros(len(buffer) + 1, dtype=np.uint64)
    np.cumsum(_LETTER[buffer] * powers[: len(buffer)], out=sums[1:])
    sizes = (ends - starts).astype(np.uint64)
    hashes = mixed((sums[ends] - sums[starts]) * inverses[starts] + sizes * _FACTORS[63])
    for i in np.flatnonzero(sizes > _LONG):
        hashes[i] = _hash_long(data[starts[i] : ends[i]])
    return starts, hashes


def _hash_long(word: bytes) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(word.lower()))


def _blocks(data: bytes):
    """(offset, block) that cut `data` at white space. A block over _BLOCK bytes is a single word."""
    at = 0
    while len(data) - at > _BLOCK:
        cut = max(data.rfind(c, at, at + _BLOCK) for c in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r"))
        if cut <= at:  # a very long word
            found = [data.find(c, at + 1) for c in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")]
            cut = min((f for f in found if f > 0), default=len(data))
        yield at, data[at:cut]
        at = cut
    yield at, data[at:]


def hash_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts one after the other, and the number of words of each text.

    Words stand between ASCII white space; A to Z are as a to z. NULL is as the empty text.
    """
    encoded = [(t or "").encode() for t in texts]
    data = b" ".join(encoded)
    ends = np.cumsum([len(e) + 1 for e in encoded])
    found = []
    for offset, block in _blocks(data):
        if len(block) <= _BLOCK:
            starts, hashes = _hash_block(block)
            found.append((starts + offset, hashes))
        else:
            word = block.strip(b" \t\n\v\f\r")
            found.append((np.array([offset + block.index(word)]), np.array([_hash_long(word)])))
    starts, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
    return hashes, np.diff(np.searchsorted(starts, ends), prepend=0)


def text_groups(
    column: pa.Array, size: int = _BLOCK, lists: bool = True
) -> Iterator[tuple[slice, list[str | None]]]:
    """Runs of a column's texts that hold about `size` bytes, so that few are in Python at a time.

    Without `lists` the texts themselves are left out.
    """
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    first = 0
    while first < len(column):
        start = ends[first] - sizes[first]
        stop = max(first, int(np.searchsorted(ends, start + size))) + 1
        run = slice(first, min(stop, len(column)))
        yield run, column.slice(run.start, run.stop - run.start).to_pylist() if lists else []
        first = run.stop


def words_of(text: str) -> list[bytes]:
    """The words themselves."""
    return text.encode().lower().split()


def shingles(words: np.ndarray, n: int = 5) -> np.ndarray:
    """The set of n-grams of word hashes, sorted. Fewer than n words make one n-gram."""
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    n = min(n, len(words))
    total = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        total += mixed(words[i : len(words) - n + 1 + i] * _FACTORS[i]) * _FACTORS[i + 1]
    return np.unique(mixed(total))


def bands_for(threshold: float, recall: float, most_bands: int = 16) -> tuple[int, int]:
    """(bands, rows): the most rows per band for which few enough bands find a pair at `threshold`
    with at least the chance `recall`. More rows mean fewer pairs that are looked at in vain."""
    best = None
    for rows in range(1, 33):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands <= most_bands:
            best = (bands, rows)
    if best is None:
        raise ValueError("no number of bands reaches this recall")
    return best


class MinHash:
    """Band hashes of sets of 64-bit numbers."""

    def __init__(self, bands: int, rows: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.factors = rng.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.terms = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)

    def signature(self, grams: np.ndarray) -> np.ndarray:
        least = np.full(len(self.factors), np.iinfo(np.uint64).max, dtype=np.uint64)
        for start in range(0, len(grams), 8192):
            block = grams[start : start + 8192, None] * self.factors + self.terms
            np.minimum(least, block.min(axis=0), out=least)
        return least

    def band_hashes(self, grams: np.ndarray) -> np.ndarray:
        parts = self.signature(grams).reshape(self.bands, self.rows)
        total = np.zeros(self.bands, dtype=np.uint64)
        for i in range(self.rows):
            total = mixed(total + parts[:, i] * _FACTORS[i])
        return total.view(np.int64)
