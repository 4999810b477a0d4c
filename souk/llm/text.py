"""Whole texts as numpy arrays: bytes, words, shingles and window fingerprints.

A task handles the texts of an Arrow batch in slices of about a megabyte, so that its
memory does not depend on how many rows a batch holds. Fingerprints are two polynomials over
the bytes, modulo a prime of 31 bits and with bases of their own, read off prefix sums: any
substring costs two subtractions and products. Equal strings always have equal fingerprints;
different ones collide with a chance of about 2**-62 a pair, and no structure of theirs
raises that, as it does where the modulus is a power of two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SHINGLE_WORDS = 5

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Texts:
    """Some texts' bytes end to end; text ``i`` is ``data[bounds[i]:bounds[i + 1]]``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def blob(self, i: int) -> bytes:
        return self.data[self.bounds[i]:self.bounds[i + 1]].tobytes()


def as_texts(column: pa.Array) -> Texts:
    """The UTF-8 bytes of a string column; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or len(bounds) == 0:
        return Texts(np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64))
    return Texts(np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0])


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """The batches cut into runs of rows with about ``limit`` bytes of ``column`` each."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        texts = as_texts(batch.column(column))
        cuts = np.searchsorted(texts.bounds, np.arange(limit, texts.bounds[-1], limit)).tolist()
        edges = sorted({0, *cuts, batch.num_rows})
        for low, high in zip(edges, edges[1:]):
            bounds = texts.bounds[low:high + 1]
            yield batch.slice(low, high - low), Texts(
                texts.data[bounds[0]:bounds[-1]], bounds - bounds[0]
            )


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finisher of splitmix64)."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


class Fingerprints:
    """Fingerprints of any substrings of ``data``; ``seed`` picks the function."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        self._parts = []
        for part in (0, 1):
            table, powers, inverses = _polynomial(2 * seed + part, len(data))
            sums = np.zeros(len(data) + 1, np.uint32)
            # Less than 2**31 each: 2**33 of them don't overflow.
            total = np.cumsum(_reduced(table[data] * powers[:len(data)].astype(np.uint64)))
            sums[1:] = _reduced(total)
            self._parts.append((sums, inverses))

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self._joined([
            _between(sums[starts], sums[ends], inverses[starts]) for sums, inverses in self._parts])

    def windows(self, size: int) -> np.ndarray:
        """Of every substring of ``size`` bytes, by its start."""
        count = max(0, len(self._parts[0][0]) - size)
        return self._joined([
            _between(sums[:count], sums[size:], inverses[:count])
            for sums, inverses in self._parts])

    @staticmethod
    def _joined(parts: list[np.ndarray]) -> np.ndarray:
        high, low = parts
        return mixed(high << np.uint64(32) | low)


_PRIME = np.uint64((1 << 31) - 1)
_POLYNOMIALS: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _reduced(values: np.ndarray) -> np.ndarray:
    """``values`` modulo the prime, a power of two less one: its digits add up."""
    for _ in range(2):
        more = values >> np.uint64(31)
        values = values & _PRIME
        values += more
    np.subtract(values, _PRIME, out=values, where=values >= _PRIME)
    return values


def _between(low: np.ndarray, high: np.ndarray, inverses: np.ndarray) -> np.ndarray:
    """What prefix sums ``high`` have beyond ``low``, moved to the start."""
    apart = high.astype(np.uint64) + (_PRIME - low.astype(np.uint64))
    return _reduced(_reduced(apart) * inverses.astype(np.uint64))


def _polynomial(number: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of bytes, powers of the base and their inverses; the longest asked is kept."""
    if number in _POLYNOMIALS and len(_POLYNOMIALS[number][1]) >= size:
        return _POLYNOMIALS[number]
    prime = int(_PRIME)
    draw = np.random.default_rng(1_000_003 + number)
    table = draw.integers(1, prime, 256, dtype=np.uint64)
    base = int(draw.integers(1 << 29, prime - 1))
    size = 1 << max(12, size.bit_length())
    out = []
    for factor in (base, pow(base, -1, prime)):
        powers = np.ones(size, np.uint32)
        filled = 1
        while filled < size:  # doubling keeps it vectorised
            step = np.uint64(pow(factor, filled, prime))
            powers[filled:2 * filled] = _reduced(powers[:filled].astype(np.uint64) * step)
            filled *= 2
        out.append(powers)
    _POLYNOMIALS[number] = table, out[0], out[1]
    return _POLYNOMIALS[number]


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of texts with A-Z in lower case, as hashes.

    The words of text ``i`` are ``hashes[bounds[i]:bounds[i + 1]]``.
    """

    def __init__(self, texts: Texts):
        data = _LOWER[texts.data]
        inside = np.zeros(len(data) + 1, bool)
        inside[:-1] = ~_SPACES[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[texts.bounds] = True
        before = np.concatenate(([False], inside[:-1]))
        starts = np.flatnonzero(inside & (cut | ~before))
        ends = np.flatnonzero(before & (cut | ~inside))
        self.hashes = Fingerprints(data).of(starts, ends) + (ends - starts).astype(np.uint64)
        self.bounds = np.searchsorted(starts, texts.bounds)

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``size`` consecutive words of a text, and the text of each."""
        count = max(0, len(self.hashes) - size + 1)
        owner = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        total = np.full(count, size, np.uint64)
        for k in range(size):
            total += self.hashes[k:k + count] * np.uint64(_WORD_FACTORS[k])
        whole = owner[:count] == owner[size - 1:]
        return mixed(total[whole]), owner[:count][whole]

    def shingles(self, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
        """Shingle hashes and the text of each, in text order, repeats included.

        A text with fewer than ``size`` words, but some, has its whole sequence as one.
        """
        found = [self.runs(size)]
        lengths = np.diff(self.bounds)
        for short in range(1, size):
            if (lengths == short).any():
                hashes, owner = self.runs(short)
                whole = lengths[owner] == short
                found.append((hashes[whole], owner[whole]))
        hashes, owner = (np.concatenate(parts) for parts in zip(*found))
        if len(found) > 1:
            order = np.argsort(owner, kind="stable")
            hashes, owner = hashes[order], owner[order]
        return hashes, owner

    def sets(self, size: int = SHINGLE_WORDS) -> list[np.ndarray]:
        """Each text's distinct shingles, ascending by hash."""
        hashes, owner = self.shingles(size)
        edges = np.searchsorted(owner, np.arange(len(self.bounds)))
        return [np.unique(hashes[a:b]) for a, b in zip(edges, edges[1:])]


_WORD_FACTORS = [int(v) | 1 for v in np.random.default_rng(77).integers(1, 1 << 63, 64)]
