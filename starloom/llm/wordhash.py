"""Hashes of words, word starts and word sequences for whole batches of texts at once.

A word's hash is a polynomial in a fixed odd base over a random 64-bit value per byte, modulo 2**64.
One running sum over the bytes of a batch gives the hash of any stretch of it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
UNBASE = np.uint64(pow(int(BASE), -1, 2**64))
BYTE = np.random.default_rng(7).integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, kept for the largest n so far."""
    size = next(iter(_powers), 0)
    if n >= size:
        size = max(n + 1, 1 << 20)
        tables = []
        for base in (BASE, UNBASE):
            powers = np.full(size, base, np.uint64)
            powers[0] = 1
            tables.append(np.multiply.accumulate(powers))
        _powers.clear()
        _powers[size] = (tables[0], tables[1])
    return _powers[size]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits (one-to-one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of a batch: byte places, hashes, and per document the range of its words."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # document i has words first[i] .. first[i + 1]
    _sums: np.ndarray
    _unpower: np.ndarray

    def hashes(self, length: np.ndarray | None = None) -> np.ndarray:
        """Of whole words, or of their first ``length`` bytes."""
        end = self.end if length is None else self.start + length
        size = (end - self.start).astype(np.uint64)
        return mix((self._sums[end] - self._sums[self.start]) * self._unpower[self.start]
                   + size * np.uint64(0xD6E8FEB86659FD93))

    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def separators(characters: str) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(characters.encode())] = True
    return mask


WHITE = separators(" \t\n\x0b\f\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = WHITE,
          case: np.ndarray = LOWER) -> Words:
    """Words split at the given bytes, of texts lower-cased (A-Z) unless ``case`` says otherwise."""
    inside = ~separator[data]
    edge = np.empty(len(data), bool)
    edge[:1] = True
    edge[1:] = ~inside[:-1]
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True
    start = np.flatnonzero(inside & edge)
    edge[-1:] = True
    edge[:-1] = ~inside[1:]
    last = offsets[1:] - 1
    edge[last[last >= 0]] = True
    end = np.flatnonzero(inside & edge) + 1
    power, unpower = _power_table(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[case[data]] * power[:len(data)], out=sums[1:])
    return Words(start, end, np.searchsorted(start, offsets), sums, unpower)


def shingles(found: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all runs of ``width`` words, per document the range of its runs).

    A document of fewer words has one run, all its words; one without words has none.
    """
    hashes, counts = found.hashes(), np.diff(found.first)
    power = _power_table(max(len(hashes), width))[0]
    n_runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.zeros(len(n_runs) + 1, np.int64)
    np.cumsum(n_runs, out=first[1:])
    document = np.repeat(np.arange(len(n_runs)), n_runs)
    at = found.first[document] + np.arange(first[-1]) - first[document]
    long = counts[document] >= width
    out = np.zeros(first[-1], np.uint64)
    for k in range(width):
        inside = at + k < found.first[document + 1]
        out[inside] += hashes[(at + k)[inside]] * power[k + 1]
    size = np.where(long, width, counts[document]).astype(np.uint64)
    return mix(out + size * np.uint64(0xA0761D6478BD642F)), first


def sequence_digests(found: Words) -> np.ndarray:
    """Two 64-bit hashes of each document's word sequence (zeros without words)."""
    hashes, counts = found.hashes(), np.diff(found.first)
    power = _power_table(len(hashes))[0]
    place = np.arange(len(hashes)) - np.repeat(found.first[:-1], counts)
    out = np.zeros((len(counts), 2), np.uint64)
    for k, salt in enumerate((np.uint64(0), np.uint64(0x2545F4914F6CDD1D))):
        terms = mix(hashes + salt) * power[place]
        sums = np.zeros(len(terms) + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        out[:, k] = sums[found.first[1:]] - sums[found.first[:-1]]
    return out
