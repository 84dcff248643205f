"""Words of many texts at once, as 64-bit hashes in numpy arrays.

A word's hash is a polynomial over its bytes modulo 2^64, taken as a difference
of running sums, so it costs the same few array steps however the bytes fall
into words.  Hashes depend on nothing but the bytes: any task gets the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20260101))
_VALUE = _rng.integers(1, 2**63, 256, dtype=_U) | _U(1)
_BASE = int(_rng.integers(2**62, 2**63)) | 1
_INVERSE = pow(_BASE, -1, 2**64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BLOCK = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.concatenate([np.ones(1, _U), np.full(n - 1, base, _U)]), dtype=_U)


_UP, _DOWN = _powers(_BASE, _BLOCK), _powers(_INVERSE, _BLOCK)
_UP_BLOCK, _DOWN_BLOCK = pow(_BASE, _BLOCK, 2**64), pow(_INVERSE, _BLOCK, 2**64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads a hash over all 64 bits; different stays different."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


@dataclass
class Words:
    """Words of a batch of texts, in order."""

    data: bytes
    start: np.ndarray  # where each word starts and ends in data
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray  # text i has words bounds[i] to bounds[i + 1]


def words_of(texts: list[str | None], lower: bool = False) -> Words:
    """Splits at white space (space, characters 9 to 13); a null text has no words."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = b"\n".join(raw) + b"\n"
    buf = np.frombuffer(data, np.uint8)
    if lower:
        buf = _LOWER[buf]
        data = buf.tobytes()
    edge = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[buf]])))
    start, end = edge[0::2], edge[1::2]
    n = len(buf)
    blocks = -(-n // _BLOCK)
    with np.errstate(over="ignore"):
        sums = _VALUE[buf]
        for b in range(blocks):
            part = sums[b * _BLOCK : (b + 1) * _BLOCK]
            part *= _UP[: len(part)]
            if b:
                part *= _U(pow(_UP_BLOCK, b, 2**64))
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(sums, dtype=_U)])
        down = np.array([pow(_DOWN_BLOCK, b, 2**64) for b in range(blocks)], _U)
        h = (sums[end] - sums[start]) * _DOWN[start & (_BLOCK - 1)]
        h *= down[start >> 16]
        h = mixed(h ^ ((end - start).astype(_U) << _U(40)))
    ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64) if raw else np.zeros(0, np.int64)
    bounds = np.concatenate([[0], np.searchsorted(start, ends)]).astype(np.int64)
    return Words(data, start, end, h, bounds)


def gather(pool: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs pool[at : at + length], one after the other."""
    total = int(length.sum())
    shift = np.repeat(at - (np.cumsum(length) - length), length)
    return pool[shift + np.arange(total)]


def text_runs(texts: list[str | None], chars: int) -> Iterator[list[str | None]]:
    """The texts in runs of about so many characters; a longer text is a run of its own."""
    run: list[str | None] = []
    size = 0
    for t in texts:
        own = len(t or "")
        if run and size + own > chars:
            yield run
            run, size = [], 0
        run.append(t)
        size += own
    if run:
        yield run


def shingle_sets(texts: list[str | None], size: int = 3, chars: int = 1_000_000) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles of lower-cased words.

    A text of fewer words is one shingle; one without words has none.
    """
    return [s for run in text_runs(texts, chars) for s in _shingle_sets(run, size)]


def _shingle_sets(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    w = words_of(texts, lower=True)
    step = _U(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        n = len(w.hash)
        grams = np.zeros(max(0, n - size + 1), _U)
        for k in range(size):
            grams = mixed(grams * step + w.hash[k : n - size + 1 + k])
        for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist()):
            if b - a >= size:
                yield np.unique(grams[a : b - size + 1])
            else:
                short = np.zeros(min(1, b - a), _U)
                for k in range(a, b):
                    short = mixed(short * step + w.hash[k] + _U(b - a))
                yield short
