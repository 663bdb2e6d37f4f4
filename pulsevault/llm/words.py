"""Vectorised word hashing over a batch of texts (numpy, used inside tasks)."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_APART = _SPACE.copy()
_APART[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PLACES = 4096


@lru_cache(maxsize=1)
def _place_weights() -> np.ndarray:
    return np.random.default_rng(20240601).integers(0, 2**63, _PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser for 64-bit hashes."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, a line feed after each, and where each starts (one entry more: the end)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return data, np.concatenate(([0], np.cumsum(sizes)))


def word_hashes(data: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of every word (run of anything but ASCII white space) of the joined bytes; equal words
    have equal hashes."""
    return _hashed(_LOWER[data] if lower else data, ~_SPACE[data])


def token_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of every run of anything but ASCII white space and punctuation, A-Z lower-cased."""
    filled = ~_APART[data]
    hashes, starts = _hashed(_LOWER[data], filled)
    return hashes, starts, np.flatnonzero(filled & np.concatenate((~filled[1:], [True]))) + 1


def _hashed(data: np.ndarray, filled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(filled & np.concatenate(([True], ~filled[:-1])))
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    body = data[starts[0]:]
    place = np.arange(len(body), dtype=np.int32)
    first = starts - starts[0]
    place -= np.repeat(first, np.diff(np.append(first, len(body)))).astype(np.int32)
    far = place // _PLACES
    value = (body.astype(np.uint64) + np.uint64(1)) * _place_weights()[place % _PLACES]
    if far.any():
        value *= (far.astype(np.uint64) * np.uint64(2) + np.uint64(1))
    value[~filled[starts[0]:]] = 0
    return mixed(np.add.reduceat(value, first)), starts
