"""Words of whole batches of texts as 64-bit digests, computed over byte arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of text that are handled at a time, if one text isn't longer.
CHUNK = 1 << 20

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15
#: Bytes between words: ASCII white space.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse, modulo 2 ** 64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK + 1)
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]), dtype=np.uint64) for b in (BASE, pow(BASE, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit finalizer."""
    x = x + np.uint64(salt * 0xD1B54A32D192ED03 % (1 << 64))
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def chunks(texts: list[str | None], size: int = CHUNK) -> Iterator[list[bytes]]:
    """The texts in UTF-8 with A-Z lower-cased, in runs of about size bytes; null texts are empty."""
    some, weight = [], 0
    for text in texts:
        some.append((text or "").encode("utf-8", "surrogatepass").lower())
        weight += len(some[-1]) + 1
        if weight >= size:
            yield some
            some, weight = [], 0
    if some:
        yield some


def runs(texts: list[str | None], size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """First place and end of runs of texts of about size characters."""
    first = weight = 0
    for k, text in enumerate(texts):
        weight += len(text or "")
        if weight >= size:
            yield first, k + 1
            first, weight = k + 1, 0
    if first < len(texts):
        yield first, len(texts)


def words(texts: list[bytes], between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the words between the given bytes, and where each text's begin (one more at the end)."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    blank = between[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]])))
    start, stop = edge[0::2], edge[1::2]
    power, inverse = _powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * power[: len(data)], dtype=np.uint64)])
    ends = np.cumsum([len(t) + 1 for t in texts])
    return mixed((sums[stop] - sums[start]) * inverse[start]), np.searchsorted(start, np.concatenate([[0], ends]))
