"""Words of batches of texts as codes into their distinct words; exact, by Arrow's dictionary encoding."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa


class Words(NamedTuple):
    """codes: of each word, into distinct. start: its first byte. first: each text's first word, and one more at the end."""

    codes: np.ndarray
    distinct: list[bytes]
    start: np.ndarray
    first: np.ndarray
    data: np.ndarray


def byte_class(ranges: list[tuple[int, int]]) -> np.ndarray:
    """Which of the 256 bytes lie in the given ranges, ends included."""
    found = np.zeros(256, bool)
    for low, high in ranges:
        found[low : high + 1] = True
    return found


def coded(texts: list[bytes], between: np.ndarray, cut: np.ndarray | None = None) -> Words:
    """The words between bytes of the class between, which has the line feed. No word goes on in the next text.

    cut: 256 x 256, the pairs of neighbouring bytes between which a word ends and the next begins.
    """
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    inside = ~between[data]
    begins = inside.copy()
    if len(data):
        ahead = ~inside[:-1]
        begins[1:] &= ahead if cut is None else ahead | cut[data[:-1], data[1:]]
    start = np.flatnonzero(begins)
    place = np.cumsum(inside)
    offsets = np.concatenate([place[start] - 1, place[-1:] if len(place) else [0]]).astype(np.int64)
    letters = np.ascontiguousarray(data[inside])
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    found = words.dictionary_encode()
    ends = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return Words(found.indices.to_numpy().astype(np.int64), found.dictionary.to_pylist(), start, np.searchsorted(start, ends), data)
