"""Hashes of words and word shingles of many texts at once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np

#: Arrays of eight bytes per byte of a group should fit a core's cache.
GROUP_BYTES = 250_000
#: Longer words are hashed by BLAKE2: polynomials modulo a power of two let long words of a regular build collide.
LONGEST_WORD = 64
_rng = np.random.default_rng(20240229)
BYTE_CODE = _rng.integers(1, 1 << 63, 256, np.uint64)
# White space is space, tab, line feed, vertical tab, form feed, carriage return; A-Z become a-z.
WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
INSIDE = (~WHITE).astype(np.uint8).tobytes()
BYTE_CODE[WHITE] = 0
BASE = 0x9E3779B97F4A7C15
PLACE = _rng.integers(1, 1 << 63, 5, np.uint64) | np.uint64(1)
#: Codes of two bytes in a row, the first in the lower half of the index.
PAIR_CODE = (BYTE_CODE + BYTE_CODE[:, None] * np.uint64(BASE)).ravel()
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(code: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values; a bijection."""
    code = (code ^ (code >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    code = (code ^ (code >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return code ^ (code >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the square of the base, and of its inverse."""
    if len(_powers[0]) < n:
        for k, base in enumerate((pow(BASE, 2, 1 << 64), pow(BASE, -1, 1 << 64))):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table)
    return _powers


def grouped(texts: Iterable[str]) -> Iterator[list[bytes]]:
    """Texts as bytes, in groups that end once they hold ``GROUP_BYTES``."""
    group: list[bytes] = []
    size = 0
    for text in texts:
        group.append(text.encode("utf-8", "replace"))
        size += len(group[-1])
        if size >= GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def word_hashes(text: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of a text."""
    text = (text.lower() if lower else text) + b" "[: len(text) % 2]
    inside = np.frombuffer(b"\0" + text.translate(INSIDE) + b"\0", np.uint8)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begins, ends = edges[::2], edges[1::2]
    square, inverse = _power_tables(len(text) + 1)
    # White space has code 0, so sums over whole pairs of bytes are those over the word.
    sums = np.zeros(len(text) // 2 + 1, np.uint64)
    np.cumsum(PAIR_CODE.take(np.frombuffer(text, "<u2")) * square[: len(text) // 2], out=sums[1:])
    hashes = mix((sums[(ends + 1) >> 1] - sums[begins >> 1]) * inverse[begins])
    for i in np.flatnonzero(ends - begins > LONGEST_WORD).tolist():
        hashes[i] = int.from_bytes(blake2b(text[begins[i] : ends[i]], digest_size=8).digest(), "little")
    return hashes, begins


def document_words(group: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a group of texts, and where each text's words end."""
    ends = np.cumsum([len(g) + 1 for g in group])
    hashes, begins = word_hashes(b"\n".join(group) + b"\n", lower)
    return hashes, np.searchsorted(begins, ends)


def shingle_sets(texts: Iterable[str], size: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the word shingles of each text; fewer words make one shingle, none make none."""
    for group in grouped(texts):
        hashes, ends = document_words(group)
        windows = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
        for k in range(size):
            windows += hashes[k : k + len(windows)] * PLACE[k]
        windows = mix(windows)
        first = 0
        for last in ends.tolist():
            n = last - first
            if n >= size:
                yield np.unique(windows[first : last - size + 1])
            elif n:
                yield mix((hashes[first:last] * PLACE[:n]).sum(keepdims=True) + np.uint64(n))
            else:
                yield np.zeros(0, np.uint64)
            first = last
