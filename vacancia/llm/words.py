"""64-bit hashes of the words of many texts at once."""

from __future__ import annotations

import numpy as np

#: Bytes between words: white space alone, or all ASCII but letters and digits.
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
MARKS = ~np.array([chr(b).isalnum() and b < 128 or b >= 128 for b in range(256)])
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: A random 64-bit number for each byte, and the odd number whose powers tell places in a word apart.
_RANDOM = np.random.default_rng(20240101)
BYTE_VALUE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
GROUP_BYTES = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_hashes(bodies: list[bytes], between: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word with A-Z lower-cased, words of each text); `between` marks separators."""
    data = np.frombuffer(b"\n".join(bodies).translate(LOWER) + b"\n", np.uint8)
    inside = ~between[data]
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    text_ends = np.cumsum(np.fromiter(map(len, bodies), np.int64, len(bodies)) + 1)
    per_text = np.diff(np.searchsorted(begins, text_ends), prepend=0)
    if not len(begins):
        return np.zeros(0, np.uint64), per_text
    lengths = ends - begins
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    powers = np.cumprod(np.full(int(lengths.max()), BASE, np.uint64))
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    return mix(np.add.reduceat(BYTE_VALUE[data[inside]] * powers[place], first)), per_text


def groups(bodies: list[bytes]):
    """The texts in groups of bounded length, so that arrays stay small; a longer text is alone."""
    group, size = [], 0
    for body in bodies:
        if group and size + len(body) > GROUP_BYTES:
            yield group
            group, size = [], 0
        group.append(body)
        size += len(body)
    if group:
        yield group
