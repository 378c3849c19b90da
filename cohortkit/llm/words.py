"""Vectorised words of many texts at once (numpy over one UTF-8 buffer).

Words are runs without ASCII white space (space and \\t..\\r). A word is known
by a 64-bit hash of its bytes: a polynomial prefix hash modulo 2^64, finished
with a mixing step, so equal words of any texts and batches agree.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64's published constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: np.uint64, n: int, name: str) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16) + 1, base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


@dataclass
class Words:
    """Words of several texts; ``doc`` numbers the texts, ``first`` is each text's first word."""

    buf: np.ndarray          # bytes of all texts, a newline between two
    text_start: np.ndarray   # per text: its first byte
    text_end: np.ndarray
    start: np.ndarray        # per word: its first byte, the byte after it, its text, its hash
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    first: np.ndarray        # per text (and one past the last): index of its first word


def find_words(texts: list[str], lower_ascii: bool = False) -> Words:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    if lower_ascii:
        raw = [r.lower() for r in raw]      # bytes.lower changes A-Z only
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    buf = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    text_start = np.concatenate(([0], np.cumsum(sizes + 1)[:-1])).astype(np.int64)
    space = SPACE[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]     # the buffer ends in white space, so edges come in pairs
    doc = np.searchsorted(text_start, start, side="right") - 1
    grown = (buf.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(buf), "up")
    upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(grown, dtype=np.uint64)))
    h = (upto[end] - upto[start]) * _power(_INV, len(buf), "down")[start]
    h = mix(h ^ ((end - start).astype(np.uint64) << np.uint64(48)))
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    return Words(buf, text_start, text_start + sizes, start, end, doc, h, first)


def shingle_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text of each n-word shingle, its hash) in order; texts with fewer words give none."""
    if len(words.hash) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    m = len(words.hash) - n + 1
    mixed = np.zeros(m, np.uint64)
    for k in range(n):
        mixed = mix(mixed * np.uint64(0xD6E8FEB86659FD93) + words.hash[k:k + m])
    inside = words.doc[:m] == words.doc[n - 1:]
    return words.doc[:m][inside], mixed[inside]
