"""Pieces of texts (pre-tokenised words) and a table of their token ids.

A corpus repeats its words, so each distinct word is encoded once per worker
and texts become table lookups: one integer per word, then one vectorised
gather of ids.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

# Characters on which Python's re classes and the tokenizers' \p{L}, \p{N} and \s agree: printable ASCII,
# tab and line ends, Latin letters and marks up to U+024F without the superscript digits and fractions.
UNUSUAL = re.compile("[^\t\n\r -~¡-±´-¸º-»¿-ɏ]")


class PieceTable:
    """Word → token ids, filled by ``encode`` (new words → ids in a row, ids per word); emptied beyond ``limit`` bytes.

    The bytes are those of the words, their ids and the dictionary's entries.
    """

    #: Bytes of a dictionary entry, its number and its offset.
    ENTRY = 120

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 32 << 20) -> None:
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.size = 0
        self.flat = np.zeros(0, np.int32)
        self.offset = np.zeros(1, np.int64)

    def _add(self, words: list[str]) -> None:
        ids, sizes = self.encode(words)
        self.size += sum(map(sys.getsizeof, words)) + self.ENTRY * len(words) + 4 * len(ids)
        self.flat = np.concatenate((self.flat, ids.astype(np.int32)))
        self.offset = np.concatenate((self.offset, self.offset[-1] + np.cumsum(sizes)))
        self.index.update(zip(words, range(len(self.index), len(self.index) + len(words)), strict=True))

    def ids_of(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's ids start and the last ones end)."""
        if self.size > self.limit:
            self.clear()
        words = list(chain.from_iterable(texts))
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        gaps = np.flatnonzero(at < 0)
        if len(gaps):
            unknown = [words[i] for i in gaps.tolist()]
            self._add(sorted(set(unknown)))
            at[gaps] = np.fromiter(map(self.index.__getitem__, unknown), np.int64, len(gaps))
        size = self.offset[at + 1] - self.offset[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.flat[np.repeat(self.offset[at] - (ends - size), size) + np.arange(total)]
        upto = np.concatenate(([0], ends)).astype(np.int64)
        return flat, upto[np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)]


def list_array(flat: np.ndarray, edges: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat, pa.int32()))


def split_specials(text: str, specials: re.Pattern) -> Iterator[tuple[str, bool]]:
    """(part, is a special token) in order."""
    for i, part in enumerate(specials.split(text)):
        if part:
            yield part, i % 2 == 1
