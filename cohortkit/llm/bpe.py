"""BPE encoding and decoding by batched merge rounds.

The symbols of many words lie in one flat integer array. In every round all
adjacent pairs are looked up at once by binary search over the sorted pair
keys; in each word every occurrence (left to right, without overlap) of its
lowest-ranked pair is merged; words without a mergeable pair leave the round.

The vocabulary is that of a tokenizers JSON file with word ends
(``end_of_word_suffix``); the driver reads it and broadcasts it (a few MB, fixed by
the file).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import text_chunks, worker_cache
from cohortkit.llm.pieces import UNUSUAL, PieceTable, list_array, split_specials

# The words of the vocabulary's Split rule, for texts without unusual characters.
WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable bytes stand for themselves, the others follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    extra = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one vocabulary file's contents."""

    def __init__(self, file: str) -> None:
        spec = json.loads(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        suffix = spec["model"]["end_of_word_suffix"] or ""
        self.file = file
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        n = max([*vocab.values(), *self.specials.values()]) + 1
        names = [""] * n
        for name, i in [*vocab.items(), *self.specials.items()]:
            names[i] = name
        self.names = pa.array(names)
        symbols = byte_symbols()
        self.symbol_byte = {s: b for b, s in enumerate(symbols)}
        self.inner = np.array([vocab.get(s, -1) for s in symbols], np.int64)
        self.last = np.array([vocab.get(s + suffix, -1) for s in symbols], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order, made[order]
        self.table = PieceTable(self.merge_words)
        self.library = None

    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of all words in a row, ids per word)."""
        raw = [w.encode("utf-8") for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(size)
        sym = self.inner[data]
        sym[ends - 1] = self.last[data[ends - 1]]
        for i in (words.index(w) for w in self.specials if w in words):
            sym[ends[i] - size[i]:ends[i]] = -1
            sym[ends[i] - size[i]] = self.specials[words[i]]
        word = np.repeat(np.arange(len(words)), size)[sym >= 0]     # a byte without a symbol gives no token
        sym = sym[sym >= 0]
        done_word, done_sym = [], []
        while len(sym):
            key = sym[:-1] << 32 | sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = (self.keys[at] == key) & (word[:-1] == word[1:])
            if not found.any():
                break
            rank = np.where(found, self.ranks[at], len(self.ranks))
            rank = np.append(rank, len(self.ranks))
            heads = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank, heads)
            span = np.diff(np.append(heads, len(word)))
            over = np.repeat(best == len(self.ranks), span)         # these words are finished
            hit = np.flatnonzero((rank == np.repeat(best, span)) & ~over)
            # pairs of equal symbols overlap in runs: every second one merges
            run = np.cumsum(np.diff(hit, prepend=-2) != 1) - 1
            head = np.flatnonzero(np.diff(run, prepend=-1))
            hit = hit[(np.arange(len(hit)) - head[run]) % 2 == 0]
            sym = sym.copy()
            sym[hit] = self.made[at[hit]]
            keep = ~over
            keep[hit + 1] = False
            done_word.append(word[over])
            done_sym.append(sym[over])
            sym, word = sym[keep], word[keep]
        all_word, all_sym = np.concatenate([*done_word, word]), np.concatenate([*done_sym, sym])
        return all_sym[np.argsort(all_word, kind="stable")], np.bincount(all_word, minlength=len(words))

    def words(self, text: str) -> list[str]:
        if self.special is not None and "<|" in text and self.special.search(text):
            return [w for part, special in split_specials(text, self.special)
                    for w in ([part] if special else self.words_plain(part))]
        return self.words_plain(text)

    def words_plain(self, text: str) -> list[str]:
        if UNUSUAL.search(text) is None:
            return WORDS.findall(text.lower())
        # rarer scripts: the library's own normaliser and word rule, then the same merge rounds
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.file)
        normal = self.library.normalizer.normalize_str(text)
        byte = self.symbol_byte
        return [bytes(byte[c] for c in piece).decode("utf-8", "surrogatepass")
                for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def encode(self, texts: list[str]) -> pa.ListArray:
        return list_array(*self.table.ids_of([self.words(t) for t in texts]))

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The tokens joined by one space, special tokens included (the file names no decoder)."""
        names = self.names.take(ids.flatten())
        return pc.binary_join(pa.ListArray.from_arrays(pc.subtract(ids.offsets, ids.offsets[0]), names), " ")


def coder(file: str) -> WordBpe:
    kept = worker_cache()
    if kept.get("word_bpe_file") != file:
        kept["word_bpe_file"], kept["word_bpe"] = file, WordBpe(file)
    return kept["word_bpe"]


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_documents(docs: DataFrame, vocabulary: str, text_col: str = "text", to: str = "ids") -> DataFrame:
    """``docs`` with the token ids of ``text_col`` (array<int>) as column ``to``.

    Null and empty texts have no ids; texts of any length are encoded whole;
    repeated rows get equal ids; other columns pass through on the JVM side
    (one named like ``to`` is replaced).
    """
    file = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    @F.arrow_udf("array<int>")
    def encode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = coder(file.value)
        for part in parts:
            for _, _, texts in text_chunks(pa.RecordBatch.from_arrays([part], ["text"]), 0):
                yield bpe.encode(texts)

    return docs.withColumn(to, encode(F.col(text_col).cast("string")))


def recode_documents(docs: DataFrame, vocabulary: str, text_col: str = "text", to: str = "coded") -> DataFrame:
    """``docs`` with a struct of both ``ids`` and ``decoded`` of ``text_col`` as column ``to``, made in one pass.

    As :func:`encode_documents` followed by :func:`decode_documents`, but a
    task runs one Python worker with one vocabulary, and hands back about a
    megabyte of texts at a time.
    """
    file = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    @F.arrow_udf("struct<ids: array<int>, decoded: string>")
    def recode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = coder(file.value)
        for part in parts:
            for _, _, texts in text_chunks(pa.RecordBatch.from_arrays([part], ["text"]), 0):
                ids = bpe.encode(texts)
                yield pa.StructArray.from_arrays([ids, bpe.decode(ids)], ["ids", "decoded"])

    return docs.withColumn(to, recode(F.col(text_col).cast("string")))


def decode_documents(docs: DataFrame, vocabulary: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """``docs`` with the decoded text of ``ids_col`` (special tokens kept) as column ``to``; no ids give an empty text."""
    file = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    @F.arrow_udf("string")
    def decode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = coder(file.value)
        for part in parts:
            yield bpe.decode(part)

    return docs.withColumn(to, decode(F.coalesce(F.col(ids_col), F.array().cast("array<int>"))))
