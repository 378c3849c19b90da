"""Packing token streams into training windows by order-preserving dynamic programming.

Each task packs its documents in order. A window may end at a document end
(free), after a sentence or after a clause (penalties in tokens), and, where no
such place comes for more tokens than the highest penalty, after any token. Cuts
minimise padding plus penalties. With v(i) = cost(i) + position(i) the best
predecessor of a cut is the smallest v among the cuts at most one window back,
held in a monotone queue, so the whole is linear in the number of places; a
window of exactly a power of two needs no padding and is a second kind of
step.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.bpe import byte_symbols
from cohortkit.llm.common import text_chunks, worker_cache
from cohortkit.llm.pieces import UNUSUAL

# Fixed value: the byte-level pre-tokeniser's words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts beyond this length are searched for words or gaps of LONG_RUN, which take the slower library.
LONG_TEXT, LONG_RUN = 10_000, re.compile(r"\S{4096}|\s{4096}")
#: Penalties, in tokens of padding, of ending a window after a sentence, after a clause, anywhere else.
SENTENCE, CLAUSE, ANYWHERE = 4.0, 16.0, 96.0


def marks_of_scripts() -> list[tuple[int, float, list[int]]]:
    """(bytes, penalty, values) of the marks outside ASCII that end a clause or a sentence, in every script."""
    import regex

    every = "".join(chr(c) for c in range(0x80, 0x20000) if not 0xD800 <= c < 0xE000)
    sentence = {*regex.findall(r"\p{Sentence_Terminal}", every), "\u2028", "\u2029"}
    clause = {*regex.findall(r"\p{Terminal_Punctuation}", every), "\uff09"} - sentence
    out = []
    for penalty, marks in ((CLAUSE, clause), (SENTENCE, sentence)):
        for n in (2, 3, 4):
            out.append((n, penalty, sorted(int.from_bytes(b, "big") for c in marks if len(b := c.encode()) == n)))
    return [x for x in out if x[2]]


class ByteTokens:
    """Token ids of whole texts under a byte-level tokenizers file.

    The ranks of the file go to the faster tiktoken; texts with special tokens,
    very long runs or characters on which the two might differ go to tokenizers.
    """

    def __init__(self, file: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(file)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        byte = {s: b for b, s in enumerate(byte_symbols())}
        ranks = {bytes(map(byte.__getitem__, name)): i for name, i in self.library.get_vocab(with_added_tokens=False).items()
                 if name not in self.special}
        self.plain = tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        names = [self.library.decode([i], skip_special_tokens=False) for i in range(self.library.get_vocab_size())]
        raw = [b"?"] * len(names)
        for token, i in ranks.items():
            raw[i] = token
        # per token: its length and its last one to four bytes as numbers
        self.size = np.array([len(r) for r in raw])
        self.tails = [np.array([int.from_bytes(r[-k:], "big") for r in raw], np.int64) for k in (1, 2, 3, 4)]
        self.marks = marks_of_scripts()
        self.ends = np.full(len(names), np.inf)
        self.ends[[i for i, t in enumerate(names) if t.rstrip(" ")[-1:] in (",", ";", ":", ")")]] = CLAUSE
        self.ends[[i for i, t in enumerate(names) if t.rstrip(" ")[-1:] in (".", "!", "?", "\n")]] = SENTENCE

    def penalties(self, flat: np.ndarray) -> np.ndarray:
        """Penalty of ending a window after each token of a stream; infinite inside a clause.

        Marks outside ASCII are known by their bytes, as one may be several tokens.
        """
        out = self.ends[flat]
        if not len(flat) or self.tails[0][flat].max() < 0x80:
            return out
        size, tail = self.size[flat], self.tails[0][flat]
        upto = [tail]
        for k in (2, 3, 4):
            # the last k bytes of the stream after each token: its own, or as many as it lacks from before
            last = self.tails[k - 1][flat]
            for own in range(1, k):
                short = np.flatnonzero(size[1:] == own) + 1
                last[short] += upto[k - own - 1][short - 1] << (8 * own)
            upto.append(last)
        for n, penalty, values in self.marks:
            out[np.isin(upto[n - 1], values)] = penalty
        return out

    def easy(self, text: str) -> bool:
        return (UNUSUAL.search(text) is None and not any(s in text for s in self.special)
                and (len(text) <= LONG_TEXT or LONG_RUN.search(text) is None))

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(self.plain.encode_ordinary(t) if self.easy(t) else self.library.encode(t, add_special_tokens=False).ids,
                         np.int32) for t in texts]


def cut_places(penalty: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(places where a window may end, their penalties): ``penalty`` per token, document ends free,
    and every token between two places that lie further apart than ANYWHERE or a window.

    In a shorter gap, ending the window where the gap starts pads no more than a cut inside it costs.
    """
    cost = penalty.copy()
    cost[ends - 1] = 0.0
    at = np.flatnonzero(np.isfinite(cost)) + 1
    gaps = np.diff(at, prepend=0)
    wide = np.repeat(gaps > min(ANYWHERE, length), gaps)
    cost[:len(wide)][wide & ~np.isfinite(cost[:len(wide)])] = ANYWHERE
    at = np.flatnonzero(np.isfinite(cost)) + 1
    return at, cost[at - 1]


def best_cuts(at: np.ndarray, penalty: np.ndarray, length: int, exact: tuple[int, ...]) -> list[int]:
    """Ends of the windows that minimise padding plus penalties over the places ``at`` (increasing)."""
    places, cost, back = array("q", [0]), array("d", [0.0]), array("q", [-1])
    places.frombytes(np.asarray(at, np.int64).tobytes())
    extra = array("d", np.asarray(penalty, np.float64).tobytes())
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    where = array("q", bytes(8 * (places[-1] + 1)))     # place number at a position; 0 also where there is none
    for j in range(1, len(places)):
        here = places[j]
        while here - places[queue[0][1]] > length:
            queue.popleft()
        value, i = queue[0]
        best = length - here + value
        for n in exact:
            if here >= n:
                k = where[here - n]
                if (k or here == n) and cost[k] < best:
                    best, i = cost[k], k
        best += extra[j - 1]
        cost.append(best)
        back.append(i)
        where[here] = j
        value = best + here
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    out, j = [], len(places) - 1
    while j > 0:
        out.append(places[j])
        j = back[j]
    return out[::-1]


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", length: int = 1024,
         separator: int = 0, block_tokens: int = 1 << 20, min_exact: int = 256, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    A document is its ids and ``separator``; null and empty texts are the
    separator alone. Sequences hold at most ``length`` tokens; powers of two
    from ``min_exact`` up count as unpadded. Rows are packed in the order in
    which their task reads them, in blocks of ``block_tokens`` that end with a
    document, so memory is bounded by a block and the longest text. Repeated
    rows are packed each; other columns are ignored. Sequence numbers are
    unique over the table and the same when a lost task runs again.
    """
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as f:
        file = spark.sparkContext.broadcast(f.read())
    exact = tuple(1 << k for k in range(length.bit_length()) if min_exact <= 1 << k < length)
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = worker_cache()
        if kept.get("byte_tokens_file") != file.value:
            kept["byte_tokens_file"], kept["byte_tokens"] = file.value, ByteTokens(file.value)
        tokens = kept["byte_tokens"]
        sequence = TaskContext.get().partitionId() << 40
        ids: list = []
        parts: list[np.ndarray] = []
        held = 0

        def block() -> pa.RecordBatch:
            nonlocal sequence
            flat = np.concatenate(parts)
            ends = np.cumsum([len(p) for p in parts])
            cuts = np.array(best_cuts(*cut_places(tokens.penalties(flat), ends, length), length, exact))
            stop = np.unique(np.concatenate((cuts, ends)))
            begin = np.concatenate(([0], stop[:-1]))
            doc, window = np.searchsorted(ends, begin, side="right"), np.searchsorted(cuts, begin, side="right")
            first = ends - [len(p) for p in parts]
            opens = np.concatenate(([0], cuts[:-1]))
            data = flat.astype("<u4")
            columns = [pa.array(ids).cast(id_type).take(pa.array(doc)), begin - first[doc], stop - begin,
                       np.array([zlib.crc32(data[a:b].tobytes()) for a, b in zip(begin, stop, strict=True)], np.int64),
                       (ends - first)[doc], sequence + window, begin - opens[window]]
            if with_ids:
                columns.append(pa.array([flat[a:b] for a, b in zip(begin, stop, strict=True)], pa.list_(pa.int32())))
            sequence += len(cuts)
            return pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c.astype(np.int64)) for c in columns], names)

        for b in batches:
            id_type = b.schema.field(0).type
            for lo, hi, texts in text_chunks(b, 1):
                ids += b.column(0).slice(lo, hi - lo).to_pylist()
                for part in tokens.ids_of(texts):
                    parts.append(np.append(part, np.int32(separator)))
                    held += len(parts[-1])
                if held >= block_tokens:
                    yield block()
                    ids, parts, held = [], [], 0
        if parts:
            yield block()

    schema = (f"id {picked.schema['id'].dataType.simpleString()}, start bigint, length bigint, ids_crc32 bigint, "
              "doc_tokens bigint, sequence_id bigint, offset bigint" + ", ids array<int>" * with_ids)
    return picked.mapInArrow(run, schema).withColumnRenamed("id", id_col)
