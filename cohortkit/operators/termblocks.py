"""Terms of texts counted in blocks of texts, so that postings are never shuffled.

A text's key deals it to one of so many blocks that each has some ``BLOCK``
characters. A task counts the terms of a block's keys; only the block's
distinct terms leave it, to be summed and numbered over the corpus. What the
corpus knows of a block's terms comes back to the block, where it meets the
counts. So texts move twice and each distinct term of a block twice, whatever
the number of (key, term) pairs.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.operators.features import global_index
from cohortkit.sources.io import materialize

# Functions sent to tasks travel by value: executors need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Characters of a block (some 50 MB in a task); a key's own texts stay together.
BLOCK = 1 << 22


def _words(texts: pa.Table) -> tuple[pa.DictionaryArray, np.ndarray, pa.Array]:
    """(keys of the rows, number of each word's key, the words) of a block; repeated and null keys are one key."""
    keys = pc.dictionary_encode(texts["__key"].combine_chunks(), null_encoding="encode")
    lists = pc.split_pattern(texts["__line"].combine_chunks(), " ")
    words, row = pc.list_flatten(lists), np.asarray(pc.list_parent_indices(lists))
    kept = pc.not_equal(words, "")                      # an empty line is split into one empty word
    row = row[kept.to_numpy(zero_copy_only=False)]
    return keys, np.asarray(keys.indices).astype(np.int64)[row], words.filter(kept)


def _met(texts: pa.Table, known: pa.Table) -> tuple[pa.DictionaryArray, pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """(keys of the rows, the block's terms by number, and of each (key, term): key, term, count), sorted by key and term."""
    keys, own, words = _words(texts)
    known = known.sort_by("idx").combine_chunks()
    at = np.asarray(pc.index_in(words, value_set=known["term"].combine_chunks())).astype(np.int64)
    n = max(1, len(known))
    pairs, tf = np.unique(own * n + at, return_counts=True)
    return keys, known, pairs // n, pairs % n, tf


class TermBlocks:
    """Texts (key, words) dealt to blocks, and the corpus' terms: ``vocabulary`` has (term, df, idx), ``rows`` counts all rows.

    ``df`` counts the keys that have the term, ``idx`` numbers the terms in sorted order.
    """

    def __init__(self, df: DataFrame, key: str, text: str, words: Column, block: int = BLOCK):
        self.rows, size = df.agg(F.count(F.lit(1)), F.sum(F.length(text))).first()
        self.key = T.StructField(key, df.schema[key].dataType)
        own = F.pmod(F.xxhash64(key), F.lit((size or 0) // block + 1))
        self.texts = df.select(own.alias("__block"), F.col(key).alias("__key"), F.coalesce(F.array_join(words, " "), F.lit("")).alias("__line"))

        def terms(texts: pa.Table) -> pa.Table:
            _, own, words = _words(texts)
            coded = words.dictionary_encode()
            n = max(1, len(coded.dictionary))
            pairs = np.unique(own * n + np.asarray(coded.indices).astype(np.int64))
            df = np.bincount(pairs % n, minlength=len(coded.dictionary))
            return pa.table({"__block": pa.array(np.full(len(df), texts["__block"][0].as_py())), "term": coded.dictionary, "n": pa.array(df)})

        found = materialize(self.texts.where("__line <> ''").groupBy("__block").applyInArrow(terms, "__block long, term string, n long"), name="block-terms")
        corpus = found.groupBy("term").agg(F.sum("n").alias("df"))
        self.vocabulary = materialize(global_index(corpus, ["term"], "idx").select("term", "df", F.col("idx").cast("int").alias("idx")), name="vocabulary")
        self.known = found.select("__block", "term").join(self.vocabulary, "term")

    def _met(self, texts: DataFrame, task, columns: list[tuple[str, str]]) -> DataFrame:
        schema = T.StructType([self.key, *(T.StructField(c, T.DataType.fromDDL(kind)) for c, kind in columns)])
        return texts.groupBy("__block").cogroup(self.known.groupBy("__block")).applyInArrow(task, schema)

    def counts(self) -> DataFrame:
        """(key, term, tf, df): how often each key has each of its terms."""
        name = self.key.name

        def task(texts: pa.Table, known: pa.Table) -> pa.Table:
            keys, known, key, term, tf = _met(texts, known)
            order = np.argsort(term, kind="stable")         # equal terms and frequencies lie together in what is written
            key, term, tf = key[order], term[order], tf[order]
            return pa.table({name: keys.dictionary.take(pa.array(key)), "term": known["term"].take(pa.array(term)), "tf": pa.array(tf.astype(np.int64)), "df": known["df"].take(pa.array(term))})

        return self._met(self.texts.where("__line <> ''"), task, [("term", "string"), ("tf", "bigint"), ("df", "bigint")])

    def lists(self) -> DataFrame:
        """One row per text: key and ``entries`` (idx, tf, df) of its key by term number; null where there is no key."""
        name = self.key.name

        def task(texts: pa.Table, known: pa.Table) -> pa.Table:
            keys, known, key, term, tf = _met(texts, known)
            edges = np.concatenate(([0], np.cumsum(np.bincount(key, minlength=len(keys.dictionary))))).astype(np.int32)
            own = [known["idx"].take(pa.array(term)).combine_chunks(), pa.array(tf.astype(np.int64)), known["df"].take(pa.array(term)).combine_chunks()]
            each = pa.ListArray.from_arrays(pa.array(edges), pa.StructArray.from_arrays(own, ["idx", "tf", "df"]))
            given = texts["__key"].combine_chunks()
            return pa.table({name: given, "entries": each.take(pc.if_else(given.is_valid(), keys.indices, pa.scalar(None, keys.indices.type)))})

        return self._met(self.texts, task, [("entries", "array<struct<idx: int, tf: bigint, df: bigint>>")])
