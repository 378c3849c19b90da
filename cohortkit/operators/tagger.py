"""Entity tagging from dictionaries of phrases, longest match first.

A dictionary has rows (tag_set, phrase, label); several tag sets are matched
independently in one pass over a text. At each word the longest phrase of a
set that starts there is taken and matching goes on behind it; elsewhere it
moves on by one word. Words are :func:`cohortkit.operators.text.tokens`, so a
phrase is found whatever stands between its words.

A dictionary up to a checked number of phrases is compiled into a trie of words
and sent to every task, which walks all places of its texts down the trie
together: a narrow map. A larger one is joined: word windows meet phrases by
equality, the longest per start is kept, and only a document's own hits come
together to be resolved. Both ways give the same rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.operators.text import tokens
from cohortkit.sources.io import materialize

# Functions sent to tasks travel by value: executors need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Phrases that a compiled dictionary may have (some 20 MB in a task).
COMPILED = 100_000
#: Words, or places of phrases, that a task looks at together: its memory follows these, not the length of a batch.
TOGETHER = 1 << 18
HITS = "array<struct<tag_set: string, idx: int, label: string, start: int, n_words: int, entity: string>>"


def normal_phrases(dictionary: DataFrame) -> DataFrame:
    """(tag_set, phrase, label, n_words): phrases as words joined by a space, each once per set with its smallest label."""
    words = tokens("phrase")
    return (dictionary.select("tag_set", F.array_join(words, " ").alias("phrase"), "label", F.size(words).alias("n_words"))
            .where("n_words > 0 AND tag_set IS NOT NULL AND label IS NOT NULL")
            .groupBy("tag_set", "phrase", "n_words").agg(F.min("label").alias("label")))


def phrase_trie(entries: list[tuple[str, str]]) -> tuple[list[str], np.ndarray, np.ndarray, list[tuple[str, str] | None]]:
    """The phrases (phrase, label) of one tag set as a trie of words: (words, steps, nodes, phrase and label of each node).

    A step is node × number of words + word; ``steps`` are sorted, ``nodes``
    say where they lead. Node 0 is the root.
    """
    words = sorted({w for phrase, _ in entries for w in phrase.split(" ")})
    number = {w: i for i, w in enumerate(words)}
    steps: dict[int, int] = {}
    full: list[tuple[str, str] | None] = [None]
    for phrase, label in entries:
        node = 0
        for w in phrase.split(" "):
            node = steps.setdefault(node * len(words) + number[w], len(full))
            if node == len(full):
                full.append(None)
        full[node] = phrase, label
    keys = np.array(sorted(steps), dtype=np.int64)
    return words, keys, np.array([steps[k] for k in keys.tolist()], dtype=np.int64), full


def trie_hits(flat: pa.Array, edges: np.ndarray, words: list[str], steps: np.ndarray, nodes: np.ndarray,
              full: list[tuple[str, str] | None]) -> Iterator[tuple[int, int, str, str, int, int]]:
    """(text, index, phrase, label, start, number of words) from left to right, without overlap.

    ``flat`` holds the words of several texts in a row, ``edges`` where each
    text's begin and the last one's end. All places walk down the trie
    together, a word at a time; the longest phrase that begins at a place counts.
    """
    word = np.asarray(pc.fill_null(pc.index_in(flat, value_set=pa.array(words, pa.string())), -1)).astype(np.int64)
    ends = np.repeat(edges[1:], np.diff(edges))
    longest, reached = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
    known = np.array([x is not None for x in full])
    at, node, k = np.arange(len(word)), np.zeros(len(word), np.int64), 0
    while len(at):
        inside = at + k < ends[at]
        at, node = at[inside], node[inside]
        step = node * len(words) + word[at + k]
        spot = np.minimum(np.searchsorted(steps, step), len(steps) - 1)
        on = (steps[spot] == step) & (word[at + k] >= 0)
        at, node, k = at[on], nodes[spot[on]], k + 1
        whole = known[node]
        longest[at[whole]], reached[at[whole]] = k, node[whole]
    starts = np.flatnonzero(longest)
    texts = np.searchsorted(edges, starts, side="right") - 1
    free, last, idx = 0, -1, 0
    for i, text, n, node in zip(starts.tolist(), texts.tolist(), longest[starts].tolist(), reached[starts].tolist(), strict=True):
        if i >= free:
            idx = idx + 1 if text == last else 0
            yield text, idx, *full[node], i - int(edges[text]), n
            free, last = i + n, text


def _hits_array(found: list[list[tuple[str, int, str, int, int, str]]]) -> pa.ListArray:
    edges = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)
    parts = list(zip(*chain.from_iterable(found), strict=True)) or [[]] * 6
    kinds = pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string()
    rows = pa.StructArray.from_arrays([pa.array(p, k) for p, k in zip(parts, kinds, strict=True)], ["tag_set", "idx", "label", "start", "n_words", "entity"])
    return pa.ListArray.from_arrays(pa.array(edges), rows)


def _slices(part: pa.ListArray, most: int = TOGETHER) -> Iterator[pa.ListArray]:
    """``part`` in consecutive slices of rows, each with at most ``most`` entries or of a single row."""
    edges, at = np.asarray(part.offsets).astype(np.int64), 0
    while at < len(part):
        to = max(at + 1, int(np.searchsorted(edges, edges[at] + most, side="right")) - 1)
        yield part.slice(at, to - at)
        at = to


def _compiled(df: DataFrame, phrases: list) -> DataFrame:
    """``df`` (with ``__words``) and its ``__hits``, by tries that every task gets."""
    entries: dict[str, list[tuple[str, str]]] = {}
    for p in phrases:
        entries.setdefault(p["tag_set"], []).append((p["phrase"], p["label"]))
    sent = df.sparkSession.sparkContext.broadcast([(name, *phrase_trie(own)) for name, own in sorted(entries.items())])

    @F.arrow_udf(HITS)
    def hits(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tries = sent.value
        for part in chain.from_iterable(map(_slices, parts)):
            found: list[list[tuple[str, int, str, int, int, str]]] = [[] for _ in range(len(part))]
            edges = np.asarray(part.offsets).astype(np.int64)
            edges -= edges[0]
            for name, *trie in tries:
                for text, idx, phrase, label, start, n in trie_hits(part.flatten(), edges, *trie):
                    found[text].append((name, idx, label, start, n, phrase))
            yield _hits_array(found)

    return df.withColumn("__hits", hits("__words"))


def _joined(df: DataFrame, phrases: DataFrame) -> DataFrame:
    """``df`` and its ``__hits``, by an equality join of word windows with the phrases."""
    rows = materialize(df.withColumn("__rid", F.monotonically_increasing_id()), name="tagger-rows")
    lengths = [r[0] for r in phrases.select("n_words").distinct().collect()]     # bounded by the longest phrase
    words, n = F.col("__words"), F.size("__words")

    def windows_of(k: int):
        starts = F.sequence(F.lit(1), n - k + 1)
        return F.when(n >= k, F.transform(starts, lambda i: F.struct(i.alias("start"), F.array_join(F.slice(words, i, k), " ").alias("phrase"))))

    windows = [windows_of(k) for k in lengths]
    all_windows = F.flatten(F.array_compact(F.array(*windows))) if windows else F.array().cast("array<struct<start:int,phrase:string>>")
    places = rows.select("__rid", F.explode(all_windows).alias("w")).select("__rid", (F.col("w.start") - 1).alias("start"), "w.phrase")
    met = places.join(phrases, "phrase").groupBy("__rid", "tag_set", "start").agg(
        F.max(F.struct("n_words", "label", "phrase")).alias("best"))

    @F.arrow_udf(HITS)
    def resolve(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in chain.from_iterable(map(_slices, parts)):
            found = []
            for candidates in part.to_pylist():
                kept, last = [], (None, 0, 0)           # set, index and end of the match before
                for c in candidates or []:
                    name, idx, free = last if last[0] == c["tag_set"] else (c["tag_set"], 0, 0)
                    if c["start"] >= free:
                        kept.append((name, idx, c["label"], c["start"], c["n_words"], c["phrase"]))
                        idx, free = idx + 1, c["start"] + c["n_words"]
                    last = (name, idx, free)
                found.append(kept)
            yield _hits_array(found)

    listed = met.groupBy("__rid").agg(F.array_sort(F.collect_list(F.struct("tag_set", "start", "best.label", "best.n_words", "best.phrase"))).alias("__found"))
    out = rows.join(listed, "__rid", "left")
    return out.withColumn("__hits", resolve("__found")).drop("__rid", "__found")


def _tagged(rows: DataFrame, dictionary: DataFrame, compiled: int) -> DataFrame:
    phrases = materialize(normal_phrases(dictionary), name="tagger-phrases")
    few = phrases.limit(compiled + 1).collect()
    return _compiled(rows, few) if len(few) <= compiled else _joined(rows, phrases)


def tag_phrases(df: DataFrame, key: str, text: str, dictionary: DataFrame, compiled: int = COMPILED) -> DataFrame:
    """(key, tag_set, idx, label, start, n_words, entity): every longest match of every tag set.

    ``idx`` counts a text's matches of a set from 0, ``start`` its words from 0;
    ``entity`` is the matched words joined by a space. Texts without a match, null texts
    and empty ones give no row; repeated rows each give theirs. Phrases
    without words or with a null set or label are ignored; a phrase that a set
    lists twice has its smallest label. Beyond ``compiled`` phrases the
    dictionary is joined instead of sent to the tasks.
    """
    tagged = _tagged(df.select(F.col(key).alias("__key"), tokens(text).alias("__words")), dictionary, compiled)
    # an outer explode: the inner one would first filter by the hits, and find them a second time for it
    return tagged.select(F.col("__key").alias(key), F.explode_outer("__hits").alias("h")).where("h is not null").select(key, "h.*")


def label_counts(df: DataFrame, text: str, dictionary: DataFrame, compiled: int = COMPILED) -> DataFrame:
    """(tag_set, label, n): how many matches each label has over all texts; labels without one are not listed."""
    tagged = _tagged(df.select(tokens(text).alias("__words")), dictionary, compiled)
    return (tagged.select(F.explode_outer("__hits").alias("h")).where("h is not null").groupBy(F.col("h.tag_set").alias("tag_set"), F.col("h.label").alias("label"))
            .agg(F.count(F.lit(1)).alias("n")))


def phrase_lists(df: DataFrame, key: str, text: str, dictionary: DataFrame, tag_set: str, compiled: int = COMPILED) -> DataFrame:
    """(key, entities): the matched phrases of one tag set of each row in order; an empty list where there is none."""
    own = dictionary.where(F.col("tag_set") == tag_set)
    tagged = _tagged(df.select(F.col(key).alias("__key"), tokens(text).alias("__words")), own, compiled)
    listed = F.transform("__hits", lambda h: h["entity"])
    return tagged.select(F.col("__key").alias(key), F.coalesce(listed, F.array().cast("array<string>")).alias("entities"))
