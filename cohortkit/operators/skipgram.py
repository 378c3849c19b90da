"""Word2Vec whose vocabulary and weights never leave the executors.

Spark's Word2Vec collects the vocabulary on the driver, and both weight
matrices after each pass. Here the vocabulary is a numbered table, and the
weights are rows (part, id, vector) that go from pass to pass by shuffles.

The training is Spark's: skip-grams with hierarchical softmax, one model per
part and pass, the parts' changed vectors averaged after each pass, its
windows, learning rate and limits. A part holds the vectors of its own words
and of the inner nodes above them only. The contexts of a few places are stepped
together. First vectors and window widths are drawn from (seed, id) and
(seed, pass, part), and words of equal count are numbered by their text, so a
run can be repeated; they are not the numbers that Spark draws.

The driver gets the number of words of each count. The Huffman tree follows
from these alone: equal counts are paired in runs, and a task walks from any
word to the root by looking up runs.
"""

from __future__ import annotations

import sys
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import feature
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.operators.features import global_index
from cohortkit.sources.io import materialize

# Functions sent to tasks travel by value: executors need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Spark's bound of a score that is still learned from, words between changes of the learning rate, its lowest share.
MAX_SCORE, RATE_WORDS, LOWEST_RATE = 6.0, 10_000, 1e-4
#: Places of a sentence that are stepped together, vectors handed on at a time.
PLACES, OUT_ROWS = 8, 1 << 14

_WEIGHTS = "part int, id long, vec array<float>, used boolean"


class Huffman:
    """The Huffman tree over words numbered by falling count, kept as runs of equal weight.

    Nodes are paired by rising weight, inner nodes before words of the same
    weight: the node at place p has the parent p // 2 and the bit p % 2. A
    node's place is its number among its kind plus the nodes of the other
    kind before it, so a run stands for all nodes of its weight.
    """

    def __init__(self, counts: dict[int, int]):
        runs = sorted(counts.items())
        self.size = sum(n for _, n in runs)
        leaves, inner, made, odd = deque(runs), deque(), [], None

        def add(weight: int, n: int) -> None:
            inner.append((weight, n))
            made.append((weight, n))

        while leaves or inner:
            weight, n = (inner if inner and (not leaves or inner[0][0] <= leaves[0][0]) else leaves).popleft()
            if odd is not None:
                add(odd + weight, 1)
                n, odd = n - 1, None
            if n > 1:
                add(2 * weight, n // 2)
            if n % 2:
                odd = weight
        self.leaf_weight, self.leaf_before = _runs(runs)
        self.inner_weight, self.inner_before = _runs(made)

    def paths(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """From the words up to the root, level by level: (places in ``words``, inner nodes, bits)."""
        at = np.arange(len(words) if self.size > 1 else 0)
        number = self.size - 1 - words[at].astype(np.int64)
        weight = self.leaf_weight[np.searchsorted(self.leaf_before, number, "right") - 1]
        place = number + self.inner_before[np.searchsorted(self.inner_weight, weight, "right")]
        while len(at):
            node = place // 2
            yield at, node, place % 2
            below = node < self.size - 2
            at, node = at[below], node[below]
            weight = self.inner_weight[np.searchsorted(self.inner_before, node, "right") - 1]
            place = node + self.leaf_before[np.searchsorted(self.leaf_weight, weight, "left")]


def _runs(runs: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Weights of runs, and how many nodes lie before each run and in all."""
    table = np.array(runs, dtype=np.int64).reshape(-1, 2)
    return table[:, 0], np.concatenate([[0], np.cumsum(table[:, 1])])


def first_vectors(ids: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Evenly spread components in [-0.5, 0.5) / ``size``, by (seed, id, component) alone (splitmix64)."""
    x = ids.astype(np.uint64)[:, None] * np.uint64(size) + np.arange(size, dtype=np.uint64)
    x = x * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0xD1342543DE82EF95 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (((x >> np.uint64(40)).astype(np.float64) / (1 << 24) - 0.5) / size).astype(np.float32)


def _weight_rows(part: int, ids: np.ndarray, vectors: np.ndarray, used: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(ids), OUT_ROWS):
        v = vectors[i:i + OUT_ROWS]
        offsets = np.arange(0, v.size + 1, v.shape[1], dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(v), part, dtype=np.int32)), pa.array(ids[i:i + OUT_ROWS]),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(v.ravel())), pa.array(used[i:i + OUT_ROWS])],
            names=["part", "id", "vec", "used"])


def _first_weights(tree: Huffman, size: int, seed: int) -> Callable:
    """A part's words and the inner nodes above them with their first vectors; inner nodes follow the words and start at 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, words = 0, np.empty(0, dtype=np.int64)
        for b in batches:
            if b.num_rows:
                part = b.column("part")[0].as_py()
                words = np.union1d(words, b.column("words").flatten().to_numpy().astype(np.int64))
        nodes = np.empty(0, dtype=np.int64)
        for _, node, _ in tree.paths(words):
            nodes = np.union1d(nodes, node)
        vectors = np.concatenate([first_vectors(words, size, seed), np.zeros((len(nodes), size), dtype=np.float32)])
        yield from _weight_rows(part, np.concatenate([words, nodes + tree.size]), vectors, np.zeros(len(vectors), dtype=bool))

    return run


def _add_rows(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """``np.add.at(table, at, rows)``, which is faster on flat arrays; a row may be named twice."""
    size = table.shape[1]
    np.add.at(table.reshape(-1), (at[:, None].astype(np.int64) * size + np.arange(size)).ravel(), rows.ravel())


class PartModel:
    """The vectors of one part in one pass, changed sentence by sentence."""

    def __init__(self, tree: Huffman, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids)
        self.ids, self.first = ids[order], vectors[order]
        n = int(np.searchsorted(self.ids, tree.size))
        self.words, nodes = self.ids[:n], self.ids[n:] - tree.size
        self.word_vectors, self.node_vectors = self.first[:n].copy(), self.first[n:].copy()
        levels = [(at, np.searchsorted(nodes, node).astype(np.int32), bit) for at, node, bit in tree.paths(self.words)]
        lengths = np.zeros(n, dtype=np.int64)
        for at, _, _ in levels:
            lengths[at] += 1
        self.start = np.concatenate([[0], np.cumsum(lengths)])
        self.nodes = np.empty(self.start[-1], dtype=np.int32)
        self.wanted = np.empty(self.start[-1], dtype=np.float32)
        for depth, (at, node, bit) in enumerate(levels):
            self.nodes[self.start[at] + depth] = node
            self.wanted[self.start[at] + depth] = 1 - bit

    def learn(self, sentence: np.ndarray, narrower: np.ndarray, window: int, rate: float) -> None:
        """Steps of ``PLACES`` places at a time: their contexts' vectors against the inner nodes above their words."""
        w, n = np.searchsorted(self.words, sentence), len(sentence)
        first, lengths = self.start[w], self.start[w + 1] - self.start[w]
        end = np.cumsum(lengths)
        at_flat = np.arange(end[-1]) + np.repeat(first - end + lengths, lengths)
        nodes, wanted, place = self.nodes[at_flat], self.wanted[at_flat], np.repeat(np.arange(n), lengths)
        everywhere, reach, end = np.arange(n)[:, None], window - narrower, [0, *end.tolist()]
        for a in range(0, n, PLACES):
            b, low = min(n, a + PLACES), max(0, a - window)
            contexts, node = w[low:b + window], nodes[end[a]:end[b]]
            away = np.abs(everywhere[low:b + window] - np.arange(a, b))
            near = ((away > 0) & (away <= reach[a:b])).astype(np.float32) * np.float32(rate)
            v, s = self.word_vectors[contexts], self.node_vectors[node]
            score = v @ s.T
            step = (wanted[end[a]:end[b]] - 1 / (1 + np.exp(-score))) * near[:, place[end[a]:end[b]] - a]
            if score.size and np.vdot(score, score) >= MAX_SCORE ** 2:
                step[np.abs(score) >= MAX_SCORE] = 0
            _add_rows(self.word_vectors, contexts, step @ s)
            _add_rows(self.node_vectors, node, step.T @ v)

    def rows(self, part: int) -> Iterator[pa.RecordBatch]:
        vectors = np.concatenate([self.word_vectors, self.node_vectors])
        yield from _weight_rows(part, self.ids, vectors, (vectors != self.first).any(axis=1))


def _one_pass(tree: Huffman, k: int, passes: int, parts: int, total: int, size: int, window: int, rate: float, longest: int,
              seed: int) -> Callable:
    """Train a part's vectors, which come first, on its sentences in pass ``k`` (from 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, model, random, ids, vectors = 0, None, None, [], []
        seen = last = 0
        now = rate
        for b in batches:
            if not b.num_rows:
                continue
            n = int((b.column("sentence").to_numpy() < 0).sum())
            if n:
                ids.append(b.column("id")[:n].to_numpy())
                vectors.append(b.column("vec")[:n].flatten().to_numpy().reshape(n, size))
            if n == b.num_rows:
                continue
            if model is None:
                part = b.column("part")[0].as_py()
                model = PartModel(tree, np.concatenate(ids), np.concatenate(vectors))
                random = np.random.default_rng([seed % (1 << 64), k, part])
                ids, vectors = [], []
            lists = b.column("words")[n:]
            flat, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())
            for whole in np.split(flat, ends[:-1]):
                for i in range(0, len(whole), longest):
                    sentence = whole[i:i + longest]
                    if seen - last > RATE_WORDS:
                        last = seen
                        now = max(rate * (1 - (parts * seen + k * total) / (passes * total + 1)), rate * LOWEST_RATE)
                    seen += len(sentence)
                    model.learn(sentence, random.integers(window, size=len(sentence)), window, now)
        if model is not None:
            yield from model.rows(part)

    return run


def _averaged(weights: DataFrame, size: int) -> DataFrame:
    """(id, vec, parts): the mean vector over the parts that changed it (unchanged: as it was), and the parts that hold it."""
    n = F.count_if("used")
    mean = [F.when(n > 0, F.sum(F.when(F.col("used"), F.col("vec")[i])) / n).otherwise(F.first("vec")[i]).cast("float") for i in range(size)]
    # rows are shuffled as they are: sums of single components would take more room
    return weights.repartition("id").groupBy("id").agg(F.array(*mean).alias("vec"), F.collect_list("part").alias("parts"))


class Word2Vec(feature.Word2Vec):
    """``pyspark.ml.feature.Word2Vec`` with its parameters, fitted on the executors."""

    def _fit(self, dataset: DataFrame) -> Word2VecModel:
        size, parts, passes, seed = self.getVectorSize(), self.getNumPartitions(), self.getMaxIter(), self.getSeed()
        tokens = F.col(self.getInputCol())
        counts = dataset.select(F.explode(tokens).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        counts = counts.where(F.col("n") >= self.getMinCount()).withColumn("falling", -F.col("n"))
        vocabulary = global_index(counts, ["falling", "word"], "id").select("word", "n", "id")
        by_count = {r["n"]: r["words"] for r in vocabulary.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect()}
        if not by_count:
            raise ValueError("The vocabulary size should be > 0. You may need to check the setting of minCount, "
                             "which could be large enough to remove all your words in sentences.")
        tree, total = Huffman(by_count), sum(n * words for n, words in by_count.items())
        # joins are told to merge: a broadcast would take the vocabulary through the driver
        numbered = dataset.select(F.monotonically_increasing_id().alias("sentence"), tokens.alias("words"))
        places = numbered.select("sentence", F.posexplode("words").alias("at", "word"))
        words = places.join(vocabulary.select("word", F.col("id").cast("int").alias("word_id")).hint("merge"), "word")
        coded = words.groupBy("sentence").agg(F.sort_array(F.collect_list(F.struct("at", "word_id"))).alias("s")).select(
            F.pmod(F.xxhash64("sentence"), F.lit(parts)).cast("int").alias("part"), "sentence", F.col("s.word_id").alias("words"))
        sentences = materialize(coded, name="word2vec-sentences")

        weights = materialize(sentences.select("part", "words").repartitionById(parts, "part")
                              .mapInArrow(_first_weights(tree, size, seed), _WEIGHTS), name="word2vec-weights")
        for k in range(passes):
            held = weights if k == 0 else _averaged(weights, size).select(F.explode("parts").alias("part"), "id", "vec")
            rows = held.select("part", F.lit(-1).cast("long").alias("sentence"), "id", "vec").unionByName(sentences, allowMissingColumns=True)
            one_pass = _one_pass(tree, k, passes, parts, total, size, self.getWindowSize(), self.getStepSize(),
                                 self.getMaxSentenceLength(), seed)
            weights = materialize(rows.repartitionById(parts, "part").sortWithinPartitions("part", "sentence")
                                  .mapInArrow(one_pass, _WEIGHTS), name="word2vec-weights")
        ends = _averaged(weights.where(F.col("id") < tree.size), size)
        vectors = vocabulary.join(ends.hint("merge"), "id").select("word", F.col("vec").alias("vector"))
        return Word2VecModel(materialize(vectors, name="word2vec-vectors"), size, self.getInputCol(), self.getOutputCol())


class Word2VecModel:
    """A vector per word, as a table."""

    def __init__(self, vectors: DataFrame, size: int, input_col: str, output_col: str):
        self.vectors, self.size, self.input_col, self.output_col = vectors, size, input_col, output_col

    def getVectors(self) -> DataFrame:
        return self.vectors.select("word", array_to_vector(F.col("vector").cast("array<double>")).alias("vector"))

    def findSynonyms(self, word: str | Vector, num: int) -> DataFrame:
        """The ``num`` words most alike by cosine (a zero vector: 0), without ``word`` itself; ties by word."""
        others = self.vectors
        if isinstance(word, str):
            found = others.where(F.col("word") == word).select("vector").first()
            if found is None:
                raise ValueError(f"{word} not in vocabulary")
            query, others = np.array(found[0]), others.where(F.col("word") != word)
        else:
            query = word.toArray()
        length = float(np.linalg.norm(query)) or 1.0
        x = [F.col("vector")[i].cast("double") for i in range(self.size)]
        dot, norm = sum(c * float(q / length) for c, q in zip(x, query, strict=True)), F.sqrt(sum(c * c for c in x))
        alike = F.when(norm > 0, dot / norm).otherwise(0.0).alias("similarity")
        return others.select("word", alike).orderBy(F.desc("similarity"), "word").limit(num)

    def transform(self, dataset: DataFrame) -> DataFrame:
        """Each row with the mean vector of its words; unknown words count as zeros."""
        rows = materialize(dataset.withColumn("__row", F.monotonically_increasing_id()), name="word2vec-rows")
        n = F.size(self.input_col)
        words = rows.select("__row", n.alias("__n"), F.explode(self.input_col).alias("word")).join(self.vectors.hint("merge"), "word")
        means = words.groupBy("__row").agg(F.array(*[F.sum(F.col("vector")[i].cast("double")) / F.first("__n")
                                                     for i in range(self.size)]).alias("__mean"))
        zeros = F.array_repeat(F.lit(0.0), self.size)
        out = array_to_vector(F.coalesce("__mean", zeros)).alias(self.output_col)
        return rows.join(means, "__row", "left").select(*dataset.columns, out)
