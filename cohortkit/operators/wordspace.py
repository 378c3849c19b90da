"""Words as vectors: lookup, neighbours of many words at once, projections by landmarks.

* ``lookup`` is a join on the word; a word without a vector has its own row.
* ``neighbours`` compares a stated set of query words with all words in
  blocks: a block of queries and a block of words share a key of two block
  numbers, a task multiplies the two matrices and passes on the best k of
  each query. No task holds more than one block of each side.
* ``landmark_projection`` maps any number of vectors by classical scaling of a
  bounded number of landmarks; every other vector is placed by its distances
  to them, row by row.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Functions sent to tasks travel by value: executors need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _matrix(column) -> np.ndarray:
    col = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(col.flatten(), dtype=np.float64).reshape(len(col), -1)


def lookup(vectors: DataFrame, words: DataFrame, word: str = "word", vector: str = "vector") -> DataFrame:
    """(word, found, vector) for each row of ``words``; a word without a vector is not found and has a null one."""
    table = vectors.select(F.col(word).alias("__w"), F.col(vector).alias("__v")).where(F.col("__v").isNotNull())
    j = words.select(word).join(table, F.col(word) == F.col("__w"), "left")
    return j.select(word, F.col("__w").isNotNull().alias("found"), F.col("__v").alias(vector))


def neighbours(vectors: DataFrame, queries: DataFrame, k: int = 10, word: str = "word", vector: str = "vector", digits: int = 6,
               block: tuple[int, int] = (8192, 512)) -> DataFrame:
    """(query, rank, word, similarity): the ``k`` words nearest to each query word by cosine, itself left out.

    Similarities are rounded to ``digits`` before they are ranked, ties by
    word; a zero vector is at similarity 0 to every other. ``vectors`` has one
    row per word; a query that has no vector gives one row with null rank,
    word and similarity; a query asked twice is answered once. Vectors must
    have the same length.
    """
    asked = lookup(vectors, queries.select(word).where(F.col(word).isNotNull()).distinct(), word, vector)
    known = asked.where("found").select(F.col(word).alias("query"), F.col(vector).cast("array<double>").alias("v"))
    cands = vectors.where(F.col(word).isNotNull() & F.col(vector).isNotNull()).select(F.col(word).alias("w"), F.col(vector).cast("array<double>").alias("v"))
    blocks, asked_blocks = (max(1, -(-df.count() // size)) for df, size in zip((cands, known), block, strict=True))
    own = lambda df, c, at, n: df.withColumn(at, F.pmod(F.xxhash64(c), F.lit(n)))                    # noqa: E731
    every = lambda df, at, n: df.withColumn(at, F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>")))
    left = every(own(cands, "w", "blk", blocks), "qblk", asked_blocks).groupBy("blk", "qblk")
    right = every(own(known, "query", "qblk", asked_blocks), "blk", blocks).groupBy("blk", "qblk")

    def best(cands: pa.Table, asked: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query": [], "word": [], "similarity": []}
        if len(cands) and len(asked):
            cands = cands.sort_by("w")
            words, names = cands["w"].to_pylist(), asked["query"].to_pylist()
            a, b = _matrix(asked["v"]), _matrix(cands["v"])
            norm = np.sqrt((a * a).sum(axis=1))[:, None] * np.sqrt((b * b).sum(axis=1))[None, :]
            near = np.round(np.divide(a @ b.T, norm, out=np.zeros_like(norm), where=norm > 0), digits)
            for q, row in zip(names, near, strict=True):
                order = [i for i in np.argsort(-row, kind="stable")[:k + 1].tolist() if words[i] != q][:k]
                out["query"] += [q] * len(order)
                out["word"] += [words[i] for i in order]
                out["similarity"] += [float(row[i]) for i in order]
        return pa.table(out, schema=pa.schema([("query", pa.string()), ("word", pa.string()), ("similarity", pa.float64())]))

    met = left.cogroup(right).applyInArrow(best, "query string, word string, similarity double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("similarity"), "word"))
    ranked = met.withColumn("rank", rank).where(F.col("rank") <= k).select("query", "rank", F.col("word").alias("word"), "similarity")
    missing = asked.where("not found").select(F.col(word).alias("query"), F.lit(None).cast("int").alias("rank"),
                                              F.lit(None).cast("string").alias("word"), F.lit(None).cast("double").alias("similarity"))
    return ranked.unionByName(missing)


def landmark_projection(vectors: DataFrame, key: str, vector: str, k: int, landmarks: int = 200, digits: int = 6, seed: str = "42") -> DataFrame:
    """``vectors`` with ``x1`` .. ``xk``: classical scaling of the landmarks' distances, all others placed by theirs.

    Landmarks are the ``landmarks`` rows whose keys hash smallest (md5), so the
    same ones are chosen on any layout; only they reach the driver. With as many landmarks as rows
    this is classical scaling of all distances. Each axis points to where its
    largest landmark entry is positive. Missing axes (fewer than ``k``
    positive eigenvalues) are 0; a null vector has null coordinates. Vectors
    must have the same length.
    """
    mark = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))
    held = vectors.where(F.col(vector).isNotNull()).select(F.col(vector).cast("array<double>").alias("v"), mark.alias("m"), F.col(key).alias("k"))
    rows = held.orderBy("m", "k").limit(landmarks).collect()
    points = np.array([r["v"] for r in rows], dtype=np.float64).reshape(len(rows), len(rows[0]["v"]) if rows else 0)
    place = np.zeros((k, len(rows)))
    square = ((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2)
    mean = square.mean(axis=0) if len(rows) else np.zeros(0)
    if len(rows):
        centred = np.eye(len(rows)) - 1.0 / len(rows)
        values, axes = np.linalg.eigh(-0.5 * centred @ square @ centred)
        for i, j in enumerate(np.argsort(-values, kind="stable")[:k]):
            if values[j] > 1e-9 * max(values.max(), 1e-300):
                axis = axes[:, j] * np.sign(axes[np.abs(axes[:, j]).argmax(), j])
                place[i] = axis / np.sqrt(values[j])
    sent = vectors.sparkSession.sparkContext.broadcast((points, mean, place))

    @F.arrow_udf("array<double>")
    def placed(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        points, mean, place = sent.value
        for part in parts:
            here = np.flatnonzero(np.asarray(part.is_valid()))
            out: list = [None] * len(part)
            if len(here):
                v = _matrix(part.drop_null())
                square = (v * v).sum(axis=1)[:, None] - 2 * v @ points.T + (points * points).sum(axis=1)[None, :]
                for i, x in zip(here.tolist(), -0.5 * (square - mean) @ place.T, strict=True):
                    out[i] = x.tolist()
            yield pa.array(out, pa.list_(pa.float64()))

    out = vectors.withColumn("__x", placed(F.col(vector).cast("array<double>")))
    return out.select(*vectors.columns, *[F.round(F.get("__x", F.lit(i)), digits).alias(f"x{i + 1}") for i in range(k)])
