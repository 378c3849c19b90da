"""Bounded samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold_of(id_col, folds: int):
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, max_rows: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Training rows (id, text, y): at most ``max_rows`` ids, taken by hash order, and as many rows.

    Only ids whose fold is not ``held_out``. Several labels of one id count as
    their maximum; null labels are left out. Of the rows of one id the text
    with the smallest digest stays, of equal texts the smallest id with the
    largest label: a copied id or text is one witness, else its own words
    would stand out. The id list (two numbers a row, ``max_rows`` at most) is
    what is broadcast; sampled texts alone are shuffled, one an id and task.
    """
    ids = (labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"))
           .where(F.col("id").isNotNull() & F.col("y").isNotNull()).where(fold_of("id", folds) != held_out)
           .groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(max_rows))
    rows = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
            .join(F.broadcast(ids), "id").withColumn("sha", F.sha2("text", 256)))
    rows = rows.groupBy("id").agg(F.max("y").alias("y"), F.min("sha").alias("sha"), F.min_by("text", "sha").alias("text"))
    return rows.groupBy("sha").agg(F.min("id").alias("id"), F.max("y").alias("y"), F.first("text").alias("text")).drop("sha")
