"""Training-corpus pipeline: from raw documents to packed windows.

Every stage is a function (spark, docs, sf_dir) → DataFrame; its result is
written as Parquet and reread as the next stage's ``docs``. The filtering
stages return the columns of ``docs``; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm import exact_dedup, ngram_join, packing, quality_model, toxicity
from cohortkit.llm.common import read_docs, stage
from cohortkit.llm.queries import tokenizer_file

#: Scores from which a document counts as good, and as toxic.
GOOD_FROM = 0.3
TOXIC_FROM = 0.3


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """The wanted column names, lengthened until no column of ``taken`` has them."""
    used = {c.lower() for c in taken}
    out = []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def kept_rows(docs: DataFrame, judged: DataFrame, digest, name: str) -> DataFrame:
    """The rows of ``docs`` that ``judged`` (doc_id, sha, keep; one row each) keeps; a row is known by doc_id and digest.

    Rows that agree in both are copies, of which one stays if any is kept.
    Only the keys that lose rows are written and joined; their table grows
    with the corpus, so the join is a merge join at every size. ``docs`` may
    have columns of any name.
    """
    odd_id, odd_sha, own_sha = free_names(docs.columns, "odd_id", "odd_sha", "own_sha")
    keys = judged.groupBy("doc_id", "sha").agg(F.max("keep").alias("keep"), F.count(F.lit(1)).alias("n"))
    odd = stage(keys.where("not keep or n > 1").select(F.col("doc_id").alias(odd_id), F.col("sha").alias(odd_sha), "keep"), name)
    met = docs["doc_id"].eqNullSafe(odd[odd_id]) & (digest == odd[odd_sha])
    out = docs.join(odd.select(odd_id, odd_sha).hint("merge"), met, "left_anti")
    again = odd.where("keep").select(odd_id, odd_sha)
    if not again.isEmpty():
        out = out.unionByName(docs.join(again, met, "left_semi").withColumn(own_sha, digest).dropDuplicates(["doc_id", own_sha]).drop(own_sha))
    return out


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it is fitted on the labelled ones among ``docs``.

    Every row is judged by its text: a null text as an empty one, repeated
    rows alike. Without a labelled document every score is 0.5, so all stay.
    An empty table stays empty; all columns, whatever their names, pass through.
    """
    model = quality_model.fit_quality(docs, read_docs(spark, sf_dir, "labels"))
    return docs.where(quality_model.quality_score(model, docs["text"]) >= GOOD_FROM)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity scan lets pass; it is fitted on the labelled ones among ``docs``.

    Nulls, repeats, empty tables and further columns as in :func:`quality`;
    without a labelled toxic document nothing is toxic, so all stay.
    """
    model = toxicity.fit_toxicity(docs, read_docs(spark, sf_dir, "labels"))
    return docs.where(toxicity.toxic_score(model, docs["text"]) < TOXIC_FROM)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the smallest doc_id.

    A null text equals an empty one; a null doc_id comes after all others; of
    rows equal in doc_id and text one stays. Further columns pass through.
    """
    groups = exact_dedup.exact_duplicates(docs).select("doc_id", F.col("text_sha256").alias("sha"), F.col("kept").alias("keep"))
    digest = F.sha2(exact_dedup.normalised(F.coalesce(docs["text"], F.lit(""))), 256)
    return kept_rows(docs, groups, digest, "pipeline-exact")


def distinct_ngrams(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (five-word n-grams, similarity 0.8): the smallest doc_id.

    Texts without words are near nothing and stay; null doc_ids, repeats and
    further columns as in :func:`distinct_texts`.
    """
    digest = F.sha2(F.coalesce(docs["text"], F.lit("")), 256)
    classes = ngram_join.link_classes(docs.select("doc_id", "text", digest.alias("sha")), n=5, percent=80, carry="sha")
    return kept_rows(docs, classes.select("doc_id", "sha", F.col("first").alias("keep")), digest, "pipeline-near")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 1024 tokens; a null or empty text is its end token alone, an empty table gives no piece."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("quality_model", quality),
    ("toxicity", clean),
    ("exact_dedup", distinct_texts),
    ("ngram_join", distinct_ngrams),
    ("packing", packed),
]

#: The classifiers cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_docs(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}-out")
    return STAGES[-1][1](spark, docs, sf_dir)
