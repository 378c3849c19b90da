"""Text jobs over a notes table: tokens, windows of token ids, pattern entities, mean vectors.

Every operator processes whole texts: tokens come from ``split`` on the full
lower-cased text, entities from ``regexp_extract_all`` over the full text,
and fixed-length model inputs are produced as consecutive windows covering
all tokens (never a prefix). Per-document work needs no shuffle; only counts
over the corpus aggregate (with map-side partial aggregation).

Regular expressions use ASCII classes only, so the JVM and other regex
engines (e.g. RE2) agree on every match.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.functions.scalar import col_of, pad_array
from cohortkit.operators.features import global_index
from cohortkit.operators.termblocks import TermBlocks
from cohortkit.sources.io import stage_path

# The tokeniser's separator and the entity pattern table.
TOKEN_SPLIT = "[^a-z0-9]+"
ENTITY_PATTERNS = (
    ("PHONE", r"[0-9]{3}-[0-9]{4}"),
    ("EMAIL", r"[A-Za-z0-9._]+@[A-Za-z0-9]+\.[A-Za-z]+"),
    ("CAPITALISED", r"[A-Z][a-z]+"),
    ("NUMBER", r"[0-9]+"),
)


def tokens(text) -> Column:
    """Lower-case word tokens of the whole text (empty pieces dropped)."""
    return F.filter(F.split(F.lower(col_of(text)), TOKEN_SPLIT), lambda t: t != "")


def token_counts(df: DataFrame, text: str, name: str = "token", count: str = "n") -> DataFrame:
    """Corpus frequency of every token."""
    return df.select(F.explode(tokens(text)).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias(count))


def token_id(tok, vocab: int) -> Column:
    """Stable id 1..vocab for a token from its md5 (0 is reserved for padding)."""
    h = F.conv(F.substring(F.md5(col_of(tok)), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(vocab)) + 1


def token_windows(df: DataFrame, key: str, text: str, size: int, vocab: int) -> DataFrame:
    """All tokens of each text as consecutive ``size``-long windows of ids, zero-padded.

    Output: key, chunk (0-based window number), ids, mask (1 = real token), n_tokens.
    Windows are cut from each row's own id array (``slice`` per window, then
    ``posexplode``), so the operator is a narrow map: no token is shuffled
    and ids are hashed once per token.
    """
    ids = F.transform(tokens(text), lambda t: token_id(t, vocab))
    per_doc = df.select(key, ids.alias("_ids"))
    n = F.size("_ids")
    windows = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.ceil(n / size).cast("int") - 1),
                                        lambda w: F.slice(F.col("_ids"), w * size + 1, size))) \
        .otherwise(F.array().cast("array<array<bigint>>"))
    exploded = per_doc.select(key, F.posexplode(windows).alias("chunk", "_w"))
    m = F.size("_w")
    mask = F.transform(F.sequence(F.lit(1), F.lit(size)), lambda i: F.when(i <= m, 1).otherwise(0))
    return exploded.select(key, F.col("chunk").cast("bigint").alias("chunk"),
                           pad_array("_w", size, 0).alias("ids"), mask.alias("mask"), m.alias("n_tokens"))


def _entity_arrays(text: str, patterns: Sequence[tuple[str, str]]) -> Column:
    return F.array(*[F.struct(F.lit(label).alias("label"),
                              F.regexp_extract_all(F.col(text), F.lit(pat), 0).alias("m"))
                     for label, pat in patterns])


def entity_label_counts(df: DataFrame, text: str, patterns=ENTITY_PATTERNS) -> DataFrame:
    """Number of matches per entity label over all texts (one pass over the text)."""
    per = df.select(F.explode(_entity_arrays(text, patterns)).alias("e"))
    return per.groupBy(F.col("e.label").alias("label")).agg(F.sum(F.size("e.m")).cast("bigint").alias("n"))


def entities(df: DataFrame, key: str, text: str, patterns=ENTITY_PATTERNS) -> DataFrame:
    """(key, label, idx, entity) for every match of every pattern."""
    per = df.select(key, F.explode(_entity_arrays(text, patterns)).alias("e"))
    return per.select(key, F.col("e.label").alias("label"),
                      F.posexplode("e.m").alias("idx", "entity"))


def entity_corpus(df: DataFrame, key: str, text: str, patterns=ENTITY_PATTERNS) -> DataFrame:
    """Entity strings of each text in order of appearance (one alternation pattern)."""
    combined = "|".join(p for _, p in patterns)
    return df.select(key, F.regexp_extract_all(F.col(text), F.lit(combined), 0).alias("entities"))


def word_steps(word, dims: int) -> Column:
    """A deterministic ``dims``-d vector of whole numbers -128..127 from the md5 of a word (in steps of 1/127)."""
    h = F.md5(col_of(word))
    return F.transform(F.sequence(F.lit(0), F.lit(dims - 1)),
                       lambda i: F.conv(F.substring(h, i * 2 + 1, 2), 16, 10).cast("long") - 128)


def word_counts(df: DataFrame, key: str, text: str, word: str = "word") -> DataFrame:
    """(key, word, n): how often each text has each token; a text without tokens has one null word."""
    return df.select(key, F.explode_outer(tokens(text)).alias(word)).groupBy(key, word).agg(F.count(F.lit(1)).alias("n"))


def mean_of_counts(counts: DataFrame, key: str, table: DataFrame, dims: int, word: str = "word",
                   vector: str = "vector", digits: int = 6, steps: int = 1) -> DataFrame:
    """Mean vector of each text of ``word_counts``; unknown and null words count as zeros.

    Entries of ``vector`` are in units of 1 / ``steps``. Whole numbers are summed
    exactly and divided once, so the mean does not depend on the summing order.
    """
    j = counts.join(table.select(word, vector), word, "left")
    total = F.sum("n") * steps
    means = [F.coalesce(F.sum(F.col("n") * F.col(vector)[i]), F.lit(0)) / total for i in range(dims)]
    return j.groupBy(key).agg(F.array(*[F.round(m, digits) for m in means]).alias("mean_vector"))


def mean_word_vectors(df: DataFrame, key: str, text: str, table: DataFrame, dims: int,
                      word: str = "word", vector: str = "vector", digits: int = 6) -> DataFrame:
    """Mean of the word vectors of each text's tokens; unknown words and empty texts count as zeros."""
    return mean_of_counts(word_counts(df, key, text, word), key, table, dims, word, vector, digits)


def tag_with(df: DataFrame, tagger, schema: str) -> DataFrame:
    """Extension point for a user's own entity tagger (e.g. a statistical NER model).

    ``tagger`` maps a pandas DataFrame batch of ``df`` rows to a pandas
    DataFrame with ``schema``; Spark feeds it Arrow batches per partition
    (``mapInPandas``), so the model is loaded once per task, not per row.
    """
    def run(batches):
        for b in batches:
            yield tagger(b)

    return df.mapInPandas(run, schema)


def tfidf_terms(df: DataFrame, key: str, text: str, digits: int = 6, listed: bool = False) -> DataFrame | tuple[DataFrame, DataFrame]:
    """TF-IDF of every (document, term): ``key``, term, tf, df, weight = tf · ln((N + 1) / (df + 1)).

    The sparse vectors in long form, over the whole vocabulary (terms are not
    hashed into buckets); N counts all rows, texts without tokens included.
    Terms are counted in blocks of documents (:mod:`cohortkit.operators.termblocks`),
    so no (document, term) row is shuffled. Rows of the same ``key`` are one document.

    ``listed``: ((key, entries), (term, df, idx)) instead, one row per row of
    ``df`` with its key's (idx, weight) in the order of idx, and the vocabulary in sorted
    order; a null key has no entries.
    """
    blocks = TermBlocks(df, key, text, tokens(text))

    def weight(tf: Column, freq: Column) -> Column:
        return F.round(tf * F.log((F.lit(blocks.rows) + 1) / (freq + 1)), digits).alias("weight")

    if listed:
        entries = F.transform("entries", lambda e: F.struct(e["idx"].alias("idx"), weight(e["tf"], e["df"])))
        return blocks.lists().select(key, entries.alias("entries")), blocks.vocabulary
    return blocks.counts().select(key, "term", "tf", "df", weight(F.col("tf"), F.col("df")))


def sparse_vectors(docs: DataFrame, key: str, weights: DataFrame, term: str = "term", weight: str = "weight",
                   vocabulary: DataFrame | None = None, listed: str | None = None) -> tuple[DataFrame, DataFrame]:
    """((key, features), (term, idx)): one sparse vector per row of ``docs`` from (key, term, weight) rows.

    The vocabulary is every term of ``weights`` in sorted order, numbered over
    range partitions (no term is hashed or cut), or the given one of an
    earlier fit, whose unknown terms are left out. A term that most texts hold
    is one key of the join to it; AQE splits that key's rows. A row of ``docs``
    without terms has an empty vector. ``key`` must be unique. Vectors are
    written once as (type, size, indices, values) and read back as Spark ML
    vectors, so no Python runs.

    ``listed`` names a column of ``weights`` that has the (idx, weight) of a row
    by the number in ``vocabulary``, with a row for each row of ``docs``: what
    ``tfidf_terms`` gives when listed. Then nothing is joined.
    """
    if listed is not None:
        return _written_vectors(docs, key, weights.select(key, F.col(listed).alias("__l")), vocabulary.count(), weight), vocabulary
    if vocabulary is None:
        vocabulary = global_index(weights.select(term).where(F.col(term).isNotNull()).distinct(), [term], "idx")
    numbered = weights.select(F.col(key).alias("__key"), F.col(term).alias("__term"), F.col(weight).cast("double").alias("__w")).join(
        vocabulary.select(F.col(term).alias("__term"), F.col("idx").cast("int").alias("idx")), "__term")
    lists = numbered.groupBy("__key").agg(F.array_sort(F.collect_list(F.struct("idx", "__w"))).alias("__l"))
    return _written_vectors(docs, key, docs.join(lists, docs[key] == lists["__key"], "left").select(docs[key], "__l"), vocabulary.count(), "__w"), vocabulary


def _written_vectors(docs: DataFrame, key: str, rows: DataFrame, size: int, weight: str) -> DataFrame:
    entries = F.coalesce("__l", F.array().cast(rows.schema["__l"].dataType))
    path = stage_path(docs.sparkSession, "sparse-vectors")
    rows.select(key, F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), F.transform(entries, lambda e: e["idx"]).alias("indices"),
        F.transform(entries, lambda e: e[weight]).alias("values")).alias("features")).write.parquet(path)
    schema = T.StructType([docs.schema[key], T.StructField("features", VectorUDT())])
    return docs.sparkSession.read.schema(schema).parquet(path)
