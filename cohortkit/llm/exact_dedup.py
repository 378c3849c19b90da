"""Exact deduplication by content-defined chunk recipes.

Each normalised text is cut where its content says so (after the end of a
sentence, once a chunk has ``min_chars``; at ``max_chars`` at the latest), so
equal passages give equal chunks wherever they stand. A chunk is known by a
64-bit fingerprint; the chunk dictionary compares the SHA-256 digests behind
each fingerprint, and a fingerprint that stands for two different chunks is
split into numbered identifiers. A document is then its ordered list of
verified identifiers, and documents are compared by those lists: no text moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.common import stage, text_of

# A run of white space other than one plain space becomes one space (a single space already is one).
SPACE_RUN = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"


def normalised(text):
    """Each run of ASCII white space as one space."""
    return F.regexp_replace(text, SPACE_RUN, " ")


def chunk_pattern(min_chars: int, max_chars: int) -> str:
    """Shortest piece of at least ``min_chars`` ending after a sentence, else ``max_chars`` or the rest."""
    return rf"(?s).{{{min_chars},{max_chars}}}?[.!?。] |.{{1,{max_chars}}}"


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     min_chars: int = 512, max_chars: int = 8192, fingerprint=None) -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept, text_sha256, n_chunks.

    Texts are equal when identical after white-space normalisation; null
    counts as empty, and all empty texts are one group. Of equal texts the row
    with the smallest id stays (a null id loses against any other; of rows
    that share the smallest id exactly one stays). Other columns are ignored.
    ``fingerprint`` (column → bigint column) replaces the 64-bit chunk
    fingerprint; a poor one costs time, never correctness.
    """
    fp = fingerprint or (lambda c: F.xxhash64(c))
    norm = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), normalised(text_of(docs, text_col)).alias("t"))
    cut = norm.select("rid", "id", F.sha2("t", 256).alias("text_sha256"),
                      F.regexp_extract_all("t", F.lit(chunk_pattern(min_chars, max_chars)), F.lit(0)).alias("chunks"))
    recipes = stage(cut.select(
        "rid", "id", "text_sha256",
        F.transform("chunks", lambda c: F.struct(fp(c).alias("fp"), F.unhex(F.sha2(c, 256)).alias("sha"))).alias("recipe")),
        "recipes")

    chunk = recipes.select("rid", F.posexplode("recipe").alias("pos", "c")).select("rid", "pos", "c.fp", "c.sha")
    entries = chunk.groupBy("fp", "sha").agg(F.count(F.lit(1)).alias("n"))
    # the dictionary: a fingerprint with several digests gets one ordinal per digest, in digest order
    clash = (entries.withColumn("ord", F.row_number().over(Window.partitionBy("fp").orderBy("sha")) - 1)
             .withColumn("texts", F.count(F.lit(1)).over(Window.partitionBy("fp")))
             .where("texts > 1 and ord > 0").select("fp", "sha", "ord"))
    clash = stage(clash, "chunk-clashes")
    renumbered = (chunk.join(clash, ["fp", "sha"])
                  .groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("pos", "ord"))).alias("ords")))
    lists = (recipes.join(renumbered, "rid", "left")
             .select("rid", "id", "text_sha256", F.size("recipe").cast("long").alias("n_chunks"),
                     F.transform("recipe", lambda c, i: F.struct(
                         c["fp"].alias("fp"),
                         F.coalesce(F.element_at("ords", i), F.lit(0)).alias("ord"))).alias("ids")))
    lists = stage(lists, "recipe-ids")
    key = F.struct(F.col("id").isNull().alias("no_id"), "id", "rid")
    # written before the join back: a group that holds much of the table is then a skewed join that AQE splits
    groups = stage(lists.groupBy("ids").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("group_size"))
                   .where("group_size > 1"), "recipe-groups")
    return (lists.join(groups, "ids", "left")
            .select(F.col("id").alias(id_col),
                    F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    F.coalesce(F.col("rid") == F.col("first.rid"), F.lit(True)).alias("kept"),
                    "text_sha256", "n_chunks"))
