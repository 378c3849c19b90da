"""Line dedup: lines that many documents share go from every document.

Lines are exploded into digests of their normalised form, documents are
counted per digest, and the lines of frequent digests are dropped. Only
digests travel for counting; a text moves once, to meet the short list of its
own frequent digests, and is put together again in line order.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import drop_stage, stage, text_of

BLANK = b" \t\n\x0b\x0c\r"


def line_digests(text: bytes, min_chars: int) -> list[bytes | None]:
    """128-bit digest of each line's key (outer ASCII white space off, A-Z lower-cased); None for shorter keys."""
    out = []
    for line in text.split(b"\n"):
        key = line.strip(BLANK).lower()         # bytes.lower changes A-Z only
        long = len(key) >= min_chars and (min_chars <= 1 or sum(b & 0xC0 != 0x80 for b in key) >= min_chars)
        out.append(blake2b(key, digest_size=16).digest() if long else None)
    return out


def _bytes(column: pa.Array) -> Iterator[bytes]:
    return (x.as_buffer().to_pybytes() for x in column.cast(pa.binary()))


def exploded(rows: DataFrame, min_chars: int) -> DataFrame:
    """(id, t, h) of rows (id, t, text): each digest that a text has, once a row."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, found = [], []
            for i, text in enumerate(_bytes(b.column(2))):
                mine = {h for h in line_digests(text, min_chars) if h}
                at += [i] * len(mine)
                found += mine
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(found, pa.binary())], ["id", "t", "h"])

    return rows.select("id", "t", "text").mapInArrow(run, f"id {kind}, t bigint, h binary")


def reassembled(rows: DataFrame, min_chars: int) -> DataFrame:
    """(id, n_lines, n_dropped, kept) of rows (id, text, gone): the text without the lines whose digest is in ``gone``."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, dropped, kept = [], [], []
            for text, gone in zip(_bytes(b.column(1)), b.column(2).to_pylist(), strict=True):
                lines = text.split(b"\n")
                left = lines
                if gone:
                    gone = set(gone)
                    left = [line for line, h in zip(lines, line_digests(text, min_chars), strict=True) if h not in gone]
                n.append(len(lines))
                dropped.append(len(lines) - len(left))
                kept.append(b"\n".join(left))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], ["id", "n_lines", "n_dropped", "kept"])

    return rows.select("id", "text", "gone").mapInArrow(run, f"id {kind}, n_lines bigint, n_dropped bigint, kept string")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
                min_chars: int = 1) -> DataFrame:
    """One row per input row: ``id_col``, n_lines (before dropping), n_dropped, kept (the text that stays).

    A text is cut at ``\\n``; a line's key is the line without ASCII white
    space at both ends, A-Z lower-cased. Keys of at least ``min_chars`` code
    points that occur in at least ``min_docs`` documents lose all their lines
    everywhere; the other lines stay, joined by ``\\n``.

    A null or empty text is one empty line, which stays. Repeats inside a
    document count once; rows with the same id are one document, rows without
    an id are told apart by their texts. Ties do not arise. An empty table
    gives an empty result; other columns are ignored, whatever their names.
    """
    text = text_of(docs, text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("t"), text.alias("text"))
    lines = stage(exploded(rows, min_chars), "lines-all")

    # counting rows first leaves few digests for the exact count of documents
    # (the digests are written, so that a join on them can split the rows of a very common one)
    often = stage(lines.groupBy("h").count().where(F.col("count") >= min_docs).select("h"), "lines-often")
    held = stage(lines.join(often, "h").select("id", "t", "h"), "lines-held")
    drop_stage(lines)
    who = F.when(F.col("id").isNull(), F.col("t"))
    frequent = stage(held.select("h", "id", who.alias("who")).distinct().groupBy("h").count()
                     .where(F.col("count") >= min_docs).select("h"), "lines-frequent")

    # (id, t) names a row's text; were two texts of an id to share t, their common list would still fit both,
    # as a digest is frequent or not in all documents alike
    gone = (held.join(frequent, "h").groupBy("id", "t").agg(F.collect_set("h").alias("gone"))
            .select(F.col("id").alias("gone_id"), F.col("t").alias("gone_t"), "gone"))
    met = rows.join(gone, rows["id"].eqNullSafe(F.col("gone_id")) & (rows["t"] == F.col("gone_t")), "left")
    return reassembled(met, min_chars).withColumnRenamed("id", id_col)
