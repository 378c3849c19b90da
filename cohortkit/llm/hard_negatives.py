"""Hard-negative mining with Four-Russians scoring.

Scores are integer inner products, taken without a multiplication. Eight
dimensions form a group: for an anchor a table holds the sums of all 256
subsets of its eight components. Candidates are packed once into bit planes
(bit k of eight components is one byte); a byte looks its subset sum up, and
the planes are shifted and added into the exact score.

Anchors are a stated query set and meet all rows in blocks: a block of
anchors and a block of candidates share a key of two block numbers, so a task
holds one block of each and passes on a few rows per anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.common import stage

#: Components are kept within this size, so that sums of 4,096 dimensions fit 63 bits.
LARGEST = 1 << 22
#: Candidates and anchors scored at once (the tables and sums of a step stay in the processor's cache).
STEP = (2048, 128)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width`` numbers; shorter lists are filled with zeros."""
    col = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(np.asarray(col.offsets))
    out = np.zeros((len(col), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = np.asarray(col.flatten())
    return out


def planes(q: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of ``q`` (rows × dimensions, a multiple of eight) in two's complement: rows × bits × bytes."""
    return np.stack([np.packbits(((q >> k) & 1).astype(np.uint8), axis=1, bitorder="little") for k in range(bits)], axis=1)


def subset_sums(q: np.ndarray, dtype) -> np.ndarray:
    """Groups × 256 × rows: per row the sum of each subset of its eight components of a group."""
    parts = q.T.reshape(-1, 8, len(q)).astype(dtype)
    out = np.zeros((len(parts), 256, len(q)), dtype=dtype)
    for i in range(8):
        out[:, 1 << i:2 << i] = out[:, :1 << i] + parts[:, i, None]
    return out


def scores(packed: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products, anchors × candidates, of packed candidates and plain anchors."""
    n, bits, groups = packed.shape
    most = int(np.abs(anchors).sum(axis=1).max(initial=0)) << max(bits - 1, 0)
    dtype = np.int32 if most < 1 << 30 else np.int64
    out = np.empty((len(anchors), n), dtype=dtype)
    for a in range(0, len(anchors), STEP[1]):
        table = subset_sums(anchors[a:a + STEP[1]], dtype)
        for c in range(0, n, STEP[0]):
            block = np.ascontiguousarray(packed[c:c + STEP[0]].transpose(1, 2, 0))
            total = np.zeros((block.shape[2], table.shape[2]), dtype=dtype)
            found = np.empty_like(total)
            for k in reversed(range(bits)):         # the highest plane is the sign: it counts negative
                total <<= 1
                for g in range(groups):
                    np.take(table[g], block[k, g], axis=0, out=found)
                    total = np.subtract(total, found, out=total) if k == bits - 1 else np.add(total, found, out=total)
            out[a:a + STEP[1], c:c + STEP[0]] = total.T
    return out


def _ranked(score: np.ndarray, where: np.ndarray) -> np.ndarray:
    """The candidates ``where``, best score first; those come in order of their ids, which settles ties."""
    return where[np.argsort(-score[where].astype(np.int64), kind="stable")]


def _by_id(cands: pa.Table) -> pa.Table:
    return cands.sort_by([("id", "ascending"), ("rid", "ascending")])      # null ids come last


def pack(rows: DataFrame, width: int, bits: int) -> DataFrame:
    """(rid, id, label, planes) of (rid, id, label, q)."""
    kind = rows.schema["id"].dataType.simpleString(), rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = planes(matrix(b.column(3), width), bits)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([r.tobytes() for r in flat], pa.binary())], ["rid", "id", "label", "planes"])

    return rows.select("rid", "id", "label", "q").mapInArrow(run, f"rid bigint, id {kind[0]}, label {kind[1]}, planes binary")


def _unpacked(cands: pa.Table, width: int, bits: int) -> np.ndarray:
    return np.frombuffer(b"".join(cands["planes"].to_pylist()), dtype=np.uint8).reshape(len(cands), bits, width // 8)


def mine_negatives(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", scale: float = 256.0, n_positives: int = 5, n_negatives: int = 3,
                   low: int = 50, high: int = 95, block: tuple[int, int] = (4096, 1024)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components x become floor(scale · x); a score is the integer inner product
    with the anchor, better scores come first, ties by smaller id. ``anchors``
    is a predicate on the input's columns. A positive is one of an anchor's
    ``n_positives`` best other rows of its label; ranked negatives are the
    ``n_negatives`` best rows of other labels whose score lies within ``low``
    and ``high`` percent of the positive's.

    Rows with a null label, a null vector, or a null or non-finite component
    take no part. A null id comes after every other one in ties. Vectors of
    different lengths are filled with zeros; an empty one scores 0. Rows that
    agree in id, label and floored vector count once. Floored components
    beyond ±2^22 count as ±2^22. An anchor without positives, and a positive
    without negatives in its range, gives no row; an empty table gives none.
    Other columns are ignored. ``block`` is the number of candidates and of
    anchors that meet in a task.
    """
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    floored = F.transform(v, lambda x: F.floor(F.greatest(F.least(x.cast("double") * F.lit(scale), F.lit(float(LARGEST))), F.lit(-float(LARGEST)))))
    rows = (vectors.where(F.col(label_col).isNotNull() & v.isNotNull()).where(finite)
            .select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), floored.alias("q"),
                    F.coalesce(anchors, F.lit(False)).alias("is_anchor")).distinct())
    rows = stage(rows.withColumn("rid", F.monotonically_increasing_id()), "negatives-rows")
    one = F.count(F.lit(1))
    own = F.sum(F.col("is_anchor").cast("bigint"))
    per_label = rows.groupBy("label").agg(one.alias("n"), own.alias("a"))
    n, n_anchors, most, most_anchors = per_label.agg(F.sum("n"), F.sum("a"), F.max("n"), F.max("a")).first()
    dims, least, largest = rows.agg(F.max(F.size("q")), F.min(F.array_min("q")), F.max(F.array_max("q"))).first()
    width = max(8, -(-(dims or 0) // 8) * 8)
    bits = max(int(least or 0).bit_length(), int(largest or 0).bit_length()) + 1

    cands = stage(pack(rows, width, bits), "negatives-planes")
    asked = rows.where("is_anchor").select("rid", "id", "label", "q")
    kind = rows.schema["id"].dataType.simpleString()

    def met(asked: DataFrame, keys: list[str], n: int | None, n_asked: int | None, task, schema: str) -> DataFrame:
        blocks, asked_blocks = (max(1, -(-(x or 0) // size)) for x, size in zip((n, n_asked), block, strict=True))
        spread = lambda df, col, k: df.withColumn(col, F.pmod(F.xxhash64("rid"), F.lit(k)))                 # noqa: E731
        every = lambda df, col, k: df.withColumn(col, F.explode(F.sequence(F.lit(0), F.lit(k - 1)).cast("array<bigint>")))
        left = every(spread(cands, "blk", blocks), "ablk", asked_blocks)
        right = every(spread(asked, "ablk", asked_blocks), "blk", blocks)
        by = [*keys, "blk", "ablk"]
        return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(task, schema)

    def best_positives(cands: pa.Table, asked: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in ("rid", "positive_id", "positive_rid", "positive_score")}
        if len(cands) and len(asked):
            cands = _by_id(cands)
            rid, ids = np.asarray(cands["rid"]), cands["id"].to_pylist()
            found = scores(_unpacked(cands, width, bits), matrix(asked["q"], width))
            for me, score in zip(asked["rid"].to_pylist(), found, strict=True):
                for i in _ranked(score, np.flatnonzero(rid != me))[:n_positives].tolist():
                    for c, x in zip(out, (me, ids[i], int(rid[i]), int(score[i])), strict=True):
                        out[c].append(x)
        return pa.table(out, schema=pa.schema([("rid", pa.int64()), ("positive_id", cands.schema.field("id").type), ("positive_rid", pa.int64()), ("positive_score", pa.int64())]))

    better = [F.desc("positive_score"), F.asc_nulls_last("positive_id"), F.asc("positive_rid")]
    positives = met(asked, ["label"], most, most_anchors, best_positives, f"rid bigint, positive_id {kind}, positive_rid bigint, positive_score bigint")
    positives = (positives.withColumn("p", F.row_number().over(Window.partitionBy("rid").orderBy(*better))).where(F.col("p") <= n_positives)
                 .groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("p", "positive_id", "positive_score"))).alias("ps")))
    asked = stage(asked.join(positives, "rid").select("rid", F.col("id").alias("anchor_id"), "label", "q",
                                                      F.col("ps.positive_id").alias("p_id"), F.col("ps.positive_score").alias("p_score")), "negatives-positives")

    columns = ["rid", "p", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_rid", "negative_score"]

    def best_negatives(cands: pa.Table, asked: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in columns}
        if len(cands) and len(asked):
            cands = _by_id(cands)
            rid, ids, label = cands["rid"].to_pylist(), cands["id"].to_pylist(), np.asarray(cands["label"])
            found = scores(_unpacked(cands, width, bits), matrix(asked["q"], width))
            for a, score in zip(asked.select(["rid", "anchor_id", "label", "p_id", "p_score"]).to_pylist(), found, strict=True):
                ranges = [(-(-low * s // 100), high * s // 100) for s in a["p_score"]]
                inside = (score >= min(r[0] for r in ranges)) & (score <= max(r[1] for r in ranges)) & (label != a["label"])
                order = _ranked(score, np.flatnonzero(inside))
                falling = -score[order].astype(np.int64)
                for p, (lo, hi) in enumerate(ranges):
                    start = int(np.searchsorted(falling, -hi))
                    for i in order[start:start + n_negatives].tolist():
                        if score[i] >= lo:
                            row = (a["rid"], p, a["anchor_id"], a["p_id"][p], a["p_score"][p], ids[i], rid[i], int(score[i]))
                            for c, x in zip(columns, row, strict=True):
                                out[c].append(x)
        id_type = cands.schema.field("id").type
        types = [pa.int64(), pa.int32(), id_type, id_type, pa.int64(), id_type, pa.int64(), pa.int64()]
        return pa.table(out, schema=pa.schema(list(zip(columns, types, strict=True))))

    kinds = ["bigint", "int", kind, kind, "bigint", kind, "bigint", "bigint"]
    found = met(asked, [], n, n_anchors, best_negatives, ", ".join(f"{c} {k}" for c, k in zip(columns, kinds, strict=True)))
    worst_last = [F.desc("negative_score"), F.asc_nulls_last("negative_id"), F.asc("negative_rid")]
    return (found.withColumn("rank", F.row_number().over(Window.partitionBy("rid", "p").orderBy(*worst_last))).where(F.col("rank") <= n_negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
