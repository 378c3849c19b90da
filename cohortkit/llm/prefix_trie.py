"""Prefix trie of conversations, with count-min screening of prefix digests.

Every conversation is a sequence of turns; a node of the trie is a distinct
sequence of first turns. A prefix is known by a 128-bit digest, the exclusive
or of digests that bind each turn to its depth, so prefix digests are running
totals and a conversation of any length is cut over range partitions.

Most prefixes belong to one conversation only. A count-min sketch over all
prefix digests never counts too low, so an estimate of one proves a singleton:
its node is made where its row stands. Only the prefixes that may be shared
are shuffled and grouped exactly; the sketch decides what travels, never what
comes out. Sums over subtrees are running totals along each conversation,
added up per node: a node of the trie is counted once, with its smallest member.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import drop_stage, stage
from cohortkit.llm.words import mix
from cohortkit.operators.lists import ordered_chunks
from cohortkit.operators.running import running

#: Counters of a sketch that travel together, and ids that are put into one string at once.
BLOCK = 4096
IDS = 512
EMPTY = sha256(b"").hexdigest()


def digested_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """(c, depth, n, digest, bytes): each turn's place in its conversation (from 1), the conversation's number of turns, a digest of role and text, the text's size.

    Order is by turn, null first, ties by the digest; null role or text is
    empty. Rows without a conversation id belong to none and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("c"), F.col(turn_col).alias("turn"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.octet_length(text).cast("bigint").alias("bytes"))
    return running(rows, "c", ["turn", "digest"], position="depth", size="n").drop("turn")


def ids_of(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(c) of all conversations."""
    return turns.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("bigint").alias("c")).distinct()


def branched(turns: DataFrame, ids: DataFrame, fan: int = 5, most: int = 9) -> DataFrame:
    """Digested turns of conversations rebuilt on shared heads.

    Conversation c begins with the first h turns of conversation c - c % ``fan``
    (all if it has fewer, none if it is absent) and goes on with its own
    turns after its first h; h = crc32 of c in decimal, modulo ``most``. A
    rebuilt conversation may have no turn.
    """
    head = lambda c: F.crc32(c.cast("string").cast("binary")) % most                 # noqa: E731
    base = lambda c: c - c % fan                                                    # noqa: E731
    turns = stage(turns.select("c", "depth", "n", "digest", "bytes"), "trie-turns")
    firsts = turns.where((F.col("depth") < most) & (F.col("c") % fan == 0))
    near = F.explode(F.array(*[F.try_add(F.col("c"), F.lit(j).cast("bigint")) for j in range(1 - fan, fan)]))
    copies = (firsts.withColumn("to", near).where((base(F.col("to")) == F.col("c")) & (F.col("depth") <= head(F.col("to"))))
              .select(F.col("to").alias("c"), "depth", "digest", "bytes").join(ids, "c", "left_semi"))
    # a short or absent base moves the conversation's own turns up
    sizes = turns.where((F.col("depth") == 1) & (F.col("c") % fan == 0)).select(F.col("c").alias("base"), F.col("n").alias("has"))
    up = (ids.select("c", base(F.col("c")).alias("base"), head(F.col("c")).alias("h")).join(sizes, "base", "left")
          .select("c", (F.col("h") - F.least("h", F.coalesce("has", F.lit(0)))).alias("up")).where("up > 0"))
    own = (turns.where(F.col("depth") > head(F.col("c"))).join(stage(up, "trie-up"), "c", "left")
           .select("c", (F.col("depth") - F.coalesce("up", F.lit(0))).alias("depth"), "digest", "bytes"))
    return copies.unionByName(own)


def prefixes(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """(c, depth, p1, p2, u1, u2, bytes, last): a row for each prefix of each conversation, the empty one too; p is its digest, u its parent's."""
    bound = [F.xxhash64(F.lit(k), F.col("depth"), F.col("digest")).alias(f"x{k}") for k in (1, 2)]
    rows = running(turns.select("c", "depth", "bytes", *bound), "c", ["depth"], position="at", size="n",
                   totals={"p1": ("xor", "x1"), "p2": ("xor", "x2")})
    zero = F.lit(0).cast("bigint")
    begun = turns.where("depth = 1").select("c", F.lit(True).alias("begun"))
    roots = ids.join(begun, "c", "left").select("c", zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), zero.alias("u1"), zero.alias("u2"),
                                                zero.alias("bytes"), F.col("begun").isNull().alias("last"))
    return rows.select("c", F.col("depth").cast("bigint").alias("depth"), "p1", "p2", F.col("p1").bitwiseXOR(F.col("x1")).alias("u1"),
                       F.col("p2").bitwiseXOR(F.col("x2")).alias("u2"), "bytes", (F.col("at") == F.col("n")).alias("last")).union(roots)


def _cells(p1: pa.Array, p2: pa.Array, depth: int, width: int) -> np.ndarray:
    """Rows of the sketch × digests: the counter of each digest in each row."""
    a, b = (np.asarray(x).view(np.uint64) for x in (p1, p2))
    return np.stack([mix(a + np.uint64(k) * (b | np.uint64(1))) & np.uint64(width - 1) for k in range(depth)]).astype(np.int64)


def sketch(rows: DataFrame, depth: int, width: int) -> np.ndarray:
    """Count-min sketch (0, 1, or 2 for more) of the digests p1, p2; ``width`` is a power of two.

    A task sends the blocks of its own sketch that it has filled; equal blocks
    are added up as they stream by. The driver gets depth × width bytes.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros((depth, width), dtype=np.uint8)
        for b in batches:
            for row, cells in zip(own, _cells(b.column(0), b.column(1), depth, width), strict=True):
                cell, n = np.unique(cells, return_counts=True)
                row[cell] = np.minimum(2, row[cell] + np.minimum(n, 2))
        blocks = own.reshape(-1, min(BLOCK, width))
        for k in np.flatnonzero(blocks.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([blocks[k].tobytes()], pa.binary())], ["k", "block"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["k", "block"])
        for b in batches:
            for k, block in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                block = np.frombuffer(block, dtype=np.uint8)
                if k != at:
                    if at is not None:
                        yield row()
                    at, total = k, block
                else:
                    total = np.minimum(2, total + block)
        if at is not None:
            yield row()

    parts = rows.select("p1", "p2").mapInArrow(count, "k bigint, block binary")
    added = parts.repartition("k").sortWithinPartitions("k").mapInArrow(add, "k bigint, block binary")
    out = np.zeros((depth, width), dtype=np.uint8)
    blocks = out.reshape(-1, min(BLOCK, width))
    for r in added.collect():
        blocks[r["k"]] = np.frombuffer(r["block"], dtype=np.uint8)
    return out


def screened(rows: DataFrame, counters: np.ndarray) -> DataFrame:
    """The rows with ``alone`` and ``parent_alone``: the sketch proves that one conversation only has the prefix, its parent."""
    shared = rows.sparkSession.sparkContext.broadcast(counters)
    depth, width = counters.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        least = lambda a, b: np.min([t[c] for t, c in zip(table, _cells(a, b, depth, width), strict=True)], axis=0) == 1
        for b in batches:
            p1, p2, u1, u2 = (b.column(c) for c in ("p1", "p2", "u1", "u2"))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(least(p1, p2)), pa.array(least(u1, u2))],
                                             [*b.schema.names, "alone", "parent_alone"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{kinds}, alone boolean, parent_alone boolean")


def end_hashes(ends: DataFrame) -> DataFrame:
    """(p1, p2, sha): SHA-256 of each node's ids c in rising order, comma-joined.

    The hash runs over the ids in one stream, as it demands; ids come in
    strings of at most ``IDS``, of which a task holds a batch at a time.
    """
    chunks = ordered_chunks(ends, ["p1", "p2"], "c", [], IDS, "ids").select(
        "p1", "p2", "chunk", F.concat_ws(",", F.col("ids").cast("array<string>")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, h = None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int64()), pa.array([at[1]], pa.int64()), pa.array([h.hexdigest()])], ["p1", "p2", "sha"])
        for b in batches:
            for p1, p2, ids in zip(*(b.column(c).to_pylist() for c in ("p1", "p2", "ids")), strict=True):
                if at == (p1, p2):
                    h.update(b"," + ids.encode())
                else:
                    if at:
                        yield row()
                    at, h = (p1, p2), sha256(ids.encode())
        if at:
            yield row()

    return chunks.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "chunk").mapInArrow(run, "p1 bigint, p2 bigint, sha string")


def prefix_trie(turns: DataFrame, ids: DataFrame, sketch_rows: int = 4, most_width: int = 1 << 22) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has (c, depth, digest, bytes) with depths 1, 2, ... for each
    conversation (see :func:`digested_turns`), ``ids`` all conversations (c),
    those without a turn too. Members of a node are the conversations that
    begin with its turns; conv_id is the smallest, parent_conv_id the
    parent's (root: null). n_leaves counts the childless nodes of the node's
    subtree, itself included; saved_tokens adds (n_convs - 1) × bytes of the
    last text over it. ends_sha256 hashes the ids of the members that end at
    the node. No conversation: no node.

    The sketch has ``sketch_rows`` rows of up to ``most_width`` counters, two
    for a prefix below that: a narrower one proves less and changes no result.
    """
    rows = stage(prefixes(turns, ids), "trie-prefixes")
    width = 1 << min(most_width.bit_length() - 1, max(8, (2 * rows.count()).bit_length()))
    seen = stage(screened(rows, sketch(rows, sketch_rows, width)), "trie-screened")
    drop_stage(rows)
    alone, maybe = seen.where("alone"), seen.where("not alone")

    # the prefixes that may be shared, grouped exactly
    groups = maybe.groupBy("p1", "p2", "depth").agg(F.min("c").alias("first"), F.count(F.lit(1)).alias("n"), F.min("bytes").alias("bytes"),
                                                    F.min("u1").alias("u1"), F.min("u2").alias("u2"))
    groups = stage(groups, "trie-groups")
    edges = alone.where("not parent_alone and depth > 0")
    kids = (groups.where("depth > 0").select("u1", "u2").unionByName(edges.select("u1", "u2")).groupBy("u1", "u2").count()
            .select(F.col("u1").alias("p1"), F.col("u2").alias("p2"), F.col("count").alias("n_children")))
    nodes = stage(groups.join(kids, ["p1", "p2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-nodes")

    # what a conversation brings to its nodes: each node weighs once, with its smallest member
    mine = F.col("c") == F.col("first")
    weighed = maybe.join(nodes.select("p1", "p2", "first", "n", "n_children"), ["p1", "p2"]).select(
        "c", "depth", "p1", "p2", F.when(mine, (F.col("n") - 1) * F.col("bytes")).otherwise(0).alias("saving"),
        (mine & F.col("last") & (F.col("n_children") == 0)).cast("bigint").alias("leaf"))
    none = F.lit(None).cast("bigint")
    tails = alone.where("last").select("c", "depth", none.alias("p1"), none.alias("p2"), F.lit(0).cast("bigint").alias("saving"), F.lit(1).cast("bigint").alias("leaf"))
    below = running(weighed.unionByName(tails), "c", [F.desc("depth")], totals={"saved": ("sum", "saving"), "leaves": ("sum", "leaf")})
    sums = below.where("p1 is not null").groupBy("p1", "p2").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    ends = end_hashes(maybe.where("last").select("p1", "p2", "c"))

    # a parent that is not among the nodes is proved a singleton, so the node's own conversation is its member
    parents = nodes.select(F.col("p1").alias("u1"), F.col("p2").alias("u2"), F.col("first").alias("parent"))
    shared = (nodes.join(parents, ["u1", "u2"], "left").join(sums, ["p1", "p2"]).join(ends, ["p1", "p2"], "left")
              .select(F.col("first").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "first")).alias("parent_conv_id"),
                      F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(EMPTY)).alias("ends_sha256")))

    def local(df: DataFrame, parent) -> DataFrame:
        one = F.lit(1).cast("bigint")
        return df.select(F.col("c").alias("conv_id"), "depth", parent.alias("parent_conv_id"), one.alias("n_convs"),
                         (~F.col("last")).cast("bigint").alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("bigint").alias("saved_tokens"),
                         F.when(F.col("last"), F.sha2(F.col("c").cast("string"), 256)).otherwise(F.lit(EMPTY)).alias("ends_sha256"))

    inner = local(alone.where("parent_alone or depth = 0"), F.when(F.col("depth") > 0, F.col("c")))
    return shared.unionByName(inner).unionByName(local(edges.join(parents, ["u1", "u2"]), F.col("parent")))


def conversation_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text") -> DataFrame:
    """The trie of conversations as they are (see :func:`prefix_trie`); other columns are ignored."""
    return prefix_trie(digested_turns(turns, conv_col, turn_col, role_col, text_col).drop("n"), ids_of(turns, conv_col))
