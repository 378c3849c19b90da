"""Similarity join on word n-grams by vertical partitioning, and its link classes.

Documents are sets of word n-grams (64-bit hashes) under one global order. The
order is cut into fragments, so a set is a row of segments; for a candidate
pair the overlap is counted fragment by fragment and summed per pair. A pair
links where ``100 * overlap >= percent * union``, decided on whole sets.

Nothing is compared all against all:

* equal sets are one class (a digest of two 64-bit sums and the size);
* a class survives only if enough of its extended prefix (its smallest
  hashes) occurs in another class, which a counted shuffle of a fifth of the
  n-grams decides; only survivors' texts are read a second time;
* survivors are indexed by prefixes in rarest-first order (n-grams of one
  document never match, common passages come last);
* in each bucket of the index members are first compared with a few hubs per
  size class, in rounds, as long as a round merges a tenth of the components;
  only pairs whose ends are still in different components are then listed.
  Links inside a component add nothing to the classes, so no link between
  classes is lost and a group of near copies costs its size, not its square;
* the listing itself holds an exact bound: a set's parity bitmap has a bit
  for each range of hash values, set where an odd number of its n-grams falls.
  The bits in which two bitmaps differ are at most the n-grams in which the
  sets differ, so a pair with too many of them cannot link and never leaves the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.common import drop_stage, release, stage, text_chunks
from cohortkit.llm.words import find_words, mix, shingle_hashes


#: Words of 64 bits in a parity bitmap, and the share of the open components that a round of hubs must merge to be followed by another.
PARITY_WORDS = 16
WORTH = 0.1


def least_overlap(n, percent: int):
    """Smallest overlap that a set of ``n`` needs with any partner."""
    return -(-n * percent // 100)


def head_size(n, percent: int):
    """(extended prefix length of a set of ``n``, matches that its prefix must have with a partner's).

    Two sets that share o elements share at least l in their (n - o + l)
    prefixes; l is a twentieth of the smaller partner allowed.
    """
    t = least_overlap(n, percent)
    return min(n, n - t + max(1, n // 20)), max(1, t // 20)


def text_sets(texts: list[str], n: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes per text (as signed 64-bit); a shorter text's words are one n-gram."""
    w = find_words(texts, lower_ascii=True)
    doc, h = shingle_hashes(w, n)
    edges = np.searchsorted(doc, np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        count = int(w.first[i + 1] - w.first[i])
        if 0 < count < n:
            whole = np.array([count], np.uint64)
            for x in w.hash[w.first[i]:w.first[i + 1]]:
                whole = mix(whole * np.uint64(0x9FB21C651E98DF25) + x)
            out.append(whole.view(np.int64))
        else:
            out.append(np.unique(h[edges[i]:edges[i + 1]].view(np.int64)))
    return out


def digest(values: np.ndarray) -> tuple[int, int]:
    u = values.view(np.uint64)
    return (int(mix(u).sum(dtype=np.uint64).astype(np.int64)),
            int(mix(u ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).astype(np.int64)))


def lists(parts: list[np.ndarray]) -> pa.ListArray:
    edges = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate([*parts, np.zeros(0, np.int64)])))


def heads(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(rid, id, carry, t, size, d1, d2, head) per row of (rid, id, text, carry, t)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, texts in text_chunks(b, 2):
                sets = text_sets(texts, n)
                marks = [digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), b.column(3).slice(lo, hi - lo),
                     b.column(4).slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()), pa.array([m[0] for m in marks], pa.int64()),
                     pa.array([m[1] for m in marks], pa.int64()),
                     lists([s[:head_size(len(s), percent)[0]] for s in sets])], ["rid", "id", "carry", "t", "size", "d1", "d2", "head"])

    return docs.select("rid", "id", "text", "carry", "t").mapInArrow(
        run, f"rid bigint, id {kind}, carry string, t bigint, size bigint, d1 bigint, d2 bigint, head array<bigint>")


def segments(docs: DataFrame, n: int, fragments: int) -> DataFrame:
    """(sid, size, frag, seg) of the rows (sid, d1, d2, text) whose set has that digest: the whole set, cut at
    equal ranges of the global (hash) order."""
    cuts = np.array([(k << 64) // fragments - (1 << 63) for k in range(1, fragments)], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sid, d1, d2 = (b.column(k).to_pylist() for k in range(3))
            for lo, _, texts in text_chunks(b, 3):
                rows, segs = [], []
                for i, s in enumerate(text_sets(texts, n)):
                    if digest(s) == (d1[lo + i], d2[lo + i]):
                        parts = np.split(s, np.searchsorted(s, cuts))
                        rows += [(sid[lo + i], len(s), k) for k in range(fragments) if len(parts[k])]
                        segs += [p for p in parts if len(p)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.int32()), lists(segs)], ["sid", "size", "frag", "seg"])

    return docs.select("sid", "d1", "d2", "text").mapInArrow(run, "sid bigint, size bigint, frag int, seg array<bigint>")


def overlapping(pairs: DataFrame, segs: DataFrame, percent: int, fragments: int) -> DataFrame:
    """The pairs (a, b) of (a, size_a, b, size_b) that link: partial overlaps, one fragment after the other, summed per pair.

    After each fragment the pairs go whose sum cannot reach a link any more,
    even if all that is left of the smaller rest were shared.
    """
    at = pairs.select("a", "b", "size_a", "size_b", F.lit(0).cast("long").alias("o"),
                      F.col("size_a").alias("rest_a"), F.col("size_b").alias("rest_b"))
    for k in range(fragments):
        part = segs.where(F.col("frag") == k)
        left, right = (part.select(F.col("sid").alias(c), F.col("seg").alias(f"seg_{c}")) for c in ("a", "b"))
        met = at.join(left, "a", "left").join(right, "b", "left")
        # a set without n-grams in this fragment has no segment there
        length = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
        at = met.select("a", "b", "size_a", "size_b", (F.col("o") + length(F.array_intersect("seg_a", "seg_b"))).alias("o"),
                        (F.col("rest_a") - length("seg_a")).alias("rest_a"), (F.col("rest_b") - length("seg_b")).alias("rest_b"))
        at = at.where((F.col("o") + F.least("rest_a", "rest_b")) * (100 + percent) >= percent * (F.col("size_a") + F.col("size_b")))
    return at.select("a", "b")


def parities(segs: DataFrame) -> DataFrame:
    """(sid, w0, w1, ...): each set's parity bitmap, one bit a range of the n-grams' low hash bits."""
    bits = 64 * PARITY_WORDS
    names = [f"w{k}" for k in range(PARITY_WORDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(1)
            row = np.repeat(np.arange(len(col)), np.diff(np.asarray(col.offsets)))
            cell = row * bits + (np.asarray(col.flatten()) & (bits - 1))
            odd = (np.bincount(cell, minlength=bits * len(col)) & 1).astype(np.uint8)
            words = np.packbits(odd, bitorder="little").view(np.int64).reshape(len(col), PARITY_WORDS)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(np.ascontiguousarray(w)) for w in words.T]], ["sid", *names])

    parts = segs.select("sid", "seg").mapInArrow(run, ", ".join(f"{c} bigint" for c in ["sid", *names]))
    return parts.groupBy("sid").agg(*[F.bit_xor(c).alias(c) for c in names])


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(v, comp): for every end of a link the smallest vertex reachable; ``known`` is the answer before these links.

    Rounds of hooking each vertex to its smallest neighbour, shortening the
    hooks to their roots, and contracting the links; each round is written, so
    lineage stays short. Vertices of any degree only meet aggregates and joins
    on written tables.
    """
    edges = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ends = edges.select(F.col("a").alias("v")).distinct().withColumn("comp", F.col("v"))
    if known is not None:
        at = lambda c: known.select(F.col("v").alias(c), F.col("comp").alias(f"{c}_comp"))
        edges = (edges.join(at("a"), "a", "left").join(at("b"), "b", "left")
                 .select(F.coalesce("a_comp", "a").alias("a"), F.coalesce("b_comp", "b").alias("b")).where("a != b"))
        ends = known.union(ends.join(known, "v", "left_anti").select("v", "comp"))
    edges, found = stage(edges.distinct(), "cc-edges"), stage(ends, "cc-found")
    while not edges.isEmpty():
        hook = stage(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p")), "cc-hook")
        while True:
            up = hook.select(F.col("a").alias("p"), F.col("p").alias("pp"))
            shorter = stage(hook.join(up, "p").select("a", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")), "cc-hook")
            hook = shorter.select("a", "p")
            if shorter.where("moved").isEmpty():
                break
        to = lambda c: hook.select(F.col("a").alias(c), F.col("p").alias(f"{c}_root"))
        found = stage(found.join(to("comp"), "comp", "left")
                      .select("v", F.coalesce("comp_root", "comp").alias("comp")), "cc-found")
        edges = stage(edges.join(to("a"), "a").join(to("b"), "b").where("a_root != b_root")
                      .select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).distinct(), "cc-edges")
    return found


def link_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, percent: int = 85,
                 fragments: int = 4, hubs: int = 4, carry: str | None = None) -> DataFrame:
    """One row per input row: ``id_col``, n_shingles, component_id, first (and the column ``carry`` if given).

    Words are runs without ASCII white space, A-Z lower-cased. component_id is
    the smallest id reachable by links, the row's own included; ``first`` marks
    one row of each component, one with that id. A text without words, and a
    null text, has no n-grams, links with nothing and is its own component.
    Repeated rows and equal texts share a component. A null id counts after
    every other id. Other columns are ignored. ``carry`` names a string column
    that is to be returned with each row.
    """
    carried = F.col(carry).cast("string") if carry else F.lit(None).cast("string")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    mark_of = F.xxhash64(text).alias("t")
    rows = stage(heads(docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"),
                                   text.alias("text"), carried.alias("carry"), mark_of), n, percent), "ngram-heads")
    mark = ["size", "d1", "d2"]
    key = F.struct(F.col("id").isNull().alias("no_id"), "id", "rid")
    classes = stage(rows.where("size > 0").groupBy(*mark).agg(
        F.min("rid").alias("sid"), F.min(key).alias("lead"), F.count(F.lit(1)).alias("copies")), "ngram-classes")

    # extended prefixes: an n-gram counts if a second class has it in its own
    entries = (rows.where("size > 0").join(classes.select(F.col("sid").alias("rid")), "rid", "left_semi")
               .select(F.col("rid").alias("sid"), "size", F.explode("head").alias("tok")))
    shared = entries.groupBy("tok").count().where("count > 1").select("tok")
    need = F.greatest(F.lit(1), F.floor(F.ceil(F.col("size") * percent / 100) / 20))
    alive = (entries.join(shared, "tok", "left_semi").groupBy("sid", "size").count().where(F.col("count") >= need).select("sid"))
    alive = stage(alive.join(rows.select(F.col("rid").alias("sid"), "id", "t", "d1", "d2"), "sid"), "ngram-alive")
    # the prefixes have served
    full, rows = rows, stage(rows.drop("head"), "ngram-rows")
    drop_stage(full)
    release(docs.sparkSession)

    # the survivors grow with the corpus: a merge join at every size
    # (id and t name a text: rows that share an id meet their own sets only)
    again = docs.select(F.col(id_col).alias("id"), mark_of, text.alias("text")).join(
        alive.withColumnsRenamed({"id": "alive_id", "t": "alive_t"}).hint("merge"),
        F.col("id").eqNullSafe(F.col("alive_id")) & (F.col("t") == F.col("alive_t")))
    segs = stage(segments(again, n, fragments).dropDuplicates(["sid", "frag"]), "ngram-segments")
    release(docs.sparkSession)

    # rarest-first order among survivors: document frequency, then hash
    toks = segs.select("sid", "size", F.explode("seg").alias("tok"))
    common = toks.groupBy("tok").count().where("count > 1").withColumnRenamed("count", "df")
    t = F.ceil(F.col("size") * percent / 100)
    by_set = Window.partitionBy("sid")
    ranked = (toks.join(common, "tok")
              .withColumn("m", F.count(F.lit(1)).over(by_set)).where(F.col("m") >= t)
              .withColumn("pos", F.col("size") - F.col("m") + F.row_number().over(by_set.orderBy("df", "tok")) - 1)
              .where(F.col("pos") <= F.col("size") - t)
              .withColumn("class", F.floor(F.log("size") / F.lit(float(np.log(100 / percent))))))
    index = stage(ranked.select("tok", "sid", "size", "pos", "class"), "ngram-index")
    release(docs.sparkSession)
    own = stage(parities(segs.join(index.select("sid").distinct(), "sid", "left_semi")), "ngram-parities")
    words = [c for c in own.columns if c != "sid"]

    size_ok = (100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b"))
    comps = None
    n_open = r = 0
    last = False
    while not last:
        held = index if comps is None else index.join(comps, index["sid"] == comps["v"], "left")
        held = held.withColumn("comp", F.col("sid") if comps is None else F.coalesce("comp", "sid")).select(*index.columns, "comp")
        per = held.groupBy("tok").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least != most")
        open_ = stage(held.join(per.select("tok"), "tok"), "ngram-open")
        before, n_open = n_open, open_.select("comp").distinct().count()
        if not n_open:
            break
        last = r > 0 and before - n_open < WORTH * before
        side = lambda df, x, *cols: df.select(
            *cols, F.col("sid").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("size", "pos", "comp", *words)])
        both = F.col("size_a") + F.col("size_b")
        differ = sum((F.bit_count(F.col(f"{w}_a").bitwiseXOR(F.col(f"{w}_b"))) for w in words), F.lit(0))
        may_link = (F.col("comp_a") != F.col("comp_b")) & size_ok & (differ * (100 + percent) <= (100 - percent) * both)
        if last:
            marked = stage(open_.join(own, "sid"), "ngram-marked")
            a, b = side(marked, "a", "tok"), side(marked, "b", "tok")
            # the first shared n-gram of a linking pair leaves enough room behind it in both sets
            room = F.least(F.col("size_a") - F.col("pos_a"), F.col("size_b") - F.col("pos_b"))
            pairs = a.join(b, (a["tok"] == b["tok"]) & (F.col("a") < F.col("b")) & may_link & (room * (100 + percent) >= percent * both))
        else:
            # a few hubs per bucket and size class, others in each round; two buckets stand for a member, which
            # is compared with the two hubs that its bitmap is closest to
            order = F.xxhash64(F.lit(r), "tok")
            probe = stage(open_.withColumn("k", F.row_number().over(Window.partitionBy("sid").orderBy(order, "tok")))
                          .where("k <= 2").drop("k").join(own, "sid"), "ngram-probe")
            first = Window.partitionBy("tok", "class").orderBy(F.xxhash64(F.lit(r), "sid"), "sid")
            centre = stage(probe.withColumn("k", F.row_number().over(first)).where(F.col("k") <= hubs), "ngram-hubs")
            met = side(probe, "a", "tok", "class").join(side(centre, "b", "tok", "class"), ["tok", "class"]).where(may_link)
            near = Window.partitionBy("a").orderBy("differ", "b")
            pairs = (met.select("a", "size_a", "b", "size_b", differ.alias("differ")).distinct()
                     .withColumn("k", F.row_number().over(near)).where("k <= 2"))
        ends = [F.struct(F.col(c).alias("v"), F.col(f"size_{c}").alias("n")) for c in ("a", "b")]
        pairs = pairs.select(F.least(*ends).alias("l"), F.greatest(*ends).alias("g")).select(
            F.col("l.v").alias("a"), F.col("l.n").alias("size_a"), F.col("g.v").alias("b"), F.col("g.n").alias("size_b"))
        pairs = stage(pairs.distinct(), "ngram-pairs")
        met = stage(overlapping(pairs, segs, percent, fragments), "ngram-links")
        if not met.isEmpty():
            comps = components(met, comps)
        drop_stage(open_)
        r += 1

    # classes that are more than one row of their own
    if comps is None:
        named = classes.withColumn("comp", F.col("sid"))
    else:
        named = classes.join(comps.withColumnRenamed("v", "sid"), "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    named = stage(named.select(*mark, "lead", "copies", "comp"), "ngram-named")
    leads = named.groupBy("comp").agg(F.min("lead").alias("best"), F.sum("copies").alias("rows")).where("rows > 1")
    final = stage(named.join(leads, "comp").select(*mark, "best"), "ngram-final")
    alone = F.col("best").isNull()
    return (rows.select("rid", "id", "carry", *mark).join(final, mark, "left")
            .select(*([F.col("carry").alias(carry)] if carry else []), F.col("id").alias(id_col), F.col("size").alias("n_shingles"),
                    F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("component_id"),
                    (alone | (F.col("rid") == F.col("best.rid"))).alias("first")))
