"""The conversation prefix trie against a brute-force version."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.llm import prefix_trie as PT
from cohortkit.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, c string, depth string, n string, bytes string, p1 string"


def sequences(rows):
    """conversation → turns in order (rows: conv_id, turn, role, text)."""
    out = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            out[c].append((t is not None, t or 0, r or "", x or ""))
    digest = lambda v: hashlib.sha256(f"{len(v[2].encode())}:{v[2]}{v[3]}".encode()).digest()
    return {c: [(r, x) for _, _, r, x in sorted(v, key=lambda v: (v[:2], digest(v)))] for c, v in out.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = Counter()
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        out[(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
             hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def table(n=90, seed=7):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        if c % 17 == 3:
            continue                                    # absent conversations, bases too
        for t in range(rnd.choice([1, 1, 2, 4, 8, 12])):
            rows.append((c, t, rnd.choice(["user", "user", "assistant", None]), rnd.choice(["hi", "hi", "hi", "höllo", "", None, f"own {c} {t}"])))
    rows += [(200, None, "user", "null turn"), (200, 0, "user", "hi"), (200, 0, "user", "tie"), (200, 0, "a", "tie"), (200, 0, "user", "tie"),
             (None, 1, "user", "no conversation"), (-7, 0, "user", "hi"), (-5, 0, "user", "hi"), (-5, 1, "user", "x"), (-5, 2, "user", "y")]
    rows += [(205, t, "user", "hi" if t < 3 else f"long {t}") for t in range(700)]            # one conversation holds most rows
    rows += [(206, t, "user", "hi" if t < 3 else f"long {t}") for t in range(650)]
    rows += [(300 + k, 0, "user", "hi") for k in range(60)]                                  # many copies
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA).repartition(5)


def rows_of(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("width", [1 << 22, 1 << 8])
def test_trie_equals_brute_force(spark, width):
    rows = table()
    df = frame(spark, rows)
    turns, ids = PT.digested_turns(df), PT.ids_of(df)
    assert rows_of(PT.prefix_trie(turns.drop("n"), ids, most_width=width)) == brute(sequences(rows))
    got = PT.prefix_trie(PT.branched(turns, ids), ids, most_width=width)
    assert rows_of(got) == brute(rebuilt(sequences(rows)))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_trie_over_many_partitions(spark):
    rows = table(40, seed=8)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "19")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert rows_of(PT.conversation_trie(frame(spark, rows))) == brute(sequences(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_trie_of_one_conversation_and_of_none(spark):
    one = [(8, 0, "user", "hi"), (8, 1, "assistant", "ho")]
    assert rows_of(PT.conversation_trie(frame(spark, one))) == brute(sequences(one))
    assert PT.conversation_trie(frame(spark, [])).collect() == []


def test_sketch_never_counts_too_low(spark):
    keys = [(k % 700) ** 2 for k in range(1500)]
    df = spark.createDataFrame([(k, -k) for k in keys], "p1 bigint, p2 bigint").repartition(6)
    counters = PT.sketch(df, 4, 1 << 9)
    true = Counter(keys)
    seen = PT.screened(df.select("p1", "p2", F.col("p1").alias("u1"), F.col("p2").alias("u2")), counters).collect()
    assert all(true[r.p1] == 1 for r in seen if r.alone) and all(r.alone == r.parent_alone for r in seen)
    wide = PT.screened(df.select("p1", "p2", F.col("p1").alias("u1"), F.col("p2").alias("u2")), PT.sketch(df, 4, 1 << 16)).collect()
    assert np.mean([true[r.p1] == 1 for r in wide]) == np.mean([r.alone for r in wide])


def test_registered_query_on_a_small_folder(spark, tmp_path):
    rows = table(60, seed=9)
    frame(spark, rows).select("conv_id", "turn", "role", "text").write.parquet(str(tmp_path / "conversations.parquet"))
    assert rows_of(QUERIES["op11_prefix_trie"](spark, str(tmp_path))) == brute(rebuilt(sequences(rows)))
