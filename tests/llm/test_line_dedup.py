"""Line dedup against a brute-force version."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from cohortkit.llm.line_dedup import dedup_lines
from cohortkit.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, id string, t string, h string, gone string, kept string, n_lines string"


def key_of(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(rows, min_docs, min_chars=1):
    seen = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            seen[key_of(line)].add(("text", t) if i is None else i)
    often = {k for k, v in seen.items() if len(k) >= min_chars and len(v) >= min_docs}
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key_of(x) not in often]
        out[(i, len(lines), len(lines) - len(kept), "\n".join(kept))] += 1
    return out


def table():
    rnd = random.Random(1)
    common = ["Menu", " menu\t", "MENU", "Kopf ÄÖ", "kopf äÖ", "kopf ÄÖ  ", "", "  ", "中", "\x0bfoot\r", "foot"]
    rows = []
    for i in range(120):
        lines = [rnd.choice(common) if rnd.random() < 0.4 else f"own {rnd.randrange(60)}" for _ in range(rnd.randrange(1, 9))]
        rows.append((i, "\n".join(lines)))
    rows += [(200, None), (201, ""), (202, "\n"), (203, "menu\nmenu\nMENU"), (204, "once\n" * 30), (None, "no id\nmenu"), (None, "no id\nmenu"),
             (None, None), (205, "\n".join(f"line {k} of a long text" for k in range(9000)) + "\nfoot")]
    rows += [(7, "repeated row\nmenu")] * 12 + [(300, f"same id {k}\nhot id") for k in range(15)]
    return rows


@pytest.mark.parametrize("min_docs,min_chars", [(10, 1), (3, 1), (3, 5), (1, 1)])
def test_line_dedup_equals_brute_force(spark, min_docs, min_chars):
    rows = table()
    df = spark.createDataFrame([(i, t, *["x"] * 6) for i, t in rows], SCHEMA).repartition(5)
    got = dedup_lines(df, min_docs=min_docs, min_chars=min_chars)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    assert Counter(map(tuple, got.collect())) == brute(rows, min_docs, min_chars)


def test_lines_without_an_id_are_documents_by_their_texts(spark):
    rows = [(None, f"shared\nown {k}") for k in range(10)] + [(None, "rare\nrare")] * 20
    got = dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert Counter(map(tuple, got.collect())) == brute(rows, 10)
    assert sum(r.n_dropped for r in got.collect()) == 10


def test_line_dedup_of_an_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], SCHEMA)).collect() == []


def test_registered_query_on_a_small_folder(spark, tmp_path):
    rows = [r for r in table() if r[0] is not None][:130]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op13_line_dedup"](spark, str(tmp_path))
    want = Counter({(i, n, d, hashlib.sha256(k.encode()).hexdigest()): c for (i, n, d, k), c in brute(rows, 10).items()})
    assert Counter(map(tuple, got.collect())) == want
