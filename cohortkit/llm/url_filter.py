"""URL filters: host-suffix × path-prefix expressions joined on short digests.

Every URL is expanded into the expressions a rule could be written as (each
host suffix of up to as many labels as a rule has, with each path prefix of a
length that a rule has). Expressions meet rules in an equi-join on a short
prefix of the SHA-256 digest, the full digest confirms, and the longest
matching rule decides. URLs that no rule fits get the method's verdict: the
words of the host are looked up, by the same join, in a list of blocked words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The registered query's rules (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

# Host words that the method blocks where no rule fits.
BLOCKED_WORDS = ("casino", "pills", "porn", "spam", "viagra", "xxx")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url):
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(rest_of(url), r"(?s)^([^/?#]*)", 1), UPPER, LOWER)


def url_path(url):
    """After the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(rest_of(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def rest_of(url):
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                rules: Sequence[tuple[str, str, str]] = RULES,
                blocked_words: Sequence[str] = BLOCKED_WORDS, default: str = "allow",
                prefix_hex: int = 8, sent: int = 100_000) -> DataFrame:
    """One row per input row: ``id_col``, host, path, rule, verdict, by.

    A rule fits its host and all subdomains if the path starts with the
    rule's path; the longest rule (host and path together) wins, and of two
    rules of the same text a block. Null urls and urls without ``://`` have
    an empty host and path; a rule with an empty host fits nothing. Without a
    fitting rule, rule is null and the method decides (``by`` says 'word' or
    'default'). Repeated rows are judged one by one; other columns are
    ignored. ``rules`` may be long: only distinct path lengths and the
    largest label count are taken from it. Up to ``sent`` rules and words
    (some 20 MB) go to every task, so that no expression is shuffled; a longer
    list meets the expressions in a merge join.
    """
    spark = pages.sparkSession
    listed = {}
    for verdict, host, path in rules:
        host = host.lower()
        if host and listed.get((host, path)) != "block":
            listed[(host, path)] = verdict
    lengths = sorted({len(p) for _, p in listed})
    labels = max((h.count(".") + 1 for h, _ in listed), default=0)
    table = spark.createDataFrame(
        [("r", h, p, v) for (h, p), v in listed.items()] + [("w", w, "", "block") for w in blocked_words],
        "kind string, host string, path string, verdict string")
    # the separator cannot stand in a host, so ("a", "b/") and ("ab", "/") differ
    digest = lambda kind, host, path: F.sha2(F.concat(kind, F.lit("\x00"), host, F.lit("/\x00"), path), 256)
    table = (table.withColumn("full", digest(F.col("kind"), F.col("host"), F.col("path")))
             .select(F.substring("full", 1, prefix_hex).alias("short"), F.col("full").alias("r_full"),
                     F.concat("host", "path").alias("rule"), "verdict"))
    table = F.broadcast(table) if len(listed) + len(blocked_words) <= sent else table.hint("merge")

    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    seen = pages.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"),
                        url_host(url).alias("host"), url_path(url).alias("path"))
    parts = F.split("host", r"\.")
    none = "array<struct<kind:string,host:string,path:string>>"
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(labels, 1)))),
                           lambda k: F.array_join(F.slice(parts, -k, k), "."))
    prefixes = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths] or [F.lit(None).cast("string")]),
                        lambda p: p.isNotNull())
    as_rules = F.flatten(F.transform(suffixes, lambda h: F.transform(
        prefixes, lambda p: F.struct(F.lit("r").alias("kind"), h.alias("host"), p.alias("path")))))
    as_words = F.transform(F.array_distinct(F.split("host", r"[.\-]")), lambda w: F.struct(
        F.lit("w").alias("kind"), w.alias("host"), F.lit("").alias("path")))
    expanded = F.when(F.col("host") != "", F.concat(as_rules, as_words)).otherwise(F.lit(None).cast(none))
    asked = (seen.select("rid", "id", "host", "path", F.explode_outer(expanded).alias("e"))
             .withColumn("full", digest(F.col("e.kind"), F.col("e.host"), F.col("e.path")))
             .withColumn("short", F.substring("full", 1, prefix_hex)))
    met = asked.join(table, "short", "left")
    sure = F.col("full") == F.col("r_full")
    # per row a packed best answer: rules before words, then the longer rule; rules have distinct texts
    is_rule = sure & (F.col("e.kind") == "r")
    rank = F.when(is_rule, F.lit(1 << 31).cast("long") + F.length("rule")).when(sure, F.lit(0).cast("long"))
    answer = met.groupBy("rid", "id", "host", "path").agg(
        F.max_by(F.when(is_rule, F.col("rule")), rank).alias("rule"),
        F.max_by("verdict", rank).alias("verdict"), F.max(rank).alias("rank"))
    return answer.select(F.col("id").alias(id_col), "host", "path", "rule",
                         F.coalesce("verdict", F.lit(default)).alias("verdict"),
                         F.when(F.col("rule").isNotNull(), "rule").when(F.col("rank").isNotNull(), "word")
                         .otherwise("default").alias("by"))
