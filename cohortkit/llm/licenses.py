"""Licence scans: a positional rare-token index over licence phrases, notices and whole licence texts.

Each text of the collection (a target) is indexed by its rarest words and the
words of its mandatory key phrase, with their relative positions. IDF over all
scanned files then names each target's anchor: the rarest word of its key
phrase. A file looks up the anchors it holds and nothing else: an anchor at
position p whose posting stands at r proposes a placement starting at p - r,
the key phrase is verified there, and only at placements that survive are the
target's other postings intersected by relative position. A target is reported
where the IDF of the words found reaches ``min_share`` of all its postings'.

Everything is DataFrame functions; whole texts are tokenised once, only hits
leave the scan, and only verified placements are grouped.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import stage, text_of

# Words of the original text; A-Z are lower-cased word by word afterwards.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A licence notice: its label, its words, and a key phrase it must contain."""

    label: str
    text: str
    key: str


# The phrases and labels that every scan reports at all places.
BASE_PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Customary one-line licence notices.
TEMPLATES = (
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "permission is hereby granted"),
    Template("apache", "licensed under the apache license version 2 0", "apache license"),
    Template("gpl", "this work is licensed under the gnu general public license version 3", "general public license"),
    Template("lgpl", "gnu lesser general public license", "lesser general public license"),
    Template("agpl", "gnu affero general public license", "affero general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license", "mozilla public license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    Template("all-rights-reserved", "all rights reserved", "all rights reserved"),
)


# The bodies of short public licences, and the notices that longer ones ask for.
WHOLE_TEXTS = (
    Template("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
    documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
    copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
    is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included
    in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
    IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
    EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
    TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
             "permission is hereby granted free of charge"),
    Template("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
    granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS"
    AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.
    IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING
    FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
    CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
             "for any purpose with or without fee is hereby granted"),
    Template("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
    following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and
    the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
    the following disclaimer in the documentation and/or other materials provided with the distribution.""",
             "redistribution and use in source and binary forms"),
    Template("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
    liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
    including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions""",
             "to alter it and redistribute it freely"),
    Template("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
    with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law
    or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS
    OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the
    License.""",
             "you may not use this file except in compliance with the license"),
    Template("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
    License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This
    program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
             "under the terms of the gnu general public license"),
)


@dataclass(frozen=True)
class Posting:
    word: str
    target: int
    rel: int
    key: bool


def words_of(text: str) -> list[str]:
    """The words of a text of the collection, by the scan's own rule (ASCII)."""
    return re.findall(r"[0-9a-z]+", text.lower())


def build_index(phrases: Sequence[tuple[str, str]], templates: Sequence[Template],
                rare_words: int = 12) -> tuple[list[Posting], list[dict]]:
    """Postings and targets (base phrases first, then templates).

    A template is indexed by its ``rare_words`` highest-IDF words (over the
    collection) plus the words of its key phrase; a base phrase by all its
    words. A key phrase must stand in its text.
    """
    entries = [words_of(p) for p, _ in phrases] + [words_of(t.text) for t in templates]
    df = Counter(w for e in entries for w in set(e))
    idf = {w: math.log(1 + len(entries) / n) for w, n in df.items()}
    postings, targets = [], []
    for i, words in enumerate(entries):
        base = i < len(phrases)
        key = words if base else words_of(templates[i - len(phrases)].key)
        at = next(k for k in range(len(words)) if words[k:k + len(key)] == key)
        rare = set(sorted(range(len(words)), key=lambda k: (-idf[words[k]], k))[:rare_words])
        used = sorted(rare | set(range(at, at + len(key))))
        postings += [Posting(words[k], i, k, at <= k < at + len(key)) for k in used]
        targets.append({"target": i, "label": phrases[i][1] if base else templates[i - len(phrases)].label, "base": base})
    return postings, targets


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  phrases: Sequence[tuple[str, str]] = BASE_PHRASES,
                  templates: Sequence[Template] = TEMPLATES + WHOLE_TEXTS,
                  min_share: float = 0.7, rare_words: int = 12) -> DataFrame:
    """One row per input row: counts, places and labels of licence phrases, notices and texts.

    Returns ``id_col``, n_words, n_base, first_word, last_word, base_labels,
    labels, score, places (array of the targets found, by start). Null and
    empty texts have no words: zero counts, null places of first and last
    word, empty label strings, score 0. Repeated rows are judged one by one;
    other columns are ignored. ``score`` is 1 where a base phrase stands, else
    the best IDF share of a reported target, else 0. A word's IDF is
    ln(1 + files / files that hold it).
    """
    spark = docs.sparkSession
    postings, targets = build_index(phrases, templates, rare_words)
    vocabulary = sorted({p.word for p in postings})

    def hit(word, i):
        low = F.lower(word)
        # equal byte length: a non-ASCII capital that lower-cases into ASCII is another word
        return F.when(low.isin(vocabulary) & (F.octet_length(low) == F.octet_length(word)),
                      F.struct(i.cast("long").alias("pos"), low.alias("word")))

    words = docs.select(F.col(id_col).alias("id"), F.regexp_extract_all(text_of(docs, text_col), F.lit(WORD), F.lit(0)).alias("w"))
    hits = stage(words.select(
        F.monotonically_increasing_id().alias("rid"), "id", F.size("w").cast("long").alias("n_words"),
        F.filter(F.transform("w", hit), lambda x: x.isNotNull()).alias("hits")), "license-hits")

    # IDF over all files; one row per indexed word (the index is a constant of this module's size)
    n_docs = hits.count()
    df = hits.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["word"]))).alias("word")).groupBy("word").count()
    seen = {r["word"]: r["count"] for r in df.collect()}
    idf = {w: math.log(1 + n_docs / seen[w]) if w in seen else 1.0 for w in vocabulary}
    rows, most = [], 1
    for t in targets:
        own = [p for p in postings if p.target == t["target"]]
        anchor = max((p for p in own if p.key), key=lambda p: (idf[p.word], -p.rel))
        most = max(most, max(p.rel for p in own) + 1)
        rows.append((anchor.word, anchor.rel, t["label"], t["base"], sum(idf[p.word] for p in own),
                     [(p.rel, p.word, p.key, idf[p.word]) for p in own]))
    index = F.broadcast(spark.createDataFrame(
        rows, "anchor string, at int, label string, base boolean, whole double, "
              "postings array<struct<rel: int, word: string, key: boolean, idf: double>>"))
    anchors = sorted({r[0] for r in rows})

    # a file's anchors, each with the hits around it: every word is at most one hit, so they lie among its neighbours
    found = hits.where(F.exists("hits", lambda h: h["word"].isin(anchors)))
    looked = (found.select("rid", "hits", F.posexplode("hits").alias("i", "h")).where(F.col("h.word").isin(anchors))
              .select("rid", F.col("h.word").alias("anchor"), F.col("h.pos").alias("pos"), F.filter(
                  F.slice("hits", F.greatest(F.lit(1), F.col("i") + 1 - most), F.lit(2 * most + 1)),
                  lambda x: F.abs(x["pos"] - F.col("h.pos")) <= most).alias("near")))
    placed = looked.join(index, "anchor").withColumn("start", F.col("pos") - F.col("at")).where("start >= 0")
    stands = lambda p: F.exists("near", lambda x: (x["pos"] == F.col("start") + p["rel"]) & (x["word"] == p["word"]))
    placed = placed.where(F.forall("postings", lambda p: ~p["key"] | stands(p)))
    share = F.aggregate("postings", F.lit(0.0), lambda acc, p: acc + F.when(stands(p), p["idf"]).otherwise(0.0)) / F.col("whole")
    best = (placed.select("rid", "label", "base", "start", F.least(F.lit(1.0), share).alias("share"))
            .where(F.col("base") | (F.col("share") >= min_share))
            .groupBy("rid", "label", "base").agg(F.count(F.lit(1)).alias("n"), F.min("start").alias("lo"), F.max("start").alias("hi"),
                                                 F.max("share").alias("share")))
    base = F.col("base")
    per_file = best.groupBy("rid").agg(
        F.sum(F.when(base, F.col("n"))).alias("n_base"),
        F.min(F.when(base, F.col("lo"))).alias("first_word"),
        F.max(F.when(base, F.col("hi"))).alias("last_word"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(base, F.col("label"))))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.collect_set("label"))).alias("labels"),
        F.max(F.when(base, F.lit(1.0)).otherwise(F.col("share"))).alias("score"),
        F.array_sort(F.collect_list(F.struct("lo", "hi", "n", "label", "share"))).alias("places"))
    return (hits.select("rid", "id", "n_words").join(per_file, "rid", "left")
            .select(F.col("id").alias(id_col), "n_words",
                    F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
                    F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                    F.coalesce("labels", F.lit("")).alias("labels"),
                    F.coalesce("score", F.lit(0.0)).alias("score"), "places"))
