"""License scans: exact set-similarity join of text blocks with license templates, in Spark's own columns."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.plans.lineage import cut



class Notice(NamedTuple):
    """A template: its words; those of them that tell it from related licenses, each of which a block must hold; and words of
    related licenses, none of which it may hold."""

    words: str
    must: str = ""
    without: str = ""


#: The phrases that count as base, and notices in common use by label.
PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
TEMPLATES = {
    "mit": (
        Notice("released under the mit license", must="mit"),
        Notice("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
        Notice("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ),
    "apache": (
        Notice("licensed under the apache license version 2 0", must="apache"),
        Notice("you may not use this file except in compliance with the license you may obtain a copy of the license at", must="compliance obtain"),
    ),
    "gpl": (
        Notice("this work is licensed under the gnu general public license version 3", must="gnu general", without="lesser affero"),
        Notice("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", must="gnu general", without="lesser affero"),
    ),
    "bsd": (Notice("redistribution and use in source and binary forms with or without modification are permitted", must="redistribution binary"),),
    "mpl": (Notice("this source code form is subject to the terms of the mozilla public license v 2 0", must="mozilla"),),
    "cc-by": (
        Notice("licensed under cc by 4 0", must="cc by", without="sa nc nd"),
        Notice("this work is licensed under a creative commons attribution 4 0 international license", must="creative attribution", without="sharealike noncommercial noderivatives"),
    ),
    "cc-by-sa": (
        Notice("licensed under cc by sa 4 0", must="cc by sa", without="nc nd"),
        Notice("this work is licensed under a creative commons attribution sharealike 4 0 international license", must="creative attribution sharealike", without="noncommercial"),
    ),
    "cc-by-nc": (
        Notice("licensed under cc by nc 4 0", must="cc by nc", without="sa nd"),
        Notice("this work is licensed under a creative commons attribution noncommercial 4 0 international license", must="creative attribution noncommercial", without="sharealike"),
    ),
    "cc0": (
        Notice("licensed under cc0 1 0", must="cc0"),
        Notice("to the extent possible under law the author has waived all copyright and related rights", must="waived"),
    ),
    "proprietary": (Notice("all rights reserved no part of this work may be reproduced or transmitted in any form or by any means without the prior written permission", must="reserved reproduced permission"),),
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of lower-cased text, and the same of text as it stands.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
THRESHOLD = 0.8
#: Blocks are windows of the text's words, line ends ignored, that overlap by half: any stretch of half a window and one word more
#: lies within one, so that no notice falls between. Windows are longer where a template has more than half as many words.
WINDOW = 64


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD_ANY_CASE), 0)


def token_counts(text: Column, docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How often each word of ``vocabulary`` (the templates', so a few hundred at most) occurs in the whole corpus."""
    some = F.filter(words_of(text), lambda w: F.lower(w).isin(vocabulary))
    words = docs.select(F.explode(some).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    words = words.select(F.translate("w", UPPER, LOWER).alias("w"), "n").groupBy("w").agg(F.sum("n").alias("n"))
    return {r["w"]: r["n"] for r in words.where(F.col("w").isin(vocabulary)).collect()}


def needed(size: int, threshold: float) -> int:
    """Least overlap that meets the threshold: ceil(threshold * size), in whole hundredths."""
    return -(-round(threshold * 100) * size // 100)


def notices(templates: dict) -> list[tuple[str, Notice]]:
    """(label, notice) of all templates; plain strings are notices without further conditions."""
    return [(label, t if isinstance(t, Notice) else Notice(t)) for label, texts in templates.items() for t in texts]


def window_of(templates: dict) -> int:
    return max(WINDOW, 2 * max((len(n.words.split()) for _, n in notices(templates)), default=0))


def prefix_index(templates: dict, rank: dict[str, int], threshold: float) -> list[tuple]:
    """Rows (token, position, label, ranks, need, must, without): each template as ranks of its words, rarest first, under each of its prefix.

    A block with ``need`` of a template's n words holds one of the n - need + 1 rarest.
    """
    rows = []
    for label, notice in notices(templates):
        ranks = sorted(rank[w] for w in set(notice.words.split()))
        need = needed(len(ranks), threshold)
        more = [sorted(rank[w] for w in set(x.split())) for x in (notice.must, notice.without)]
        rows += [(r, i, label, ranks, need, *more) for i, r in enumerate(ranks[: len(ranks) - need + 1])]
    return rows


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict = TEMPLATES, threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Base places are where a phrase's words stand one after the other. For the method's labels the words of templates and
    of blocks (windows of the whole text's words) become ranks in one global order, rarest in the corpus first; a block
    joins the templates whose prefix holds one of its words. The length filter (a block needs as many template words
    as the template asks for) and the positional filter (what stands after the matched word, in the template and in the
    block, must suffice with it; so must what stands before it and after it) leave the blocks whose containment is
    computed. A block that meets a template must hold its distinguishing words and none of its relatives' (:class:`Notice`). ``score`` is the largest containment met, 1 for a base place, else 0.

    The texts' words are found once and written, as ranks, for texts with a prefix word only. Null and empty texts have
    no words. Repeated rows give equal rows, rows with a null id are scanned, too. Other columns are not read. An empty
    table gives no rows.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    window = window_of(templates)
    vocabulary = sorted({w for _, notice in notices(templates) for x in notice for w in x.split()})
    counts = token_counts(F.col("text"), d, vocabulary) if vocabulary else {}
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    index = prefix_index(templates, rank, threshold)
    first = sorted({r[0] for r in index})
    named = {i: w for w, i in rank.items()}
    spark = d.sparkSession
    rows = spark.createDataFrame(index, "rank int, position int, label string, words array<int>, need int, must array<int>, without array<int>")

    folded = lambda w: F.translate(w, UPPER, LOWER)
    w = d.select("doc_id", words_of(F.col("text")).alias("w"))
    rare, has = [named[i] for i in first], lambda some: F.exists("w", lambda x: F.lower(x).isin(some))
    w = w.select("doc_id", "w", (has(rare) if rare else F.lit(False)).alias("maybe"), has([p.split()[-1] for p in PHRASES.values()]).alias("base"))
    w = w.select("doc_id", F.size("w").cast("long").alias("n_words"), "maybe", "base", F.when(F.col("maybe") | F.col("base"), F.transform("w", folded)).alias("w"))
    at = lambda i, k: F.get("w", i + k)

    def place(x: Column, i: Column) -> Column:
        case = None
        for label, phrase in PHRASES.items():
            head, *rest = phrase.split()
            test = x == head
            for k, y in enumerate(rest, 1):
                test = test & (at(i, k) == y)
            case = F.when(test, label) if case is None else case.when(test, label)
        return F.struct(i.cast("long").alias("i"), case.alias("label"))

    places = F.filter(F.transform("w", place), lambda p: p["label"].isNotNull())
    none = F.array().cast("array<struct<i:bigint,label:string>>")
    ranks = F.create_map(*(F.lit(x) for pair in rank.items() for x in pair)) if rank else None
    as_rank = F.transform("w", lambda x: F.when(x.isin(vocabulary), F.element_at(ranks, x)).otherwise(F.lit(-1))) if rank else F.lit(None).cast("array<int>")
    table = cut(w.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", F.coalesce(F.when(F.col("base"), places), none).alias("p"),
        F.when(F.col("maybe"), as_rank).alias("ranks")), "licenses")

    starts = F.sequence(F.lit(1), F.greatest(F.size("ranks") - window // 2, F.lit(1)), F.lit(window // 2))
    block = lambda s: F.array_sort(F.array_distinct(F.filter(F.slice("ranks", s, window), lambda x: x >= 0)))
    some = lambda b: F.arrays_overlap(b, F.array(*map(F.lit, first)))
    blocks = table.where("ranks is not null").select("row", F.explode(F.filter(F.transform(starts, block), some)).alias("b"))
    found = blocks.select("row", "b", F.posexplode("b").alias("at", "rank")).where(F.col("rank").isin(first)).join(F.broadcast(rows), "rank")
    after = lambda x, i: F.size(x) - i  # noqa: E731  the word itself and what follows it
    found = found.where(F.col("need") <= F.size("b"))
    found = found.where(F.least(F.col("position"), F.col("at")) + F.least(after("words", F.col("position")), after("b", F.col("at"))) >= F.col("need"))
    overlap = F.size(F.array_intersect("words", "b"))
    told = (F.size(F.array_except("must", "b")) == 0) & ~F.arrays_overlap("without", "b")
    found = found.where((overlap >= F.col("need")) & told).select("row", "label", (overlap / F.size("words")).alias("containment"))
    found = found.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))

    columns = ["doc_id", "n_words", "p"]
    out = table.where("ranks is not null").join(found, "row", "left").select(*columns, "more", "best")
    out = out.unionByName(table.where("ranks is null").select(*columns), allowMissingColumns=True)
    labels = F.array_sort(F.array_distinct(F.col("p")["label"]))
    return out.select(
        "doc_id", "n_words", F.size("p").cast("long").alias("n_base"), F.get("p", F.lit(0))["i"].alias("first_word"),
        F.get("p", F.size("p") - 1)["i"].alias("last_word"), F.array_join(labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels, F.coalesce("more", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.size("p") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def _values() -> str:
    as_list = lambda x: f"CAST([{', '.join(repr(w) for w in sorted(set(x.split())))}] AS VARCHAR[])"
    rows = []
    for label, notice in notices(TEMPLATES):
        rows.append(f"('{label}', {', '.join(map(as_list, notice))}, {needed(len(set(notice.words.split())), THRESHOLD)})")
    return ", ".join(rows)


_SPAN = window_of(TEMPLATES)

LICENSE_SQL = rf"""
WITH t(label, words, must, without, need) AS (VALUES {_values()}),
d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM d),
p AS (SELECT doc_id, unnest(list_filter(list_transform(range(1, len(w) + 1), lambda i: struct_pack(i := i - 1, label :=
    CASE WHEN w[i] = 'mit' AND w[i + 1] = 'license' THEN 'mit' WHEN w[i] = 'apache' AND w[i + 1] = 'license' THEN 'apache'
         WHEN w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license' THEN 'gpl' END)), lambda x: x.label IS NOT NULL)) AS p FROM w),
b AS (SELECT doc_id, count(*) AS n_base, CAST(min(p.i) AS BIGINT) AS first_word, CAST(max(p.i) AS BIGINT) AS last_word,
  string_agg(DISTINCT p.label, ',' ORDER BY p.label) AS base_labels FROM p GROUP BY doc_id),
bl AS (SELECT doc_id, w[s : s + {_SPAN - 1}] AS b FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {_SPAN // 2}, 1) + 1, {_SPAN // 2})) AS s FROM w)),
f AS (SELECT doc_id, label, len(list_distinct(list_intersect(words, b))) / len(words) AS c
      FROM bl JOIN t ON len(list_distinct(list_intersect(words, b))) >= need AND list_has_all(b, must) AND NOT list_has_any(b, without)),
a AS (SELECT doc_id, label, c FROM f UNION ALL SELECT doc_id, p.label, 1.0 FROM p),
g AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(c) AS score FROM a GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN g USING (doc_id)
"""
