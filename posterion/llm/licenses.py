"""License scans by diagonal voting.

All rolling k-grams of a document's words are hashed and joined to the hashes of the templates'
grams (`k` is 2 for phrases of up to four words, 4 for longer templates). A hit at word p of the
document and word t of the template votes for the diagonal p - t. Votes are added up by document,
template and diagonal; a diagonal that every gram of the template voted for is an exact place.
Neighbouring diagonals of one template (words added or left out in between) are merged into
one span, and the span is verified: its hits must form a chain that rises in document and template
alike, and the share of the template's words on that chain is the span's score. Base phrases count
exact places only; other templates give their label from `share` upwards.

The templates are an argument of bounded size, so their grams are broadcast and document grams
never leave their task: only hits and one narrow row a document are shuffled. Grams are 64-bit
hashes of 64-bit word hashes, equal for different words once in some 10^19 comparisons, and a place
needs all its grams.

Defined cases: null, empty or wordless text has no words, no labels and score 0; repeated rows are
documents of their own (also those without id); a text of fewer words than k has no grams of that
width; overlapping places all count.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from posterion.llm.common import renamed

SLACK = 8                    # diagonals up to this far apart belong to one span
SHARE = 0.6                  # of a template's words, found in order, for its label
MAX_TEMPLATE_WORDS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A label and its wording; `base` phrases count exact places, others need `share` of their words."""
    label: str
    text: str
    base: bool = False
    share: float = SHARE


# fixed values: phrases of the base labels
PHRASES = (
    Template("mit", "mit license", True),
    Template("apache", "apache license", True),
    Template("gpl", "general public license", True),
)
# fixed values: statements and passages of public licenses
PASSAGES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", share=0.85),
    Template("mit-statement", "released under the mit license", share=1.0),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", share=0.85),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", share=1.0),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", share=1.0),
    Template("cc-by-4.0", "licensed under cc by 4 0", share=1.0),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", share=1.0),
    Template("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", share=0.9),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
             " documentation files the software to deal in the software without restriction including without limitation the rights"
             " to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    Template("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted provided that"
             " the following conditions are met redistributions of source code must retain the above copyright notice this list of"
             " conditions and the following disclaimer"),
    Template("isc-text", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
             " granted provided that the above copyright notice and this permission notice appear in all copies"),
    Template("apache-text", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    Template("gpl-text", "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
             " public license as published by the free software foundation"),
    Template("mpl-text", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("unlicense-text", "this is free and unencumbered software released into the public domain"),
)


def words(text: Column) -> Column:
    """Words of a text in order: A-Z in lower case, then maximal runs of digits, letters and characters beyond ASCII."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BREAK), "")


def gram_hashes(hashes: Column, k: int) -> Column:
    """struct(gram hash, place) of all rolling k-grams, from the words' hashes."""
    starts = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (k - 1), F.lit(0)))
    return F.transform(starts, lambda x, i: F.struct(
        F.xxhash64(F.lit(k), x, *(F.get(hashes, i + j) for j in range(1, k))).alias("gram"), i.alias("place")))


def width(n_words: int) -> int:
    return max(1, min(2 if n_words <= 4 else 4, n_words))


def template_grams(spark: SparkSession, templates) -> tuple[DataFrame, list[int], list[int]]:
    """gram, template, t (place); the widths in use; the words of each template. A few thousand rows at most."""
    rows = spark.createDataFrame([(i, t.text) for i, t in enumerate(templates)], "template int, text string")
    rows = rows.select("template", words(F.col("text")).alias("w"))
    sizes = {r.template: r.n for r in rows.select("template", F.size("w").alias("n")).collect()}
    lengths = [sizes[i] for i in range(len(templates))]
    if not all(lengths):
        raise ValueError("a template without words")
    if sum(lengths) > MAX_TEMPLATE_WORDS:
        raise ValueError("templates are broadcast and must stay small")
    widths = sorted({width(n) for n in lengths})
    hashes = F.transform("w", lambda x: F.xxhash64(x))
    out = None
    for k in widths:
        part = rows.filter(F.col("template").isin([i for i, n in enumerate(lengths) if width(n) == k]))
        part = part.select("template", F.inline(gram_hashes(hashes, k))).withColumnRenamed("place", "t")
        out = part if out is None else out.unionByName(part)
    return out, widths, lengths


def chained(spans: pa.Array) -> pa.Array:
    """Per span (gram width, and diagonals with the template places that voted) the longest chain that rises in
    document and template: its first and last document word and the number of template words on it."""
    out = []
    for row in spans:
        found = []
        for span in row.as_py() or ():
            k = span["k"]
            # hits by document place; of one place the latest template place first, so that a chain takes one of them
            hits = sorted({(d["diagonal"] + t, -t) for d in span["diagonals"] for t in d["places"]})
            tails, last, back = [], [], []
            for n, (_, t) in enumerate(hits):
                at = bisect_left(tails, -t)
                back.append(last[at - 1] if at else -1)
                tails[at:at + 1], last[at:at + 1] = [-t], [n]
            chain, n = [], last[-1]
            while n >= 0:
                chain.append(hits[n])
                n = back[n]
            covered = {-t + j for _, t in chain for j in range(k)}
            found.append({"first": chain[-1][0], "last": chain[0][0] + k - 1, "words": len(covered)})
        out.append(found)
    return pa.array(out, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("words", pa.int32())])))


def diagonals(docs: DataFrame, templates, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """row, doc_id, n_words, template, diagonal, votes, places (template places that voted): the
    votes of every diagonal, and for each document one row without template."""
    grams, widths, _ = template_grams(docs.sparkSession, templates)
    rows = renamed(docs, {"doc_id": doc_id, "text": text}).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.transform(words(F.col("text")), lambda x: F.xxhash64(x)).alias("h"))
    none = F.array(F.struct(F.lit(None).cast("long").alias("gram"), F.lit(-1).alias("place")))
    hashed = F.concat(none, *(gram_hashes(F.col("h"), k) for k in widths))
    exploded = rows.select("row", "doc_id", F.size("h").alias("n_words"), hashed.alias("g")).select("row", "doc_id", "n_words", F.inline("g"))
    hits = exploded.join(F.broadcast(grams), "gram", "left").filter((F.col("place") < 0) | F.col("template").isNotNull())
    return (hits.groupBy("row", "doc_id", "n_words", "template", (F.col("place") - F.col("t")).alias("diagonal"))
            .agg(F.count("t").alias("votes"), F.sort_array(F.collect_list("t")).alias("places")))


def scanned(docs: DataFrame, templates=PHRASES + PASSAGES, doc_id: str = "doc_id", text: str = "text", slack: int = SLACK) -> DataFrame:
    """One row per document: doc_id, n_words, places and spans.

    `places` holds the exact places of base phrases (label, first, last: words from 0), `spans` the
    verified spans of the other templates (label, first, last, score), both in document order."""
    _, _, lengths = template_grams(docs.sparkSession, templates)
    votes = diagonals(docs, templates, doc_id, text)

    def of(values):         # one value per template, looked up by its number
        return F.get(F.array(*map(F.lit, values)), F.col("template"))

    # one exchange by document serves the windows and the last grouping
    order = Window.partitionBy("row").orderBy("template", "diagonal")
    new = (F.col("template") != F.lag("template").over(order)) | (F.col("diagonal") - F.lag("diagonal").over(order) > slack)
    exact = F.col("votes") == of([n - width(n) + 1 for n in lengths])
    base = of([t.base for t in templates])
    marked = votes.withColumn("span", F.sum(F.coalesce(new, F.lit(True)).cast("int")).over(order))
    place = F.struct(F.col("diagonal").alias("first"), (F.col("diagonal") + of(lengths) - 1).alias("last"), of([t.label for t in templates]).alias("label"))
    one = marked.groupBy("row", "doc_id", "n_words", "span", "template").agg(
        F.sort_array(F.collect_list(F.when(base & exact, place))).alias("places"),
        F.collect_list(F.when(~base, F.struct("diagonal", "places"))).alias("diagonals"))
    one = one.withColumn("span", F.when(F.size("diagonals") > 0, F.struct("template", of([width(n) for n in lengths]).alias("k"), "diagonals")))
    per_doc = one.groupBy("row", "doc_id", "n_words").agg(
        F.sort_array(F.flatten(F.collect_list("places"))).alias("places"), F.collect_list("span").alias("spans"))
    chain = F.arrow_udf(chained, "array<struct<first:int,last:int,words:int>>")
    found = per_doc.withColumn("spans", F.zip_with("spans", chain("spans"), lambda s, c: F.struct(s["template"].alias("template"), c.alias("c"))))
    label, size, share = (F.array(*map(F.lit, v)) for v in ([t.label for t in templates], lengths, [float(t.share) for t in templates]))
    spans = F.transform("spans", lambda s: F.struct(
        s["c"]["first"].alias("first"), s["c"]["last"].alias("last"), F.get(label, s["template"]).alias("label"),
        (s["c"]["words"] / F.get(size, s["template"])).alias("score"), F.get(share, s["template"]).alias("share"),
        F.get(size, s["template"]).alias("size")))
    spans = F.filter(spans, lambda s: (s["score"] >= s["share"]) & (s["last"] - s["first"] < 2 * s["size"]))
    spans = F.sort_array(F.transform(spans, lambda s: F.struct(s["first"], s["last"], s["label"], s["score"])))
    return found.select("doc_id", F.col("n_words").cast("long").alias("n_words"), "places", spans.alias("spans"))


def labelled(docs: DataFrame, templates=PHRASES + PASSAGES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The scan with sorted labels: doc_id, n_words, places, spans, base_labels, labels and the best score (0 to 1)."""
    found = scanned(docs, templates, doc_id, text)
    base = F.transform("places", lambda p: p["label"])
    every = F.concat(base, F.transform("spans", lambda s: s["label"]))
    best = F.array_max(F.concat(F.array(F.lit(0.0)), F.transform("places", lambda p: F.lit(1.0)), F.transform("spans", lambda s: s["score"])))
    return found.select("*", F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
                        F.array_join(F.array_sort(F.array_distinct(every)), ",").alias("labels"), best.alias("score"))
