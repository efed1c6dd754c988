"""Quality rules: counts in whole texts and a hashed n-gram log-likelihood ratio.

The base rules count words, characters, signs, repeated lines and repeated five-word windows of
each text. The verdict of the method is the mean log-likelihood ratio of the text's hashed words
and word pairs between two multinomials, one of trusted target text and one of the whole raw
corpus, against a fixed threshold.

All of it is DataFrame expressions. A document is read by two passes, one that counts n-grams
(partially aggregated in each task, `BUCKETS` rows at most leave it) and one that scores with the
weights as a constant array. The trusted target is a bounded sample of labelled documents
(`max_trusted`, by the smallest hash of the id); the raw counts cover all documents.

Defined cases: null or wordless text has zero counts and fails the base rules; without labels
all weights are 0, so the base rules decide alone; repeated rows are judged alike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from posterion.functions.scalars import const_array
from posterion.llm.common import BREAK, kept

BUCKETS = 1 << 15
MAX_TRUSTED = 20_000
THRESHOLD = -0.10           # mean log ratio per n-gram below which a text is left out
WINDOW = 5
SEED = 23


def let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAK), "")


def buckets(hashes: Column) -> Column:
    """Buckets of all words and pairs of neighbours, from the words' hashes."""
    one = F.transform(hashes, lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))
    two = F.transform(hashes, lambda h, i: F.pmod(F.xxhash64(h, F.get(hashes, i + 1)), F.lit(BUCKETS)).cast("int"))
    return F.concat(one, F.slice(two, F.lit(1), F.greatest(F.size(hashes) - 1, F.lit(0))))


def covered(windows: Column) -> Column:
    """Words covered by windows that occur twice or more, from the windows' hashes in order."""
    def cover(order: Column) -> Column:      # sorted (hash, place); a neighbour with the same hash marks a repeat
        def repeated(x, i):
            same = lambda y: F.coalesce(y["h"] == x["h"], F.lit(False))      # noqa: E731
            return same(F.get(order, i - 1)) | same(F.get(order, i + 1))
        places = F.sort_array(F.transform(F.filter(order, repeated), lambda x: x["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(places, start, lambda a, i: F.struct((a["n"] + i + WINDOW - F.greatest(i, a["end"])).alias("n"), (i + WINDOW).alias("end")),
                           lambda a: a["n"])

    order = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), let(order, cover)).otherwise(0)


def measured(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, hashes (of the words in order) and the counts of the base rules."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), t.alias("t")).withColumn("w", words(F.col("t")))
    lines = F.filter(F.split("t", "\n"), lambda l: F.length(F.translate(l, " \t\n\x0b\x0c\r", "")) > 0)
    hashes = F.transform("w", lambda x: F.xxhash64(x))

    def windows(h):
        n = F.size(h) - (WINDOW - 1)
        return F.when(n > 0, F.transform(F.slice(h, F.lit(1), F.greatest(n, F.lit(1))), lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, WINDOW)))))

    found = let(hashes, lambda h: F.struct(h.alias("hashes"), F.coalesce(let(windows(h), covered), F.lit(0)).alias("repeat")))
    n_lines = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    rows = rows.select("doc_id", F.size("w").cast("long").alias("n_words"),
                       F.length(F.translate("t", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
                       (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
                       n_lines.cast("long").alias("n_dup_lines"), found.alias("f"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.col("f.repeat").cast("long").alias("n_repeat_words"), F.col("f.hashes").alias("hashes"))


def weights(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", max_trusted: int = MAX_TRUSTED) -> list[int]:
    """Log ratio target to raw of each bucket in thousandths."""
    trusted = kept(labels.filter((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
                   .orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(max_trusted)
                   .select(F.col("doc_id").alias("__id"), F.lit(1).alias("__trusted")))
    marked = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text}`").alias("__text")).join(F.broadcast(trusted), "__id", "left")
    grams = marked.select("__trusted", F.explode(let(F.transform(words(F.col("__text")), lambda x: F.xxhash64(x)), buckets)).alias("b"))
    counts = grams.groupBy("b").agg(F.count(F.lit(1)).alias("raw"), F.count("__trusted").alias("target")).collect()     # at most BUCKETS rows
    trusted.unpersist()
    raw, target = sum(r.raw for r in counts), sum(r.target for r in counts)
    out = [0] * BUCKETS
    if target:
        base = math.log((raw + BUCKETS) / (target + BUCKETS))
        out = [round(1000 * base)] * BUCKETS
        for r in counts:
            out[r.b] = round(1000 * (math.log((r.target + 1) / (r.raw + 1)) + base))
    return out


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Counts, mean log ratio, base_failed and kept of every document."""
    table = const_array(weights(docs, labels, id_col, text)).cast("array<int>")
    rows = measured(docs, id_col, text)
    total = let(F.col("hashes"), lambda h: F.aggregate(buckets(h), F.lit(0).cast("long"), lambda s, b: s + F.get(table, b)))
    n = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    rows = rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (total / (1000.0 * n)).alias("mean_ratio"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("mean_ratio") >= threshold))
