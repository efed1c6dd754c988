"""Ranked lexical search turned round: items wait in an inverted index, documents stream past.

The items' terms, with their weights, form an inverted index that is broadcast. One pass over the
documents counts them, their terms, and in how many documents each indexed term stands; a second
pass streams the term counts of each document through the index, adds up its score for every item
that shares a term, and keeps the `k` best documents of each item in its task. These short lists
are merged in two steps, first by task groups and then in whole, so no list grows with the number
of tasks. Documents are never shuffled.

The index of one pass holds at most `INDEX_BYTES` of terms and postings (measured before anything
is collected); more items are split into blocks, each with its own two passes.

Scores are integers: with N documents that have a term, L terms in all of them, n in this one, df
documents that hold a term and tf occurrences in this one, a term weighs
w = floor(1000 * ln((2N + 2) / (2 df + 1))), m = 10 + (90 n N) div L, and the document scores
w * ((1000000000 tf) div (1000 tf + 8 m)), summed over the item's distinct terms.

Defined cases: a null or termless document is not counted and never ranked; a null or termless
item has no rows; repeated rows are documents (or items) of their own; a null doc_id comes after
all others with its score; an item ranks documents with a score above 0 only.
"""

from __future__ import annotations

import math
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from posterion.llm.common import renamed, staged

INDEX_BYTES = 32 << 20       # terms and postings of one pass
CELLS = 2_000_000            # documents times items, or postings, added up at a time
MERGE = 64                   # task groups whose lists are merged first
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """item (row number), item_id, words (distinct, sorted), bytes; items without a term are gone."""
    schema = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("words", pa.list_(pa.binary())), ("bytes", pa.int64())])

    def work(batches):
        for b in batches:
            words = [sorted(set(terms(t))) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(words, pa.list_(pa.binary())),
                                              pa.array([sum(map(len, w)) + 64 * len(w) for w in words], pa.int64())], schema=schema)

    rows = renamed(items, {"item_id": item_id, "text": text}).select(
        F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long"), "text")
    found = rows.mapInArrow(work, "item long, item_id long, words array<binary>, bytes long").filter("bytes > 0")
    return staged(found, "items")


def blocks_of(items: DataFrame, limit: int) -> DataFrame:
    """The items with a block number, such that no block of several items exceeds `limit` bytes."""
    total = items.agg(F.sum("bytes")).first()[0] or 0
    n = max(1, -(-total // limit))
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(n)))
        over = dealt.groupBy("block").agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("c")).filter((F.col("b") > limit) & (F.col("c") > 1))
        if over.isEmpty():
            return dealt
        n *= 2


class Index:
    """Postings of one block: for each term the items that hold it, by number inside the block."""

    def __init__(self, rows):
        self.items = [(r["item"], r["item_id"]) for r in rows]
        self.number: dict[bytes, int] = {}
        postings: list[list[int]] = []
        for i, r in enumerate(rows):
            for w in r["words"]:
                at = self.number.setdefault(bytes(w), len(postings))
                if at == len(postings):
                    postings.append([])
                postings[at].append(i)
        self.start = np.concatenate([[0], np.cumsum([len(p) for p in postings], dtype=np.int64)]).astype(np.int64)
        self.item = np.fromiter(chain.from_iterable(postings), np.int64, int(self.start[-1]))


def counted(docs: DataFrame, index) -> tuple[int, int, np.ndarray]:
    """N, L and df of every indexed term; index is a broadcast Index."""
    size = len(index.value.number)

    def work(batches):
        get, df, n, length = index.value.number.get, np.zeros(size, np.int64), 0, 0
        for b in batches:
            for t in b.column(0).to_pylist():
                found = terms(t)
                n += bool(found)
                length += len(found)
                df[[i for i in map(get, set(found)) if i is not None]] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"at": np.concatenate([[-2, -1], at]).astype(np.int32), "n": np.concatenate([[n, length], df[at]])})

    rows = docs.select("text").mapInArrow(work, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()    # at most one row a term
    got = {r["at"]: r["n"] for r in rows}
    df = np.zeros(size, np.int64)
    for at, n in got.items():
        if at >= 0:
            df[at] = n
    return got.get(-2, 0), got.get(-1, 0), df


class Heaps:
    """The k best documents of every item met so far, as sorted arrays."""

    def __init__(self, items: int, k: int):
        self.k, self.floor = k, np.zeros(items, np.int64)
        self.rows = [np.empty(0, t) for t in (np.int64, np.int64, np.int64, bool)]      # item, score, doc, doc is null

    def push(self, item, score, doc, null):
        item, score, doc, null = (np.concatenate(p) for p in zip(self.rows, (item, score, doc, null)))
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        first = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]])) if len(item) else np.empty(0, int)
        place = np.arange(len(item)) - np.repeat(first, np.diff(np.concatenate([first, [len(item)]])))
        kept = order[place < self.k]
        last = order[place == self.k - 1]
        self.rows = [item[place < self.k], score[kept], doc[kept], null[kept]]
        self.floor[item[place == self.k - 1]] = score[last]


def streamed(docs: DataFrame, index, weight, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The k best documents of every item in each task: item, item_id, doc_id, score."""
    def work(batches):
        ix, w = index.value, weight.value
        get, items = ix.number.get, len(ix.items)
        heaps = Heaps(items, k)
        step = max(1, CELLS // items)

        def add(ids, numbers, lengths, nulls, owners):
            """Scores of some documents: numbers are their terms' numbers, owners the documents these stand in."""
            key, tf = np.unique(np.array(owners, np.int64) * len(w) + np.array(numbers, np.int64), return_counts=True)
            doc, term = key // len(w), key % len(w)
            m = np.array([10 + 90 * n * n_docs // n_terms for n in lengths], np.int64)
            tf = tf.astype(np.int64)
            value = w[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
            size = ix.start[term + 1] - ix.start[term]
            total = np.zeros(len(ids) * items, np.int64)
            ends = np.cumsum(size)
            cut = 0
            while cut < len(size):
                stop = max(cut + 1, int(np.searchsorted(ends, (ends[cut - 1] if cut else 0) + CELLS, "right")))
                s = size[cut:stop]
                inside = np.arange(s.sum()) - np.repeat(np.cumsum(s) - s, s)
                posting = ix.item[np.repeat(ix.start[term[cut:stop]], s) + inside]
                np.add.at(total, np.repeat(doc[cut:stop], s) * items + posting, np.repeat(value[cut:stop], s))
                cut = stop
            total = total.reshape(-1, items)
            d, i = np.nonzero((total > 0) & (total >= heaps.floor))
            heaps.push(i, total[d, i], ids[d], nulls[d])

        for b in batches:
            null = b.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = b.column(0).fill_null(0).to_numpy()
            texts = b.column(1)
            for at in range(0, len(ids), step):
                numbers, owners, lengths = [], [], []
                for j, t in enumerate(texts.slice(at, step).to_pylist()):
                    found = terms(t)
                    lengths.append(len(found))
                    here = [i for i in map(get, found) if i is not None]
                    numbers += here
                    owners += [j] * len(here)
                if numbers:
                    add(ids[at:at + step], numbers, lengths, null[at:at + step], owners)
        item, score, doc, gone = heaps.rows
        yield pa.RecordBatch.from_arrays(
            [pa.array([ix.items[i][0] for i in item], pa.int64()), pa.array([ix.items[i][1] for i in item], pa.int64()),
             pa.array(doc, pa.int64(), mask=gone), pa.array(score, pa.int64())], names=["item", "item_id", "doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(work, "item long, item_id long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
           index_bytes: int = INDEX_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k best documents of every item."""
    spark = docs.sparkSession
    docs = renamed(docs, {"doc_id": doc_id, "text": text}).withColumn("doc_id", F.col("doc_id").cast("long"))
    dealt = blocks_of(item_terms(items, item_id, text), index_bytes)
    found = spark.createDataFrame([], "item long, item_id long, doc_id long, score long")
    for (block,) in dealt.select("block").distinct().orderBy("block").collect():
        index = spark.sparkContext.broadcast(Index(dealt.filter(F.col("block") == block).collect()))       # at most index_bytes, or one item
        n_docs, n_terms, df = counted(docs, index)
        if not n_docs:
            break
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        found = found.unionByName(streamed(docs, index, spark.sparkContext.broadcast(weight), n_docs, n_terms, k))
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGE)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*best))).filter(F.col("rank") <= k).drop("rank", "part")
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best))).filter(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
