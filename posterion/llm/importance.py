"""Quality classifier by importance resampling.

Two multinomials over hashed words and word pairs are counted: one on trusted text (labelled
good and not toxic), one on all text. A document's log weight is s * C / (n + C), where s is the
sum of the log ratios of its n features and C is TEMPER: near the sum itself for short texts, C
times the mean ratio for long ones, so that noise and cut act alike on all lengths. Adding Gumbel
noise and keeping the k largest keys draws k documents without replacement in proportion to
their weights.

The raw counts cover every document. The trusted side is a bounded sample of labelled documents
(`max_trusted`, the smallest hashes of their ids). k is the share of good labels times the
number of documents unless a share is given. The k-th key is found exactly by narrowing.

Defined cases: null or wordless text has weight 0; without labels all weights are 0 and every
document stays; equal keys (repeated rows) stand or fall together.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from posterion.llm.common import fresh, kept, kth_largest, staged

BUCKETS = 1 << 16
MAX_TRUSTED = 20_000
SEED = 17
TEMPER = 200        # features; a fixed value


def features(text: str | None) -> np.ndarray:
    """Buckets of all words and of all pairs of neighbours in the text."""
    words = text.encode("utf-8", "surrogatepass").split() if text else []
    one = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = one * np.uint64(0xD6E8FEB86659FD93)
    return (np.concatenate([mixed, two]) >> np.uint64(48)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Log ratio of each bucket, and the share of documents to keep."""
    ratio: np.ndarray
    share: float


def _count(batches):
    sums = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for text, trusted in zip(batch.column(0), batch.column(1)):
            counts = np.bincount(features(text.as_py()), minlength=BUCKETS)
            sums[0] += counts
            if trusted.as_py():
                sums[1] += counts
    for side in (0, 1):
        at = np.flatnonzero(sums[side])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), side, np.int32)), pa.array(at.astype(np.int32)),
                                          pa.array(sums[side][at])], names=["side", "bucket", "n"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", share: float | None = None,
        max_trusted: int = MAX_TRUSTED, smooth: float = 1.0) -> Model:
    """Count both texts and set the share of documents to keep."""
    good = F.col("quality") == 1
    rated = labels.filter("doc_id is not null and quality is not null")
    trusted = kept(rated.filter(good & (F.coalesce("toxic", F.lit(0)) == 0)).select("doc_id").distinct()
                   .orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(max_trusted)
                   .select(F.col("doc_id").alias("__id"), F.lit(True).alias("__trusted")))
    if share is None:
        n_rated, n_good = rated.agg(F.count(F.lit(1)), F.count_if(good)).first()
        share = n_good / n_rated if n_rated else 1.0
    marked = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text}`").alias("__text")).join(
        F.broadcast(trusted), "__id", "left").select("__text", F.coalesce("__trusted", F.lit(False)).alias("__trusted"))
    counts = marked.mapInArrow(_count, "side int, bucket int, n long").groupBy("side", "bucket").agg(F.sum("n").alias("n"))
    sums = np.zeros((2, BUCKETS))
    for r in counts.collect():          # at most two times BUCKETS rows
        sums[r.side, r.bucket] = r.n
    trusted.unpersist()
    if not sums[1].any():
        return Model(np.zeros(BUCKETS), 1.0)
    p = (sums + smooth) / (sums + smooth).sum(axis=1, keepdims=True)
    return Model(np.log(p[1] / p[0]), float(share))


def keyed(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text", weight: str = "log_weight",
          key: str = "gumbel_key", seed: int = SEED) -> DataFrame:
    """The table with each document's log weight and its noisy key."""
    ratio = docs.sparkSession.sparkContext.broadcast(model.ratio)

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        table = ratio.value
        found = (table[features(t.as_py())] for t in texts)
        return pa.array((float(r.sum()) * TEMPER / (len(r) + TEMPER) for r in found), pa.float64())

    # a document without id draws by its text
    own = F.xxhash64(F.col(f"`{id_col}`"), F.when(F.col(f"`{id_col}`").isNull(), F.col(f"`{text}`")), F.lit(seed))
    u = (F.shiftrightunsigned(own, 11).cast("double") + 0.5) / float(1 << 53)
    return docs.withColumn(weight, of(F.col(f"`{text}`"))).withColumn(key, F.col(weight) - F.log(-F.log(u)))


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", share: float | None = None,
             selected: str = "selected", weight: str = "log_weight", key: str = "gumbel_key") -> DataFrame:
    """The table with log weight, key and whether the document is among the k drawn."""
    model = fit(docs, labels, id_col, text, share)
    scored = staged(keyed(docs, model, id_col, text, weight, key), "scored")
    total = scored.count()
    cut = kth_largest(scored, key, round(model.share * total), total)
    return scored.withColumn(selected, F.lit(True) if cut is None else F.col(key) >= F.lit(cut))


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", share: float | None = None) -> DataFrame:
    """The drawn documents with their own columns."""
    flag, weight, key = fresh(docs, "__drawn"), fresh(docs, "__weight"), fresh(docs, "__key")
    out = resample(docs, labels, id_col, text, share, flag, weight, key)
    return out.filter(F.col(flag)).drop(flag, weight, key)
