"""Packing of clustered lengths, inner products beyond doubles, noise of documents without id."""

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from posterion.llm import importance, packing, topk
from posterion.llm.importance import Model

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_op8_clustered_lengths_fill_each_other(spark):
    """One task with long pieces, one with those that fill them up: no bin leaves loosely before they meet."""
    text = lambda n: "the" + " the" * (n - 2)      # noqa: E731  n tokens with the end id
    long = spark.range(2000, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit(text(2100)).alias("text"))
    short = spark.range(2000, 4000, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit(text(1996)).alias("text"))
    got = packing.packed(long.union(short), PATH).select("doc_id", "length", "sequence_id", "offset").collect()
    assert sorted(r.length for r in got) == [1996] * 2000 + [2100] * 2000
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert None not in bins and len(bins) <= 2010
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 4096


def test_op8_one_length_that_never_fits(spark):
    docs = spark.range(3000, numPartitions=3).select(F.col("id").alias("doc_id"), F.lit("the" + " the" * 2198).alias("text"))
    got = packing.packed(docs, PATH).select("doc_id", "sequence_id").collect()
    assert len({r.sequence_id for r in got}) == len(got) == 3000


def test_op3_components_beyond_doubles(spark):
    r = np.random.default_rng(7)
    for scale in (20.0, 3e3, 1e9):
        vectors = [(i, [float(x) for x in scale * r.normal(size=64)]) for i in range(300)]
        vectors[7] = (7, vectors[8][1])
        frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
        x = {i: [int(c) for c in np.floor(1024 * np.array(v))] for i, v in vectors}
        got = sorted(map(tuple, topk.top_k(frame, frame.filter("vec_id % 10 = 0"), 10).select("query_id", "rank", "vec_id", "score").collect()))
        want = []
        for q in range(0, 300, 10):
            scores = sorted((-sum(a * b for a, b in zip(x[q], x[i])), i) for i in x if i != q)[:10]
            want += [(q, n, i, max(-(1 << 63), min((1 << 63) - 1, -s))) for n, (s, i) in enumerate(scores, 1)]
        if scale < 1e9:
            assert got == want
        else:                       # beyond a long the score is cut, the order of the first is still that of equal longs
            assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]


def test_op10_weights_keys_and_documents_without_id(spark):
    """Log weights and keys against their definitions; documents without id draw by their text."""
    r = np.random.default_rng(3)
    ratio = r.normal(size=importance.BUCKETS)
    words = ["w%d" % i for i in range(50)]
    rows = [(i if i % 2 else None, " ".join(r.choice(words, r.integers(0, 30)))) for i in range(200)]
    got = importance.keyed(spark.createDataFrame(rows, "doc_id long, text string"), Model(ratio, .5)).collect()
    noise = []
    for g in got:
        f = importance.features(g.text)
        want = float(ratio[f].sum()) * importance.TEMPER / (len(f) + importance.TEMPER)
        assert abs(g.log_weight - want) < 1e-9
        noise.append(g.gumbel_key - g.log_weight)
    assert len({round(n, 9) for n, g in zip(noise, got) if g.doc_id is None}) == len({g.text for g in got if g.doc_id is None})
    assert abs(np.mean(noise) - 0.5772) < 0.3 and all(np.isfinite(noise))
