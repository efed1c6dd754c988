"""Kept rates of good documents that the weights were not learned from, by length."""

import os

import numpy as np
from pyspark.sql import functions as F

from posterion.llm import importance


def test_good_documents_stay_at_all_lengths(spark, data):
    data = os.path.join(os.path.dirname(data.rstrip("/")), "sf0.1")     # long documents are too few in the smaller tables
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{data}/labels.parquet").withColumn("seen", F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    share = labels.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    rows = {r.doc_id: r for r in importance.resample(docs, labels.filter("seen or quality = 0").drop("seen"), share=share).collect()}
    held = {r.doc_id for r in labels.filter("not seen and quality = 1 and coalesce(toxic, 0) = 0").collect()}
    length = {i: len(importance.features(rows[i].text)) for i in held}
    for low, high in ((1, 200), (200, 2000), (2000, 10 ** 9)):
        own = [rows[i].selected for i in held if low <= length[i] < high]
        assert len(own) >= 50 and np.mean(own) >= 0.97, (low, len(own), np.mean(own))
    bad = [rows[r.doc_id].selected for r in labels.filter("quality = 0").collect()]
    assert np.mean(bad) < 0.1
