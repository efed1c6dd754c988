"""The registered queries of the operators and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from posterion.llm import (html, importance, language, licenses, mixing, packing, pii, reversed_search, rules, simhash, topk, wavelet,
                           whitening)

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op6_simhash_near_duplicates")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op10_importance_resampling")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "log_weight", "gumbel_key", "selected")


@query("op7_curriculum_mix")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


@query("op8_bin_slack_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.packed(table(spark, sf_dir, "documents"), VOCABULARY)
    return found.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


@query("op2_wavelet_token_file")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = wavelet.write_shards(table(spark, sf_dir, "documents"), VOCABULARY)
    return wavelet.read_documents(shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


TOP_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as e from embeddings
  where embedding is not null and vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::bigint as score
  from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id and len(c.e) = len(q.e)),
r as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from s)
select query_id, rank, vec_id, score from r where rank <= 10"""


@query("op3_no_random_access_topk", TOP_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 100 == 0), 10)


@query("op4_ppm_language")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.identified(docs, language.train(docs))


@query("op9_likelihood_ratio_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_boosted_personal_data")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.located(docs, pii.train(spark), "found").select("doc_id", F.col("found.base").alias("base"), F.col("found.every").alias("every"))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["ord"] == kind)).cast("long").alias(f"n_{pii.KINDS[kind]}")

    counts = map(count, range(len(pii.KINDS)))
    return found.select("doc_id", *counts, F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("every")).alias("spans"))


@query("op1_tree_field_extraction")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html.extracted(pages, html.fit(html.training_pages()))
    return found.select("page_id", "url", F.col("main.text").alias("text"), F.length("main.text").cast("long").alias("n_chars"),
                        F.col("main.blocks").alias("n_blocks"), F.col("main.certainty").alias("certainty"))


@query("op11_diagonal_license_scan")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.labelled(table(spark, sf_dir, "documents").select("doc_id", "text"))
    first = F.transform("places", lambda p: p["first"].cast("long"))
    return found.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(first).alias("first_word"),
                        F.array_max(first).alias("last_word"), "base_labels", "labels", "score")


@query("op12_polarisation_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
         r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
RANKED_SQL = f"""
with d as (select row_number() over () as r, doc_id, {TERMS} as w from documents),
i as (select row_number() over () as item, item_id, unnest(list_distinct({TERMS})) as term from benchmark),
c as (select count(*) as docs, sum(len(w))::bigint as terms from d where len(w) > 0),
t as (select r, term, count(*) as tf from (select r, unnest(w) as term from d) group by r, term),
f as (select term, count(*) as df from t group by term),
m as (select r, doc_id, 100 - 90 + ((90 * len(w)::bigint * docs) // terms) as m from d, c where len(w) > 0),
s as (select item, item_id, t.r, sum(floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::bigint * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from i join t using (term) join f using (term) join m on m.r = t.r, c group by item, item_id, t.r),
k as (select item_id, row_number() over (partition by item order by score desc, doc_id)::int as rank, doc_id, score from s join d using (r) where score > 0)
select item_id, rank, doc_id, score from k where rank <= 10"""


@query("op13_reversed_search", RANKED_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reversed_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
