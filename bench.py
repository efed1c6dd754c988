"""Headline timings on the driver's data: one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession, functions as F  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    from catalogue.tables import DN1, MX1, NB1, dn_cases, labelled, order_cases, table, turn_cases
    from posterion.operators.fit import fit
    from posterion.operators.mixture import fit_mixture
    from posterion.operators.posterior import score_general
    from posterion.operators.score import ModelStatistics, MostLikelyState, StateProbability, impute, score
    from posterion.operators.structure import mutual_information
    from posterion.operators.validate import cross_validate, hash_folds
    from posterion.plans.templates import mixture

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    cases = order_cases(spark, sf_dir).persist()
    n = cases.count()
    model = fit(labelled(cases), NB1)            # warms the session as well
    dn = dn_cases(spark, sf_dir).persist()
    dn.count()
    dn_model = fit(dn, DN1)
    wide = mixture(discrete=["size_band", "o_orderpriority"], continuous=["sum_qty", "price_k"], latent_states=5)
    queries = [ModelStatistics(), MostLikelyState("any_return"), StateProbability("any_return", "1")]

    jobs = {
        "scan_to_case_table": lambda: run(order_cases(spark, sf_dir)),
        "fit_naive_bayes": lambda: fit(labelled(cases), NB1),
        "fit_discrete_network": lambda: fit(dn, DN1),
        "em_mixture_k5_10iter": lambda: fit_mixture(cases, wide, iterations=10, tolerance=0.0, start="sum_qty"),
        "score_naive_bayes": lambda: run(score(cases, model, queries)),
        "score_general_network": lambda: run(score_general(dn, dn_model, "any_return", id_col="case_id", evidence=["size_band", "qty_band"])),
        "impute": lambda: run(impute(cases, model, ["size_band", "sum_qty"])),
        "cross_validation_3fold": lambda: run(cross_validate(hash_folds(cases, "case_id", 3, 7), {"nb": NB1}, "any_return", k=3)),
        "mutual_information_lineitem": lambda: run(mutual_information(
            table(spark, sf_dir, "lineitem").withColumn("qty", F.col("l_quantity").cast("int")),
            ["l_returnflag", "l_linestatus", "l_linenumber", "l_discount", "l_tax", "qty"])),
    }
    times = {}
    for name, job in jobs.items():
        start = time.time()
        job()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""), "cases": n,
                      "score_rows_per_sec": round(n / times["score_naive_bayes"]),
                      "em_iteration_sec": round(times["em_mixture_k5_10iter"] / 10, 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
