"""Registered queries against their SQL twins. The default takes one query of each group;
FULL=1 takes all of them."""

import os
import re

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

NAMES = list(entry.queries())


def chosen():
    if os.environ.get("FULL"):
        return NAMES
    seen, out = set(), []
    for n in NAMES:
        g = re.match("[a-z]+", n).group()
        if g not in seen and n in entry.oracle_sql():
            seen.add(g)
            out.append(n)
    return out


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


@pytest.mark.parametrize("name", chosen())
def test_query_matches_sql(spark, duck, data, name):
    assert compare(spark, duck, name, entry.queries()[name], entry.oracle_sql().get(name), data) is None


def test_every_operator_has_a_query():
    ids = {n.split("_")[0] for n in NAMES}
    want = {f"{g}{i}" for g, n in (("s", 11), ("t", 10), ("f", 7), ("d", 10), ("p", 18), ("g", 4), ("q", 18), ("m", 6), ("i", 14),
                                   ("v", 21), ("w", 12)) for i in range(1, n + 1)}
    assert want <= ids
    assert set(entry.oracle_sql()) <= set(NAMES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["case_id", "loglikelihood", "any_return_maxlikelihood", "any_return_probability"]
    assert df.count() == 1500


def test_scoring_plan_is_one_stage_and_pruned(spark, data):
    from catalogue.scoring import nb1
    from posterion.operators.score import score
    model = nb1(spark, data)
    orders = spark.read.parquet(f"{data}/orders.parquet")
    plan = score(orders, model, id_col="o_orderkey", append=False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    schema = plan[plan.index("ReadSchema"):]
    assert "o_orderpriority" in schema and "o_totalprice" not in schema
