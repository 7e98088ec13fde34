"""Queries on small tables of their own: whole input, bounded memory, exact results."""

import datetime
import tracemalloc

import numpy as np
import pytest

from __spark_entry__ import queries
from marshlight.operators import cleaning, quantiles
from marshlight.plans import outliers

ALL = queries()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Eight districts with two facilities each, five years of months."""
    folder = str(tmp_path_factory.mktemp("tables"))
    rng = np.random.default_rng(5)
    lines = []
    for supplier in range(16):
        for month in range(60):
            day = datetime.datetime(2015 + month // 12, month % 12 + 1, 3)
            for line, flag in enumerate("ARNR"):
                if flag == "N" or rng.random() < 0.95:
                    lines.append((month, supplier, line + 1, float(rng.integers(1, 51)), float(rng.integers(100, 900)) / 4,
                                  float(rng.integers(0, 9)) / 100, flag, "F", day))
    made = {
        "region": ([(0, "SOUTH"), (1, "NORTH")], "r_regionkey long, r_name string"),
        "nation": ([(n, f"N{n}", n % 2) for n in range(8)], "n_nationkey long, n_name string, n_regionkey long"),
        "supplier": ([(s, f"S{s}", 100.0 * s, s % 8) for s in range(16)], "s_suppkey long, s_name string, s_acctbal double, s_nationkey long"),
        "lineitem": (lines, "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                            "l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "orders": ([(k, k % 40, float(k), datetime.datetime(2015 + k % 5, k % 12 + 1, 1)) for k in range(240)],
                   "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_rain_seasonality_has_every_district(spark, tables):
    """all districts of the facilities, not three groups of customers."""
    got = {r.ADM2_ID: r.SEASONALITY_RAINFALL for r in ALL["K19_rain_seasonality"](spark, tables).collect()}
    assert got == {f"D{n}": 1 for n in range(8)}


def test_cleaning_holds_a_block_of_series_at_a_time():
    """F2, F5 to F7: what the decomposition holds does not grow with the number of series."""
    y = np.random.default_rng(6).poisson(60, (4096, 84)).astype(float)
    cleaning.seasonal_flags(y[:256], 2)  # matrices of this length are kept
    tracemalloc.start()
    flags = cleaning.seasonal_flags(y, 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6
    assert (flags[256:512] == cleaning.seasonal_flags(y[256:512], 2)).all()


def test_series_without_outliers_are_decomposed_once(monkeypatch):
    """F5 to F7: the second search reads the first one's residuals where nothing was taken out."""
    calls, decompose = [], cleaning.decompose
    monkeypatch.setattr(cleaning, "decompose", lambda y: calls.append(len(y)) or decompose(y))
    t = np.arange(84)
    y = 200 + 100 * np.sin(t / 6 * np.pi) + np.random.default_rng(7).normal(0, 5, (10, 84))
    y[3, 40] += 900
    cleaning.clean(y)
    assert calls[0] == 10 and sum(calls) < 2 * len(y)


def test_quantiles_stage_the_values_without_a_shuffle(spark, monkeypatch):
    """values are neither dealt out one by one nor joined with a thousand edges each; groups without a key stay out."""
    plans, stage = [], quantiles.stage
    monkeypatch.setattr(quantiles, "stage", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or stage(df))
    values = np.random.default_rng(8).lognormal(3, 2, 3000)
    rows = [("a", float(v)) for v in values] + [("b", float(k % 3)) for k in range(50)] + [(None, 1.0), ("a", None)]
    got = {(r.k, r.prob): r.quantile for r in quantiles.exact_quantiles(
        spark.createDataFrame(rows, "k string, v double"), "v", [0.25, 0.9], ["k"]).collect()}
    assert "Exchange" not in plans[0]
    assert got == {("a", p): pytest.approx(np.quantile(values, p), rel=1e-12) for p in (0.25, 0.9)} | {("b", 0.25): 0.0, ("b", 0.9): 2.0}


def test_series_are_sorted_once_and_dealt_by_facility(spark):
    """one sort of a task's rows for both windows, and parts that grow in number with the session's setting."""
    schema = "PERIOD int, YEAR int, MONTH int, ADM1_ID string, ADM2_ID string, OU_ID string, INDICATOR string, VALUE double"
    text = outliers.detect(spark.createDataFrame([], schema), "IQR")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Sort [") == 1 and text.count("Exchange hashpartitioning(OU_ID") == 1


def test_routine_variant_is_the_imputed_one(spark, tables):
    got = ALL["B16_routine_variant"](spark, tables)
    assert set(got.columns) == {"OU_ID", "PERIOD", "INDICATOR", "VALUE"} and got.count() == 16 * 60 * 4
