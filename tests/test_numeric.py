import math
from datetime import date

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallycast.functions.scalars import (
    category_id,
    log_target,
    period_from_index,
    period_index,
    unlog_target,
)
from tallycast.operators import numeric
from tallycast.operators.numeric import exact_quantile, fit_imputer, ids_to_categories, skew_transform


def values(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "x double")


def test_median_treats_nan_as_null(spark):
    df = values(spark, [1.0, 2.0, float("nan"), None, 10.0])
    assert fit_imputer(df, ["x"]) == {"x": 2.0}
    assert math.isclose(fit_imputer(df, ["x"], "mean")["x"], 13 / 3)
    assert fit_imputer(df, ["x"], "constant") == {"x": 0.0}
    assert fit_imputer(df, ["absent"]) == {}
    assert fit_imputer(values(spark, [None, None]), ["x"]) == {}


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("shape", ["normal", "hot", "heavy", "steps"])
def test_quantile_narrows_to_the_exact_value(spark, monkeypatch, shape, q):
    monkeypatch.setattr(numeric, "BAND_ROWS", 20)
    rng = np.random.default_rng(5)
    xs = {
        "normal": rng.normal(size=4001),
        "hot": np.where(rng.random(4000) < 0.4, 7.0, rng.normal(size=4000) * 100),
        "heavy": np.exp(rng.normal(size=3999) * 30),
        "steps": np.repeat([1.0, 2.0, 3.0, 4.0], 1000),
    }[shape]
    df = values(spark, [float(x) for x in xs]).repartition(7)
    assert math.isclose(exact_quantile(df, ["x"], q)["x"], float(np.quantile(xs, q)), rel_tol=1e-12)


@pytest.mark.parametrize("q", [0.1, 0.5])
def test_bisection_step_is_exact_too(spark, monkeypatch, q):
    monkeypatch.setattr(numeric, "BAND_ROWS", 4)
    monkeypatch.setattr(numeric, "_narrow", lambda df, wide, _: [numeric._bisect(df, s) for s in wide.values()])
    xs = [float(x) for x in (1, 1, 2, 3, 3, 3, 5, 8, 8, 9, 20, 21)]
    assert math.isclose(exact_quantile(values(spark, xs), ["x"], q)["x"], float(np.quantile(xs, q)))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40))
def test_median_of_anything(spark, xs):
    assert math.isclose(exact_quantile(values(spark, xs), ["x"])["x"], float(np.median(xs)), abs_tol=1e-9)


def test_skew_log_and_flags(spark):
    df = spark.createDataFrame([(0, None), (1, -3.0), (2, 2.0)], "i int, x double")
    out = skew_transform(df, ["x", "absent"], {}).orderBy("i").collect()
    assert [r["x_log"] for r in out][:2] == [None, 0.0]
    assert math.isclose(out[2]["x_log"], math.log(3))
    df = spark.createDataFrame([(0, None), (1, 0.0), (2, 7.0)], "i int, x double")
    out = skew_transform(df, ["x"], {"x": 7.0}).orderBy("i").collect()
    assert [r["x"] for r in out] == [7.0, 0.0, 7.0]
    assert [r["x_is_missing"] for r in out] == [1, 0, 0]
    assert [r["x_is_zero"] for r in out] == [0, 1, 0]


def test_ids(spark):
    df = spark.createDataFrame([(101.0, 1), (None, 2)], "a double, i int")
    out = ids_to_categories(df, ["a", "absent"]).orderBy("i").collect()
    assert [r["a"] for r in out] == ["id_101", "id_nan"]
    assert df.select(category_id("a", "k")).first()[0] == "k101"


def test_target_transform_round_trip(spark):
    df = values(spark, [None, -5.0, 0.0, 41.0])
    out = df.select(log_target("x").alias("y")).select("y", unlog_target("y").alias("z")).collect()
    assert out[0]["y"] is None and out[0]["z"] is None
    assert out[1]["y"] == 0.0 and math.isclose(out[3]["z"], 41.0)
    assert df.select(log_target("x", enabled=False).alias("y")).collect()[1]["y"] == -5.0


@pytest.mark.parametrize("grain", ["month", "day"])
def test_period_index_round_trip(spark, grain):
    days = [date(1969, 12, 1), date(1970, 1, 1), date(2020, 2, 1), date(2021, 12, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    back = df.select(period_from_index(period_index("d", grain), grain).alias("b")).collect()
    assert [r["b"] for r in back] == days


def test_median_moves_no_rows(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    got = exact_quantile(lines, ["l_extendedprice", "l_quantity"])
    want = lines.agg(F.median("l_extendedprice"), F.median("l_quantity")).first()
    assert list(got.values()) == pytest.approx(list(want))
