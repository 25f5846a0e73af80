import math
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plans import count, plan
from tallycast.config import FeatureSpec
from tallycast.operators.temporal import temporal_features

DAY = date(2021, 1, 1)


def month(i):
    return date(2020 + i // 12, i % 12 + 1, 1)


def panel(spark, values, customer=1):
    rows = [(customer, month(i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "c long, d date, v long")


def column(df, name):
    return [r[name] for r in df.orderBy("c", "d").select(name).collect()]


def test_lag_and_rolling_skip_nulls(spark):
    out = temporal_features(panel(spark, [1, None, 3]), "c", "d", "v")
    assert column(out, "v_lag_1m") == [None, 1, None]
    assert column(out, "v_rolling_mean_3m") == [1.0, 1.0, 2.0]
    std = column(out, "v_rolling_std_3m")
    assert std[:2] == [None, None] and math.isclose(std[2], math.sqrt(2))
    assert column(out, "v_rolling_std_1m") == [None, None, None]


def test_null_customer_has_no_features(spark):
    out = temporal_features(panel(spark, [5, 6], customer=None), "c", "d", "v")
    names = [c for c in out.columns if c.startswith(("v_", "velocity", "trend", "yoy"))]
    assert len(names) == 28
    assert all(r[n] is None for r in out.collect() for n in names)


def test_rows_without_a_customer_meet_no_window(spark):
    df = spark.range(3000).selectExpr("cast(null as long) AS c", "date'2021-01-01' AS d", "id AS v")
    out = temporal_features(df.unionAll(df.selectExpr("v % 7", "d", "v")), "c", "d", "v", one_row_per_period=True)
    text = plan(out)
    assert text.count("Window [") == 1 and text.count("Exchange hashpartitioning") == 1
    assert out.filter("c is null").count() == 3000


def test_trend_and_growth(spark):
    out = temporal_features(panel(spark, [4, 5, 6, 10]), "c", "d", "v")
    assert column(out, "trend_3m") == [None, None, None, 6]
    out = temporal_features(panel(spark, [1] + [0] * 11 + [5]), "c", "d", "v")
    assert column(out, "yoy_growth")[-1] == 2.0
    assert column(out, "velocity_1m_vs_12m")[-1] == 2.5


def test_zero_denominator_is_null(spark):
    out = temporal_features(panel(spark, [-1] * 13), "c", "d", "v")
    assert column(out, "velocity_3m_vs_12m") == [None] * 13


def test_calendar_of_null_date(spark):
    df = spark.createDataFrame([(1, date(2021, 11, 2), 1), (1, None, 2)], "c long, d date, v long")
    out = temporal_features(df, "c", "d", "v").collect()
    flags = {r["d"]: (r["is_nov_jan"], r["is_holiday_season"]) for r in out}
    assert flags == {date(2021, 11, 2): (1, 1), None: (0, 0)}


def test_lag_three_is_hidden_when_not_asked_for(spark):
    spec = FeatureSpec(short_lags=(1,), seasonal_lags=(24,), velocity=((3, 12), (6, 1)))
    out = temporal_features(panel(spark, [1, 2, 3, 9]), "c", "d", "v", spec)
    assert column(out, "trend_3m") == [None, None, None, 8]
    assert "v_lag_3m" not in out.columns and "yoy_growth" not in out.columns
    assert [c for c in out.columns if c.startswith("velocity")] == ["velocity_6m_vs_1m"]


def test_unknown_statistic_and_missing_column(spark):
    with pytest.raises(ValueError, match="unknown"):
        temporal_features(panel(spark, [1]), "c", "d", "v", FeatureSpec(rolling_stats=("mode",)))
    with pytest.raises(ValueError, match="missing"):
        temporal_features(panel(spark, [1]), "c", "nope", "v")


def test_same_as_pandas(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame(
        [(c, month(i), float(rng.integers(0, 9))) for c in range(20) for i in range(int(rng.integers(1, 40)))],
        columns=["c", "d", "v"],
    )
    frame.loc[rng.random(len(frame)) < 0.1, "v"] = np.nan
    rows = [(int(c), d, None if math.isnan(v) else v) for c, d, v in frame.itertuples(index=False)]
    got = (
        temporal_features(spark.createDataFrame(rows, "c long, d date, v double").repartition(5), "c", "d", "v")
        .orderBy("c", "d")
        .toPandas()
    )
    grouped = frame.groupby("c")["v"]
    for n in (1, 2, 3, 6):
        np.testing.assert_allclose(got[f"v_lag_{n}m"].astype(float), grouped.shift(n))
    for n in (1, 3, 6, 12):
        for stat in ("mean", "std", "min", "max"):
            want = getattr(grouped.rolling(n, min_periods=1), stat)().to_numpy()
            np.testing.assert_allclose(got[f"v_rolling_{stat}_{n}m"].astype(float), want, atol=1e-9)


def test_one_exchange_one_window(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderdate", "o_totalprice")
    out = temporal_features(df, "o_custkey", "o_orderdate", "o_totalprice")
    assert count(out, "Exchange") == 1
    assert count(out, "Window ") == 1


def test_future_rows_do_not_matter(spark):
    a = temporal_features(panel(spark, list(range(20))), "c", "d", "v")
    b = temporal_features(panel(spark, list(range(15)) + [99] * 5), "c", "d", "v")
    cut = F.col("d") < F.lit(month(15))
    assert a.filter(cut).orderBy("d").collect() == b.filter(cut).orderBy("d").collect()


@pytest.mark.parametrize("blocks", [1, 3, 16, 200])
def test_blocks_equal_plain_windows_for_a_hot_customer(spark, blocks):
    rows = [(1 if i % 3 else i % 7, DAY + timedelta(days=i // 4), i, i % 11) for i in range(1500)]
    df = spark.createDataFrame(rows, "c long, d date, id long, v long").repartition(6)
    plain = temporal_features(df, "c", "d", "v", tie_break=("id",))
    split = temporal_features(df, "c", "d", "v", tie_break=("id",), one_row_per_period=False, blocks=blocks)
    assert sorted(split.columns) == sorted(plain.columns)
    want = plain.orderBy("id").collect()
    got = split.select(plain.columns).orderBy("id").collect()
    assert got == want
