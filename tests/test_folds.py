from datetime import date, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from plans import plan
from tallycast.config import CvSpec
from tallycast.operators.folds import (
    fold_bounds,
    fold_columns,
    group_spans,
    purged_groups,
    rank_groups,
    rolling_folds,
    rolling_origin,
)
from tallycast.session import materialise


def month(i):
    return date(2015 + i // 12, i % 12 + 1, 1)


def months(spark, n, missing=()):
    return spark.createDataFrame([(month(i), i) for i in range(n) if i not in missing], "d date, i int")


# Worked by hand from the rule: (train_end, test_start, test_end).
EXPECTED = {
    11: [(6, 9, 10), (7, 10, 11)],
    13: [(6, 9, 10), (7, 10, 11), (8, 11, 12), (9, 12, 13)],
    24: [(6, 9, 12), (9, 12, 15), (12, 15, 18), (15, 18, 21), (18, 21, 24)],
    34: [(6, 9, 14), (11, 14, 19), (16, 19, 24), (21, 24, 29), (26, 29, 34)],
    80: [(6, 9, 23), (20, 23, 37), (34, 37, 51), (48, 51, 65), (62, 65, 79)],
}


@pytest.mark.parametrize("n", EXPECTED)
def test_bounds(spark, n):
    rows = fold_bounds(months(spark, n), "d").orderBy("fold").collect()
    assert [(r["train_end"], r["test_start"], r["test_end"]) for r in rows] == EXPECTED[n]
    assert rows[0]["test_start_date"] == month(9)


def test_too_short(spark):
    with pytest.raises(PySparkException, match="at least 11, got 10"):
        fold_bounds(months(spark, 10), "d").collect()


def test_fold_without_test_rows_is_left_out(spark):
    folds = rolling_folds(months(spark, 24, missing=(12, 13, 14)), "d")
    assert [f.fold for f in folds] == [0, 2, 3, 4]


def test_membership_agrees_with_columns_and_keeps_the_gap(spark):
    df = months(spark, 34)
    folds = rolling_folds(df, "d")
    members = rolling_origin(df, "d", folds, ["i"]).collect()
    marks = {r["i"]: r for r in fold_columns(df, "d", folds).collect()}
    for f, (train_end, start, end) in enumerate(EXPECTED[34]):
        train = {r["i"] for r in members if r["fold"] == f and r["role"] == "train"}
        test = {r["i"] for r in members if r["fold"] == f and r["role"] == "test"}
        assert train == set(range(train_end)) and test == set(range(start, end))
        assert train == {i for i, r in marks.items() if r["first_train_fold"] is not None and r["first_train_fold"] <= f}
        assert test == {i for i, r in marks.items() if r["test_fold"] == f}
        assert max(train) < min(test) - 2


def test_daily_dates_belong_to_their_month(spark):
    rows = [(date(2015, 1, 15) + timedelta(days=i),) for i in range(730)]
    folds = rolling_folds(spark.createDataFrame(rows, "d date"), "d")
    assert all(x.day == 1 for f in folds for x in (f.train_end, f.test_start, f.test_end))


def test_fold_predicates_reach_the_scan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    fold = rolling_folds(orders, "o_orderdate")[0]
    assert "GreaterThanOrEqual(o_orderdate" in plan(orders.filter(fold.tests(F.col("o_orderdate"))))


def test_ranks_are_dense_and_ordered(spark):
    rows = [(g, month(g % 3)) for g in range(500)]
    spans = materialise(group_spans(spark.createDataFrame(rows, "g long, d date"), "g", "d"))
    ranked = rank_groups(spans, "g").orderBy("group_rank").collect()
    assert [r["group_rank"] for r in ranked] == list(range(500))
    dates = [r["first_date"] for r in ranked]
    assert dates == sorted(dates)


def test_ranks_follow_the_time_of_day(spark):
    """Groups that start on one day, some at one moment, keep the order of their first timestamps."""
    from datetime import datetime

    rows = [(g, datetime(2021, 3, 1, g % 24, (7 * g) % 60, g % 2)) for g in range(600)]
    spans = materialise(group_spans(spark.createDataFrame(rows, "g long, d timestamp_ntz"), "g", "d"))
    ranked = rank_groups(spans, "g").orderBy("group_rank").collect()
    assert [r["group_rank"] for r in ranked] == list(range(600))
    dates = [r["first_date"] for r in ranked]
    assert dates == sorted(dates)


def test_group_split(spark):
    # Group g starts in month g and has ten monthly rows.
    rows = [(g, month(g + k), g * 100 + k) for g in range(13) for k in range(10)]
    df = spark.createDataFrame(rows, "g long, d date, id long")
    members = purged_groups(df, "g", "d", CvSpec(n_splits=5, gap=3), ["id"]).collect()
    folds = sorted({r["fold"] for r in members})
    # Fold 0 tests groups 2-3 from month 2: nothing lies before its cutoff.
    assert folds == [1, 2, 3, 4]
    for f in folds:
        test = {r["g"] for r in members if r["fold"] == f and r["role"] == "test"}
        train = [r for r in members if r["fold"] == f and r["role"] == "train"]
        assert test == {2 * (f + 1), 2 * (f + 1) + 1}
        assert {r["g"] for r in train} <= set(range(2 * (f + 1)))
        assert max(r["d"] for r in train) < month(2 * (f + 1) - 3)
    # The leftover group is never tested.
    assert 12 not in {r["g"] for r in members}


def test_first_group_may_be_zero_only(spark):
    rows = [(g, month(6 * g + k), g * 100 + k) for g in range(6) for k in range(3)]
    df = spark.createDataFrame(rows, "g long, d date, id long")
    members = purged_groups(df, "g", "d", CvSpec(n_splits=5, gap=3)).collect()
    assert sorted({r["fold"] for r in members}) == [0, 1, 2, 3, 4]


def test_fewer_groups_than_folds(spark):
    df = spark.createDataFrame([(1, month(0)), (2, month(5))], "g long, d date")
    assert purged_groups(df, "g", "d").count() == 0
