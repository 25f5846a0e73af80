"""Scoring from the kept rows of a history, against scoring with all rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plans import plan
from tallycast.config import CvSpec, EncoderSpec, FeatureSpec, ModelSpec, PanelSpec, PipelineSpec
from tallycast.plans.history import build_history, features_with_history, merge_history, open_history, score_with_history
from tallycast.plans.prepare import stateless_features
from tallycast.plans.score import score
from tallycast.plans.train import fit_forecaster
from tallycast.session import materialise
from tallycast.operators.panel import forward_label

SPEC = PipelineSpec(
    panel=PanelSpec("cust", "period", high_cardinality_cols=("kind",), skewed_cols=("amount",), numeric_id_cols=()),
    encoders=EncoderSpec(), cv=CvSpec(n_splits=2), model=ModelSpec(kind="gbt", rounds=3, params={"maxDepth": 3, "seed": 1}),
)


@pytest.fixture(scope="module")
def rows(spark):
    """Customers with 1 to 30 months, a few without an id."""
    month = F.add_months(F.lit("2020-01-01").cast("date"), F.col("k"))
    panel = spark.range(60).withColumn("k", F.explode(F.sequence(F.lit(0), (F.col("id") * 7 % 30).cast("int"))))
    panel = panel.select(
        F.when(F.col("id") != 13, F.concat(F.lit("c"), "id")).alias("cust"), month.alias("period"),
        (F.xxhash64("id", "k") % 9).cast("bigint").alias("txn_count"), F.concat(F.lit("k"), F.col("id") % 3).alias("kind"),
        F.col("k").cast("double").alias("amount"),
    ).withColumn("txn_count", F.abs("txn_count"))
    return materialise(forward_label(panel, "cust", "period"))


@pytest.fixture(scope="module")
def forecaster(rows):
    return fit_forecaster(stateless_features(rows.filter("cust is not null"), SPEC), SPEC)


def split(rows, n):
    """The newest ``n`` rows of each customer, and all before them; rows without an id are new."""
    place = F.row_number().over(Window.partitionBy("cust").orderBy(F.desc("period")))
    ranked = rows.withColumn("_n", F.when(F.col("cust").isNull(), 0).otherwise(place))
    new, old = ranked.filter(F.col("_n") <= n).drop("_n"), ranked.filter(F.col("_n") > n).drop("_n")
    return materialise(new), materialise(old)


def values(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


@pytest.mark.parametrize("n", [1, 2])
def test_the_scores_of_the_whole_history(spark, rows, forecaster, tmp_path, n):
    new, old = split(rows, n)
    history = build_history(old, SPEC, str(tmp_path / "history"), buckets=3)
    want = values(score(new, forecaster, old))
    assert values(score_with_history(new, forecaster, history)) == want and len(want) == new.count()
    again = open_history(spark, history.path)
    assert values(score_with_history(new, forecaster, again)) == want


def test_the_history_is_not_shuffled(spark, rows, forecaster, tmp_path):
    new, old = split(rows, 1)
    history = build_history(old, SPEC, str(tmp_path / "history"), buckets=3)
    text = plan(features_with_history(new, history, SPEC))
    assert text.count("Exchange") == 1 and "Exchange hashpartitioning(cust" in text  # the new rows
    assert "Bucketed: true" in text and "SortMergeJoin" in text


def test_merged_by_period(spark, rows, forecaster, tmp_path):
    """Three months, one after the other: each is scored from what was kept, then merged."""
    new, old = split(rows, 3)
    history = build_history(old, SPEC, str(tmp_path / "h0"), buckets=3)
    place = F.row_number().over(Window.partitionBy("cust").orderBy("period"))
    months = new.filter("cust is not null").withColumn("_n", place)
    seen = old
    for k in (1, 2, 3):
        month = materialise(months.filter(F.col("_n") == k).drop("_n"))
        assert values(score_with_history(month, forecaster, history)) == values(score(month, forecaster, seen))
        history = merge_history(history, month, SPEC, str(tmp_path / f"h{k}"))
        seen = seen.unionByName(month)
        # The newest month can be scored again, and merging it twice changes nothing.
        assert values(score_with_history(month, forecaster, history)) == values(score(month, forecaster, seen))
    whole = build_history(rows, SPEC, str(tmp_path / "whole"), buckets=3)
    twice = merge_history(history, month, SPEC, str(tmp_path / "twice"))
    assert values(history.read(spark)) == values(whole.read(spark)) == values(twice.read(spark))


def test_rows_older_than_the_history(spark, rows, forecaster, tmp_path):
    history = build_history(rows, SPEC, str(tmp_path / "history"), buckets=3)
    oldest = rows.filter("period = '2020-01-01' and cust = 'c4'")
    with pytest.raises(Exception, match="reach back"):
        score_with_history(oldest, forecaster, history).collect()


def test_no_rows(spark, rows, forecaster, tmp_path):
    history = build_history(rows.limit(0), SPEC, str(tmp_path / "history"), buckets=2)
    new, _ = split(rows, 1)
    assert values(score_with_history(new, forecaster, history)) == values(score(new, forecaster))
    assert score_with_history(new.limit(0), forecaster, history).count() == 0
