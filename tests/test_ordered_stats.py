"""Ordered target statistics against a walk over the rows in their random order."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tallycast.config import EncoderSpec, ModelSpec, PanelSpec, PipelineSpec
from tallycast.operators.ordered_stats import ordered_target_stats
from tallycast.plans.prepare import fit_preprocessing
from tallycast.plans.train import labelled


def by_hand(rows, smoothing):
    """``rows``: (id, category, label)."""
    known = [y for _, _, y in rows if y is not None]
    prior = sum(known) / len(known)
    seen, out = {}, {}
    for i, c, y in sorted(rows, key=lambda r: (hashlib.md5(f"42|{r[0]}".encode()).hexdigest(), r[0])):
        total, n = seen.get(c, (0.0, 0))
        out[i] = prior if c is None or n + smoothing == 0 else (total + smoothing * prior) / (n + smoothing)
        if y is not None:
            seen[c] = (total + y, n + 1)
    return out


@pytest.mark.parametrize("smoothing, block_rows", [(1.0, 100_000), (0.0, 10), (2.5, 1)])
def test_by_hand(spark, smoothing, block_rows):
    random.seed(6)
    rows = [(i, random.choice(["hot"] * 8 + ["b", "c", "", None, f"only{i}"]), random.choice([None, 1.0, 2.0, 5.0])) for i in range(600)]
    df = spark.createDataFrame(rows, "id bigint, kind string, y double").withColumn("other", F.col("kind"))
    out = ordered_target_stats(df, ["kind", "absent"], "y", ["id"], EncoderSpec(smoothing=smoothing), block_rows)
    assert out.columns == ["id", "y", "other", "kind_target_enc"]
    assert {r["id"]: r["kind_target_enc"] for r in out.collect()} == pytest.approx(by_hand(rows, smoothing))


def test_training_rows_do_not_see_their_label(spark):
    """Every customer a category of its own: the column says nothing in training, and all about it afterwards."""
    spec = PipelineSpec(
        panel=PanelSpec("cust", "period", "n", "y", (), (), ()), encoders=EncoderSpec(ordered_cols=("shop",)),
        model=ModelSpec(kind="gbt", rounds=1, log_target=False),
    )
    rows = spark.range(300).select(
        F.col("id").alias("cust"), F.lit("2020-01-01").cast("date").alias("period"), F.lit(1).alias("n"),
        (F.col("id") * 10).alias("y"), F.concat(F.lit("s"), "id").alias("shop"),
    )
    rows = labelled(rows, spec)
    prep = fit_preprocessing(rows, spec)
    train, later = prep.apply_training(rows), prep.apply(rows)
    assert train.select("shop_target_enc").distinct().count() == 1
    assert later.select(F.corr("shop_target_enc", "y")).first()[0] > 0.999
    assert "shop_target_enc" in prep.layout.names and set(train.columns) == set(later.columns)
