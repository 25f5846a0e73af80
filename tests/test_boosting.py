"""Staged boosting against Spark's own, round by round."""

import math
import re

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import functions as F

from tallycast.config import ModelSpec
from tallycast.operators import binned_boosting as binned
from tallycast.operators.boosting import fit_binned, fit_in_stages, stopped
from tallycast.operators.models import fit_trees
from tallycast.session import materialise


@pytest.fixture(scope="module")
def tables(spark):
    """A noisy signal; the validation rows follow it less and less."""
    x = [F.rand(k).alias(f"x{k}") for k in range(4)]
    rows = spark.range(0, 600, 1, 2).select("id", *x).withColumn("y", 3 * F.col("x0") + F.sin(6 * F.col("x1")) + F.randn(9) * 0.8)
    rows = VectorAssembler(inputCols=[f"x{k}" for k in range(4)], outputCol="features").transform(rows.withColumn("w", 1 + F.col("id") % 3))
    rows = materialise(rows.select("id", "features", "y", "w"))
    return rows.filter("id % 3 <> 0"), rows.filter("id % 3 = 0")


@pytest.mark.parametrize("params", [{}, {"subsamplingRate": 0.7, "featureSubsetStrategy": "0.5"}, {"weightCol": "w"}])
def test_stages_are_the_full_fit(tables, params):
    train, validation = tables
    booster = GBTRegressor(labelCol="y", maxIter=9, maxDepth=3, stepSize=0.4, seed=5, **params)
    whole = booster.fit(train)
    errors = whole.evaluateEachIteration(validation, "squared")
    staged = fit_in_stages(train, validation, booster, patience=100, stage=4)
    assert staged.fitted == 9 and staged.errors == pytest.approx(errors)
    best = errors.index(min(errors)) + 1
    assert staged.rounds == best == staged.model.getNumTrees
    for ours, theirs in zip(staged.model.trees, whole.trees):
        assert ours.toDebugString.split("\n")[1:] == theirs.toDebugString.split("\n")[1:]
    assert staged.model.treeWeights == whole.treeWeights[:best]


def test_it_stops(tables, tmp_path):
    train, validation = tables
    booster = GBTRegressor(labelCol="y", maxIter=60, maxDepth=4, stepSize=0.5, seed=5)
    staged = fit_in_stages(train, validation, booster, patience=5, stage=3)
    assert staged.fitted <= staged.rounds + 5 + 3 < 60
    whole = booster.fit(train)
    errors = whole.evaluateEachIteration(validation, "squared")
    assert staged.rounds == stopped(errors, 5)
    cut = booster.copy({booster.maxIter: staged.rounds}).fit(train)
    got, want = (m.transform(validation).orderBy("id").select("prediction").collect() for m in (staged.model, cut))
    assert [r[0] for r in got] == pytest.approx([r[0] for r in want])
    assert staged.model.featureImportances == cut.featureImportances
    staged.model.write().save(str(tmp_path / "model"))
    back = GBTRegressionModel.load(str(tmp_path / "model")).transform(validation).orderBy("id").select("prediction").collect()
    assert back == got


def test_stopped():
    assert stopped([5, 4, 3, 3.5, 2.9], 2) is None
    assert stopped([5, 4, 4.5, 4.6, 1.0], 2) == 2
    assert stopped([1.0], 1) is None


@pytest.mark.parametrize("params", [{"minInstancesPerNode": 200, "maxBins": 16}, {"minInfoGain": 0.02}])
def test_binned_rows_give_the_trees_of_spark(spark, params, monkeypatch):
    """More rows than thresholds are drawn from; features that are signed, mostly zero, constant or of few values."""
    x = [F.randn(1), F.greatest(F.randn(2), F.lit(0.0)), F.lit(3.0), F.floor(F.rand(3) * 5), F.rand(4) * 1e6, F.lit(0.0)]
    rows = spark.range(0, 24_000, 1, 2).select("id", *[c.cast("double").alias(f"x{k}") for k, c in enumerate(x)])
    rows = rows.withColumn("y", F.sin("x0") + F.col("x1") * F.col("x3") + F.col("x4") / 1e6 + F.randn(9) * 0.3)
    rows = materialise(VectorAssembler(inputCols=[f"x{k}" for k in range(6)], outputCol="features").transform(rows).select("features", "y"))
    given = {"maxDepth": 3, "stepSize": 0.3, "seed": 7, **params}
    theirs = GBTRegressor(labelCol="y", maxIter=3, **given).fit(rows)

    def kept(*_):
        raise AssertionError("the rows were given to a learner that keeps them as objects")

    monkeypatch.setattr(GBTRegressor, "_fit", kept)
    ours = fit_trees(rows, "y", ModelSpec(kind="gbt", rounds=3, params=given, stage_rounds=2), [f"x{k}" for k in range(6)]).model
    shape = re.compile(r"Predict: .*")
    for a, b in zip(ours.trees, theirs.trees, strict=True):
        assert shape.sub("", a.toDebugString).split("\n")[1:] == shape.sub("", b.toDebugString).split("\n")[1:]
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray())
    got, want = ([r[0] for r in m.transform(rows.limit(500)).select("prediction").collect()] for m in (ours, theirs))
    assert got == pytest.approx(want)


def test_rows_that_cannot_be_learned_from_are_refused(tables):
    train, _ = tables
    spec = ModelSpec(kind="gbt", rounds=1, params={"maxDepth": 1})
    with pytest.raises(Exception, match="null, NaN or infinite"):
        fit_trees(train.withColumn("y", F.expr("if(id = 1, null, y)")), "y", spec, [])
    with pytest.raises(ValueError, match="no rows"):
        fit_trees(train.filter("id < 0"), "y", spec, [])


def test_features_alike_are_kept_and_summed_once(spark, monkeypatch):
    """The third feature parts the rows as the first does, the second only those of the first block."""
    monkeypatch.setattr(binned, "BLOCK_BYTES", 50 * (3 + 16))
    x = [(k % 7, k % 7 if k < 100 else k % 5, 2 * (k % 7)) for k in range(200)]
    y = [math.sin(k) for k in range(200)]
    rows = spark.createDataFrame([(v, Vectors.dense(f)) for v, f in zip(y, x)], ["y", "features"]).coalesce(1)
    booster = GBTRegressor(labelCol="y", maxIter=1, maxDepth=2)
    cuts = binned.thresholds(rows, booster)
    blocks = binned.binned(rows, booster, cuts)
    kept = blocks.orderBy("place").toArrow().to_batches()
    assert [len(b.bins) for b in binned.unpacked(kept, 3, np.uint8)] == [1, 2, 2]
    (got,) = binned.node_sums(binned.Growing(blocks, [], [], booster, cuts, True), 0, [0]).collect()
    want = np.zeros((3, 3, 7))
    for v, features in zip(y, x):
        for f, value in enumerate(features):
            want[:, f, np.searchsorted(cuts[f], value)] += 1, v, v * v
    assert np.array_equal(np.frombuffer(got.stats).reshape(want.shape), want)


@pytest.mark.parametrize("n", [3, 20, 300])
def test_bins(n):
    values = np.random.default_rng(n).normal(size=500).round(2)
    cuts = np.unique(values)[:n]
    assert np.array_equal(binned.bin_of(values, cuts, np.uint16), np.searchsorted(cuts, values))


def test_models_that_grow_side_by_side_are_those_fitted_alone(tables, monkeypatch):
    train, validation = tables
    given = [(train, validation, None), (train.filter("id % 2 = 0"), validation, None), (train.filter("id < 40"), validation, None)]
    boosters = [GBTRegressor(labelCol="y", maxIter=7, maxDepth=3, stepSize=0.7, seed=5) for _ in given]
    alone = [fit_in_stages(*t, b, patience=2, stage=2) for (*t, _), b in zip(given, boosters)]
    calls, fit_trees = [], binned.fit_trees
    monkeypatch.setattr(binned, "fit_trees", lambda growing: calls.append(len(growing)) or fit_trees(growing))
    together = fit_binned(given, boosters, 2, 2)
    assert calls[0] == 3 and sum(calls) == sum(s.fitted for s in together) and len(calls) == max(s.fitted for s in together)
    for a, b in zip(together, alone):
        assert (a.rounds, a.errors) == (b.rounds, b.errors)
        assert [t.toDebugString.split("\n")[1:] for t in a.model.trees] == [t.toDebugString.split("\n")[1:] for t in b.model.trees]
