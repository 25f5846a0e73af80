"""Boosting in stages: rounds are added until the validation error stops falling.

Spark's own boosting fits a fixed number of rounds in one call. Here a round is
one regression tree on the residuals of all earlier ones, fitted by Spark's tree
learner with the same loss, weights and seeds, and rounds come in stages. At the
end of a stage the error after each of its rounds is read off in one pass over
the validation rows, and the running forecast of every row is written beside its
features, so that the next stage starts warm: no round is ever fitted, and no
tree evaluated, twice. The trees make up an ordinary Spark model.

Where rows and features are all used alike, the trees come from binned rows (see
``binned_boosting``); with weights, samples of rows or features, or nominal
features they come from Spark's tree learner.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark import SparkContext
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.operators import binned_boosting as binned
from tallycast.session import materialise

SUM, TREE = "_boosted", "_tree"


@dataclass
class Stages:
    """The model cut at its best round, the error after every fitted round, and how many were fitted."""

    model: GBTRegressionModel
    rounds: int
    errors: list[float] = field(default_factory=list)

    @property
    def fitted(self) -> int:
        return len(self.errors)


def tree_learner(booster: GBTRegressor, label: str, m: int) -> RandomForestRegressor:
    """What fits round ``m``: one tree, with the samples that Spark's booster draws for it."""
    shared = (
        "maxDepth", "maxBins", "minInstancesPerNode", "minInfoGain", "minWeightFractionPerNode", "maxMemoryInMB",
        "cacheNodeIds", "checkpointInterval", "subsamplingRate", "featureSubsetStrategy", "featuresCol",
    )
    params = {name: booster.getOrDefault(name) for name in shared}
    learner = RandomForestRegressor(labelCol=label, numTrees=1, bootstrap=False, seed=booster.getSeed() + m, **params)
    return learner.setWeightCol(booster.getWeightCol()) if booster.isDefined("weightCol") else learner


def assembled(trees: list, weights: list[float], booster: GBTRegressor, features: int) -> GBTRegressionModel:
    """A Spark model of the given trees."""
    context = SparkContext.getOrCreate()
    jvm, gateway = context._jvm, context._gateway
    listed = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    scale = gateway.new_array(jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        listed[i], scale[i] = tree._java_obj, float(weight)
    made = jvm.org.apache.spark.ml.regression.GBTRegressionModel(booster.uid, listed, scale, features)
    return booster._copyValues(GBTRegressionModel(made))


def fit_in_stages(
    train: DataFrame, validation: DataFrame, booster: GBTRegressor, patience: int, stage: int = 10,
    made_from: binned.MadeFrom | None = None,
) -> Stages:
    """Add rounds, ``stage`` at a time, until ``patience`` rounds in a row brought no gain.

    No more than the best round plus ``patience`` plus ``stage`` rounds are
    fitted, and never more than the booster's own number. The result is that of
    fitting all rounds and cutting at the best one.
    """
    if binned.is_plain(booster, train):
        return fit_binned([(train, validation, made_from)], [booster], patience, stage)[0]
    label, features = booster.getLabelCol(), booster.getFeaturesCol()
    keep = [features, label] + ([booster.getWeightCol()] if booster.isDefined("weightCol") else [])
    zero = F.lit(0.0).alias(SUM)
    train, validation = train.select(*keep, zero), validation.select(features, label, zero)
    trees, weights, errors = [], [], []
    most, residual = booster.getMaxIter(), "_residual"
    while len(trees) < most:
        after = []
        for _ in range(min(stage, most - len(trees))):
            m = len(trees)
            # The first round learns the label; a later one the slope of the squared error.
            target = F.col(label) if m == 0 else 2.0 * (F.col(label) - F.col(SUM))
            learner = tree_learner(booster, residual, m)
            tree = learner.fit(train.withColumn(residual, target.cast("double"))).trees[0]
            trees.append(tree)
            weights.append(1.0 if m == 0 else booster.getStepSize())
            train = added(train, tree, weights[-1], features)
            validation = added(validation, tree, weights[-1], features)
            gap = F.col(label) - F.col(SUM)
            error = f"_error_{len(after)}"
            validation = validation.withColumn(error, gap * gap)
            after.append(error)
        # One pass for the errors of the stage; then both tables start warm.
        validation = materialise(validation)
        found = validation.agg(*[F.avg(e) for e in after]).first()
        errors += [math.nan if e is None else e for e in found]
        validation = validation.drop(*after)
        if stopped(errors, patience):
            break
        if len(trees) < most:
            train = materialise(train)
    best = stopped(errors, patience) or errors.index(min(errors)) + 1
    return Stages(assembled(trees[:best], weights[:best], booster, trees[0].numFeatures), best, errors)


def fit_all(
    train: DataFrame, booster: GBTRegressor, stage: int = 10, made_from: binned.MadeFrom | None = None
) -> GBTRegressionModel:
    """All rounds of the booster."""
    if not binned.is_plain(booster, train):
        return booster.fit(train)
    return fit_binned([(train, None, made_from)], [booster], 0, stage)[0].model


# Training rows, validation rows and what the former are made of.
Tables = tuple[DataFrame, DataFrame | None, binned.MadeFrom | None]


class BinnedFit:
    """A model that grows on binned rows."""

    def __init__(self, tables: Tables, booster: GBTRegressor):
        train, validation, made_from = tables
        self.booster, self.cuts = booster, binned.thresholds(train, booster, made_from)
        self.most = booster.getMaxIter()
        self.blocks = binned.binned(train, booster, self.cuts)
        self.tested = None if validation is None else binned.binned(validation, booster, self.cuts)
        self.trees, self.weights, self.errors, self.warm = [], [], [], 0

    def growing(self) -> binned.Growing:
        late = self.trees[self.warm :], self.weights[self.warm :]
        return binned.Growing(self.blocks, *late, self.booster, self.cuts, not self.trees)

    def add(self, tree: binned.Tree) -> None:
        self.trees.append(tree)
        self.weights.append(1.0 if len(self.trees) == 1 else self.booster.getStepSize())

    def goes_on(self, patience: int) -> bool:
        """At the end of a stage: the errors of its rounds; then, if there are more, both tables start warm."""
        late = self.trees[self.warm :], self.weights[self.warm :], self.cuts
        if self.tested is not None:
            self.errors += binned.mean_errors(self.tested, *late)
            if stopped(self.errors, patience):
                return False
        if len(self.trees) == self.most:
            return False
        self.blocks = binned.advanced(self.blocks, *late)
        self.tested = None if self.tested is None else binned.advanced(self.tested, *late)
        self.warm = len(self.trees)
        return True

    def result(self, patience: int) -> Stages:
        errors = self.errors
        best = self.most if self.tested is None else stopped(errors, patience) or errors.index(min(errors)) + 1
        made = [binned.spark_tree(tree, self.cuts, f"{self.booster.uid}_{k}") for k, tree in enumerate(self.trees[:best])]
        return Stages(assembled(made, self.weights[:best], self.booster, len(self.cuts)), best, errors)


def fit_binned(tables: list[Tables], boosters: list[GBTRegressor], patience: int, stage: int) -> list[Stages]:
    """``fit_in_stages`` on binned rows, for several models of the same parameters together.

    A level of the trees of all of them is one job. Without validation rows all
    rounds are fitted and kept.
    """
    fits = [BinnedFit(*given) for given in zip(tables, boosters, strict=True)]
    going = fits
    while going:
        for _ in range(min(stage, going[0].most - len(going[0].trees))):
            for fit, tree in zip(going, binned.fit_trees([fit.growing() for fit in going])):
                fit.add(tree)
        going = [fit for fit in going if fit.goes_on(patience)]
    return [fit.result(patience) for fit in fits]


def added(df: DataFrame, tree, weight: float, features: str) -> DataFrame:
    scored = tree.copy().setFeaturesCol(features).setPredictionCol(TREE).transform(df)
    return scored.withColumn(SUM, F.col(SUM) + weight * F.col(TREE)).drop(TREE)


def stopped(errors: list[float], patience: int) -> int | None:
    """The best round, if ``patience`` rounds without gain followed it; else None."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1
    return None
