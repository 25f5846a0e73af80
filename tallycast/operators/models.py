"""Boosted trees: fit with early stopping, predict, importance, ensembles."""

from __future__ import annotations

import sys
import warnings
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallycast.config import BOOSTER_PARAMS, ModelSpec
from tallycast.functions.scalars import as_col
from tallycast.operators.binned_boosting import NUMBERS, MadeFrom, is_plain
from tallycast.operators.boosting import Tables, fit_all, fit_binned, fit_in_stages

# Back-end parameter names and the tree parameter each one stands for.
SPARK_NAMES = {
    "n_estimators": "maxIter",
    "iterations": "maxIter",
    "learning_rate": "stepSize",
    "max_depth": "maxDepth",
    "depth": "maxDepth",
    "bagging_fraction": "subsamplingRate",
    "subsample": "subsamplingRate",
    "feature_fraction": "featureSubsetStrategy",
    "colsample_bytree": "featureSubsetStrategy",
    "min_child_samples": "minInstancesPerNode",
    "min_child_weight": "minInstancesPerNode",
    "gamma": "minInfoGain",
    "border_count": "maxBins",
    "random_state": "seed",
    "random_seed": "seed",
}
TREE_PARAMS = {
    "maxIter", "stepSize", "maxDepth", "subsamplingRate", "featureSubsetStrategy",
    "minInstancesPerNode", "minInfoGain", "maxBins", "seed", "maxMemoryInMB", "checkpointInterval",
}
# Ratios and differences may be negative: they get 0 and an indicator for null.
SIGNED_PREFIXES = ("velocity_", "trend_", "yoy_")
NULL_COUNT = -1.0


def tree_params(spec: ModelSpec) -> dict:
    """Spark parameters of a model; those without a counterpart are named."""
    block = dict(BOOSTER_PARAMS.get(spec.kind, {}))
    if spec.kind not in ("gbt", "random_forest", *BOOSTER_PARAMS):
        raise ValueError(f"unknown model kind: {spec.kind!r}")
    if spec.rounds is not None:
        block = {k: v for k, v in block.items() if SPARK_NAMES.get(k) != "maxIter"}
        block["maxIter"] = spec.rounds
    out, ignored = {}, []
    for name, value in {**block, **spec.params}.items():
        known = SPARK_NAMES.get(name, name)
        if known in TREE_PARAMS:
            out[known] = str(value) if known == "featureSubsetStrategy" else value
        elif name != "early_stopping_rounds":
            ignored.append(name)
    if ignored:
        warnings.warn(f"no counterpart in Spark trees, ignored: {', '.join(sorted(ignored))}", stacklevel=2)
    return out


def make_estimator(spec: ModelSpec, label: str, features: str = "features"):
    """The unfitted regressor that belongs to ``spec``."""
    params = tree_params(spec)
    shared = dict(labelCol=label, featuresCol=features, predictionCol="prediction", cacheNodeIds=True)
    if spec.weight_col:
        shared["weightCol"] = spec.weight_col
    if spec.kind == "random_forest":
        params = {k: v for k, v in params.items() if k != "stepSize"}
        if "maxIter" in params:
            params["numTrees"] = params.pop("maxIter")
        return RandomForestRegressor(**shared, **params)
    return GBTRegressor(**shared, **params)


@dataclass(frozen=True)
class FeatureLayout:
    """Which columns make up the feature vector, in which order."""

    numeric: tuple[str, ...]
    vectors: tuple[tuple[str, tuple[str, ...]], ...] = ()
    nominal: tuple[str, ...] = ()

    @property
    def signed(self) -> list[str]:
        return [c for c in self.numeric if c.startswith(SIGNED_PREFIXES)]

    @property
    def names(self) -> list[str]:
        spelled = [name for _, names in self.vectors for name in names]
        return [*self.numeric, *[f"{c}_is_null" for c in self.signed], *self.nominal, *spelled]

    def fill(self, df: DataFrame) -> DataFrame:
        """Replace nulls, which Spark trees do not take, at the model boundary."""
        signed = set(self.signed)
        filled = {
            c: F.coalesce(F.col(c).cast("double"), F.lit(0.0 if c in signed else NULL_COUNT))
            for c in self.numeric
        }
        flags = {f"{c}_is_null": F.col(c).isNull().cast("double") for c in self.signed}
        return df.withColumns({**flags, **filled})

    def fit_assembler(self, df: DataFrame, max_bins: int = 32) -> PipelineModel:
        """Index nominal columns and assemble the vector."""
        if not self.nominal:
            return self.assembler(None)
        indexer = StringIndexer(
            inputCols=list(self.nominal),
            outputCols=[f"{c}_index" for c in self.nominal],
            handleInvalid="keep",
        ).fit(df)
        for c, labels in zip(self.nominal, indexer.labelsArray):
            if len(labels) + 1 > max_bins:
                raise ValueError(f"{c} has {len(labels)} categories: raise maxBins or target-encode it")
        return self.assembler(indexer)

    def fit_indexers(self, df: DataFrame, n_folds: int, max_bins: int = 32) -> list[StringIndexerModel | None]:
        """The nominal values in the training rows of every fold, from one pass; ``df`` carries ``first_train_fold``."""
        if not self.nominal:
            return [None] * n_folds
        values = df.select("first_train_fold", *[F.col(c).cast("string").alias(c) for c in self.nominal])
        later = F.explode(F.sequence(F.col("first_train_fold"), F.lit(n_folds - 1)))
        counts = (
            values.unpivot(["first_train_fold"], list(self.nominal), "col", "value")
            .filter("first_train_fold is not null and value is not null")
            .groupBy("first_train_fold", "col", "value").count()
            .withColumn("fold", later).groupBy("fold", "col", "value").agg(F.sum("count").alias("n"))
        )
        # As many rows as are needed to see that a column has too many values.
        place = F.row_number().over(Window.partitionBy("fold", "col").orderBy(F.desc("n"), "value"))
        found = counts.withColumn("place", place).filter(F.col("place") <= max_bins).orderBy("fold", "col", "place").collect()
        out = []
        for fold in range(n_folds):
            labels = [[r["value"] for r in found if r["fold"] == fold and r["col"] == c] for c in self.nominal]
            for c, known in zip(self.nominal, labels):
                if len(known) + 1 > max_bins:
                    raise ValueError(f"{c} has {len(known)} categories or more: raise maxBins or target-encode it")
            indexer = StringIndexerModel.from_arrays_of_labels(
                labels, inputCols=list(self.nominal), outputCols=[f"{c}_index" for c in self.nominal], handleInvalid="keep"
            )
            out.append(indexer)
        return out

    def assembler(self, indexer: StringIndexerModel | None) -> PipelineModel:
        """Index nominal columns, if there are any, and assemble the vector."""
        inputs = [
            *self.numeric,
            *[f"{c}_is_null" for c in self.signed],
            *[f"{c}_index" for c in self.nominal],
            *[c for c, _ in self.vectors],
        ]
        vectors = VectorAssembler(inputCols=inputs, outputCol="features")
        return PipelineModel([vectors] if indexer is None else [indexer, vectors])

    def assemble(self, df: DataFrame, assembler: PipelineModel, keep: Iterable[str]) -> DataFrame:
        """The vectors and, where all features are single numbers, the same as an array, which costs nothing unless read."""
        filled = assembler.transform(self.fill(df))
        if self.vectors or self.nominal:
            return filled.select(*keep, "features")
        numbers = F.array(*[F.col(c).cast("double") for c in self.names]).alias(NUMBERS)
        return filled.select(*keep, "features", numbers)


def best_round(errors: list[float], patience: int) -> int:
    """Rounds to keep: the best one before ``patience`` rounds without gain."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def patience(spec: ModelSpec) -> int:
    """Rounds without gain before stopping: given, or that of the parameters; without either, all rounds count."""
    if spec.patience is not None:
        return spec.patience
    block = {**BOOSTER_PARAMS.get(spec.kind, {}), **spec.params}
    return block.get("early_stopping_rounds") or sys.maxsize


@dataclass
class TreeModel:
    """A fitted regressor over an assembled ``features`` column."""

    model: object
    names: list[str]
    rounds: int | None = None
    errors: list[float] = field(default_factory=list)

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        if self.model is None:
            raise ValueError("the model has not been fitted")
        return self.model.copy().setPredictionCol(output).transform(df)

    def importance(self, spark: SparkSession) -> DataFrame:
        """Feature and importance, largest first; one row per feature."""
        rows = zip(self.names, [float(v) for v in self.model.featureImportances.toArray()])
        return spark.createDataFrame(list(rows), "feature string, importance double").orderBy(
            F.desc("importance"), "feature"
        )

    def top_features(self, spark: SparkSession, k: int = 10) -> DataFrame:
        return self.importance(spark).limit(k)


def reads_once(train: DataFrame, label: str, spec: ModelSpec) -> bool:
    """Whether the fit reads the assembled rows once, to bin them; other learners read them for every tree."""
    return spec.kind != "random_forest" and is_plain(make_estimator(spec, label), train)


def fit_trees(
    train: DataFrame, label: str, spec: ModelSpec, names: list[str], validation: DataFrame | None = None,
    made_from: MadeFrom | None = None,
) -> TreeModel:
    """Fit on an assembled table; ``made_from`` says what rows it is made of one by one.

    With ``validation``, rounds are added in stages until ``patience`` of them in
    a row brought no gain on its rows, and the model is cut at the best round.
    """
    estimator = make_estimator(spec, label)
    if validation is not None and spec.kind != "random_forest":
        staged = fit_in_stages(train, validation, estimator, patience(spec), spec.stage_rounds, made_from)
        return TreeModel(staged.model, names, staged.rounds, staged.errors)
    if spec.kind == "random_forest":
        return TreeModel(estimator.fit(train), names)
    return TreeModel(fit_all(train, estimator, spec.stage_rounds, made_from), names, estimator.getMaxIter())


def fit_trees_together(tables: list[Tables], label: str, spec: ModelSpec, names: list[list[str]]) -> list[TreeModel]:
    """``fit_trees`` for each of the tables, where ``reads_once`` holds: the models grow side by side."""
    estimators = [make_estimator(spec, label) for _ in tables]
    fitted = fit_binned(tables, estimators, patience(spec), spec.stage_rounds)
    return [TreeModel(f.model, n, f.rounds, f.errors) for f, n in zip(fitted, names)]


def weighted_average(predictions: Iterable[Column | str], weights: Iterable[float] | None = None) -> Column:
    """Average of prediction columns; weights are normalised to sum to one."""
    predictions = [as_col(p) for p in predictions]
    weights = [1.0] * len(predictions) if weights is None else list(weights)
    if not predictions:
        raise ValueError("an ensemble needs at least one model")
    if len(weights) != len(predictions):
        raise ValueError("number of weights must match number of models")
    total = float(sum(weights))
    parts = [p.cast("double") * F.lit(w / total) for p, w in zip(predictions, weights)]
    return sum(parts[1:], parts[0])


@dataclass
class Ensemble:
    """Weighted average of fitted models over the same feature vector."""

    models: list[TreeModel]
    weights: list[float] | None = None

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        parts = [f"_prediction_{i}" for i in range(len(self.models))]
        average = weighted_average(parts, self.weights)
        for model, part in zip(self.models, parts):
            df = model.predict(df, part)
        return df.withColumn(output, average).drop(*parts)
