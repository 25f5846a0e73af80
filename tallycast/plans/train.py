"""Cross-validation over rolling-origin folds and the final fit."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.config import PipelineSpec
from tallycast.functions.scalars import log_target, unlog_target
from tallycast.operators.binned_boosting import NUMBERS, MadeFrom
from tallycast.operators.folds import Fold, fold_columns, rolling_folds
from tallycast.operators.metrics import cv_summary, fold_scores
from tallycast.operators.models import TreeModel, fit_trees, fit_trees_together, reads_once, tree_params
from tallycast.plans.prepare import TRAIN_LABEL, Preprocessing, fit_fold_preprocessing, fit_preprocessing, stateless_features
from tallycast.session import materialise


@dataclass
class CvResult:
    """Test predictions of all folds by row key, and their scores."""

    predictions: DataFrame
    scores: DataFrame
    summary: DataFrame
    models: list[TreeModel] = field(default_factory=list)
    forecasters: list[Forecaster] = field(default_factory=list)

    @property
    def rounds(self) -> int | None:
        """Mean of the best rounds over the folds."""
        known = [m.rounds for m in self.models if m.rounds]
        return max(1, round(sum(known) / len(known))) if known else None


@dataclass
class Forecaster:
    """All that scoring needs."""

    preprocessing: Preprocessing
    assembler: PipelineModel
    model: TreeModel

    @property
    def spec(self) -> PipelineSpec:
        return self.preprocessing.spec


def labelled(features: DataFrame, spec: PipelineSpec) -> DataFrame:
    label = spec.panel.label_col
    return features.filter(F.col(label).isNotNull()).withColumn(
        TRAIN_LABEL, log_target(label, spec.model.log_target)
    )


def _vectors(df: DataFrame, prep: Preprocessing, assembler: PipelineModel | None = None, training: bool = False):
    """Encoded and assembled rows with their keys; the assembler is reused if given."""
    p, m = prep.spec.panel, prep.spec.model
    encoded = prep.apply_training(df) if training else prep.apply(df)
    if assembler is None:
        assembler = prep.layout.fit_assembler(encoded, int(tree_params(m).get("maxBins", 32)))
    keep = [p.customer_col, p.date_col, p.label_col, TRAIN_LABEL]
    keep += [m.weight_col] if m.weight_col else []
    return prep.layout.assemble(encoded, assembler, keep), assembler


def _made_from(rows: DataFrame, train: DataFrame, prep: Preprocessing, assembler: PipelineModel) -> MadeFrom | None:
    """What ``train`` is made of, where each row is made by itself and read once; else ``train`` is worth keeping."""
    spec = prep.spec
    if spec.encoders.ordered_cols or not reads_once(train, TRAIN_LABEL, spec.model):
        return None
    return rows, lambda df: _vectors(df, prep, assembler, training=True)[0]


def fit_folds(rows: DataFrame, folds: list[Fold], spec: PipelineSpec) -> list[tuple[Preprocessing, PipelineModel]]:
    """Preprocessing and assembler of every fold, from shared passes over the rows."""
    if not folds:
        return []
    # States are indexed by the place of a fold in the list.
    placed = [replace(f, fold=k) for k, f in enumerate(folds)]
    marked = fold_columns(rows, spec.panel.date_col, placed)
    preps = fit_fold_preprocessing(marked, len(folds), spec)
    indexers = preps[0].layout.fit_indexers(marked, len(folds), int(tree_params(spec.model).get("maxBins", 32)))
    return [(prep, prep.layout.assembler(indexer)) for prep, indexer in zip(preps, indexers)]


def cross_validate(features: DataFrame, spec: PipelineSpec, *, early_stopping: bool = True) -> CvResult:
    """Fit one model per fold; nothing learned in a fold sees its test rows.

    ``features`` holds the stateless features and the label and should be
    materialised. Fill values, encodings and vocabularies of all folds are
    learned together: the features are read for them as often as for one fold.
    Then the driver goes over a handful of folds; each is a set of Spark jobs
    whose date predicates reach the scan. Models that are fitted on binned rows
    grow side by side: a job has the same level of the trees of all folds.
    """
    p = spec.panel
    rows = labelled(features, spec)
    folds = rolling_folds(rows, p.date_col, spec.cv, p.grain)
    made = []
    for fold, (prep, assembler) in zip(folds, fit_folds(rows, folds, spec)):
        train_rows = rows.filter(fold.trains(F.col(p.date_col)))
        test_rows = rows.filter(fold.tests(F.col(p.date_col)))
        train, _ = _vectors(train_rows, prep, assembler, training=True)
        test, _ = _vectors(test_rows, prep, assembler)
        made.append((train, test, _made_from(train_rows, train, prep, assembler), prep, assembler))
    # Whether it is so depends on the settings, so it is so for all folds or for none.
    side_by_side = bool(made) and all(made_from is not None for _, _, made_from, _, _ in made)
    if side_by_side:
        tables = [(train, test if early_stopping else None, made_from) for train, test, made_from, _, _ in made]
        models = fit_trees_together(tables, TRAIN_LABEL, spec.model, [prep.layout.names for _, _, _, prep, _ in made])
    else:
        models = []
    predictions, forecasters = None, []
    for k, (fold, (train, test, _, prep, assembler)) in enumerate(zip(folds, made)):
        if not side_by_side:
            train = train.drop(NUMBERS).persist(StorageLevel.MEMORY_AND_DISK)
            test = test.drop(NUMBERS).persist(StorageLevel.MEMORY_AND_DISK)
            models.append(fit_trees(train, TRAIN_LABEL, spec.model, prep.layout.names, test if early_stopping else None))
        predicted = models[k].predict(test, "_log_prediction").select(
            F.lit(fold.fold).alias("fold"),
            p.customer_col,
            p.date_col,
            p.label_col,
            unlog_target("_log_prediction", spec.model.log_target).alias("prediction"),
        )
        predicted = materialise(predicted)
        predictions = predicted if predictions is None else predictions.unionByName(predicted)
        forecasters.append(Forecaster(prep, assembler, models[k]))
        if not side_by_side:
            train.unpersist()
            test.unpersist()
    if predictions is None:
        raise ValueError("no fold has both training and test rows")
    return CvResult(
        predictions,
        fold_scores(predictions, p.label_col, "prediction"),
        cv_summary(predictions, p.label_col, "prediction", labelled=rows.count()),
        models,
        forecasters,
    )


def fit_forecaster(features: DataFrame, spec: PipelineSpec, rounds: int | None = None) -> Forecaster:
    """Fit preprocessing and model on all labelled rows."""
    rows = labelled(features, spec)
    prep = fit_preprocessing(rows, spec)
    train, assembler = _vectors(rows, prep, training=True)
    made_from = _made_from(rows, train, prep, assembler)
    if made_from is None:
        train = train.drop(NUMBERS).persist(StorageLevel.MEMORY_AND_DISK)
    model = fit_trees(train, TRAIN_LABEL, spec.model.with_rounds(rounds), prep.layout.names, made_from=made_from)
    if made_from is None:
        train.unpersist()
    return Forecaster(prep, assembler, model)


def train(panel: DataFrame, spec: PipelineSpec) -> tuple[Forecaster, CvResult]:
    """Cross-validate, then refit on all rows with the rounds that did best."""
    features = materialise(stateless_features(panel, spec))
    cv = cross_validate(features, spec)
    return fit_forecaster(features, spec, cv.rounds), cv
