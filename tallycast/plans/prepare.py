"""Columns in the order they are built at fit and at score time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tallycast.config import PipelineSpec
from tallycast.operators.encoders import Encoders, fit_panel_encoders, fit_panel_encoders_folds
from tallycast.operators.models import FeatureLayout
from tallycast.operators.numeric import fit_imputer, fit_imputer_folds, ids_to_categories, skew_transform
from tallycast.operators.ordered_stats import ordered_target_stats
from tallycast.operators.panel import dense_panel, forward_label, periodic_panel
from tallycast.operators.temporal import temporal_features
from tallycast.operators.text_encoding import TfidfEncoding


def build_panel(
    transactions: DataFrame, spec: PipelineSpec, *, source_customer: str, source_date: str, amount: str | None = None,
) -> DataFrame:
    """Transactions to a dense, labelled panel in the columns of ``spec``."""
    p = spec.panel
    measures = {"transaction_amount": F.sum(amount)} if amount else {}
    panel = periodic_panel(
        transactions.withColumnRenamed(source_customer, p.customer_col),
        p.customer_col,
        source_date,
        grain=p.grain,
        period=p.date_col,
        count=p.value_col,
        measures=measures,
    )
    # Every customer's rows go on to the newest period of the data, also through silence.
    newest = transactions.agg(F.max(source_date)).first()[0]
    dense = dense_panel(
        panel, p.customer_col, p.date_col, zero=[p.value_col], grain=p.grain, until=F.lit(newest)
    )
    return forward_label(
        dense, p.customer_col, p.date_col, p.value_col, horizon=p.label_horizon, label=p.label_col
    )


def stateless_features(
    df: DataFrame, spec: PipelineSpec, null_customers: bool = True, wanted: str | None = None
) -> DataFrame:
    """What needs no fit: ID categories and temporal features; ``wanted`` as in ``temporal_features``."""
    p = spec.panel
    named = ids_to_categories(df, p.numeric_id_cols)
    return temporal_features(
        named, p.customer_col, p.date_col, p.value_col, spec.features, null_customers=null_customers, wanted=wanted
    )


# The label on the training scale.
TRAIN_LABEL = "_label"


@dataclass
class Preprocessing:
    """Everything learned from training rows, plus the resulting layout."""

    fill: dict[str, float]
    encoders: Encoders
    layout: FeatureLayout
    spec: PipelineSpec

    def apply(self, df: DataFrame) -> DataFrame:
        """``df`` already has the stateless features."""
        return self.encoders.apply(skew_transform(df, self.spec.panel.skewed_cols, self.fill))

    def apply_training(self, df: DataFrame) -> DataFrame:
        """As ``apply`` for the rows that were learned from: no row's label reaches its ordered columns."""
        p, e = self.spec.panel, self.spec.encoders
        keys = [p.customer_col, p.date_col]
        return self.apply(ordered_target_stats(df, e.ordered_cols, p.label_col, keys, e) if e.ordered_cols else df)


def fit_preprocessing(df: DataFrame, spec: PipelineSpec) -> Preprocessing:
    """Learn fill values and encodings from ``df`` only."""
    p = spec.panel
    fill = fit_imputer(df, p.skewed_cols, spec.encoders.impute)
    encoders = fit_panel_encoders(df, p, spec.encoders)
    preprocessing = Preprocessing(fill, encoders, FeatureLayout(()), spec)
    preprocessing.layout = feature_layout(preprocessing.apply(df), encoders, spec)
    return preprocessing


def fit_fold_preprocessing(df: DataFrame, n_folds: int, spec: PipelineSpec) -> list[Preprocessing]:
    """``fit_preprocessing`` of the training rows of every fold, with ``df`` read as often as for one fold.

    ``df`` carries ``first_train_fold``. Everything that is learned is a state
    counted by first fold and summed over folds: training windows only grow.
    """
    p = spec.panel
    fills = fit_imputer_folds(df, p.skewed_cols, n_folds, spec.encoders.impute)
    learned = fit_panel_encoders_folds(df, n_folds, p, spec.encoders)
    out = []
    for fill, encoders in zip(fills, learned):
        preprocessing = Preprocessing(fill, encoders, FeatureLayout(()), spec)
        preprocessing.layout = feature_layout(preprocessing.apply(df.drop("first_train_fold", "test_fold")), encoders, spec)
        out.append(preprocessing)
    return out


def feature_layout(df: DataFrame, encoders: Encoders, spec: PipelineSpec) -> FeatureLayout:
    """Feature columns: all but the keys, the date and the label."""
    p, m = spec.panel, spec.model
    dropped = {p.customer_col, p.date_col, p.label_col, m.weight_col, TRAIN_LABEL}
    vectors = {t.output: tuple(t.names) for t in encoders.text}
    numeric = [
        f.name
        for f in df.schema.fields
        if f.name not in dropped and f.name not in m.nominal_cols and isinstance(f.dataType, NumericType)
    ]
    return FeatureLayout(
        numeric=tuple(numeric),
        vectors=tuple((c, vectors[c]) for c in df.columns if c in vectors),
        nominal=tuple(c for c in m.nominal_cols if c in df.columns),
    )


def tfidf_rows(encoders: Encoders) -> list[tuple[str, int, str, float]]:
    return [
        (t.column, i, term, idf)
        for t in encoders.text
        if isinstance(t, TfidfEncoding)
        for i, (term, idf) in enumerate(zip(t.terms, t.idf))
    ]
