"""Immutable settings. Nothing here touches Spark."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class PanelSpec:
    """Which column plays which role.

    ``value_col`` is the observed count that features are built from;
    ``label_col`` is the forward sum to predict and is never a feature source.
    """

    # The column names of the input files.
    customer_col: str = "UniqueID"
    date_col: str = "transaction_date"
    value_col: str = "txn_count"
    label_col: str = "next_3m_txn_count"
    high_cardinality_cols: tuple[str, ...] = (
        "transaction_description",
        "merchant_category",
        "transaction_channel",
    )
    skewed_cols: tuple[str, ...] = ("income", "transaction_amount")
    numeric_id_cols: tuple[str, ...] = (
        "branch_code",
        "region_id",
        "area_code",
        "district_id",
        "office_code",
        "segment_code",
        "sector_id",
    )
    label_horizon: int = 3
    grain: str = "month"


@dataclass(frozen=True)
class FeatureSpec:
    """Window features. All offsets count rows of the panel."""

    # The default offsets and widths.
    seasonal_lags: tuple[int, ...] = (12, 11, 13)
    short_lags: tuple[int, ...] = (1, 2, 3, 6)
    rolling_windows: tuple[int, ...] = (1, 3, 6, 12)
    rolling_stats: tuple[str, ...] = ("mean", "std", "min", "max")
    velocity: tuple[tuple[int, int], ...] = ((3, 12), (1, 12), (3, 6))

    @property
    def look_back(self) -> int:
        """Rows before the current one that any feature can reach."""
        return max(
            3,
            *self.seasonal_lags,
            *self.short_lags,
            *(w - 1 for w in self.rolling_windows),
        )


@dataclass(frozen=True)
class EncoderSpec:
    # Encoder defaults.
    smoothing: float = 1.0
    min_samples: int | None = None
    noise: float = 0.0
    seed: int = 42
    handle_unknown: str = "global_mean"
    text_method: str = "tfidf"
    hash_buckets: int = 1000
    hash_signed: bool = True
    tfidf_terms: int = 500
    tfidf_ngrams: tuple[int, int] = (1, 2)
    tfidf_min_df: float = 5
    tfidf_max_df: float = 0.95
    stop_words: tuple[str, ...] | None = None
    impute: str = "median"
    # Nominal columns whose training rows are encoded by earlier rows only.
    ordered_cols: tuple[str, ...] = ()


@dataclass(frozen=True)
class CvSpec:
    # Fold defaults.
    n_splits: int = 5
    gap: int = 3
    min_train: int = 6
    purge: bool = True


# The parameter block of each back-end name.
BOOSTER_PARAMS: dict[str, dict] = {
    "lightgbm": {
        "n_estimators": 2000,
        "learning_rate": 0.05,
        "max_depth": 8,
        "num_leaves": 63,
        "feature_fraction": 0.8,
        "bagging_fraction": 0.8,
        "bagging_freq": 5,
        "min_child_samples": 20,
        "reg_alpha": 0.1,
        "reg_lambda": 0.1,
        "early_stopping_rounds": 100,
        "random_state": 42,
    },
    "xgboost": {
        "n_estimators": 2000,
        "learning_rate": 0.05,
        "max_depth": 8,
        "subsample": 0.8,
        "colsample_bytree": 0.8,
        "min_child_weight": 3,
        "gamma": 0.1,
        "reg_alpha": 0.1,
        "reg_lambda": 0.1,
        "early_stopping_rounds": 100,
        "random_state": 42,
    },
    "catboost": {
        "iterations": 2000,
        "learning_rate": 0.05,
        "depth": 8,
        "border_count": 128,
        "l2_leaf_reg": 3,
        "bagging_temperature": 0.5,
        "early_stopping_rounds": 100,
        "random_seed": 42,
    },
}


@dataclass(frozen=True)
class ModelSpec:
    """``kind`` is ``gbt``, ``random_forest`` or a key of ``BOOSTER_PARAMS``.

    ``params`` overrides the block that belongs to ``kind``; both back-end
    names (``learning_rate``) and Spark names (``stepSize``) are understood.
    ``rounds`` replaces the block's own count, ``patience`` its number of rounds
    without gain before stopping; None keeps them. With early stopping,
    ``stage_rounds`` are fitted between two looks at the error.
    """

    kind: str = "lightgbm"
    params: dict = field(default_factory=dict)
    rounds: int | None = None
    log_target: bool = True
    patience: int | None = None
    stage_rounds: int = 10
    weight_col: str | None = None
    nominal_cols: tuple[str, ...] = ()

    def with_rounds(self, rounds: int | None) -> ModelSpec:
        """The same model with another number of rounds; None changes nothing."""
        if rounds is None:
            return self
        counts = ("n_estimators", "iterations", "maxIter")
        params = {k: v for k, v in self.params.items() if k not in counts}
        return replace(self, rounds=rounds, params=params)


@dataclass(frozen=True)
class PipelineSpec:
    panel: PanelSpec = PanelSpec()
    features: FeatureSpec = FeatureSpec()
    encoders: EncoderSpec = EncoderSpec()
    cv: CvSpec = CvSpec()
    model: ModelSpec = field(default_factory=ModelSpec)

    def __post_init__(self) -> None:
        if self.cv.gap < self.panel.label_horizon:
            raise ValueError("the gap must cover the label horizon, or training labels reach into the test periods")
