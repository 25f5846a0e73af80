"""tallycast: customer-panel forecasting on Spark.

Raw transactions become customer-by-period panels, window features, encoded
columns, leakage-aware folds, boosted-tree models and scored output. Every step
takes and returns DataFrames, or is a ``fit`` that returns a small state.
"""

from tallycast.config import (
    CvSpec,
    EncoderSpec,
    FeatureSpec,
    ModelSpec,
    PanelSpec,
    PipelineSpec,
)

__all__ = [
    "CvSpec",
    "EncoderSpec",
    "FeatureSpec",
    "ModelSpec",
    "PanelSpec",
    "PipelineSpec",
]
