"""Scores, prediction statistics and row-count checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.functions.scalars import clip_low
from tallycast.operators.numeric import exact_quantiles


def rmsle(truth: str, prediction: str) -> Column:
    """Aggregate: root mean squared difference of ``log1p`` values.

    Predictions are clipped at zero; the truth is not.
    """
    gap = F.log1p(clip_low(F.col(prediction))) - F.log1p(F.col(truth).cast("double"))
    return F.sqrt(F.avg(gap * gap))


def fold_scores(predictions: DataFrame, truth: str, prediction: str, fold: str = "fold") -> DataFrame:
    return predictions.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), rmsle(truth, prediction).alias("rmsle"))


def cv_summary(
    predictions: DataFrame, truth: str, prediction: str, fold: str = "fold", labelled: int | None = None
) -> DataFrame:
    """One row: mean and population deviation over folds, and the pooled score.

    Only predicted rows are scored; ``coverage`` tells their share of
    ``labelled`` rows. The pooled score is rebuilt from per-fold sums, so the
    predictions are read once.
    """
    gap = F.log1p(clip_low(F.col(prediction))) - F.log1p(F.col(truth).cast("double"))
    per_fold = predictions.groupBy(fold).agg(F.count(gap).alias("n"), F.sum(gap * gap).alias("sse"))
    score = F.sqrt(F.col("sse") / F.col("n"))
    covered = F.sum("n")
    return per_fold.filter(F.col("n") > 0).agg(
        F.count(F.lit(1)).alias("folds"),
        covered.alias("n"),
        F.sqrt(F.sum("sse") / covered).alias("overall_rmsle"),
        F.avg(score).alias("mean_rmsle"),
        F.stddev_pop(score).alias("std_rmsle"),
        (covered / F.lit(labelled) if labelled else F.lit(None).cast("double")).alias("coverage"),
    )


def row_counts(inputs: DataFrame, outputs: DataFrame, expected: int | None = None) -> DataFrame:
    """One row with both counts and whether they agree."""
    counts = outputs.agg(F.count(F.lit(1)).alias("n_out")).withColumn(
        "n_in", inputs.agg(F.count(F.lit(1))).scalar()
    )
    wanted = F.col("n_in") if expected is None else F.lit(expected).cast("bigint")
    return counts.select("n_in", "n_out", wanted.alias("expected"), (F.col("n_out") == wanted).alias("ok"))


def check_row_count(inputs: DataFrame, outputs: DataFrame, expected: int | None = None) -> int:
    """Raise unless the output has as many rows as the input (or ``expected``)."""
    row = row_counts(inputs, outputs, expected).first()
    if not row["ok"]:
        raise ValueError(f"expected {row['expected']} output rows, got {row['n_out']}")
    return row["n_out"]


def prediction_stats(df: DataFrame, prediction: str) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum."""
    quartiles = exact_quantiles(df, {f"p{p}": (prediction, p / 100) for p in (25, 50, 75)})
    v = F.col(prediction).cast("double")
    return df.agg(
        F.count(v).alias("n"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    ).withColumns({name: F.lit(value).cast("double") for name, value in quartiles.items()})
