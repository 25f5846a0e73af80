"""Sinks for scores, out-of-fold predictions and feature importances."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Write in parallel, one file per partition; CSV files carry a header."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_scores(scores: DataFrame, path: str, id_col: str, score_col: str, fmt: str = "csv") -> None:
    """Two columns: the id and the score on the ``log1p`` scale."""
    write_table(scores.select(id_col, score_col), path, fmt)


def write_out_of_fold(predictions: DataFrame, path: str, keys: list[str], label: str, fmt: str = "csv") -> None:
    """Predictions and truth of all test rows, with the keys of their rows."""
    out = predictions.selectExpr("fold", *keys, "prediction AS oof_prediction", f"`{label}` AS actual")
    write_table(out, path, fmt)


def write_importance(importance: DataFrame, path: str, fmt: str = "csv") -> None:
    write_table(importance, path, fmt)
