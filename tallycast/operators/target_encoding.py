"""Smoothed target encoding, over all rows or per fold."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.config import EncoderSpec
from tallycast.functions.hashing import gaussian
from tallycast.functions.scalars import nan_to_null, ratio
from tallycast.operators.guards import present, require
from tallycast.operators.lookup import BROADCAST_BYTES, bytes_by, lookup, within_budget
from tallycast.session import materialise

# Pseudo-column that counts every row, so one aggregation also gives the prior.
ALL_ROWS = "*"


def encoded_name(column: str) -> str:
    return f"{column}_target_enc"


def category_totals(df: DataFrame, columns: list[str], label: str, by: Iterable[str] = ()) -> DataFrame:
    """``rows``, ``n`` (labelled rows) and label ``total`` per column and category.

    All columns are aggregated together: one shuffle of partial aggregates, in
    which a category that owns a third of the rows is a few rows per task.
    """
    by = list(by)
    y = nan_to_null(F.col(label).cast("double")).alias("_y")
    long = df.select(
        *by, y, F.lit(ALL_ROWS).alias(ALL_ROWS), *[F.col(c).cast("string").alias(c) for c in columns]
    ).unpivot([*by, "_y"], [f"`{ALL_ROWS}`", *columns], "col", "category")
    return (
        long.filter(F.col("category").isNotNull())
        .groupBy(*by, "col", "category")
        .agg(F.count(F.lit(1)).alias("rows"), F.count("_y").alias("n"), F.sum("_y").alias("total"))
    )


def category_stats(df: DataFrame, columns: Iterable[str], label: str) -> DataFrame:
    """Mean and count of the label per column and category."""
    return (
        category_totals(df, present(df, columns), label)
        .filter(F.col("col") != ALL_ROWS)
        .select("col", "category", "n", ratio(F.col("total"), F.col("n")).alias("mean"))
    )


def smoothed(n: Column, mean: Column, prior: Column, spec: EncoderSpec, *key: Column) -> Column:
    """Encoding of a category: its mean drawn towards the prior."""
    weight = ratio(n, n + F.lit(spec.smoothing))
    value = F.coalesce(weight * mean + (1 - weight) * prior, prior)
    if spec.min_samples:
        value = F.when(n < spec.min_samples, prior).otherwise(value)
    if spec.noise:
        value = value + F.lit(spec.noise) * F.abs(prior) * gaussian(spec.seed, *key)
    return value


@dataclass
class TargetEncoding:
    """Learned encodings: ``(col, category, rows, n, mean, enc)`` and the prior."""

    table: DataFrame
    columns: list[str]
    prior: float | None
    rows: int
    handle_unknown: str = "global_mean"

    @property
    def names(self) -> list[str]:
        return [encoded_name(c) for c in self.columns]

    def apply(self, df: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """Replace each column by its encoding; unknown categories get the prior."""
        sizes = bytes_by(self.table.select("col", "category", "enc"), "col")
        small = within_budget({c: sizes.get(c, 0) for c in present(df, self.columns)}, broadcast_bytes)
        for c in present(df, self.columns):
            encodings = self.table.filter(F.col("col") == c).select(
                F.col("category").alias(c), "rows", F.col("enc").alias(encoded_name(c))
            )
            df = lookup(
                df.withColumn(c, F.col(c).cast("string")),
                encodings,
                [c],
                "rows",
                broadcast_bytes=0,
                size=0 if c in small else 1,
            ).drop(c)
            if self.handle_unknown == "global_mean":
                known = F.coalesce(F.col(encoded_name(c)), F.lit(self.prior).cast("double"))
                df = df.withColumn(encoded_name(c), known)
        return df


def check_unknown(spec: EncoderSpec) -> None:
    if spec.handle_unknown not in ("global_mean", "nan"):
        raise ValueError("handle_unknown must be 'global_mean' or 'nan'")


def fit_target_encoding(
    df: DataFrame, columns: Iterable[str], label: str, spec: EncoderSpec = EncoderSpec()
) -> TargetEncoding:
    check_unknown(spec)
    require(df, [label])
    columns = present(df, columns)
    totals = materialise(category_totals(df, columns, label))
    everything = totals.filter(F.col("col") == ALL_ROWS).first()
    rows = everything["rows"] if everything else 0
    prior = everything["total"] / everything["n"] if everything and everything["n"] else None
    mean = ratio(F.col("total"), F.col("n"))
    enc = smoothed(F.col("n"), mean, F.lit(prior).cast("double"), spec, F.col("col"), F.col("category"))
    table = totals.filter(F.col("col") != ALL_ROWS).select(
        "col", "category", "rows", "n", mean.alias("mean"), enc.alias("enc")
    )
    return TargetEncoding(table, columns, prior, rows, spec.handle_unknown)


def summed_over_folds(totals: DataFrame, n_folds: int) -> DataFrame:
    """Totals by ``first_train_fold`` as totals by ``fold``: training windows only grow."""
    later = F.explode(F.sequence(F.col("first_train_fold"), F.lit(n_folds - 1)))
    return (
        totals.withColumn("fold", later)
        .groupBy("fold", "col", "category")
        .agg(F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.sum("total").alias("total"))
    )


def fit_target_encoding_folds(
    df: DataFrame, columns: Iterable[str], label: str, n_folds: int, spec: EncoderSpec = EncoderSpec()
) -> list[TargetEncoding]:
    """``fit_target_encoding`` of the training rows of every fold, from one pass; ``df`` carries ``first_train_fold``."""
    check_unknown(spec)
    require(df, [label])
    columns = present(df, columns)
    trained = df.filter(F.col("first_train_fold").isNotNull())
    totals = materialise(summed_over_folds(category_totals(trained, columns, label, by=["first_train_fold"]), n_folds))
    whole = {r["fold"]: r for r in totals.filter(F.col("col") == ALL_ROWS).collect()}
    mean = ratio(F.col("total"), F.col("n"))
    out = []
    for fold in range(n_folds):
        all_rows = whole.get(fold)
        prior = all_rows["total"] / all_rows["n"] if all_rows and all_rows["n"] else None
        enc = smoothed(F.col("n"), mean, F.lit(prior).cast("double"), spec, F.col("col"), F.col("category"))
        table = totals.filter((F.col("fold") == fold) & (F.col("col") != ALL_ROWS)).select(
            "col", "category", "rows", "n", mean.alias("mean"), enc.alias("enc")
        )
        out.append(TargetEncoding(table, columns, prior, all_rows["rows"] if all_rows else 0, spec.handle_unknown))
    return out


def fold_encodings(
    df: DataFrame, columns: Iterable[str], label: str, n_splits: int, spec: EncoderSpec = EncoderSpec()
) -> DataFrame:
    """Encodings of every fold, each from that fold's training rows only.

    ``df`` carries ``first_train_fold``. Rows are aggregated once per first
    fold; training windows only grow, so a fold's totals are the sum of the
    totals of the folds up to it. The work on rows does not depend on the
    number of folds.
    """
    columns = present(df, columns)
    trained = df.filter(F.col("first_train_fold").isNotNull())
    totals = materialise(summed_over_folds(category_totals(trained, columns, label, by=["first_train_fold"]), n_splits))
    # One row per fold.
    priors = totals.filter(F.col("col") == ALL_ROWS).select(
        "fold", ratio(F.col("total"), F.col("n")).alias("prior")
    )
    mean = ratio(F.col("total"), F.col("n"))
    enc = smoothed(F.col("n"), mean, F.col("prior"), spec, F.col("fold"), F.col("col"), F.col("category"))
    return (
        totals.filter(F.col("col") != ALL_ROWS)
        .join(F.broadcast(priors), "fold")
        .select("fold", "col", "category", "rows", "n", mean.alias("mean"), "prior", enc.alias("enc"))
    )


def encode_out_of_fold(
    df: DataFrame, columns: Iterable[str], label: str, n_splits: int, spec: EncoderSpec = EncoderSpec(),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Test rows of all folds, encoded by what their own fold has seen.

    ``df`` carries ``first_train_fold`` and ``test_fold``; the latter is
    returned as ``fold``.
    """
    columns = present(df, columns)
    table = materialise(fold_encodings(df, columns, label, n_splits, spec))
    priors = table.groupBy("fold").agg(F.first("prior").alias("_prior"))
    sizes = bytes_by(table.select("fold", "col", "category", "enc"), "col")
    small = within_budget({c: sizes.get(c, 0) for c in columns}, broadcast_bytes)
    out = df.filter(F.col("test_fold").isNotNull()).withColumnRenamed("test_fold", "fold")
    for c in columns:
        encodings = table.filter(F.col("col") == c).select(
            "fold", F.col("category").alias(c), "rows", F.col("enc").alias(encoded_name(c))
        )
        out = lookup(
            out.withColumn(c, F.col(c).cast("string")),
            encodings,
            ["fold", c],
            "rows",
            broadcast_bytes=0,
            size=0 if c in small else 1,
        ).drop(c)
    if spec.handle_unknown == "global_mean":
        # One row per fold.
        out = out.join(F.broadcast(priors), "fold", "left").withColumns(
            {encoded_name(c): F.coalesce(encoded_name(c), "_prior") for c in columns}
        )
    return out.drop("_prior", "first_train_fold")
