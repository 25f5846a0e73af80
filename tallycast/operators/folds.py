"""Leakage-aware folds as columns and membership tables, never as positions."""

from __future__ import annotations

import datetime
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycast.config import CvSpec
from tallycast.functions.scalars import period_from_index, period_index
from tallycast.operators.guards import require
from tallycast.operators.lookup import lookup
from tallycast.session import materialise

# Group ranks are counted per start day, minute, moment and 16 ** RANK_DIGITS hash buckets.
RANK_DIGITS = 3


def fold_bounds(df: DataFrame, date: str, cv: CvSpec = CvSpec(), grain: str = "month") -> DataFrame:
    """One row per fold of the rolling-origin split.

    Bounds are half-open period offsets from the first period of the data:
    training covers ``[0, train_end)`` and testing ``[test_start, test_end)``,
    ``gap`` periods later. Folds past the end of the data, or without training
    or test rows, are left out. The table is read once, for its distinct
    periods; all else happens on those.
    """
    require(df, [date])
    if cv.n_splits < 1 or cv.min_train < 1 or cv.gap < 0:
        raise ValueError("need n_splits >= 1, min_train >= 1 and gap >= 0")
    needed = cv.min_train + cv.n_splits
    seen = df.filter(F.col(date).isNotNull()).select(period_index(date, grain).alias("idx")).distinct()
    # One entry per calendar period.
    span = seen.agg(
        F.min("idx").alias("origin"), F.max("idx").alias("newest"), F.collect_set("idx").alias("observed")
    )
    short = F.raise_error(
        F.concat(
            F.lit(f"not enough periods: need at least {needed}, got "),
            F.coalesce(F.col("periods"), F.lit(0)).cast("string"),
        )
    )
    size = F.floor((F.col("periods") - cv.min_train) / cv.n_splits).cast("int")
    table = (
        span.withColumn("periods", F.col("newest") - F.col("origin") + 1)
        .withColumn("size", F.when(F.col("periods") >= needed, size).otherwise(short))
        .withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(cv.n_splits - 1))))
        .withColumn("train_end", F.lit(cv.min_train) + F.col("fold") * F.col("size"))
        .withColumn("test_start", F.col("train_end") + cv.gap)
        .withColumn("test_end", F.least(F.col("test_start") + F.col("size"), F.col("periods")))
        .filter(F.col("test_start") < F.col("periods"))
    )

    def holds_rows(low: Column, high: Column) -> Column:
        return F.exists("observed", lambda p: (p - F.col("origin") >= low) & (p - F.col("origin") < high))

    usable = holds_rows(F.lit(0), F.col("train_end")) & holds_rows(F.col("test_start"), F.col("test_end"))
    dates = [
        period_from_index(F.col("origin") + F.col(b), grain).alias(f"{b}_date")
        for b in ("train_end", "test_start", "test_end")
    ]
    return table.filter(usable).select(
        "fold", "origin", "periods", "size", "train_end", "test_start", "test_end", *dates
    )


@dataclass(frozen=True)
class Fold:
    """One fold as literal dates, so that its predicates reach the scan."""

    fold: int
    train_end: datetime.date
    test_start: datetime.date
    test_end: datetime.date
    purge: bool = True

    def trains(self, date: Column) -> Column:
        train = date < F.lit(self.train_end)
        if self.purge:
            train = train & ~((date >= F.lit(self.train_end)) & (date < F.lit(self.test_start)))
        return train

    def tests(self, date: Column) -> Column:
        return (date >= F.lit(self.test_start)) & (date < F.lit(self.test_end))


def rolling_folds(df: DataFrame, date: str, cv: CvSpec = CvSpec(), grain: str = "month") -> list[Fold]:
    """The folds of ``fold_bounds``, at most ``n_splits``, on the driver."""
    rows = fold_bounds(df, date, cv, grain).orderBy("fold").collect()
    return [
        Fold(r["fold"], r["train_end_date"], r["test_start_date"], r["test_end_date"], cv.purge) for r in rows
    ]


def fold_columns(df: DataFrame, date: str, folds: list[Fold]) -> DataFrame:
    """Add ``first_train_fold`` and ``test_fold`` without multiplying rows.

    Training windows expand, so a row that trains fold k trains all later
    folds too; test windows are disjoint. Two integers hold the whole split.
    """
    at = F.col(date)
    none = F.lit(None).cast("int")
    trains = F.coalesce(none, *[F.when(f.trains(at), F.lit(f.fold)) for f in folds])
    tests = F.coalesce(none, *[F.when(f.tests(at), F.lit(f.fold)) for f in folds])
    return df.withColumns({"first_train_fold": trains, "test_fold": tests})


def rolling_origin(df: DataFrame, date: str, folds: list[Fold], keys: Iterable[str] = ()) -> DataFrame:
    """Membership table ``(fold, role, keys…, date)``, built in one pass."""
    at = F.col(date)
    roles = [
        F.struct(
            F.lit(f.fold).alias("fold"),
            F.when(f.trains(at), "train").when(f.tests(at), "test").alias("role"),
        )
        for f in folds
    ]
    if not folds:
        nothing = df.select(F.lit(0).alias("fold"), F.lit("").alias("role"), *keys, date)
        return nothing.limit(0)
    return (
        df.select(*keys, date)
        .filter(at < F.lit(max(f.test_end for f in folds)))
        .select(F.inline(F.array(*roles)), *keys, date)
        .filter(F.col("role").isNotNull())
    )


def fold_summary(members: DataFrame, date: str) -> DataFrame:
    return members.groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
    )


def group_spans(df: DataFrame, group: str, date: str) -> DataFrame:
    """First date, last date and number of dated rows of every group."""
    return (
        df.filter(F.col(group).isNotNull())
        .groupBy(group)
        .agg(
            F.min(date).alias("first_date"),
            F.max(date).alias("last_date"),
            F.count(date).alias("n"),
        )
    )


def rank_groups(spans: DataFrame, group: str) -> DataFrame:
    """Add ``group_rank`` (from 0) by the first date, with its time of day.

    Groups that start at the same moment are ranked by the md5 of their key:
    many start with the data itself, and a hash cuts even that crowd into
    equal buckets. The rank is the sum of the counts of earlier days, of
    earlier minutes of the day, moments of the minute and buckets of the
    moment, and the position in the bucket, so no task sees more than one of
    them or one calendar. ``spans`` is read more than once and should be
    materialised.
    """
    moment = F.col("first_date").cast("timestamp_ntz")
    spans = spans.withColumns(
        {
            "_day": F.col("first_date").cast("date"),
            "_minute": F.hour(moment) * 60 + F.minute(moment),
            "_moment": moment,
            "_digest": F.md5(F.col(group).cast("string")),
        }
    ).withColumn("_bucket", F.conv(F.substring("_digest", 1, RANK_DIGITS), 16, 10).cast("int"))
    levels = ["_day", "_minute", "_moment", "_bucket"]
    inside = Window.partitionBy(*levels).orderBy("_digest", group)
    ranked = spans.withColumn("_rank", F.row_number().over(inside) - 1)
    for k, level in enumerate(levels):
        outer = levels[:k]
        counts = spans.groupBy(*outer, level).agg(F.count(F.lit(1)).alias("_n"))
        w = Window.partitionBy(*(outer or [F.lit(0)])).orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
        before = counts.select(*outer, level, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
        ranked = ranked.join(before, [*outer, level]).withColumn("_rank", F.col("_rank") + F.col("_before")).drop("_before")
    return ranked.select(group, "first_date", "last_date", "n", F.col("_rank").alias("group_rank"))


def purged_groups(
    df: DataFrame, group: str, date: str, cv: CvSpec = CvSpec(), keys: Iterable[str] = ()
) -> DataFrame:
    """Membership table ``(fold, role, group, keys…, date)`` of the group split.

    Groups are ranked by first date and cut into ``n_splits + 1`` equal blocks.
    Fold i tests block i + 1 and trains on the groups before it, on rows dated
    more than ``gap`` months before the first date of the test block.
    """
    require(df, [group, date])
    keys = [k for k in keys if k not in (group, date)]
    rows = df.select(group, *keys, date)
    spans = materialise(group_spans(rows, group, date).filter(F.col("first_date").isNotNull()))
    size = spans.count() // (cv.n_splits + 1)
    block = F.floor(F.col("group_rank") / max(size, 1)).cast("int")
    ranked = materialise(
        rank_groups(spans, group).withColumn("_block", block if size else F.lit(-1))
    )

    # One row per block, n_splits + 1 in all. A fold trains on something
    # exactly when an earlier block holds a row before the fold's cutoff.
    earlier = Window.partitionBy(F.lit(0)).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranked.filter(F.col("_block").between(0, cv.n_splits))
        .groupBy("_block")
        .agg(F.min("first_date").alias("_start"))
        .withColumn("_oldest", F.min("_start").over(earlier))
        .withColumn("cutoff", F.col("_start") - F.expr(f"INTERVAL {int(cv.gap)} MONTH"))
        .withColumn("fold", F.col("_block") - 1)
    )
    cutoffs = starts.filter(F.col("_oldest") < F.col("cutoff")).select("fold", "cutoff").collect()
    if not cutoffs:
        return rows.select(F.lit(0).alias("fold"), F.lit("").alias("role"), group, *keys, date).limit(0)
    placed = lookup(rows, ranked.select(group, "n", "_block"), [group], "n")
    roles = []
    for fold, cutoff in cutoffs:
        train = F.col("_block").between(0, fold) & (F.col(date) < F.lit(cutoff))
        role = F.when(train, "train").when(F.col("_block") == fold + 1, "test")
        roles.append(F.struct(F.lit(fold).alias("fold"), role.alias("role")))
    return placed.select(F.inline(F.array(*roles)), group, *keys, date).filter(F.col("role").isNotNull())
