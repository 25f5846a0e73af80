"""Transactions to customer-by-period panels and forward labels."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycast.functions.scalars import period_index, period_start, shift_period


def periodic_panel(
    df: DataFrame,
    customer: str,
    date: str,
    *,
    grain: str = "month",
    period: str = "period",
    count: str = "txn_count",
    measures: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per customer and period with a row count and further aggregates.

    The aggregation combines on the map side, so a customer who owns a large
    share of all rows reaches the shuffle as a few rows per period.
    """
    extra = [m.alias(name) for name, m in (measures or {}).items()]
    return (
        df.filter(F.col(customer).isNotNull() & F.col(date).isNotNull())
        .groupBy(customer, period_start(date, grain).alias(period))
        .agg(F.count(F.lit(1)).alias(count), *extra)
    )


def dense_panel(
    panel: DataFrame,
    customer: str,
    period: str = "period",
    *,
    zero: Iterable[str] = ("txn_count",),
    constant: Iterable[str] = (),
    grain: str = "month",
    until: Column | None = None,
) -> DataFrame:
    """Fill the periods a customer was silent in.

    Every observed row emits itself and the silent periods up to the
    customer's next row, so neither a calendar table nor a join is needed.
    ``zero`` columns are 0 in the new rows, ``constant`` columns are repeated
    and all others are null. A customer's rows end at the last observed period,
    or at ``until``.

    The exchange by customer has a fixed number of partitions: adaptive
    execution would merge them by the size of what goes in, not knowing that
    the filled panel is many times larger. Windows by customer that follow use
    the same partitioning.
    """
    partitions = int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    here = period_index(period, grain)
    upcoming = F.lead(period_index(period, grain)).over(Window.partitionBy(customer).orderBy(period))
    last = here if until is None else F.greatest(here, period_index(until, grain))
    steps = F.coalesce(F.col("_next"), last + 1) - here
    zero, constant = set(zero), {customer, *constant}

    def filled(name: str) -> Column:
        if name == period:
            return shift_period(F.col(period), F.col("_step"), grain).alias(period)
        if name in constant:
            return F.col(name)
        observed = F.when(F.col("_step") == 0, F.col(name))
        return (observed.otherwise(F.lit(0)) if name in zero else observed).alias(name)

    return (
        panel.repartition(partitions, customer)
        .withColumn("_next", upcoming)
        .withColumn("_step", F.explode(F.sequence(F.lit(0), steps - 1)))
        .select(*[filled(c) for c in panel.columns])
    )


def forward_label(
    panel: DataFrame,
    customer: str,
    period: str = "period",
    value: str = "txn_count",
    *,
    horizon: int = 3,
    label: str = "next_3m_txn_count",
) -> DataFrame:
    """Sum of the next ``horizon`` rows; null unless all of them exist."""
    ahead = Window.partitionBy(customer).orderBy(period).rowsBetween(1, horizon)
    complete = F.count(F.lit(1)).over(ahead) == horizon
    return panel.withColumn(label, F.when(complete, F.sum(value).over(ahead)))
