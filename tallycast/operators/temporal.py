"""Lag, rolling, velocity, trend and calendar features."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tallycast.config import FeatureSpec
from tallycast.functions.scalars import calendar, ratio
from tallycast.operators.blocks import in_row_blocks
from tallycast.operators.guards import require

STATS: dict[str, Callable[[Column], Column]] = {
    "mean": F.avg,
    "std": F.stddev_samp,
    "min": F.min,
    "max": F.max,
}

# Rows without a customer are spread over so many groups.
SALT, SPREAD = "_salt", 4096


def lag_name(value: str, n: int, seasonal: bool = False) -> str:
    return f"{value}_lag_{n}m" + ("_seasonal" if seasonal else "")


def rolling_name(value: str, stat: str, n: int) -> str:
    return f"{value}_rolling_{stat}_{n}m"


def lag_columns(value: str, spec: FeatureSpec, w: WindowSpec) -> dict[str, Column]:
    short = {lag_name(value, n): F.lag(value, n).over(w) for n in spec.short_lags}
    seasonal = {lag_name(value, n, True): F.lag(value, n).over(w) for n in spec.seasonal_lags}
    return {**short, **seasonal}


def rolling_columns(value: str, spec: FeatureSpec, w: WindowSpec) -> dict[str, Column]:
    """Statistics over the last n rows with the current one; nulls are skipped."""
    unknown = [s for s in spec.rolling_stats if s not in STATS]
    if unknown:
        raise ValueError(f"unknown rolling statistics: {', '.join(unknown)}")
    number = F.col(value).cast("double")
    return {
        rolling_name(value, stat, n): STATS[stat](number).over(w.rowsBetween(1 - n, 0))
        for n in spec.rolling_windows
        for stat in spec.rolling_stats
    }


def velocity_columns(value: str, spec: FeatureSpec, have: set[str]) -> dict[str, Column]:
    """Recent mean over a historical lag plus one; needs both columns."""
    out = {}
    for recent, past in spec.velocity:
        mean, lag = rolling_name(value, "mean", recent), lag_name(value, past, past == 12)
        if mean in have and lag in have:
            out[f"velocity_{recent}m_vs_{past}m"] = ratio(F.col(mean), F.col(lag) + 1)
    return out


def trend_columns(value: str, lag_3: str, have: set[str]) -> dict[str, Column]:
    out = {"trend_3m": F.col(value) - F.col(lag_3)}
    year_ago = lag_name(value, 12, True)
    if year_ago in have:
        out["yoy_growth"] = ratio(F.col(value) - F.col(year_ago), F.col(year_ago) + 1)
    return out


def _windowed(df: DataFrame, customer: str, value: str, spec: FeatureSpec, w: WindowSpec) -> DataFrame:
    """All window columns in one select, then the columns derived from them."""
    windows = {**lag_columns(value, spec, w), **rolling_columns(value, spec, w)}
    lag_3 = lag_name(value, 3)
    hidden = [] if lag_3 in windows else ["_lag_3"]
    if hidden:
        lag_3 = hidden[0]
        windows[lag_3] = F.lag(value, 3).over(w)
    keyed = F.col(customer).isNotNull()
    out = df.select("*", *[F.when(keyed, c).alias(name) for name, c in windows.items()])
    have = set(windows)
    derived = {**velocity_columns(value, spec, have), **trend_columns(value, lag_3, have)}
    derived["trend_3m"] = F.when(keyed, derived["trend_3m"])
    return out.withColumns(derived).drop(*hidden)


def _near(df: DataFrame, customer: str, date: str, wanted: str, spec: FeatureSpec, w: WindowSpec) -> DataFrame:
    """The wanted rows and what their features reach back to, from the exchange and sort of the features."""
    keyed = F.col(customer).isNotNull() & F.col(date).isNotNull()
    same = F.max(wanted).over(Window.partitionBy(customer, SALT, date))
    first = df.withColumn("_replaced", keyed & same & ~F.col(wanted)).filter(~F.col("_replaced")).drop("_replaced")
    near = F.max(wanted).over(w.rowsBetween(0, spec.look_back))
    return first.withColumn("_near", near).filter("_near").drop("_near")


def temporal_features(
    df: DataFrame,
    customer: str,
    date: str,
    value: str,
    spec: FeatureSpec = FeatureSpec(),
    *,
    tie_break: tuple[str, ...] = (),
    one_row_per_period: bool = True,
    blocks: int | None = None,
    null_customers: bool = True,
    wanted: str | None = None,
) -> DataFrame:
    """Add calendar, lag, rolling, velocity and trend columns.

    ``null_customers=False`` says that every row has a customer. ``wanted`` names
    a flag of the rows that are asked for in a panel: the others are their past,
    and go where a wanted row has their customer and date, or where they lie
    further back than features reach. Not all rows that stay are wanted.

    A panel holds one row per customer and period, so a window partition is
    never longer than the calendar: all windows share one exchange and sort.
    Where rows are finer than that (``one_row_per_period=False``) one customer
    may own a large share of the table; rows are then processed in blocks of
    the global order and each block also receives the rows just before it.
    """
    require(df, [customer, date, value, *tie_break])
    flagged = df.withColumns(calendar(date))
    order = [F.col(date), *[F.col(t) for t in tie_break]]
    if one_row_per_period:
        order = [c.asc_nulls_last() for c in order]
        if not null_customers:
            return _windowed(flagged, customer, value, spec, Window.partitionBy(customer).orderBy(*order))
        # Rows without a customer get no features; they are spread, so that no window has to gather them.
        spread = F.when(F.col(customer).isNull(), F.pmod(F.xxhash64(date, value), F.lit(SPREAD)))
        w = Window.partitionBy(customer, SALT).orderBy(*order)
        flagged = flagged.withColumn(SALT, spread)
        if wanted:
            flagged = _near(flagged, customer, date, wanted, spec, w)
        return _windowed(flagged, customer, value, spec, w).drop(SALT)
    return in_row_blocks(
        flagged,
        key=customer,
        order=[date, *tie_break],
        back=spec.look_back,
        blocks=blocks,
        build=lambda rows, w: _windowed(rows, customer, value, spec, w),
    )
