"""Exact distributed quantiles, imputation and skew transforms."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.functions.scalars import category_id, clip_low, nan_to_null
from tallycast.operators.guards import normalise_nan, present

# Values between the bounds are listed once no more than this many are left.
BAND_ROWS = 10_000
# Accuracy of the sketch that proposes bounds: rank error of rows / accuracy.
SKETCH_ACCURACY = 10_000


@dataclass
class _Search:
    """Bounds known to hold the order statistics that a quantile falls between."""

    column: str
    q: float
    low: float = -math.inf
    high: float = math.inf
    below: int = 0
    inside: int = 0
    first: int = 0
    last: int = 0
    fraction: float = 0.0

    @property
    def value(self) -> Column:
        """The column inside the bounds, null elsewhere."""
        c = F.col(self.column)
        held = c.isNotNull()
        if self.low > -math.inf:
            held = held & (c >= F.lit(self.low))
        if self.high < math.inf:
            held = held & (c <= F.lit(self.high))
        return F.when(held, c)

    @property
    def open(self) -> bool:
        return self.low < self.high

    def start(self, rows: int) -> None:
        rank = self.q * (rows - 1)
        self.inside, self.first = rows, math.floor(rank)
        self.last = min(self.first + 1, rows - 1)
        self.fraction = rank - self.first

    def probe(self) -> Column:
        """Sketch of the values just below, at and just above the wanted ranks."""
        if self.inside:
            lower, upper = ((r - self.below) / self.inside for r in (self.first, self.last))
        else:
            lower = upper = self.q
        slack = 4.0 / SKETCH_ACCURACY
        points = [max(0.0, lower - slack), lower, min(1.0, upper + slack)]
        return F.percentile_approx(self.value, points, SKETCH_ACCURACY)

    def interpolate(self, left: float, right: float) -> float:
        return left + (right - left) * self.fraction


def exact_quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> dict[str, float | None]:
    """Exact, linearly interpolated quantiles: ``{name: (column, q)}``.

    No value is shuffled. A quantile sketch proposes bounds, which are kept if
    an exact count shows that they hold the wanted ranks. A round narrows a
    column about a thousandfold, so one or two are enough for any table; the
    last pass lists at most ``BAND_ROWS`` values per quantile, or none where
    the bounds meet. All quantiles share every pass.
    """
    if not wanted:
        return {}
    columns = sorted({c for c, _ in wanted.values()})
    df = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in columns])
    search = {name: _Search(c, q) for name, (c, q) in wanted.items()}

    counts = {f"rows_{i}": F.count(c) for i, c in enumerate(columns)}
    probes = {f"probe_{i}": s.probe() for i, s in enumerate(search.values())}
    first = df.agg(*[v.alias(n) for n, v in {**counts, **probes}.items()]).first()
    rows = {c: first[f"rows_{i}"] for i, c in enumerate(columns)}
    proposed = {name: first[f"probe_{i}"] for i, name in enumerate(search)}
    result: dict[str, float | None] = {name: None for name in wanted}
    search = {name: s for name, s in search.items() if rows[s.column]}
    for s in search.values():
        s.start(rows[s.column])

    while wide := {name: s for name, s in search.items() if s.open and s.inside > BAND_ROWS}:
        if not proposed:
            probed = df.agg(*[s.probe().alias(f"probe_{i}") for i, s in enumerate(wide.values())]).first()
            proposed = {name: probed[f"probe_{i}"] for i, name in enumerate(wide)}
        _narrow(df, wide, proposed)
        proposed = {}

    listed = {name: s for name, s in search.items() if s.open}
    values = {}
    if listed:
        lists = [F.sort_array(F.collect_list(s.value)).alias(f"list_{i}") for i, s in enumerate(listed.values())]
        found = df.agg(*lists).first()
        values = {name: found[f"list_{i}"] for i, name in enumerate(listed)}
    for name, s in search.items():
        if s.open:
            result[name] = s.interpolate(values[name][s.first - s.below], values[name][s.last - s.below])
        else:
            result[name] = s.low
    return result


def exact_quantile(df: DataFrame, columns: Iterable[str], q: float = 0.5) -> dict[str, float | None]:
    return exact_quantiles(df, {c: (c, q) for c in columns})


def _narrow(df: DataFrame, wide: dict[str, _Search], proposed: dict[str, list[float]]) -> None:
    """Adopt the proposed bounds that an exact count confirms."""
    checks = []
    for i, (name, s) in enumerate(wide.items()):
        low, middle, high = proposed[name]
        v = F.col(s.column)
        counted = {"below": v < low, "inside": (v >= low) & (v <= high), "less": v < middle, "equal": v == middle}
        checks += [F.count(F.when(c, 1)).alias(f"{n}_{i}") for n, c in counted.items()]
    exact = df.agg(*checks).first()
    for i, (name, s) in enumerate(wide.items()):
        low, middle, high = proposed[name]
        below, inside, less, equal = (exact[f"{n}_{i}"] for n in ("below", "inside", "less", "equal"))
        if less <= s.first and s.last < less + equal:
            s.low, s.high, s.below, s.inside = middle, middle, less, equal
        elif below <= s.first and s.last < below + inside and inside < s.inside:
            s.low, s.high, s.below, s.inside = low, high, below, inside
        else:
            _bisect(df, s)


def _bisect(df: DataFrame, s: _Search) -> None:
    """Fallback step: halve the value range between the two extremes."""
    v = s.value
    low, high = df.agg(F.min(v), F.max(v)).first()
    middle = low + (high - low) / 2
    left = df.agg(F.count(F.when(v <= middle, 1))).first()[0]
    following = df.agg(F.min(F.when(v > middle, v))).first()[0]
    if s.last < s.below + left:
        s.low, s.high, s.inside = low, middle, left
    elif s.first >= s.below + left:
        s.low, s.high, s.below, s.inside = following, high, s.below + left, s.inside - left
    else:
        # The two ranks lie on either side of the cut: both values are known.
        preceding = df.agg(F.max(F.when(v <= middle, v))).first()[0]
        s.low = s.high = s.interpolate(preceding, following)
        s.inside = 0


# Size of a quantile sketch: its normalised rank error is about 2.3 / k ** 0.97, here 0.1 %.
SKETCH_K = 4000


def quantile_states(df: DataFrame, columns: Iterable[str], by: Iterable[str] = ()) -> DataFrame:
    """``col``, ``sketch`` and ``n`` of each column: mergeable summaries of a few hundred kB at most, to be kept as a table."""
    by = list(by)
    named = df.select(*by, *[nan_to_null(F.col(c).cast("double")).alias(c) for c in columns])
    long = named.unpivot(by, list(columns), "col", "value").filter(F.col("value").isNotNull())
    return long.groupBy(*by, "col").agg(F.kll_sketch_agg_double("value", F.lit(SKETCH_K)).alias("sketch"), F.count(F.lit(1)).alias("n"))


def merge_quantile_states(states: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """The states of all periods, files or folds as one for each column (and ``by``)."""
    return states.groupBy(*by, "col").agg(F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch"), F.sum("n").alias("n"))


def state_quantiles(states: DataFrame, q: float = 0.5) -> DataFrame:
    """Add ``value``, the quantile within the rank error of the sketch."""
    return states.withColumn("value", F.kll_sketch_get_quantile_double("sketch", F.lit(q)))


def fit_imputer(df: DataFrame, columns: Iterable[str], strategy: str = "median") -> dict[str, float]:
    """Fill value of each column that exists: median, mean, or 0 otherwise."""
    columns = present(df, columns)
    if strategy == "median":
        values = exact_quantile(df, columns)
    elif strategy == "approx_median" and columns:
        values = {r["col"]: r["value"] for r in state_quantiles(quantile_states(df, columns)).collect()}
    elif strategy == "mean" and columns:
        means = normalise_nan(df.select(*columns)).agg(*[F.avg(c).alias(c) for c in columns])
        values = means.first().asDict()
    else:
        values = {c: 0.0 for c in columns}
    return {c: float(v) for c, v in values.items() if v is not None}


def fit_imputer_folds(df: DataFrame, columns: Iterable[str], n_folds: int, strategy: str = "median") -> list[dict[str, float]]:
    """``fit_imputer`` of the training rows of every fold; all folds share every pass.

    ``df`` carries ``first_train_fold``: a row counts for that fold and all later ones.
    """
    columns = present(df, columns)
    if strategy == "approx_median" and columns:
        known = df.filter(F.col("first_train_fold").isNotNull())
        states = quantile_states(known, columns, ["first_train_fold"])
        later = F.explode(F.sequence(F.col("first_train_fold"), F.lit(n_folds - 1)))
        summed = state_quantiles(merge_quantile_states(states.withColumn("fold", later), ["fold"])).collect()
        return [{r["col"]: r["value"] for r in summed if r["fold"] == fold} for fold in range(n_folds)]
    names = {f"_{i}_{fold}": (c, fold) for i, c in enumerate(columns) for fold in range(n_folds)}
    values = {
        name: F.when(F.col("first_train_fold") <= fold, nan_to_null(F.col(c).cast("double"))).alias(name)
        for name, (c, fold) in names.items()
    }
    if strategy == "median":
        found = exact_quantile(df.select(*values.values()), names)
    elif strategy == "mean" and columns:
        found = df.agg(*[F.avg(v).alias(name) for name, v in values.items()]).first().asDict()
    else:
        found = dict.fromkeys(names, 0.0)
    out: list[dict[str, float]] = [{} for _ in range(n_folds)]
    for name, (c, fold) in names.items():
        if found[name] is not None:
            out[fold][c] = float(found[name])
    return out


def imputer_table(spark: SparkSession, values: dict[str, float]) -> DataFrame:
    return spark.createDataFrame(sorted(values.items()), "col string, value double")


def skew_transform(
    df: DataFrame, columns: Iterable[str], fill: dict[str, float], log: bool = True
) -> DataFrame:
    """Fill nulls and, with ``log``, add the log column and two indicators.

    ``{c}_is_missing`` marks rows that were null before filling and
    ``{c}_is_zero`` marks rows that are zero after it.
    """
    out: dict[str, Column] = {}
    for c in present(df, columns):
        raw = F.col(c).cast("double")
        raw = nan_to_null(raw)
        filled = F.coalesce(raw, F.lit(fill[c])) if c in fill else raw
        out[c] = filled
        if log:
            out[f"{c}_log"] = F.log1p(clip_low(filled))
            out[f"{c}_is_missing"] = raw.isNull().cast("int")
            out[f"{c}_is_zero"] = F.coalesce((filled == 0).cast("int"), F.lit(0))
    return df.withColumns(out) if out else df


def ids_to_categories(df: DataFrame, columns: Iterable[str], prefix: str = "id_") -> DataFrame:
    out = {c: category_id(c, prefix) for c in present(df, columns)}
    return df.withColumns(out) if out else df
