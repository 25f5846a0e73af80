"""Batch scoring on the ``log1p`` scale."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallycast.functions.scalars import clip_low, log_target
from tallycast.operators.metrics import check_row_count
from tallycast.operators.models import weighted_average
from tallycast.plans.prepare import stateless_features
from tallycast.plans.train import Forecaster
from tallycast.sources.writers import write_scores

# Up to so many customers to score, their history is picked out before it is shuffled.
FEW_CUSTOMERS = 20_000


def score(rows: DataFrame, forecaster: Forecaster, history: DataFrame | None = None) -> DataFrame:
    """Predictions for ``rows``: customer, date and ``log1p`` of the forecast.

    Lags reach back before the rows to score, so features are built over
    ``history`` and the rows together and only then cut to the rows; history
    that no feature reaches goes before. A row to score that history holds as
    well is one row. The output is clipped at a forecast of zero.
    """
    spec = forecaster.spec
    p = spec.panel
    columns = [c for c in rows.columns if c != p.label_col]
    both = rows.select(*columns).withColumn("_wanted", F.lit(True))
    wanted = None
    if history is not None:
        shared, wanted = [c for c in columns if c in history.columns], "_wanted"
        past = history.select(*shared).withColumn("_wanted", F.lit(False))
        both = both.unionByName(past, allowMissingColumns=True)
    return predicted(stateless_features(both, spec, wanted=wanted).filter("_wanted").drop("_wanted"), forecaster)


def predicted(features: DataFrame, forecaster: Forecaster) -> DataFrame:
    """Customer, date and ``log1p`` of the forecast of rows that have their stateless features."""
    spec = forecaster.spec
    p = spec.panel
    prep = forecaster.preprocessing
    vectors = prep.layout.assemble(prep.apply(features), forecaster.assembler, [p.customer_col, p.date_col])
    scored = forecaster.model.predict(vectors, "_prediction")
    scale = clip_low if spec.model.log_target else log_target
    return scored.select(
        p.customer_col, p.date_col, scale(F.col("_prediction")).alias(p.label_col)
    )


def score_ensemble(
    rows: DataFrame, forecasters: list[Forecaster], weights: list[float] | None = None, history: DataFrame | None = None
) -> DataFrame:
    """As ``score``, but the weighted average over forecasters, each with its own preprocessing.

    ``rows`` has one row per customer and date. Forecasters of the folds of a
    cross-validation, for example, each bring their own vocabulary and layout.
    """
    if not forecasters:
        raise ValueError("an ensemble needs at least one model")
    p = forecasters[0].spec.panel
    keys = [p.customer_col, p.date_col]
    names = [f"_score_{i}" for i in range(len(forecasters))]
    average = weighted_average(names, weights).alias(p.label_col)
    parts = [score(rows, f, history).withColumnRenamed(p.label_col, n) for f, n in zip(forecasters, names)]
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.join(part, keys)
    return joined.select(*keys, average)


def history_of(rows: DataFrame, history: DataFrame, customer: str) -> DataFrame:
    """The history without customers that are not to be scored, if those to score are few; it is not shuffled for that."""
    if history.schema[customer].dataType != rows.schema[customer].dataType:
        return history
    asked = rows.select(customer).distinct().limit(FEW_CUSTOMERS + 1).toArrow()
    if asked.num_rows > FEW_CUSTOMERS:
        return history
    return history.join(F.broadcast(rows.sparkSession.createDataFrame(asked)), customer, "left_semi")


def score_to_file(
    rows: DataFrame,
    forecaster: Forecaster,
    path: str,
    history: DataFrame | None = None,
    *,
    fmt: str = "csv",
    expected: int | None = None,
) -> int:
    """Score, write, and check that what was written lost or gained no row; returns the row count.

    With a history, the customers of the rows are read first: see ``history_of``.
    Both counts are taken while the scores are written. Work that Spark repeats
    after a failure may be counted twice, so counts that differ are taken again,
    from the input and from what was written, before an error is raised.
    """
    p = forecaster.spec.panel
    seen, done = Observation(), Observation()
    number = F.count(F.lit(1)).alias("n")
    if history is not None:
        history = history_of(rows, history, p.customer_col)
    scores = score(rows.observe(seen, number), forecaster, history)
    write_scores(scores.observe(done, number), path, p.customer_col, p.label_col, fmt)
    written, wanted = done.get["n"], seen.get["n"] if expected is None else expected
    if written == wanted:
        return written
    back = rows.sparkSession.read.option("header", True).format(fmt).load(path)
    return check_row_count(rows, back, expected)
