"""States of all folds from one pass, against a fit of each fold."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallycast.config import CvSpec, EncoderSpec, ModelSpec, PanelSpec, PipelineSpec
from tallycast.operators.folds import rolling_folds
from tallycast.operators.numeric import fit_imputer, fit_imputer_folds
from tallycast.plans.prepare import build_panel, fit_preprocessing, stateless_features
from tallycast.plans.train import fit_folds, labelled
from tallycast.session import materialise

SPEC = PipelineSpec(
    panel=PanelSpec(
        customer_col="o_custkey", date_col="period", high_cardinality_cols=("c_mktsegment", "c_desc"),
        skewed_cols=("transaction_amount", "c_acctbal"), numeric_id_cols=("c_nationkey",),
    ),
    encoders=EncoderSpec(tfidf_terms=6, tfidf_min_df=2),
    cv=CvSpec(n_splits=5),
    model=ModelSpec(kind="gbt", rounds=1, nominal_cols=("c_kind",)),
)


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    panel = build_panel(
        spark.read.parquet(f"{sf_dir}/orders.parquet"), SPEC,
        source_customer="o_custkey", source_date="o_orderdate", amount="o_totalprice",
    )
    who = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_acctbal", "c_mktsegment",
        F.concat_ws(" ", F.lit("shop"), "c_mktsegment", F.concat(F.lit("n"), "c_nationkey")).alias("c_desc"),
        F.concat(F.lit("k"), F.col("c_custkey") % 7).alias("c_kind"),
    )
    rows = panel.join(who, "o_custkey", "left")
    late = F.col("period") > F.lit("1997-01-01").cast("date")
    rows = rows.withColumn("c_kind", F.when(late, F.concat(F.lit("late"), F.month("period"))).otherwise(F.col("c_kind")))
    return materialise(labelled(stateless_features(rows, SPEC), SPEC))


def jobs(spark, work):
    spark.sparkContext.setJobGroup(name := f"counted-{id(work)}", "")
    out = work()
    spark.sparkContext.setJobGroup("others", "")
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_equal_to_fits_by_fold(spark, rows):
    folds = rolling_folds(rows, "period", SPEC.cv)
    assert len(folds) == 5
    learned, many = jobs(spark, lambda: fit_folds(rows, folds, SPEC))
    _, one = jobs(spark, lambda: fit_folds(rows, folds[-1:], SPEC))
    assert many < 1.5 * one, (many, one)
    for fold, (prep, assembler) in zip(folds, learned):
        train = rows.filter(fold.trains(F.col("period")))
        alone = fit_preprocessing(train, SPEC)
        assert prep.fill == alone.fill and prep.layout == alone.layout
        assert prep.encoders.text == alone.encoders.text and prep.encoders.text[0].terms
        target, other = prep.encoders.target, alone.encoders.target
        assert (target.prior, target.rows, target.columns) == (pytest.approx(other.prior), other.rows, other.columns)
        got, want = ({(r["col"], r["category"]): (r["rows"], r["n"], r["enc"]) for r in t.table.collect()} for t in (target, other))
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)
        indexer = alone.layout.fit_assembler(train).stages[0]
        assert assembler.stages[0].labelsArray == indexer.labelsArray
        assert assembler.stages[1].getInputCols() == alone.layout.fit_assembler(train).stages[1].getInputCols()


def test_too_many_nominal_values(rows):
    folds = rolling_folds(rows, "period", SPEC.cv)
    spec = replace(SPEC, model=replace(SPEC.model, params={"maxBins": 8}))
    with pytest.raises(ValueError, match="categories"):
        fit_folds(rows, folds, spec)


@pytest.mark.parametrize("strategy", ["median", "mean", "zero"])
def test_fill_values(spark, strategy):
    data = [(k % 4 if k % 5 else None, float(k % 17) if k % 3 else None) for k in range(200)]
    df = spark.createDataFrame(data, "first_train_fold int, x double")
    got = fit_imputer_folds(df, ["x", "not_there"], 4, strategy)
    want = [fit_imputer(df.filter(F.col("first_train_fold") <= k), ["x"], strategy) for k in range(4)]
    assert [g["x"] for g in got] == pytest.approx([w["x"] for w in want])
