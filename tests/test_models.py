import math
from dataclasses import replace

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallycast.config import CvSpec, EncoderSpec, FeatureSpec, ModelSpec, PanelSpec, PipelineSpec
from tallycast.functions.scalars import log_target
from tallycast.operators import metrics
from tallycast.operators.numeric import ids_to_categories
from tallycast.operators.models import (
    patience,
    Ensemble,
    FeatureLayout,
    TreeModel,
    best_round,
    fit_trees,
    make_estimator,
    tree_params,
    weighted_average,
)
from tallycast.operators.panel import forward_label
from tallycast.operators.temporal import temporal_features
from tallycast.plans.prepare import build_panel, stateless_features
from tallycast.plans.score import score, score_ensemble, score_to_file
from tallycast.plans.train import cross_validate, fit_forecaster, train
from tallycast.session import materialise
from tallycast.sources.artifacts import load_ensemble, load_forecaster, save_ensemble, save_forecaster
from tallycast.sources.readers import read_optional, read_panel
from tallycast.sources.writers import write_importance, write_out_of_fold

SPEC = PipelineSpec(
    panel=PanelSpec(
        customer_col="o_custkey",
        date_col="period",
        high_cardinality_cols=("c_mktsegment", "c_desc"),
        skewed_cols=("transaction_amount", "c_acctbal"),
        numeric_id_cols=("c_nationkey",),
    ),
    encoders=EncoderSpec(tfidf_terms=5),
    cv=CvSpec(n_splits=2),
    model=ModelSpec(kind="gbt", rounds=3, params={"maxDepth": 3, "seed": 1}, patience=2),
)


def test_rmsle_clips_predictions(spark):
    df = spark.createDataFrame([(0.0, -5.0), (3.0, 3.0)], "y double, p double")
    assert df.agg(metrics.rmsle("y", "p")).first()[0] == 0.0


def test_summary_scores_covered_rows_only(spark):
    rows = [(0, 0.0, math.e - 1), (0, 0.0, 0.0), (1, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "fold int, y double, p double")
    got = metrics.cv_summary(df, "y", "p", labelled=6).first()
    a = math.sqrt(0.5)
    assert got["overall_rmsle"] == pytest.approx(math.sqrt(1 / 3))
    assert (got["mean_rmsle"], got["std_rmsle"]) == pytest.approx((a / 2, a / 2))
    assert (got["folds"], got["n"], got["coverage"]) == (2, 3, 0.5)


def test_row_count_guard(spark):
    df = spark.range(5)
    assert metrics.check_row_count(df, df) == 5
    with pytest.raises(ValueError, match="expected 5 output rows, got 3"):
        metrics.check_row_count(df, df.filter("id < 3"))
    with pytest.raises(ValueError, match="expected 3584"):
        metrics.check_row_count(df, df, expected=3584)


def test_parameters_and_kinds():
    with pytest.warns(UserWarning, match="num_leaves"):
        params = tree_params(ModelSpec(kind="lightgbm"))
    assert params["maxIter"] == 2000 and params["stepSize"] == 0.05 and params["minInstancesPerNode"] == 20
    with pytest.warns(UserWarning):
        assert tree_params(ModelSpec(kind="catboost", rounds=100))["maxIter"] == 100
    assert tree_params(ModelSpec(kind="gbt", params={"learning_rate": 0.3}))["stepSize"] == 0.3
    with pytest.raises(ValueError, match="unknown model"):
        tree_params(ModelSpec(kind="linear"))


def test_estimators(spark):
    assert make_estimator(ModelSpec(kind="random_forest", rounds=7), "y").getNumTrees() == 7
    assert make_estimator(ModelSpec(kind="gbt", weight_col="w"), "y").getWeightCol() == "w"


def test_best_round_with_patience():
    assert best_round([5, 4, 3, 3.5, 2.9], patience=2) == 5
    assert best_round([5, 4, 4.5, 4.6, 1.0], patience=2) == 2
    assert best_round([1.0], patience=1) == 1


def test_weighted_average(spark):
    df = spark.createDataFrame([(1.0, 3.0)], "a double, b double")
    assert df.select(weighted_average(["a", "b"], [3, 1])).first()[0] == 1.5
    assert df.select(weighted_average(["a", "b"])).first()[0] == 2.0
    with pytest.raises(ValueError, match="weights"):
        weighted_average(["a", "b"], [1])
    with pytest.raises(ValueError, match="at least one"):
        weighted_average([])


def vectors(spark, n=400):
    rows = [(float(i % 20), float(i % 7), Vectors.dense(float(i % 20), float(i % 7))) for i in range(n)]
    return spark.createDataFrame(rows, ["a", "b", "features"]).withColumn(
        "y", F.col("a") * 2 + F.col("b")
    )


def test_early_stopping_refit_and_importance(spark):
    df = vectors(spark)
    spec = ModelSpec(kind="gbt", rounds=8, params={"maxDepth": 3, "stepSize": 1.0}, patience=1)
    shuffled = df.withColumn("y", -F.col("y"))
    model = fit_trees(df, "y", spec, ["a", "b"], validation=shuffled)
    assert model.rounds == best_round(model.errors, 1) < 8
    assert model.model.getNumTrees == model.rounds
    assert [r["feature"] for r in model.top_features(spark, 1).collect()] == ["a"]


def test_ensemble_of_models(spark):
    df = vectors(spark)
    models = [
        fit_trees(df, "y", ModelSpec(kind=k, rounds=3, params={"maxDepth": 2, "seed": 1}), ["a", "b"])
        for k in ("gbt", "random_forest")
    ]
    one, two = (m.predict(df).orderBy("a", "b").first()["prediction"] for m in models)
    both = Ensemble(models, [1, 3]).predict(df).orderBy("a", "b").first()["prediction"]
    assert both == pytest.approx(one / 4 + two * 3 / 4)
    with pytest.raises(ValueError, match="not been fitted"):
        TreeModel(None, []).predict(df)


def test_layout_fills_nulls_and_indexes(spark):
    df = spark.createDataFrame(
        [(None, None, "u"), (2.0, -1.0, "v")], "v_lag_1m double, trend_3m double, kind string"
    )
    layout = FeatureLayout(("v_lag_1m", "trend_3m"), nominal=("kind",))
    assert layout.names == ["v_lag_1m", "trend_3m", "trend_3m_is_null", "kind"]
    assembler = layout.fit_assembler(df)
    rows = [list(r["features"].toArray()) for r in layout.assemble(df, assembler, []).collect()]
    assert rows[0][:3] == [-1.0, 0.0, 1.0] and rows[1][:3] == [2.0, -1.0, 0.0]
    with pytest.raises(ValueError, match="categories"):
        layout.fit_assembler(df, max_bins=2)


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    panel = build_panel(
        spark.read.parquet(f"{sf_dir}/orders.parquet"), SPEC,
        source_customer="o_custkey", source_date="o_orderdate", amount="o_totalprice",
    )
    who = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_acctbal", "c_mktsegment",
        F.concat_ws(" ", F.lit("shop"), "c_mktsegment").alias("c_desc"),
    )
    return materialise(panel.join(who, "o_custkey", "left"))


@pytest.fixture(scope="module")
def trained(rows):
    return train(rows, SPEC)


def test_cross_validation_covers_each_row_once(trained):
    _, cv = trained
    got = cv.summary.first()
    assert got["folds"] == 2 and 0 < got["coverage"] < 1
    assert cv.predictions.count() == got["n"]
    assert cv.predictions.groupBy("o_custkey", "period").count().filter("count > 1").count() == 0


def test_model_beats_the_mean(spark):
    """Customers with levels of their own, and one busy season."""
    value = F.pmod(F.col("id"), F.lit(5)) * 3 + F.when(F.month("period") == 12, 6).otherwise(0)
    panel = (
        spark.range(40)
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(35))))
        .select(
            F.col("id").alias("o_custkey"),
            F.add_months(F.lit("2019-01-01").cast("date"), F.col("k")).alias("period"),
            "id",
        )
        .withColumn("txn_count", value.cast("bigint"))
        .drop("id")
    )
    spec = replace(
        SPEC,
        panel=PanelSpec("o_custkey", "period", high_cardinality_cols=(), skewed_cols=(), numeric_id_cols=()),
        model=replace(SPEC.model, rounds=3),
    )
    rows = materialise(forward_label(panel, "o_custkey"))
    cv = cross_validate(materialise(stateless_features(rows, spec)), spec)
    label = "next_3m_txn_count"
    mean = rows.agg(F.avg(log_target(label))).first()[0]
    naive = cv.predictions.withColumn("p", F.expm1(F.lit(mean))).agg(metrics.rmsle(label, "p")).first()[0]
    assert cv.summary.first()["overall_rmsle"] < naive / 2


def test_nominal_columns_are_split_by_set(spark, rows):
    spec = replace(
        SPEC,
        panel=replace(SPEC.panel, high_cardinality_cols=(), numeric_id_cols=()),
        model=ModelSpec(kind="gbt", rounds=1, params={"maxDepth": 2, "maxBins": 8}, nominal_cols=("c_mktsegment",)),
    )
    level = F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), 9).otherwise(1)
    forecaster = fit_forecaster(
        stateless_features(rows.withColumn("next_3m_txn_count", level.cast("bigint")), spec), spec
    )
    assert forecaster.preprocessing.layout.nominal == ("c_mktsegment",)
    assert forecaster.model.importance(spark).first()["feature"] == "c_mktsegment"
    assert " in {" in forecaster.model.model.toDebugString
    assert score(rows, forecaster).count() == rows.count()


def newest(rows):
    w = Window.partitionBy("o_custkey").orderBy("period")
    return rows.withColumn("_next", F.lead("period").over(w)).filter("_next is null").drop("_next")


def test_label_is_no_feature(trained):
    forecaster, _ = trained
    names = forecaster.preprocessing.layout.names
    assert not any("next_3m" in n or n in ("o_custkey", "period", "_label") for n in names)
    assert "c_desc_tfidf_shop" in names or any(n.startswith("c_desc_tfidf") for n in names)
    assert len(names) == forecaster.model.model.numFeatures


def test_scoring_sees_history(spark, trained, rows):
    forecaster, _ = trained
    wanted = newest(rows).drop("next_3m_txn_count")
    with_history = score(wanted, forecaster, rows.join(wanted, ["o_custkey", "period"], "left_anti"))
    direct = score(rows, forecaster).join(wanted.select("o_custkey", "period"), ["o_custkey", "period"])
    assert with_history.count() == wanted.count()
    a = {r[0]: r[2] for r in with_history.collect()}
    b = {r["o_custkey"]: r["next_3m_txn_count"] for r in direct.collect()}
    assert a == pytest.approx(b) and min(a.values()) >= 0


def test_save_load_score(spark, trained, rows, tmp_path):
    forecaster, cv = trained
    save_forecaster(forecaster, str(tmp_path / "model"), spark)
    loaded = load_forecaster(str(tmp_path / "model"), spark)
    assert loaded.spec == forecaster.spec
    before = {(r[0], r[1]): r[2] for r in score(rows, forecaster).collect()}
    after = {(r[0], r[1]): r[2] for r in score(rows, loaded).collect()}
    assert after == before

    n = score_to_file(newest(rows), loaded, str(tmp_path / "scores"), rows.limit(0))
    back = spark.read.option("header", True).csv(str(tmp_path / "scores"))
    assert back.columns == ["o_custkey", "next_3m_txn_count"] and back.count() == n
    write_out_of_fold(cv.predictions, str(tmp_path / "oof"), ["o_custkey", "period"], "next_3m_txn_count", "parquet")
    assert spark.read.parquet(str(tmp_path / "oof")).columns == [
        "fold", "o_custkey", "period", "oof_prediction", "actual",
    ]
    write_importance(forecaster.model.importance(spark), str(tmp_path / "importance"))
    assert spark.read.option("header", True).csv(str(tmp_path / "importance")).columns == ["feature", "importance"]


def test_plain_cross_validation(rows):
    spec = replace(SPEC, cv=replace(SPEC.cv, n_splits=1, min_train=70), model=replace(SPEC.model, rounds=2))
    cv = cross_validate(materialise(stateless_features(rows, spec)), spec, early_stopping=False)
    assert cv.rounds == 2 and cv.models[0].errors == []


def test_csv_source(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text(
        "branch_code,UniqueID,transaction_date,txn_count,income,extra\n"
        "101.0,c1,2021-01-01,3,NaN,x\n,c2,2021-02-01,,12.5,y\n"
    )
    df = read_panel(spark, str(path))
    types = dict(df.dtypes)
    assert types["branch_code"] == "decimal(38,6)" and types["transaction_date"] == "date" and types["extra"] == "string"
    rows = df.orderBy("UniqueID").collect()
    assert rows[0]["income"] is None and rows[1]["branch_code"] is None and rows[1]["income"] == 12.5
    assert dict(read_panel(spark, str(path), infer=True).dtypes)["income"] == "double"
    assert read_optional(spark, str(tmp_path / "nothing.csv")) is None
    assert read_optional(spark, str(path)).count() == 2
    labels = ids_to_categories(df, ["branch_code"]).orderBy("UniqueID").collect()
    assert [r["branch_code"] for r in labels] == ["id_101", "id_nan"]


def test_csv_files_with_other_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("UniqueID,income,transaction_amount\nc1,1.0,2.0\n")
    (tmp_path / "b.csv").write_text("UniqueID,transaction_amount,income\nc2,3.0,4.0\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_panel(spark, str(tmp_path)).collect()


def test_patience_comes_from_the_parameters():
    assert patience(ModelSpec(kind="lightgbm")) == 100
    assert patience(ModelSpec(kind="lightgbm", params={"early_stopping_rounds": 7})) == 7
    assert patience(ModelSpec(kind="lightgbm", patience=3)) == 3
    assert patience(ModelSpec(kind="gbt")) > 10**6


def test_gap_must_cover_the_horizon():
    with pytest.raises(ValueError, match="horizon"):
        replace(SPEC, panel=replace(SPEC.panel, label_horizon=SPEC.cv.gap + 1))


def test_history_that_holds_the_rows_changes_nothing(spark, trained, rows):
    forecaster, _ = trained
    wanted = newest(rows).drop("next_3m_txn_count")
    apart = score(wanted, forecaster, rows.join(wanted, ["o_custkey", "period"], "left_anti"))
    overlapping = score(wanted, forecaster, rows)
    assert {tuple(r) for r in overlapping.collect()} == {tuple(r) for r in apart.collect()}


def test_a_lost_row_is_noticed(spark, trained, rows, tmp_path, monkeypatch):
    from tallycast.plans import score as module

    forecaster, _ = trained
    whole = module.score
    monkeypatch.setattr(module, "score", lambda *a: whole(*a).withColumn("_n", F.row_number().over(Window.orderBy("o_custkey"))).filter("_n > 1").drop("_n"))
    with pytest.raises(ValueError, match="output rows"):
        score_to_file(newest(rows), forecaster, str(tmp_path / "scores"), rows.limit(0))


def test_ensemble_of_fold_forecasters(spark, trained, rows, tmp_path):
    _, cv = trained
    some = cv.forecasters[:2]
    save_ensemble(some, str(tmp_path / "ensemble"), spark, [3.0, 1.0])
    loaded, weights = load_ensemble(str(tmp_path / "ensemble"), spark)
    wanted = newest(rows)
    got = {r[0]: r[2] for r in score_ensemble(wanted, loaded, weights, rows).collect()}
    parts = [{r[0]: r[2] for r in score(wanted, f, rows).collect()} for f in some]
    assert got == pytest.approx({k: (3 * parts[0][k] + parts[1][k]) / 4 for k in parts[0]})


def test_training_rows_are_not_kept(spark, rows, monkeypatch):
    """The fit on binned rows makes each vector once: a copy of all of them in the executors is of no use."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    def kept(*_):
        raise AssertionError("the assembled rows were persisted")

    monkeypatch.setattr(Classic, "persist", kept)
    spec = replace(SPEC, model=ModelSpec(kind="gbt", rounds=1, params={"maxDepth": 1}))
    features = stateless_features(rows, spec)
    assert fit_forecaster(features, spec).model.rounds == 1
    assert cross_validate(features, spec).predictions.count()


def test_history_is_cut_to_what_features_reach(spark):
    """Old rows, and those that a wanted row replaces, go before the windows; the features stay."""
    spec = FeatureSpec()
    days = spark.range(40).select(F.lit(1).alias("who"), F.expr("add_months(date'2020-01-01', int(id))").alias("period"), F.col("id").alias("n"))
    copies = days.withColumn("wanted", F.lit(False)).unionByName(days.filter("n = 39").withColumn("wanted", F.lit(True)))
    lost = copies.unionByName(copies.filter("n = 39 and not wanted").withColumn("who", F.lit(None).cast("int")))
    got = temporal_features(lost, "who", "period", "n", spec, wanted="wanted")
    assert sorted(r["n"] for r in got.filter("who = 1").select("n").collect()) == list(range(39 - spec.look_back, 40))
    want = temporal_features(days, "who", "period", "n", spec).filter("n = 39")
    assert got.filter("wanted").drop("wanted").collect() == want.collect()
