"""Versions that appear whole, counts taken while writing, bad rows set aside, and validation stages."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallycast.config import CvSpec, ModelSpec, PanelSpec, PipelineSpec
from tallycast.operators.panel import forward_label
from tallycast.plans.prepare import stateless_features
from tallycast.plans import score as scoring
from tallycast.plans.score import score, score_to_file
from tallycast.plans.train import cross_validate, fit_forecaster, labelled
from tallycast.session import materialise
from tallycast.sources import artifacts, versions
from tallycast.sources.readers import read_panel_checked
from tallycast.stages import RmsleEvaluator, RollingOriginFolds, RollingOriginValidator

SPEC = PipelineSpec(
    panel=PanelSpec("cust", "period", high_cardinality_cols=(), skewed_cols=(), numeric_id_cols=()),
    cv=CvSpec(n_splits=2), model=ModelSpec(kind="gbt", rounds=3, params={"maxDepth": 3, "seed": 1}),
)


@pytest.fixture(scope="module")
def rows(spark):
    month = F.add_months(F.lit("2020-01-01").cast("date"), F.col("k"))
    panel = spark.range(30).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(23))))
    panel = panel.select(F.concat(F.lit("c"), "id").alias("cust"), month.alias("period"), F.abs(F.xxhash64("id", "k") % 9).alias("txn_count"))
    return materialise(forward_label(panel, "cust", "period"))


@pytest.fixture(scope="module")
def forecaster(rows):
    return fit_forecaster(stateless_features(rows, SPEC), SPEC)


def values(df):
    return sorted(map(tuple, df.collect()))


def test_a_save_that_is_cut_short_changes_nothing(spark, rows, forecaster, tmp_path, monkeypatch):
    path = str(tmp_path / "model")
    with pytest.raises(FileNotFoundError):
        artifacts.load_forecaster(path, spark)
    artifacts.save_forecaster(forecaster, path, spark)
    want = values(score(rows, artifacts.load_forecaster(path, spark)))
    other = fit_forecaster(stateless_features(rows.withColumn("next_3m_txn_count", F.lit(50).cast("bigint")), SPEC), SPEC)
    for broken in ("imputer_table", "write_manifest", "point_to"):
        with monkeypatch.context() as patch:
            patch.setattr(artifacts, broken, lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
            with pytest.raises(KeyboardInterrupt):
                artifacts.save_forecaster(other, path, spark)
        assert values(score(rows, artifacts.load_forecaster(path, spark))) == want
    artifacts.save_forecaster(other, path, spark)
    assert values(score(rows, artifacts.load_forecaster(path, spark))) != want


def test_a_changed_file_is_noticed(spark, forecaster, tmp_path):
    path = tmp_path / "model"
    artifacts.save_forecaster(forecaster, str(path), spark)
    folder = path / versions.current_version(spark, str(path))
    (damaged,) = (folder / "imputer").glob("*.parquet") if len(list((folder / "imputer").glob("*.parquet"))) == 1 else [next((folder / "settings").glob("*.parquet"))]
    damaged.with_name(f".{damaged.name}.crc").unlink(missing_ok=True)
    damaged.write_bytes(damaged.read_bytes()[:-1] + b"?")
    with pytest.raises(ValueError, match="not as it was written"):
        artifacts.load_forecaster(str(path), spark)


@pytest.mark.parametrize("with_history", [False, True])
def test_the_input_is_read_once(spark, rows, forecaster, tmp_path, with_history):
    newest = F.col("period") == rows.agg(F.max("period")).first()[0]
    new, old = rows.filter(newest).collect(), rows.filter(~newest)
    read = spark.sparkContext.accumulator(0)

    def counted(row):
        read.add(1)
        return row

    frame = spark.createDataFrame(spark.sparkContext.parallelize(new, 3).map(counted), rows.schema)
    n = score_to_file(frame, forecaster, str(tmp_path / "scores"), old if with_history else None)
    assert n == len(new) == spark.read.option("header", True).csv(str(tmp_path / "scores")).count()
    assert read.value == len(new) * (2 if with_history else 1)  # with a history the keys are read as well
    with pytest.raises(ValueError, match="expected 7"):
        score_to_file(frame, forecaster, str(tmp_path / "scores"), expected=7)


def test_history_of_other_customers_is_not_shuffled(spark, rows, forecaster, tmp_path, monkeypatch):
    newest = F.col("period") == rows.agg(F.max("period")).first()[0]
    new, old = rows.filter(newest).filter("cust in ('c3', 'c4')"), rows.filter(~newest)
    without = old.limit(1).withColumn("cust", F.lit(None).cast("string"))
    asked = scoring.history_of(new, old.unionByName(without), "cust")
    assert {r[0] for r in asked.select("cust").distinct().collect()} == {"c3", "c4"}
    want = values(score(new, forecaster, old))
    for most in (2, 1):
        monkeypatch.setattr(scoring, "FEW_CUSTOMERS", most)
        assert score_to_file(new, forecaster, str(tmp_path / f"{most}"), old) == 2
        got = spark.read.option("header", True).csv(str(tmp_path / f"{most}"))
        assert sorted(map(float, (r[1] for r in got.collect()))) == pytest.approx(sorted(w[2] for w in want))
    assert scoring.history_of(new, old, "cust") is old
    assert scoring.history_of(new.withColumn("cust", F.lit(3)), old, "cust") is old


def test_bad_rows_are_set_aside(spark, tmp_path):
    lines = ["UniqueID,transaction_date,txn_count,income,note", "c1,2021-01-01,3,1.5,x", "c2,2021/02/03,x,1,y", "c3,31.12.2021,1,2,z", "c4, 20210405 ,1,NaN,w"]
    lines += ["c5,2021-01-01,1", "c6,2021-01-01,1,2,a,b", ",2021-01-01,1,2,c", "c8,,1,2,d", "c9,2021-01-01 10:00:00,,,"]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    got = read_panel_checked(spark, str(tmp_path / "a.csv"))
    assert got.counts == {"good": 3, "malformed": 3, "bad date": 1, "missing key": 2}
    good = {r["UniqueID"]: r for r in got.good.collect()}
    assert {k: str(r["transaction_date"]) for k, r in good.items()} == {"c1": "2021-01-01", "c4": "2021-04-05", "c9": "2021-01-01"}
    assert good["c4"]["income"] is None and good["c9"]["txn_count"] is None and got.good.columns == lines[0].split(",")
    bad = {(r["_line"].split(",")[0], r["_reason"]) for r in got.bad.collect()}
    assert {b[0] for b in bad} >= {"c2", "c3", "c5", "c6", "c8"} and {b[1] for b in bad} == {"malformed", "bad date", "missing key"}
    assert "c6,2021-01-01,1,2,a,b" in {r["_line"] for r in got.bad.collect()}
    (tmp_path / "empty.csv").write_text(lines[0] + "\n")
    none = read_panel_checked(spark, str(tmp_path / "empty.csv"))
    assert none.good.count() == none.bad.count() == 0


def test_evaluator(spark, tmp_path):
    df = spark.createDataFrame([(0.0, -5.0), (3.0, 3.0), (1.0, 7.0)], "y double, p double")
    evaluator = RmsleEvaluator(labelCol="y", predictionCol="p")
    want = ((__import__("math").log(2) - __import__("math").log(8)) ** 2 / 3) ** 0.5
    assert evaluator.evaluate(df) == pytest.approx(want) and not evaluator.isLargerBetter()
    logs = df.select(F.log1p("y").alias("y"), F.log1p(F.greatest("p", F.lit(0.0))).alias("p"))
    on_log = RmsleEvaluator(labelCol="y", predictionCol="p", logScale=True)
    on_log.write().overwrite().save(str(tmp_path / "evaluator"))
    assert RmsleEvaluator.load(str(tmp_path / "evaluator")).evaluate(logs) == pytest.approx(want)


def test_validator_scores_as_cross_validate(spark, rows, tmp_path):
    features = materialise(stateless_features(rows, SPEC))
    cv = cross_validate(features, SPEC, early_stopping=False)
    layout = cv.forecasters[0].preprocessing.layout
    marked = RollingOriginFolds(dateCol="period", numFolds=2).transform(layout.fill(labelled(features, SPEC)))
    inputs = [*layout.numeric, *[f"{c}_is_null" for c in layout.signed]]
    booster = GBTRegressor(labelCol="_label", maxIter=3, maxDepth=3, seed=1, cacheNodeIds=True)
    pipeline = Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="features"), booster])
    grid = ParamGridBuilder().addGrid(booster.maxIter, [3]).build()
    evaluator = RmsleEvaluator(labelCol="_label", predictionCol="prediction", logScale=True)
    validator = RollingOriginValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=evaluator, numFolds=2, foldCol="test_fold")
    model = validator.fit(marked)
    want = {r["fold"]: r["rmsle"] for r in cv.scores.collect()}
    assert model.avgMetrics[0] == pytest.approx(sum(want.values()) / 2)
    model.write().overwrite().save(str(tmp_path / "cv"))
    back = type(model).load(str(tmp_path / "cv"))
    assert back.avgMetrics == model.avgMetrics
    keys = ["cust", "period"]
    assert back.transform(marked).orderBy(keys).select("prediction").collect() == model.transform(marked).orderBy(keys).select("prediction").collect()
