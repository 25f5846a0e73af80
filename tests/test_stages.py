import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tallycast.operators.numeric import fit_imputer, skew_transform
from tallycast.operators.temporal import temporal_features
from tallycast.stages import (
    IdCategories,
    SkewTransform,
    SkewTransformModel,
    TargetEncode,
    TemporalFeatures,
    TextEncode,
    TextEncodeModel,
)


@pytest.fixture(scope="module")
def customers(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/customer.parquet")


def test_pipeline_of_all_column_stages(spark, customers):
    df = customers.withColumn("note", F.concat_ws(" ", "c_mktsegment", F.lit("client")))
    pipeline = Pipeline(
        stages=[
            IdCategories(inputCols=["c_nationkey"]),
            SkewTransform(inputCols=["c_acctbal"], strategy="mean"),
            TargetEncode(inputCols=["c_nationkey", "c_mktsegment"], labelCol="c_acctbal"),
            TextEncode(inputCol="note", maxFeatures=3),
        ]
    )
    out = pipeline.fit(df).transform(df)
    assert {"c_acctbal_log", "c_nationkey_target_enc", "c_mktsegment_target_enc", "note_tfidf"} <= set(out.columns)
    assert "c_nationkey" not in out.columns and out.count() == df.count()
    hashed = TextEncode(inputCol="note", method="hashing", hashBuckets=16).fit(df).transform(df)
    assert hashed.first()["note_hash"].size == 16
    with pytest.raises(ValueError):
        TextEncode(inputCol="note", method="words").fit(df)


def test_skew_model_can_be_saved(spark, customers, tmp_path):
    model = SkewTransform(inputCols=["c_acctbal"]).fit(customers)
    model.write().overwrite().save(str(tmp_path / "skew"))
    loaded = SkewTransformModel.load(str(tmp_path / "skew"))
    want = skew_transform(customers, ["c_acctbal"], fit_imputer(customers, ["c_acctbal"]))
    assert loaded.transform(customers).orderBy("c_custkey").collect() == want.orderBy("c_custkey").collect()


def test_learned_stages_can_be_saved(spark, customers, tmp_path):
    df = customers.withColumn("note", F.concat_ws(" ", "c_mktsegment", F.lit("big client")))
    pipeline = Pipeline(
        stages=[
            TargetEncode(inputCols=["c_mktsegment"], labelCol="c_acctbal", smoothing=2.0),
            TextEncode(inputCol="note", maxFeatures=4, ngrams=[1, 1], minDF=0.01, maxDF=1000.0, stopWords=["big"]),
        ]
    )
    pipeline.write().overwrite().save(str(tmp_path / "pipeline"))
    model = Pipeline.load(str(tmp_path / "pipeline")).fit(df)
    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    assert loaded.transform(df).orderBy("c_custkey").collect() == model.transform(df).orderBy("c_custkey").collect()
    assert "big" not in loaded.stages[1].encoding.terms and "client" in loaded.stages[1].encoding.terms
    hashed = TextEncode(inputCol="note", method="hashing", hashBuckets=8).fit(df)
    hashed.write().overwrite().save(str(tmp_path / "hash"))
    back = TextEncodeModel.load(str(tmp_path / "hash")).transform(df)
    assert back.orderBy("c_custkey").collect() == hashed.transform(df).orderBy("c_custkey").collect()


def test_temporal_stage_is_the_operator(spark, sf_dir, tmp_path):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").dropDuplicates(["o_custkey", "o_orderdate"])
    stage = TemporalFeatures(customerCol="o_custkey", dateCol="o_orderdate", valueCol="o_totalprice")
    stage.write().overwrite().save(str(tmp_path / "stage"))
    got = TemporalFeatures.load(str(tmp_path / "stage")).transform(orders)
    want = temporal_features(orders, "o_custkey", "o_orderdate", "o_totalprice")
    assert got.columns == want.columns
    keys = ["o_custkey", "o_orderdate"]
    assert got.orderBy(keys).collect() == want.orderBy(keys).collect()
