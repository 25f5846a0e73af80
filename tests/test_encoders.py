import math

import pytest
from pyspark.ml.feature import StringIndexer, TargetEncoder
from pyspark.sql import functions as F

from plans import count, plan
from tallycast.config import CvSpec, EncoderSpec, PanelSpec
from tallycast.operators.encoders import fit_encoders, fit_panel_encoders, route_columns
from tallycast.operators.folds import fold_columns, rolling_folds
from tallycast.operators.lookup import lookup, within_budget
from tallycast.operators.target_encoding import (
    category_stats,
    encode_out_of_fold,
    fit_target_encoding,
)
from tallycast.session import materialise

ROWS = [("a", 1.0), ("a", 3.0), ("b", 10.0), (None, 2.0)]


def fixture(spark):
    return spark.createDataFrame(ROWS, "k string, y double")


def encodings(df, learned, **kwargs):
    return {r["k0"]: r["k_target_enc"] for r in learned.apply(df.withColumn("k0", F.col("k")), **kwargs).collect()}


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_smoothing(spark, broadcast_bytes):
    learned = fit_target_encoding(fixture(spark), ["k", "absent"], "y")
    assert learned.prior == 4.0 and learned.names == ["k_target_enc"]
    unseen = spark.createDataFrame([("a",), ("b",), (None,), ("z",)], "k string")
    got = encodings(unseen, learned, broadcast_bytes=broadcast_bytes)
    assert got == pytest.approx({"a": 8 / 3, "b": 7.0, None: 4.0, "z": 4.0})


def test_unknown_null_and_floor(spark):
    nan = fit_target_encoding(fixture(spark), ["k"], "y", EncoderSpec(handle_unknown="nan"))
    unseen = spark.createDataFrame([("a",), (None,), ("z",)], "k string")
    assert [v is None for v in encodings(unseen, nan).values()] == [False, True, True]
    floor = fit_target_encoding(fixture(spark), ["k"], "y", EncoderSpec(min_samples=2))
    assert encodings(fixture(spark), floor)["b"] == 4.0
    with pytest.raises(ValueError):
        fit_target_encoding(fixture(spark), ["k"], "y", EncoderSpec(handle_unknown="drop"))
    with pytest.raises(ValueError, match="missing"):
        fit_target_encoding(fixture(spark), ["k"], "label")


def test_category_without_labels_gets_the_prior(spark):
    df = spark.createDataFrame([("a", 2.0), ("c", None)], "k string, y double")
    learned = fit_target_encoding(df, ["k"], "y", EncoderSpec(smoothing=0.0))
    assert encodings(df, learned) == {"a": 2.0, "c": 2.0}


def test_noise_depends_on_the_key_only(spark):
    spec = EncoderSpec(noise=0.5)
    df = spark.createDataFrame([(f"k{i}", 4.0) for i in range(400)], "k string, y double")
    one = encodings(df.repartition(3), fit_target_encoding(df, ["k"], "y", spec))
    two = encodings(df.repartition(7), fit_target_encoding(df.repartition(5), ["k"], "y", spec))
    assert one == two
    draws = [(v - 4.0) / 2.0 for v in one.values()]
    mean = sum(draws) / len(draws)
    assert abs(mean) < 0.2 and 0.8 < math.sqrt(sum(d * d for d in draws) / len(draws)) < 1.2
    # A negative prior is no error.
    negative = df.withColumn("y", -F.col("y"))
    assert fit_target_encoding(negative, ["k"], "y", spec).table.count() == 400


def test_same_as_spark_ml(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    learned = fit_target_encoding(orders, ["o_orderpriority"], "o_totalprice", EncoderSpec(smoothing=3.0))
    got = {r["category"]: r["enc"] for r in learned.table.collect()}
    indexed = StringIndexer(inputCol="o_orderpriority", outputCol="i").fit(orders).transform(orders)
    ml = TargetEncoder(
        inputCol="i", outputCol="e", labelCol="o_totalprice", targetType="continuous", smoothing=3.0
    ).fit(indexed)
    want = {r[0]: r[1] for r in ml.transform(indexed).select("o_orderpriority", "e").distinct().collect()}
    assert got == pytest.approx(want)


def test_stats_take_one_shuffle(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    stats = category_stats(orders, ["o_orderpriority", "o_orderstatus", "o_custkey"], "o_totalprice")
    assert count(stats, "Exchange") == 1


def test_small_lookup_moves_no_fact(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    learned = fit_target_encoding(orders, ["o_orderpriority"], "o_totalprice")
    text = plan(learned.apply(orders))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_hot_keys_do_not_meet_in_the_shuffle(spark):
    """A third of the rows under one key, a third null, the rest rare."""
    keys = ["hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 1200}" for i in range(6000)]
    facts = spark.createDataFrame(list(enumerate(keys)), "i int, k string")
    table = materialise(
        facts.filter("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("i").alias("v"))
    )
    small = lookup(facts, table, ["k"], "n")
    split = lookup(facts, table, ["k"], "n", broadcast_bytes=0)
    assert split.orderBy("i").collect() == small.select(split.columns).orderBy("i").collect()
    assert split.count() == 6000


@pytest.mark.parametrize("kind", ["hot", "null", "unseen"])
def test_no_task_of_the_lookup_gets_a_hot_key(spark, kind):
    """60 % of the facts under one known, null or unknown key: the join's tasks stay even."""
    top = {"hot": "k0", "null": None, "unseen": "nowhere"}[kind]
    facts = spark.range(30000).select(
        "id", F.when(F.col("id") % 10 < 6, F.lit(top)).otherwise(F.concat(F.lit("k"), (F.col("id") % 9973).cast("string"))).alias("k")
    )
    table = materialise(spark.range(9973).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.col("id").alias("n"), F.col("id").alias("v")))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = lookup(facts, table, ["k"], "n", broadcast_bytes=0)
        assert "hashpartitioning(_key" in plan(out)
        per_task = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(per_task) == 30000 and max(per_task) < 2 * 30000 / 8


def test_broadcasts_keep_to_one_budget_together():
    assert within_budget({"a": 40, "b": 30, "c": 30}, 64) == {"b", "c"}
    assert within_budget({"a": 65}, 64) == set()


def dated(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select("o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice")


def out_of_fold(df, **kwargs):
    folds = rolling_folds(df, "o_orderdate", CvSpec())
    out = encode_out_of_fold(
        fold_columns(df, "o_orderdate", folds), ["o_orderpriority"], "o_totalprice", 5, **kwargs
    )
    rows = out.select("o_orderkey", "fold", "o_orderpriority_target_enc").collect()
    return {(r[1], r[0]): r[2] for r in rows}


def test_test_labels_do_not_reach_their_own_encoding(spark, sf_dir):
    df = dated(spark, sf_dir)
    fold = rolling_folds(df, "o_orderdate")[-1]
    changed = df.withColumn(
        "o_totalprice", F.when(fold.tests(F.col("o_orderdate")), F.lit(-1e9)).otherwise(F.col("o_totalprice"))
    )
    before, after = out_of_fold(df), out_of_fold(changed)
    same = {k for k in before if k[0] == fold.fold}
    assert same and {k: before[k] for k in same} == pytest.approx({k: after[k] for k in same})


def test_out_of_fold_by_shuffle_is_the_same(spark, sf_dir):
    df = dated(spark, sf_dir)
    assert out_of_fold(df) == pytest.approx(out_of_fold(df.repartition(5), broadcast_bytes=0))


def test_routing_and_methods(spark):
    assert route_columns(["transaction_DESC", "kind"]) == (["kind"], ["transaction_DESC"])
    df = spark.createDataFrame(
        [("w x", "u", 101, 1.0)] * 6, "transaction_description string, merchant_category string, branch_code long, next_3m_txn_count double"
    )
    learned = fit_panel_encoders(df, PanelSpec(), EncoderSpec(tfidf_max_df=1.0, tfidf_min_df=1))
    assert learned.target.names == ["merchant_category_target_enc", "branch_code_target_enc"]
    hashed = fit_encoders(df, [], ["transaction_description"], "next_3m_txn_count", EncoderSpec(text_method="hashing"))
    assert len(hashed.names) == 1000
    with pytest.raises(ValueError, match="text_method"):
        fit_encoders(df, [], [], "next_3m_txn_count", EncoderSpec(text_method="words"))
