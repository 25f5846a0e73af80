"""Save and load a forecaster: a model directory, Parquet tables and settings in a folder for each version."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession

from tallycast.config import CvSpec, EncoderSpec, FeatureSpec, ModelSpec, PanelSpec, PipelineSpec
from tallycast.operators.encoders import Encoders
from tallycast.operators.models import FeatureLayout, TreeModel
from tallycast.operators.numeric import imputer_table
from tallycast.operators.target_encoding import TargetEncoding
from tallycast.operators.text_encoding import HashEncoding, TfidfEncoding
from tallycast.plans.prepare import Preprocessing, tfidf_rows
from tallycast.plans.train import Forecaster
from tallycast.sources.versions import check_manifest, current_version, new_version, point_to, write_manifest

SPECS = {"panel": PanelSpec, "features": FeatureSpec, "encoders": EncoderSpec, "cv": CvSpec, "model": ModelSpec}


def _overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _tuples(value):
    """JSON lists back to the tuples of the settings."""
    return tuple(_tuples(v) for v in value) if isinstance(value, list) else value


def save_forecaster(forecaster: Forecaster, path: str, spark: SparkSession) -> None:
    """Write a new version beside the older ones; only when it is whole does ``path`` name it.

    A save that is cut short leaves the version before it in force. Old versions
    stay until they are removed.
    """
    version = new_version()
    folder = f"{path}/{version}"
    _write_parts(forecaster, folder, spark)
    write_manifest(spark, folder)
    point_to(spark, path, version)


def _write_parts(forecaster: Forecaster, path: str, spark: SparkSession) -> None:
    prep, model = forecaster.preprocessing, forecaster.model
    target = prep.encoders.target
    settings = {
        "spec": asdict(prep.spec),
        "layout": asdict(prep.layout),
        "names": model.names,
        "rounds": model.rounds,
        "kind": type(model.model).__name__,
        "text": [[t.column, isinstance(t, TfidfEncoding)] for t in prep.encoders.text],
        "target": target and {
            "columns": target.columns,
            "prior": target.prior,
            "rows": target.rows,
            "handle_unknown": target.handle_unknown,
        },
    }
    forecaster.assembler.write().overwrite().save(f"{path}/assembler")
    model.model.write().overwrite().save(f"{path}/model")
    _overwrite(imputer_table(spark, prep.fill), f"{path}/imputer")
    vocabulary = spark.createDataFrame(
        tfidf_rows(prep.encoders), "col string, term_index int, term string, idf double"
    )
    _overwrite(vocabulary, f"{path}/vocabulary")
    if target:
        _overwrite(target.table, f"{path}/target_encoding")
    _overwrite(spark.createDataFrame([(json.dumps(settings),)], "settings string"), f"{path}/settings")


def load_forecaster(path: str, spark: SparkSession) -> Forecaster:
    """The newest whole version; files that are not as they were written raise an error."""
    path = f"{path}/{current_version(spark, path)}"
    check_manifest(spark, path)
    settings = json.loads(spark.read.parquet(f"{path}/settings").first()[0])
    parts = {}
    for name, cls in SPECS.items():
        values = settings["spec"][name]
        parts[name] = cls(**{k: _tuples(v) for k, v in values.items()})
    spec = PipelineSpec(**parts)
    fill = {r["col"]: r["value"] for r in spark.read.parquet(f"{path}/imputer").collect()}

    terms: dict[str, list] = {}
    for r in spark.read.parquet(f"{path}/vocabulary").orderBy("col", "term_index").collect():
        terms.setdefault(r["col"], []).append(r)
    text = []
    for column, learned in settings["text"]:
        rows = terms.get(column, [])
        if learned:
            text.append(TfidfEncoding(column, [r["term"] for r in rows], [r["idf"] for r in rows], spec.encoders))
        else:
            text.append(HashEncoding(column, spec.encoders))
    target = None
    if settings["target"]:
        target = TargetEncoding(table=spark.read.parquet(f"{path}/target_encoding"), **settings["target"])

    layout = FeatureLayout(**{k: _tuples(v) for k, v in settings["layout"].items()})
    readers = {"GBTRegressionModel": GBTRegressionModel, "RandomForestRegressionModel": RandomForestRegressionModel}
    model = TreeModel(readers[settings["kind"]].load(f"{path}/model"), settings["names"], settings["rounds"])
    prep = Preprocessing(fill, Encoders(target, text), layout, spec)
    return Forecaster(prep, PipelineModel.load(f"{path}/assembler"), model)


def save_ensemble(forecasters: list[Forecaster], path: str, spark: SparkSession, weights: list[float] | None = None) -> None:
    """Each forecaster in a folder of its own, and the weights."""
    version = new_version()
    for i, forecaster in enumerate(forecasters):
        save_forecaster(forecaster, f"{path}/{version}/{i}", spark)
    settings = json.dumps({"models": len(forecasters), "weights": weights})
    _overwrite(spark.createDataFrame([(settings,)], "settings string"), f"{path}/{version}/ensemble")
    point_to(spark, path, version)


def load_ensemble(path: str, spark: SparkSession) -> tuple[list[Forecaster], list[float] | None]:
    path = f"{path}/{current_version(spark, path)}"
    settings = json.loads(spark.read.parquet(f"{path}/ensemble").first()[0])
    return [load_forecaster(f"{path}/{i}", spark) for i in range(settings["models"])], settings["weights"]
