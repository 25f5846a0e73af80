"""The operators as ``pyspark.ml`` stages, for use in a ``Pipeline``."""

from __future__ import annotations

from dataclasses import asdict, replace

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasLabelCol, HasPredictionCol
from pyspark.ml.tuning import CrossValidator
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.config import CvSpec, EncoderSpec, FeatureSpec
from tallycast.functions.scalars import unlog_target
from tallycast.operators.folds import fold_columns, rolling_folds
from tallycast.operators.metrics import rmsle
from tallycast.operators.numeric import fit_imputer, ids_to_categories, skew_transform
from tallycast.operators.target_encoding import TargetEncoding, fit_target_encoding
from tallycast.operators.temporal import temporal_features
from tallycast.operators.text_encoding import HashEncoding, TfidfEncoding, fit_tfidf


def _param(name: str, doc: str, convert) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=convert)


class TemporalFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Calendar, lag, rolling, velocity and trend columns of a panel."""

    customerCol = _param("customerCol", "customer key", TypeConverters.toString)
    dateCol = _param("dateCol", "period of the row", TypeConverters.toString)
    valueCol = _param("valueCol", "observed value", TypeConverters.toString)
    shortLags = _param("shortLags", "row offsets", TypeConverters.toListInt)
    seasonalLags = _param("seasonalLags", "row offsets of a year or so", TypeConverters.toListInt)
    rollingWindows = _param("rollingWindows", "rows per window", TypeConverters.toListInt)
    rollingStats = _param("rollingStats", "mean, std, min, max", TypeConverters.toListString)
    velocity = _param("velocity", "pairs of (window, lag)", TypeConverters.toList)

    @keyword_only
    def __init__(
        self, *, customerCol=None, dateCol=None, valueCol=None, shortLags=None, seasonalLags=None,
        rollingWindows=None, rollingStats=None, velocity=None,
    ):
        super().__init__()
        spec = FeatureSpec()
        self._setDefault(
            customerCol="customer_id",
            dateCol="transaction_date",
            valueCol="txn_count",
            shortLags=list(spec.short_lags),
            seasonalLags=list(spec.seasonal_lags),
            rollingWindows=list(spec.rolling_windows),
            rollingStats=list(spec.rolling_stats),
            velocity=[list(v) for v in spec.velocity],
        )
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        spec = FeatureSpec(
            seasonal_lags=tuple(get("seasonalLags")),
            short_lags=tuple(get("shortLags")),
            rolling_windows=tuple(get("rollingWindows")),
            rolling_stats=tuple(get("rollingStats")),
            velocity=tuple(tuple(v) for v in get("velocity")),
        )
        return temporal_features(dataset, get("customerCol"), get("dateCol"), get("valueCol"), spec)


class IdCategories(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Numeric codes to category labels, in place."""

    prefix = _param("prefix", "put before the code", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, prefix=None):
        super().__init__()
        self._setDefault(inputCols=[], prefix="id_")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return ids_to_categories(dataset, self.getInputCols(), self.getOrDefault("prefix"))


class _SkewParams(HasInputCols):
    strategy = _param("strategy", "median, mean, or anything else for 0", TypeConverters.toString)
    logTransform = _param("logTransform", "add log and indicator columns", TypeConverters.toBoolean)


class SkewTransformModel(Model, _SkewParams, DefaultParamsReadable, DefaultParamsWritable):
    fillCols = _param("fillCols", "columns with a fill value", TypeConverters.toListString)
    fillValues = _param("fillValues", "their fill values", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fill = dict(zip(self.getOrDefault("fillCols"), self.getOrDefault("fillValues")))
        return skew_transform(dataset, self.getInputCols(), fill, self.getOrDefault("logTransform"))


class SkewTransform(Estimator, _SkewParams, DefaultParamsReadable, DefaultParamsWritable):
    """Impute, take logs and flag missing and zero values."""

    @keyword_only
    def __init__(self, *, inputCols=None, strategy=None, logTransform=None):
        super().__init__()
        self._setDefault(inputCols=[], strategy="median", logTransform=True)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> SkewTransformModel:
        fill = fit_imputer(dataset, self.getInputCols(), self.getOrDefault("strategy"))
        model = self._copyValues(SkewTransformModel())
        return model._set(fillCols=list(fill), fillValues=list(fill.values()))


class _StateWriter(MLWriter):
    """Metadata with the small part of a learned state, and its table if it has one."""

    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        state, table = self.instance._state()
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata={"state": state})
        if table is not None:
            table.write.parquet(f"{path}/table")


class _StateReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls._restored(metadata["state"], self.sparkSession, path)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class _SavedState(MLWritable, MLReadable):
    def write(self) -> MLWriter:
        return _StateWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StateReader(cls)


class TargetEncodeModel(Model, _SavedState):
    def __init__(self, encoding: TargetEncoding):
        super().__init__()
        self.encoding = encoding

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.encoding.apply(dataset)

    def _state(self):
        e = self.encoding
        small = {"columns": e.columns, "prior": e.prior, "rows": e.rows, "handle_unknown": e.handle_unknown}
        return small, e.table

    @classmethod
    def _restored(cls, state: dict, spark: SparkSession, path: str) -> TargetEncodeModel:
        return cls(TargetEncoding(table=spark.read.parquet(f"{path}/table"), **state))


class TargetEncode(Estimator, HasInputCols, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Smoothed target encoding; the input columns are replaced."""

    smoothing = _param("smoothing", "weight of the prior", TypeConverters.toFloat)
    minSamples = _param("minSamples", "rows below which the prior is used", TypeConverters.toInt)
    noise = _param("noise", "deviation in units of the prior", TypeConverters.toFloat)
    handleUnknown = _param("handleUnknown", "global_mean or nan", TypeConverters.toString)
    seed = _param("seed", "of the noise", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, inputCols=None, labelCol=None, smoothing=None, minSamples=None, noise=None,
        handleUnknown=None, seed=None,
    ):
        super().__init__()
        spec = EncoderSpec()
        self._setDefault(
            inputCols=[], smoothing=spec.smoothing, minSamples=0, noise=spec.noise,
            handleUnknown=spec.handle_unknown, seed=spec.seed,
        )
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TargetEncodeModel:
        get = self.getOrDefault
        spec = EncoderSpec(
            smoothing=get("smoothing"),
            min_samples=get("minSamples") or None,
            noise=get("noise"),
            handle_unknown=get("handleUnknown"),
            seed=get("seed"),
        )
        return TargetEncodeModel(fit_target_encoding(dataset, self.getInputCols(), self.getLabelCol(), spec))


class TextEncodeModel(Model, _SavedState):
    def __init__(self, encoding: TfidfEncoding | HashEncoding):
        super().__init__()
        self.encoding = encoding

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.encoding.apply(dataset)

    def _state(self):
        e = self.encoding
        learned = {"terms": e.terms, "idf": e.idf} if isinstance(e, TfidfEncoding) else None
        return {"column": e.column, "learned": learned, "spec": asdict(e.spec)}, None

    @classmethod
    def _restored(cls, state: dict, spark: SparkSession, path: str) -> TextEncodeModel:
        spec = EncoderSpec(**{k: tuple(v) if isinstance(v, list) else v for k, v in state["spec"].items()})
        if state["learned"] is None:
            return cls(HashEncoding(state["column"], spec))
        return cls(TfidfEncoding(state["column"], state["learned"]["terms"], state["learned"]["idf"], spec))


class TextEncode(Estimator, HasInputCol, DefaultParamsReadable, DefaultParamsWritable):
    """TF-IDF or hashed vector of a text column, which is replaced.

    Document bounds below 1 are shares of all documents, others are counts.
    Stop words default to the English list; an empty list keeps all words.
    """

    method = _param("method", "tfidf or hashing", TypeConverters.toString)
    maxFeatures = _param("maxFeatures", "vocabulary size", TypeConverters.toInt)
    hashBuckets = _param("hashBuckets", "width of the hashed vector", TypeConverters.toInt)
    ngrams = _param("ngrams", "shortest and longest n-gram", TypeConverters.toListInt)
    minDF = _param("minDF", "documents a term has to be in", TypeConverters.toFloat)
    maxDF = _param("maxDF", "documents a term may be in", TypeConverters.toFloat)
    stopWords = _param("stopWords", "words to leave out", TypeConverters.toListString)

    @keyword_only
    def __init__(
        self, *, inputCol=None, method=None, maxFeatures=None, hashBuckets=None, ngrams=None, minDF=None,
        maxDF=None, stopWords=None,
    ):
        super().__init__()
        spec = EncoderSpec()
        self._setDefault(
            method=spec.text_method, maxFeatures=spec.tfidf_terms, hashBuckets=spec.hash_buckets,
            ngrams=list(spec.tfidf_ngrams), minDF=float(spec.tfidf_min_df), maxDF=spec.tfidf_max_df,
        )
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TextEncodeModel:
        get = self.getOrDefault
        bounds = [get(b) if get(b) < 1 else int(get(b)) for b in ("minDF", "maxDF")]
        spec = replace(
            EncoderSpec(),
            tfidf_terms=get("maxFeatures"),
            hash_buckets=get("hashBuckets"),
            tfidf_ngrams=tuple(get("ngrams")),
            tfidf_min_df=bounds[0],
            tfidf_max_df=bounds[1],
            stop_words=tuple(get("stopWords")) if self.isDefined("stopWords") else None,
        )
        if get("method") == "tfidf":
            return TextEncodeModel(fit_tfidf(dataset, self.getInputCol(), spec))
        if get("method") == "hashing":
            return TextEncodeModel(HashEncoding(self.getInputCol(), spec))
        raise ValueError(f"method must be 'tfidf' or 'hashing', not {get('method')!r}")


class RmsleEvaluator(Evaluator, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Root mean squared difference of ``log1p`` values; predictions are clipped at zero."""

    logScale = _param("logScale", "label and prediction are log1p values already", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, labelCol="label", predictionCol="prediction", logScale=False):
        super().__init__()
        self._setDefault(logScale=False)
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset: DataFrame) -> float:
        label, prediction = self.getLabelCol(), self.getPredictionCol()
        on_log = self.getOrDefault("logScale")
        pairs = dataset.select(unlog_target(label, on_log).alias("_truth"), unlog_target(prediction, on_log).alias("_forecast"))
        return pairs.agg(rmsle("_truth", "_forecast")).first()[0]

    def isLargerBetter(self) -> bool:
        return False


class RollingOriginFolds(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Add ``first_train_fold`` and ``test_fold``: from which fold on a row trains, and which fold it tests."""

    dateCol = _param("dateCol", "period of the row", TypeConverters.toString)
    numFolds = _param("numFolds", "folds", TypeConverters.toInt)
    gap = _param("gap", "periods between training and testing", TypeConverters.toInt)
    minTrain = _param("minTrain", "periods before the first test", TypeConverters.toInt)
    grain = _param("grain", "length of a period", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, dateCol=None, numFolds=None, gap=None, minTrain=None, grain=None):
        super().__init__()
        cv = CvSpec()
        self._setDefault(dateCol="transaction_date", numFolds=cv.n_splits, gap=cv.gap, minTrain=cv.min_train, grain="month")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        cv = CvSpec(n_splits=get("numFolds"), gap=get("gap"), min_train=get("minTrain"))
        found = rolling_folds(dataset, get("dateCol"), cv, get("grain"))
        # Folds that the data leave out would be holes in the numbers.
        return fold_columns(dataset, get("dateCol"), [replace(f, fold=k) for k, f in enumerate(found)])


class RollingOriginValidator(CrossValidator):
    """A ``CrossValidator`` whose folds train on the past only.

    ``foldCol`` is the test fold of a row, as ``RollingOriginFolds`` adds it
    (null: the row tests nothing), and ``first_train_fold`` stands beside it.
    Parameter grids, parallel fits, saving and loading are Spark's own.
    """

    FIRST = "first_train_fold"

    def _kFold(self, dataset: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
        tests = self.getFoldCol() or "test_fold"
        folds = []
        for k in range(self.getNumFolds()):
            train, test = dataset.filter(F.col(self.FIRST) <= k), dataset.filter(F.col(tests) == k)
            if train.isEmpty() or test.isEmpty():
                raise ValueError(f"fold {k} has no rows to train on or to test")
            folds.append((train, test))
        return folds
