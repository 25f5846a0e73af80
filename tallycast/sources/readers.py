"""Panel sources: CSV with a header, or Parquet."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycast.config import PanelSpec
from tallycast.operators.guards import normalise_nan
from tallycast.session import scratch_path


def panel_types(spec: PanelSpec = PanelSpec()) -> dict[str, T.DataType]:
    """Known column types of the input files."""
    return {
        spec.customer_col: T.StringType(),
        spec.date_col: T.DateType(),
        spec.value_col: T.LongType(),
        spec.label_col: T.LongType(),
        **{c: T.StringType() for c in spec.high_cardinality_cols},
        **{c: T.DoubleType() for c in spec.skewed_cols},
        # A whole number written as 101.0 is an ID as well.
        **{c: T.DecimalType(38, 6) for c in spec.numeric_id_cols},
    }


def read_panel(
    spark: SparkSession,
    path: str,
    spec: PanelSpec = PanelSpec(),
    *,
    fmt: str = "csv",
    types: dict[str, T.DataType] | None = None,
    infer: bool = False,
) -> DataFrame:
    """Read a panel; NaN becomes null.

    CSV columns get the types of ``panel_types`` (and ``types``); the header
    decides which columns exist and the others are read as strings. Files whose
    header differs from the first one's fail. ``infer`` lets Spark find all
    types, at the price of one more pass over the files.
    """
    if fmt != "csv":
        return normalise_nan(spark.read.format(fmt).load(path))
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if infer:
        return normalise_nan(reader.option("inferSchema", True).csv(path))
    known = {**panel_types(spec), **(types or {})}
    header = reader.csv(path).columns
    schema = T.StructType([T.StructField(c, known.get(c, T.StringType())) for c in header])
    return normalise_nan(reader.schema(schema).option("mode", "FAILFAST").csv(path))


def read_optional(spark: SparkSession, path: str, *args, **kwargs) -> DataFrame | None:
    """As ``read_panel``, but None when the path does not exist."""
    try:
        return read_panel(spark, path, *args, **kwargs)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            return None
        raise


# Patterns a date may be written in; the first that fits counts.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss")
LINE, REASON = "_line", "_reason"
REASONS = ("malformed", "bad date", "missing key")


@dataclass
class CheckedPanel:
    """Rows that can be used, rows that cannot (``_line``, ``_reason``), and how many there are of each kind."""

    good: DataFrame
    bad: DataFrame
    counts: dict[str, int]


def lenient_date(text: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """The date in any of the formats, else null; blanks around it do not matter."""
    return F.coalesce(*[F.try_to_timestamp(F.trim(text), F.lit(f)) for f in formats]).cast("date")


def read_panel_checked(
    spark: SparkSession,
    path: str,
    spec: PanelSpec = PanelSpec(),
    *,
    types: dict[str, T.DataType] | None = None,
    date_formats: tuple[str, ...] = DATE_FORMATS,
) -> CheckedPanel:
    """As ``read_panel`` of CSV files, but rows that cannot be read are set aside instead of ending the job.

    Set aside are rows with too few or too many fields or a field that is not of
    its type (``malformed``), a date in none of the formats (``bad date``), and
    no customer or no date at all (``missing key``); the first reason counts. The
    files are read once: good and bad rows are written to the shared folder,
    apart, and counted on the way. Headers that differ still fail.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    header = reader.csv(path).columns
    known = {**panel_types(spec), **(types or {})}
    dates = [c for c in header if isinstance(known.get(c), T.DateType)]
    fields = [T.StructField(c, T.StringType() if c in dates else known.get(c, T.StringType())) for c in header]
    schema = T.StructType([*fields, T.StructField(LINE, T.StringType())])
    raw = reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE).csv(path)
    parsed = {c: lenient_date(F.col(f"`{c}`"), date_formats) for c in dates}
    unreadable = F.lit(False)
    for c in dates:
        unreadable = unreadable | ((F.trim(f"`{c}`") != "") & parsed[c].isNull())
    keys = [c for c in (spec.customer_col, spec.date_col) if c in header]
    missing = F.lit(False)
    for c in keys:
        missing = missing | (F.trim(F.col(f"`{c}`").cast("string")) == "") | F.col(f"`{c}`").isNull()
    reason = F.when(F.col(LINE).isNotNull(), REASONS[0]).when(F.coalesce(unreadable, F.lit(False)), REASONS[1]).when(missing, REASONS[2])
    line = F.coalesce(LINE, F.to_csv(F.struct(*[F.col(f"`{c}`") for c in header])))
    marked = raw.withColumn(REASON, F.coalesce(reason, F.lit(""))).withColumn(LINE, F.when(F.col(REASON) != "", line))
    marked = normalise_nan(marked.withColumns(parsed))
    seen = Observation()
    counted = [F.count(F.when(F.col(REASON) == r, 1)).alias(r or "good") for r in ("", *REASONS)]
    folder = scratch_path(spark, "checked")
    marked.observe(seen, *counted).write.partitionBy(REASON).parquet(folder)
    stored = T.StructType([f for f in marked.schema.fields if f.name != REASON] + [T.StructField(REASON, T.StringType())])
    back = spark.read.schema(stored).parquet(folder)
    # An empty partition value is written as null.
    good = back.filter(F.col(REASON).isNull()).drop(LINE, REASON)
    return CheckedPanel(good, back.filter(F.col(REASON).isNotNull()).select(LINE, REASON), dict(seen.get))
