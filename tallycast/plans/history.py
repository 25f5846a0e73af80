"""The newest rows of every customer, kept for scoring.

Features of a new month look back at most ``look_back`` rows. A history is a
table with one row for each customer that holds just those, written in buckets
by customer. Scoring brings the new rows to the buckets: the history is read,
never shuffled, and never longer than customers times ``look_back``. When a
month is over its rows are merged in, bucket by bucket, into a new version.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.config import PipelineSpec
from tallycast.functions.scalars import calendar
from tallycast.operators.numeric import ids_to_categories
from tallycast.plans.prepare import stateless_features
from tallycast.plans.score import predicted
from tallycast.plans.train import Forecaster

RECENT = "_recent"


@dataclass(frozen=True)
class History:
    """A bucketed table (customer, recent rows) in the folder ``path``; ``table`` is its name in this session."""

    path: str
    table: str
    buckets: int
    keep: int

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)


def kept_rows(spec: PipelineSpec) -> int:
    """So many rows let the newest one be scored again."""
    return spec.features.look_back + 1


def _entries(spec: PipelineSpec) -> Column:
    p = spec.panel
    return F.struct(F.col(p.date_col).alias("date"), F.col(p.value_col).cast("double").alias("value"))


def _newest(entries: Column, keep: int) -> Column:
    """The last ``keep`` of an array of entries, oldest first; of two with one date the one given last."""
    ordered = F.array_sort(entries, lambda a, b: F.when(a["date"] < b["date"], -1).when(a["date"] > b["date"], 1).otherwise(0))
    size = F.size(ordered)
    return F.slice(ordered, F.greatest(size - keep + 1, F.lit(1)), F.greatest(F.least(size, F.lit(keep)), F.lit(1)))


def _recent(rows: DataFrame, spec: PipelineSpec) -> DataFrame:
    """Customers with their newest rows; a customer has one row a period, so a list is no longer than the calendar."""
    p = spec.panel
    known = rows.filter(F.col(p.customer_col).isNotNull() & F.col(p.date_col).isNotNull())
    listed = known.groupBy(p.customer_col).agg(F.collect_list(_entries(spec)).alias(RECENT))
    return listed.withColumn(RECENT, _newest(F.col(RECENT), kept_rows(spec)))


def _write(rows: DataFrame, path: str, spec: PipelineSpec, buckets: int) -> History:
    spark, customer = rows.sparkSession, spec.panel.customer_col
    name = f"history_{uuid.uuid4().hex}"
    rows.write.bucketBy(buckets, customer).sortBy(customer).option("path", path).format("parquet").saveAsTable(name)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    settings = json.dumps({"buckets": buckets, "keep": kept_rows(spec), "customer": customer, "columns": columns})
    spark.createDataFrame([(settings,)], "settings string").coalesce(1).write.parquet(f"{path}-settings")
    return History(path, name, buckets, kept_rows(spec))


def build_history(rows: DataFrame, spec: PipelineSpec, path: str, buckets: int = 200) -> History:
    """Write the history of a panel to a new folder. ``buckets`` should leave each bucket a task's worth of customers."""
    recent = _recent(rows.repartition(buckets, spec.panel.customer_col), spec)
    return _write(recent, path, spec, buckets)


def open_history(spark: SparkSession, path: str) -> History:
    """A history that an earlier session wrote."""
    settings = json.loads(spark.read.parquet(f"{path}-settings").first()[0])
    name = f"history_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({settings['columns']}) USING parquet CLUSTERED BY (`{settings['customer']}`) "
        f"SORTED BY (`{settings['customer']}`) INTO {settings['buckets']} BUCKETS LOCATION '{path}'"
    )
    return History(path, name, settings["buckets"], settings["keep"])


def merge_history(history: History, rows: DataFrame, spec: PipelineSpec, path: str) -> History:
    """A new version with ``rows`` merged in, in a folder of its own; a row with a known date replaces it.

    Old and new rows meet in the buckets: only the new rows are shuffled.
    """
    customer = spec.panel.customer_col
    old = history.read(rows.sparkSession).withColumnRenamed(RECENT, "_old")
    new = _recent(rows.repartition(history.buckets, customer), spec)
    dates = F.transform(RECENT, lambda e: e["date"])
    none = F.array().cast(old.schema["_old"].dataType)
    kept = F.filter(F.coalesce("_old", none), lambda e: ~F.coalesce(F.array_contains(dates, e["date"]), F.lit(False)))
    both = F.concat(kept, F.coalesce(RECENT, none))
    joined = old.hint("merge").join(new, customer, "full_outer")
    return _write(joined.select(customer, _newest(both, history.keep).alias(RECENT)), path, spec, history.buckets)


def features_with_history(rows: DataFrame, history: History, spec: PipelineSpec) -> DataFrame:
    """The stateless features of ``rows``, which look back into the history; its rows are not returned.

    A row that the history holds as well is taken from ``rows``. A row that is
    older than what the history reaches back to raises an error: its features
    would not be whole.
    """
    p = spec.panel
    customer, date = p.customer_col, p.date_col
    keyed = rows.filter(F.col(customer).isNotNull()).repartition(history.buckets, customer)
    whole = F.struct(*[F.col(c) for c in rows.columns])
    # A customer has one row a period, so its rows make up a short list.
    listed = keyed.groupBy(customer).agg(F.collect_list(whole).alias("_rows"))
    state = history.read(rows.sparkSession)
    met = listed.hint("merge").join(state, customer, "left")
    dates = F.transform("_rows", lambda r: r[date])
    past = F.filter(F.coalesce(RECENT, F.array().cast(state.schema[RECENT].dataType)), lambda e: ~F.array_contains(dates, e["date"]))
    reach = F.when(F.size(RECENT) >= history.keep, F.element_at(RECENT, 2)["date"])
    short = F.raise_error(F.concat(F.lit("the history does not reach back far enough for customer "), F.col(customer).cast("string")))
    met = met.withColumn("_rows", F.when(F.array_min(dates) < reach, short).otherwise(F.col("_rows")))
    fields = {f.name: f.dataType for f in rows.schema.fields}

    def blank(e: Column) -> Column:
        filled = {customer: F.col(customer), date: e["date"], p.value_col: e["value"].cast(fields[p.value_col])}
        return F.struct(*[filled.get(c, F.lit(None).cast(t)).alias(c) for c, t in fields.items()])

    marked = F.concat(
        F.transform("_rows", lambda r: F.struct(r.alias("row"), F.lit(True).alias("wanted"))),
        F.transform(past, lambda e: F.struct(blank(e).alias("row"), F.lit(False).alias("wanted"))),
    )
    # The customer stays the column that rows and history met by, so that windows find the rows where they are.
    each = met.withColumn("_all", marked).select(customer, F.inline_outer("_all"))
    columns = [F.col(customer) if c == customer else F.col("row")[c].alias(c) for c in rows.columns]
    each = each.select(*columns, F.col("wanted").alias("_wanted"))
    found = stateless_features(each, spec, null_customers=False).filter("_wanted").drop("_wanted")
    # Rows without a customer have no features but those of the date.
    rest = ids_to_categories(rows.filter(F.col(customer).isNull()), p.numeric_id_cols)
    return found.unionByName(rest.withColumns(calendar(date)), allowMissingColumns=True)


def score_with_history(rows: DataFrame, forecaster: Forecaster, history: History) -> DataFrame:
    """As ``score`` with the whole history given, from the kept rows alone."""
    label = forecaster.spec.panel.label_col
    return predicted(features_with_history(rows.drop(label), history, forecaster.spec), forecaster)
