"""Every operator as a query over the test tables, with its SQL twin.

Doubles are rounded and integers widened on both sides, so that the two
engines can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallycast.config import CvSpec, EncoderSpec, FeatureSpec, ModelSpec, PanelSpec, PipelineSpec
from tallycast.functions import scalars
from tallycast.functions.stop_words import ENGLISH
from tallycast.functions.text import TOKEN_PATTERN, accent_table, ngrams
from tallycast.operators import encoders, folds, metrics, models, numeric, ordered_stats, panel, target_encoding
from tallycast.operators import temporal, text_encoding
from tallycast.plans import history, prepare, score, train
from tallycast.session import materialise, scratch_path
from tallycast.sources import readers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, Callable[[], str]] = {}


def query(name: str, sql: str | Callable[[], str] | None = None) -> Callable[[Query], Query]:
    """Register a query and its SQL twin, if it has one."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql if callable(sql) else lambda: sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


def widened(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


# Prices in cents, all digits kept: sums are exact, so no digit depends on their order.
PRICED_SQL = "(SELECT *, round(o_totalprice * 100) AS price FROM orders)"
# A mean of cents has eight digits before the point; so many after it are the same by any rule of rounding.
PRICE_DIGITS = 4


def priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("price", F.round(F.col("o_totalprice") * 100))


# ------------------------------------------------------------------ panels

CUSTOMER, PERIOD, VALUE, LABEL = "o_custkey", "period", "txn_count", "next_3m_txn_count"


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return panel.periodic_panel(orders, CUSTOMER, "o_orderdate", measures={"amount": F.sum("o_totalprice")})


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = table(spark, sf_dir, "orders").agg(F.max("o_orderdate")).first()[0]
    return panel.dense_panel(observed(spark, sf_dir), CUSTOMER, until=F.lit(newest))


PANEL_SQL = """panel AS (
  SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS period,
         count(*) AS txn_count, sum(o_totalprice) AS amount
  FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL GROUP BY 1, 2
)"""
DENSE_SQL = f"""{PANEL_SQL}, ends AS (
  SELECT o_custkey, min(period) AS lo, (SELECT max(period) FROM panel) AS hi FROM panel GROUP BY 1
), spine AS (
  SELECT o_custkey, CAST(unnest(generate_series(
           CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS period
  FROM ends
), dense AS (
  SELECT s.o_custkey, s.period, coalesce(p.txn_count, 0) AS txn_count, p.amount
  FROM spine s LEFT JOIN panel p ON p.o_custkey = s.o_custkey AND p.period = s.period
)"""
WINDOW_SQL = "(PARTITION BY o_custkey ORDER BY period)"


@query(
    "scan_panel",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice,
              CAST(o_orderdate AS DATE) AS o_orderdate FROM orders""",
)
def _(spark, sf_dir):
    orders = readers.read_panel(spark, f"{sf_dir}/orders.parquet", fmt="parquet")
    return orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
    )


@query(
    "bad_rows_split",
    """SELECT CASE WHEN o_orderkey % 50 = 7 THEN 'malformed' WHEN o_orderkey % 50 = 9 THEN 'bad date'
              WHEN o_orderkey % 50 = 13 OR o_custkey IS NULL OR o_orderdate IS NULL THEN 'missing key' ELSE 'good' END AS kind,
              count(*) AS n, round(sum(CASE WHEN o_orderkey % 50 NOT IN (7, 9, 13) AND o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
                                            THEN o_totalprice END), 2) AS amount FROM orders GROUP BY 1""",
)
def _(spark, sf_dir):
    """All orders as CSV files in which some cells are damaged by a rule, read back: what is good, and what is set aside."""
    cell, folder = F.col("o_orderkey") % 50, scratch_path(spark, "csv")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    written = table(spark, sf_dir, "orders").select(
        F.when(cell != 13, F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(cell == 9, F.lit("31st of May")).otherwise(day).alias("o_orderdate"),
        F.when(cell == 7, F.lit("a lot")).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
    )
    written.write.option("header", True).csv(folder)
    spec = PanelSpec(customer_col="o_custkey", date_col="o_orderdate", skewed_cols=("o_totalprice",))
    checked = readers.read_panel_checked(spark, folder, spec)
    good = checked.good.agg(F.lit("good").alias("kind"), F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("amount"))
    bad = checked.bad.groupBy(F.col("_reason").alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("amount"))
    return rounded(good.unionByName(bad), "amount", digits=2)


@query("monthly_panel", f"WITH {PANEL_SQL} SELECT o_custkey, period, txn_count, round(amount, 2) AS amount FROM panel")
def _(spark, sf_dir):
    return rounded(observed(spark, sf_dir), "amount", digits=2)


@query("dense_panel", f"WITH {DENSE_SQL} SELECT o_custkey, period, txn_count, round(amount, 2) AS amount FROM dense")
def _(spark, sf_dir):
    return rounded(widened(dense(spark, sf_dir), VALUE), "amount", digits=2)


@query(
    "dense_daily_panel",
    """WITH seen AS (
         SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n_events, sum(value) AS value
         FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2
       ), ends AS (SELECT user_id, min(day) AS lo, max(day) AS hi FROM seen GROUP BY 1),
       spine AS (
         SELECT user_id, CAST(unnest(generate_series(
                  CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM ends
       )
       SELECT s.user_id, s.day, coalesce(e.n_events, 0) AS n_events, round(e.value, 2) AS value
       FROM spine s LEFT JOIN seen e ON e.user_id = s.user_id AND e.day = s.day""",
)
def _(spark, sf_dir):
    daily = panel.periodic_panel(
        table(spark, sf_dir, "events"), "user_id", "ts", grain="day", period="day", count="n_events",
        measures={"value": F.sum("value")},
    )
    filled = panel.dense_panel(daily, "user_id", "day", zero=["n_events"], grain="day")
    return rounded(widened(filled, "n_events"), "value", digits=2)


LABEL_SQL = f"""{DENSE_SQL}, labelled AS (
  SELECT *, CASE WHEN count(*) OVER ahead = 3 THEN CAST(sum(txn_count) OVER ahead AS BIGINT) END AS next_3m_txn_count
  FROM dense WINDOW ahead AS (PARTITION BY o_custkey ORDER BY period ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING)
)"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.forward_label(dense(spark, sf_dir), CUSTOMER)


@query("forward_label", f"WITH {LABEL_SQL} SELECT o_custkey, period, txn_count, next_3m_txn_count FROM labelled")
def _(spark, sf_dir):
    out = labelled(spark, sf_dir).select(CUSTOMER, PERIOD, VALUE, LABEL)
    return widened(out, VALUE, LABEL)


# ---------------------------------------------------------- temporal features

FEATURES = FeatureSpec()
KEYS = (CUSTOMER, PERIOD)


def temporal_sql(spec: FeatureSpec, value: str, w: str) -> dict[str, str]:
    """SQL of the window features, by output name."""
    out = {f"{value}_lag_{n}m": f"lag({value}, {n}) OVER {w}" for n in spec.short_lags}
    out |= {f"{value}_lag_{n}m_seasonal": f"lag({value}, {n}) OVER {w}" for n in spec.seasonal_lags}
    functions = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
    inner = w.strip("()")
    for n in spec.rolling_windows:
        frame = f"({inner} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        for stat in spec.rolling_stats:
            call = f"{functions[stat]}(CAST({value} AS DOUBLE)) OVER {frame}"
            out[f"{value}_rolling_{stat}_{n}m"] = f"round({call}, 6)"
    mean = {n: f"avg(CAST({value} AS DOUBLE)) OVER ({inner} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in spec.rolling_windows}
    for recent, past in spec.velocity:
        out[f"velocity_{recent}m_vs_{past}m"] = (
            f"round({mean[recent]} / nullif(CAST(lag({value}, {past}) OVER {w} + 1 AS DOUBLE), 0), 6)"
        )
    out["trend_3m"] = f"{value} - lag({value}, 3) OVER {w}"
    out["yoy_growth"] = (
        f"round(({value} - lag({value}, 12) OVER {w}) / nullif(CAST(lag({value}, 12) OVER {w} + 1 AS DOUBLE), 0), 6)"
    )
    return out


def pick_sql(*names: str) -> str:
    columns = temporal_sql(FEATURES, VALUE, WINDOW_SQL)
    picked = ", ".join(f"{columns[n]} AS {n}" for n in names)
    return f"WITH {PANEL_SQL} SELECT o_custkey, period, {picked} FROM panel"


def observed_features(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Some feature columns over the observed panel; the others are pruned."""
    features = temporal.temporal_features(observed(spark, sf_dir), CUSTOMER, PERIOD, VALUE, FEATURES)
    doubles = [n for n in names if "rolling" in n or "velocity" in n or n == "yoy_growth"]
    return rounded(features.select(*KEYS, *names), *doubles)


def register_features(name: str, *columns: str) -> None:
    @query(name, pick_sql(*columns))
    def _(spark, sf_dir):
        return observed_features(spark, sf_dir, *columns)


register_features("lag_short", *[temporal.lag_name(VALUE, n) for n in FEATURES.short_lags])
register_features("lag_seasonal", *[temporal.lag_name(VALUE, n, True) for n in FEATURES.seasonal_lags])
for _stat in FEATURES.rolling_stats:
    register_features(
        f"rolling_{_stat}", *[temporal.rolling_name(VALUE, _stat, n) for n in FEATURES.rolling_windows]
    )
register_features("velocity", *[f"velocity_{r}m_vs_{h}m" for r, h in FEATURES.velocity])
register_features("trend_3m", "trend_3m")
register_features("yoy_growth", "yoy_growth")

CALENDAR_SQL = {
    "month": "CAST(month({d}) AS BIGINT)",
    "quarter": "CAST(quarter({d}) AS BIGINT)",
    "is_nov_jan": "CAST(coalesce(month({d}) IN (11, 12, 1), false) AS BIGINT)",
    "is_holiday_season": "CAST(coalesce(month({d}) IN (10, 11, 12, 1), false) AS BIGINT)",
}


def calendar_sql(date: str) -> str:
    return ", ".join(f"{sql.format(d=date)} AS {name}" for name, sql in CALENDAR_SQL.items())


@query("calendar_flags", f"SELECT o_orderkey, {calendar_sql('o_orderdate')} FROM orders")
def _(spark, sf_dir):
    flags = scalars.calendar("o_orderdate")
    out = table(spark, sf_dir, "orders").select("o_orderkey", *[c.alias(n) for n, c in flags.items()])
    return widened(out, *flags)


def full_features_sql() -> str:
    columns = temporal_sql(FEATURES, VALUE, WINDOW_SQL)
    body = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"WITH {DENSE_SQL} SELECT o_custkey, period, txn_count, {calendar_sql('period')}, {body} FROM dense"


@query(
    "history_features",
    lambda: f"""SELECT * FROM ({full_features_sql()})
                QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY period DESC) = 1""",
)
def _(spark, sf_dir):
    """The features of every customer's newest month, from the kept rows of a history alone."""
    spec = PipelineSpec(panel=PanelSpec(customer_col=CUSTOMER, date_col=PERIOD, value_col=VALUE, numeric_id_cols=()))
    rows = materialise(dense(spark, sf_dir).select(*KEYS, VALUE))
    newest = F.col(PERIOD) == rows.agg(F.max(PERIOD)).first()[0]
    kept = history.build_history(rows.filter(~newest), spec, scratch_path(spark, "history"), buckets=8)
    out = history.features_with_history(rows.filter(newest), kept, spec)
    doubles = [c for c, t in out.dtypes if t == "double"]
    longs = [c for c, t in out.dtypes if t == "int"]
    return rounded(widened(out, *longs), *doubles)


@query("temporal_features", full_features_sql)
def _(spark, sf_dir):
    base = dense(spark, sf_dir).select(*KEYS, VALUE)
    out = temporal.temporal_features(base, CUSTOMER, PERIOD, VALUE, FEATURES)
    doubles = [c for c, t in out.dtypes if t == "double"]
    longs = [c for c, t in out.dtypes if t == "int"]
    return rounded(widened(out, *longs), *doubles)


def row_digits(name: str) -> int:
    """Deviations of cents depend on the order of operations in their last digits."""
    return 0 if "_std_" in name else 6


def row_features_sql() -> str:
    w = "(PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"
    columns = temporal_sql(FEATURES, "price", w)
    body = ", ".join(f"round({sql}, {row_digits(name)}) AS {name}" for name, sql in columns.items())
    return f"SELECT o_orderkey, {body} FROM {PRICED_SQL}"


@query("temporal_features_rows", row_features_sql)
def _(spark, sf_dir):
    """One row per transaction: a customer may own any share of the rows."""
    rows = priced(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderdate", "price")
    out = temporal.temporal_features(
        rows, "o_custkey", "o_orderdate", "price", FEATURES,
        tie_break=("o_orderkey",), one_row_per_period=False,
    )
    names = list(temporal_sql(FEATURES, "price", "()"))
    out = out.select("o_orderkey", *names)
    return out.withColumns({n: F.round(F.col(n).cast("double"), row_digits(n)) for n in names})


# ------------------------------------------------------------ numeric columns


@query(
    "log1p_target",
    """SELECT c_custkey, round(CASE WHEN c_acctbal IS NOT NULL THEN ln(1 + greatest(c_acctbal, 0)) END, 6) AS y
       FROM customer""",
)
def _(spark, sf_dir):
    out = table(spark, sf_dir, "customer").select("c_custkey", scalars.log_target("c_acctbal").alias("y"))
    return rounded(out, "y")


@query(
    "expm1_inverse",
    """SELECT c_custkey, round(CASE WHEN c_acctbal IS NOT NULL
              THEN greatest(exp(c_acctbal / 1000.0) - 1, 0) END, 6) AS y FROM customer""",
)
def _(spark, sf_dir):
    scaled = F.col("c_acctbal") / 1000.0
    return rounded(table(spark, sf_dir, "customer").select("c_custkey", scalars.unlog_target(scaled).alias("y")), "y")


def imputed(spark: SparkSession, sf_dir: str, strategy: str) -> DataFrame:
    rows = materialise(dense(spark, sf_dir))
    fill = numeric.fit_imputer(rows, ["amount"], strategy)
    out = numeric.skew_transform(rows, ["amount"], fill, log=False)
    return rounded(out.select(*KEYS, "amount"), "amount", digits=4)


def imputed_sql(value: str) -> str:
    return f"""WITH {DENSE_SQL.replace("dense AS (", "dense AS MATERIALIZED (")}, fill AS (SELECT {value} AS v FROM dense)
        SELECT o_custkey, period, round(coalesce(amount, v), 4) AS amount FROM dense CROSS JOIN fill"""


@query("impute_median", imputed_sql("median(amount)"))
def _(spark, sf_dir):
    return imputed(spark, sf_dir, "median")


@query("impute_mean", imputed_sql("avg(amount)"))
def _(spark, sf_dir):
    return imputed(spark, sf_dir, "mean")


@query("impute_zero", imputed_sql("CAST(max(0) AS DOUBLE)"))
def _(spark, sf_dir):
    return imputed(spark, sf_dir, "zero")


@query(
    "impute_values",
    """SELECT 'l_quantity' AS col, round(median(l_quantity), 6) AS value FROM lineitem
       UNION ALL SELECT 'l_extendedprice', round(median(l_extendedprice), 6) FROM lineitem
       UNION ALL SELECT 'l_discount', round(median(l_discount), 6) FROM lineitem""",
)
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    fill = numeric.fit_imputer(lines, ["l_quantity", "l_extendedprice", "l_discount", "not_there"])
    return rounded(numeric.imputer_table(spark, fill), "value")


@query(
    "skew_log",
    """SELECT c_custkey, c_acctbal,
              round(CASE WHEN c_acctbal IS NOT NULL THEN ln(1 + greatest(c_acctbal, 0)) END, 6) AS c_acctbal_log
       FROM customer""",
)
def _(spark, sf_dir):
    out = numeric.skew_transform(table(spark, sf_dir, "customer"), ["c_acctbal"], {"c_acctbal": 0.0})
    return rounded(out.select("c_custkey", "c_acctbal", "c_acctbal_log"), "c_acctbal_log")


@query(
    "missing_flags",
    f"""WITH {DENSE_SQL}
        SELECT o_custkey, period, CAST(amount IS NULL AS BIGINT) AS amount_is_missing,
               CAST(coalesce(amount, 0) = 0 AS BIGINT) AS amount_is_zero FROM dense""",
)
def _(spark, sf_dir):
    out = numeric.skew_transform(dense(spark, sf_dir), ["amount"], {"amount": 0.0})
    flags = ["amount_is_missing", "amount_is_zero"]
    return widened(out.select(*KEYS, *flags), *flags)


@query(
    "id_to_category",
    """SELECT d.doc_id, 'id_' || coalesce(CAST(l.quality AS VARCHAR), 'nan') AS quality
       FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    joined = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return numeric.ids_to_categories(joined, ["quality", "not_there"]).select("doc_id", "quality")


# -------------------------------------------------------------------- folds

CV = CvSpec()
FOLDS_SQL = """span AS (
  SELECT min(idx) AS origin, max(idx) - min(idx) + 1 AS periods, (max(idx) - min(idx) + 1 - 6) // 5 AS size
  FROM (SELECT year(o_orderdate) * 12 + month(o_orderdate) - 1 AS idx FROM orders WHERE o_orderdate IS NOT NULL)
), folds AS (
  SELECT CAST(i AS BIGINT) AS fold, CAST(origin AS BIGINT) AS origin, CAST(periods AS BIGINT) AS periods,
         CAST(size AS BIGINT) AS size, CAST(6 + i * size AS BIGINT) AS train_end,
         CAST(9 + i * size AS BIGINT) AS test_start, CAST(least(9 + i * size + size, periods) AS BIGINT) AS test_end
  FROM span, range(5) t(i) WHERE 9 + i * size < periods
)"""


def month_sql(offset: str) -> str:
    return (
        f"make_date((origin + {offset}) // 12, (origin + {offset}) % 12 + 1, 1) AS {offset}_date"
    )


@query(
    "cv_fold_bounds",
    f"WITH {FOLDS_SQL} SELECT *, {month_sql('train_end')}, {month_sql('test_start')}, {month_sql('test_end')} FROM folds",
)
def _(spark, sf_dir):
    bounds = folds.fold_bounds(table(spark, sf_dir, "orders"), "o_orderdate", CV)
    return widened(bounds, *[c for c in bounds.columns if not c.endswith("_date")])


MEMBERS_SQL = f"""{FOLDS_SQL}, placed AS (
  SELECT *, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS idx FROM {PRICED_SQL}
), members AS (
  SELECT f.fold, CASE WHEN p.idx - f.origin < f.train_end THEN 'train' ELSE 'test' END AS role, p.*
  FROM placed p JOIN folds f ON p.idx - f.origin < f.train_end
    OR (p.idx - f.origin >= f.test_start AND p.idx - f.origin < f.test_end)
)"""


def order_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    return folds.rolling_origin(orders, "o_orderdate", folds.rolling_folds(orders, "o_orderdate", CV), ["o_orderkey"])


@query(
    "cv_rolling_origin",
    f"WITH {MEMBERS_SQL} SELECT fold, role, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM members",
)
def _(spark, sf_dir):
    return widened(order_members(spark, sf_dir), "fold")


@query(
    "cv_fold_summary",
    f"""WITH {MEMBERS_SQL} SELECT fold, role, count(*) AS n, CAST(min(o_orderdate) AS DATE) AS first_date,
        CAST(max(o_orderdate) AS DATE) AS last_date FROM members GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    return widened(folds.fold_summary(order_members(spark, sf_dir), "o_orderdate"), "fold")


@query(
    "cv_fold_columns",
    f"""WITH {FOLDS_SQL} SELECT o_orderkey,
          (SELECT min(fold) FROM folds f WHERE year(o_orderdate) * 12 + month(o_orderdate) - 1 - f.origin < f.train_end)
            AS first_train_fold,
          (SELECT min(fold) FROM folds f WHERE year(o_orderdate) * 12 + month(o_orderdate) - 1 - f.origin >= f.test_start
             AND year(o_orderdate) * 12 + month(o_orderdate) - 1 - f.origin < f.test_end) AS test_fold
        FROM orders""",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    marks = ["first_train_fold", "test_fold"]
    split = folds.rolling_folds(orders, "o_orderdate", CV)
    return widened(folds.fold_columns(orders, "o_orderdate", split).select("o_orderkey", *marks), *marks)


RANKS_SQL = """spans AS (
  SELECT o_custkey, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date, count(o_orderdate) AS n
  FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY first_date, md5(CAST(o_custkey AS VARCHAR)), o_custkey) - 1
              AS group_rank
  FROM spans
)"""


@query(
    "group_spans",
    f"""WITH {RANKS_SQL} SELECT o_custkey, CAST(first_date AS DATE) AS first_date,
        CAST(last_date AS DATE) AS last_date, n, group_rank FROM ranked""",
)
def _(spark, sf_dir):
    spans = materialise(folds.group_spans(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate"))
    out = folds.rank_groups(spans, "o_custkey")
    return out.withColumns({c: F.col(c).cast("date") for c in ("first_date", "last_date")})


@query(
    "cv_purged_group",
    f"""WITH {RANKS_SQL}, sized AS (SELECT count(*) // 6 AS size FROM spans), blocks AS (
          SELECT o_custkey, first_date, CAST(group_rank // size AS BIGINT) AS block FROM ranked, sized
        ), starts AS (
          SELECT block, min(first_date) AS started FROM blocks WHERE block <= 5 GROUP BY 1
        ), cuts AS (
          SELECT s.block - 1 AS fold, s.started - INTERVAL 3 MONTH AS cutoff,
                 (SELECT min(started) FROM starts e WHERE e.block < s.block) AS oldest
          FROM starts s WHERE s.block >= 1
        )
        SELECT c.fold, CASE WHEN b.block = c.fold + 1 THEN 'test' ELSE 'train' END AS role,
               o.o_custkey, o.o_orderkey, CAST(o.o_orderdate AS DATE) AS o_orderdate
        FROM orders o JOIN blocks b ON b.o_custkey = o.o_custkey
        JOIN cuts c ON c.oldest < c.cutoff
          AND (b.block = c.fold + 1 OR (b.block <= c.fold AND o.o_orderdate < c.cutoff))""",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    return widened(folds.purged_groups(orders, "o_custkey", "o_orderdate", CV, keys=["o_orderkey"]), "fold")


# ------------------------------------------------------------------- metrics

NAIVE_SQL = f"""{LABEL_SQL}, naive AS (
  SELECT *, 3 * avg(CAST(txn_count AS DOUBLE)) OVER w3 AS by_mean, 3.0 * lag(txn_count, 1) OVER w AS by_lag
  FROM labelled
  WINDOW w AS (PARTITION BY o_custkey ORDER BY period),
         w3 AS (PARTITION BY o_custkey ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
)"""
SQUARED_GAP = "power(ln(1 + greatest(by_mean, 0)) - ln(1 + next_3m_txn_count), 2)"


def naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label beside two naive forecasts: the recent mean and the last value."""
    w = Window.partitionBy(CUSTOMER).orderBy(PERIOD)
    return labelled(spark, sf_dir).withColumns(
        {
            "by_mean": 3 * F.avg(F.col(VALUE).cast("double")).over(w.rowsBetween(-2, 0)),
            "by_lag": 3.0 * F.lag(VALUE, 1).over(w),
        }
    )


def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive(spark, sf_dir).filter(F.col(LABEL).isNotNull())


@query(
    "rmsle",
    f"""WITH {NAIVE_SQL} SELECT count(*) AS n, round(sqrt(avg({SQUARED_GAP})), 6) AS rmsle
        FROM naive WHERE next_3m_txn_count IS NOT NULL""",
)
def _(spark, sf_dir):
    score_ = metrics.rmsle(LABEL, "by_mean").alias("rmsle")
    return rounded(scored_rows(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"), score_), "rmsle")


PANEL_FOLDS_SQL = f"""{NAIVE_SQL}, usable AS (
  SELECT *, year(period) * 12 + month(period) - 1 AS idx FROM naive WHERE next_3m_txn_count IS NOT NULL
), span AS (
  SELECT min(idx) AS origin, max(idx) - min(idx) + 1 AS periods, (max(idx) - min(idx) + 1 - 6) // 5 AS size FROM usable
), tested AS (
  SELECT i AS fold, u.* FROM usable u, span s, range(5) t(i)
  WHERE u.idx - s.origin >= 9 + i * s.size AND u.idx - s.origin < least(9 + (i + 1) * s.size, s.periods)
), per_fold AS (
  SELECT fold, count(*) AS n, sum({SQUARED_GAP}) AS sse FROM tested GROUP BY 1
)"""


def tested_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialise(scored_rows(spark, sf_dir))
    split = folds.rolling_folds(rows, PERIOD, CV)
    return folds.fold_columns(rows, PERIOD, split).filter(F.col("test_fold").isNotNull())


@query(
    "cv_scores",
    f"WITH {PANEL_FOLDS_SQL} SELECT CAST(fold AS BIGINT) AS fold, n, round(sqrt(sse / n), 6) AS rmsle FROM per_fold",
)
def _(spark, sf_dir):
    scores = metrics.fold_scores(tested_rows(spark, sf_dir), LABEL, "by_mean", "test_fold")
    return rounded(widened(scores.withColumnRenamed("test_fold", "fold"), "fold"), "rmsle")


@query(
    "cv_summary",
    f"""WITH {PANEL_FOLDS_SQL} SELECT count(*) AS folds, CAST(sum(n) AS BIGINT) AS n,
          round(sqrt(sum(sse) / sum(n)), 6) AS overall_rmsle, round(avg(sqrt(sse / n)), 6) AS mean_rmsle,
          round(stddev_pop(sqrt(sse / n)), 6) AS std_rmsle,
          round(sum(n) / (SELECT count(*) FROM usable), 6) AS coverage FROM per_fold""",
)
def _(spark, sf_dir):
    rows = materialise(scored_rows(spark, sf_dir))
    split = folds.rolling_folds(rows, PERIOD, CV)
    tested = folds.fold_columns(rows, PERIOD, split).filter(F.col("test_fold").isNotNull())
    out = metrics.cv_summary(tested, LABEL, "by_mean", "test_fold", labelled=rows.count())
    return rounded(out, "overall_rmsle", "mean_rmsle", "std_rmsle", "coverage")


@query(
    "row_count_guard",
    f"""WITH {DENSE_SQL} SELECT count(*) AS n_in, count(*) AS n_out, count(*) AS expected, true AS ok FROM dense""",
)
def _(spark, sf_dir):
    rows = dense(spark, sf_dir).select(*KEYS, VALUE)
    # Written first: a plan that is only counted loses the windows that could go wrong.
    written = materialise(temporal.temporal_features(rows, CUSTOMER, PERIOD, VALUE))
    return metrics.row_counts(rows, written)


@query(
    "prediction_stats",
    f"""WITH {NAIVE_SQL} SELECT count(by_mean) AS n, round(avg(by_mean), 6) AS mean,
          round(stddev_samp(by_mean), 6) AS std, min(by_mean) AS min, max(by_mean) AS max,
          quantile_cont(by_mean, 0.25) AS p25, quantile_cont(by_mean, 0.5) AS p50,
          quantile_cont(by_mean, 0.75) AS p75 FROM naive""",
)
def _(spark, sf_dir):
    stats = metrics.prediction_stats(materialise(naive(spark, sf_dir).select("by_mean")), "by_mean")
    return rounded(stats, "mean", "std")


BLEND = (0.6, 0.4)


@query(
    "ensemble_average",
    f"WITH {NAIVE_SQL} SELECT o_custkey, period, round(0.6 * by_mean + 0.4 * by_lag, 6) AS prediction FROM naive",
)
def _(spark, sf_dir):
    blend = models.weighted_average(["by_mean", "by_lag"], [3 * w for w in BLEND]).alias("prediction")
    return rounded(naive(spark, sf_dir).select(*KEYS, blend), "prediction")


@query(
    "scored_output",
    f"""WITH {NAIVE_SQL} SELECT o_custkey, round(ln(1 + greatest(by_mean, 0)), 6) AS next_3m_txn_count
        FROM naive QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY period DESC) = 1""",
)
def _(spark, sf_dir):
    """The scoring contract on a naive forecast: one row per customer, log scale."""
    w = Window.partitionBy(CUSTOMER).orderBy(PERIOD)
    newest = naive(spark, sf_dir).withColumn("_next", F.lead(PERIOD).over(w)).filter(F.col("_next").isNull())
    return rounded(newest.select(CUSTOMER, scalars.log_target("by_mean").alias(LABEL)), LABEL)


# ----------------------------------------------------------- target encoding

ORDER_CATEGORIES = ("o_orderpriority", "o_orderstatus")


def stats_sql(columns: tuple[str, ...], label: str, source: str) -> str:
    parts = [
        f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS category, count({label}) AS n, avg({label}) AS mean "
        f"FROM {source} WHERE {c} IS NOT NULL GROUP BY 2"
        for c in columns
    ]
    return " UNION ALL ".join(parts)


@query(
    "category_stats",
    f"""SELECT col, category, n, round(mean, {PRICE_DIGITS}) AS mean
        FROM ({stats_sql((*ORDER_CATEGORIES, 'o_custkey'), 'price', PRICED_SQL)})""",
)
def _(spark, sf_dir):
    orders = priced(spark, sf_dir)
    stats = target_encoding.category_stats(orders, [*ORDER_CATEGORIES, "o_custkey"], "price")
    return rounded(stats, "mean", digits=PRICE_DIGITS)


@query(
    "category_counts",
    """SELECT 'p_brand' AS col, count(DISTINCT p_brand) AS categories FROM part
       UNION ALL SELECT 'p_name', count(DISTINCT p_name) FROM part
       UNION ALL SELECT 'p_type', count(DISTINCT p_type) FROM part""",
)
def _(spark, sf_dir):
    """How many categories an encoding of each column holds."""
    stats = target_encoding.category_stats(table(spark, sf_dir, "part"), ["p_brand", "p_name", "p_type"], "p_retailprice")
    return stats.groupBy("col").agg(F.count(F.lit(1)).alias("categories"))


def digits_of(label: str) -> int:
    return PRICE_DIGITS if label == "price" else 6


def encode_sql(key: str, columns: tuple[str, ...], label: str, fit: str, rows: str, enc: str, default: str = "p.prior") -> str:
    """SQL of a target encoding fitted on ``fit`` and applied to ``rows``."""
    joins, outputs = [], []
    for i, c in enumerate(columns):
        joins.append(
            f"""LEFT JOIN (SELECT CAST({c} AS VARCHAR) AS category, '{c}' AS col, count({label}) AS n, avg({label}) AS mean
                FROM {fit} WHERE {c} IS NOT NULL GROUP BY 1) s{i} ON s{i}.category = CAST(r.{c} AS VARCHAR)"""
        )
        value = enc.format(n=f"s{i}.n", mean=f"s{i}.mean", col=f"s{i}.col", category=f"s{i}.category")
        outputs.append(f"round(CASE WHEN s{i}.category IS NULL THEN {default} ELSE {value} END, {digits_of(label)}) AS {c}_target_enc")
    return (
        f"SELECT {key}, {', '.join(outputs)} FROM {rows} r "
        f"CROSS JOIN (SELECT avg({label}) AS prior FROM {fit}) p {' '.join(joins)}"
    )


SMOOTH_SQL = "({n} / ({n} + 1.0) * {mean} + (1 - {n} / ({n} + 1.0)) * p.prior)"


def encoded(
    df: DataFrame, keys: list[str], learned: target_encoding.TargetEncoding, digits: int = PRICE_DIGITS, **kwargs
) -> DataFrame:
    out = learned.apply(df.select(*keys, *[F.col(c) for c in learned.columns]), **kwargs)
    return rounded(out.select(*keys, *learned.names), *learned.names, digits=digits)


@query(
    "target_encode",
    encode_sql("r.o_orderkey", (*ORDER_CATEGORIES, "o_custkey"), "price", PRICED_SQL, PRICED_SQL, SMOOTH_SQL),
)
def _(spark, sf_dir):
    orders = priced(spark, sf_dir)
    learned = target_encoding.fit_target_encoding(orders, [*ORDER_CATEGORIES, "o_custkey"], "price")
    return encoded(orders.withColumn("o_custkey", F.col("o_custkey").cast("string")), ["o_orderkey"], learned)


@query(
    "target_encode_high_cardinality",
    encode_sql("r.l_orderkey, r.l_linenumber, r.l_suppkey", ("l_partkey",), "l_quantity", "lineitem", "lineitem", SMOOTH_SQL),
)
def _(spark, sf_dir):
    """Encodings too many to broadcast: the hot ones are, the others are shuffled."""
    lines = table(spark, sf_dir, "lineitem")
    learned = target_encoding.fit_target_encoding(lines, ["l_partkey"], "l_quantity")
    return encoded(lines, ["l_orderkey", "l_linenumber", "l_suppkey"], learned, digits=6, broadcast_bytes=0)


EARLY = f"(SELECT * FROM {PRICED_SQL} WHERE o_orderdate < TIMESTAMP '1996-01-01')"


@query(
    "target_encode_unknown_null",
    encode_sql("r.o_orderkey", ("o_custkey",), "price", EARLY, "orders", SMOOTH_SQL, default="NULL"),
)
def _(spark, sf_dir):
    """Learned on the first year, applied to all rows: later customers are unknown."""
    orders = priced(spark, sf_dir)
    early = orders.filter(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    spec = EncoderSpec(handle_unknown="nan")
    return encoded(orders, ["o_orderkey"], target_encoding.fit_target_encoding(early, ["o_custkey"], "price", spec))


@query(
    "target_encode_min_samples",
    encode_sql(
        "r.o_orderkey", ("o_custkey",), "price", PRICED_SQL, PRICED_SQL,
        "CASE WHEN {n} < 12 THEN p.prior ELSE " + SMOOTH_SQL + " END",
    ),
)
def _(spark, sf_dir):
    orders = priced(spark, sf_dir)
    spec = EncoderSpec(min_samples=12)
    return encoded(orders, ["o_orderkey"], target_encoding.fit_target_encoding(orders, ["o_custkey"], "price", spec))


def uniform_sql(part: str) -> str:
    key = "concat_ws('|', '42', {col}, {category}, '" + part + "')"
    return f"((('0x' || substr(md5({key}), 1, 12))::UBIGINT::DOUBLE + 1) / 281474976710656.0)"


NOISE_SQL = f"0.01 * abs(p.prior) * sqrt(-2.0 * ln({uniform_sql('u')})) * cos(2.0 * pi() * {uniform_sql('v')})"


@query(
    "target_encode_noise",
    encode_sql("r.o_orderkey", ("o_custkey",), "price", PRICED_SQL, PRICED_SQL, f"{SMOOTH_SQL} + {NOISE_SQL}"),
)
def _(spark, sf_dir):
    orders = priced(spark, sf_dir)
    learned = target_encoding.fit_target_encoding(orders, ["o_custkey"], "price", EncoderSpec(noise=0.01))
    return encoded(orders, ["o_orderkey"], learned)


OOF_SQL = f"""WITH {MEMBERS_SQL}, priors AS (
  SELECT fold, avg(price) AS prior FROM members WHERE role = 'train' GROUP BY 1
), stats AS (
  SELECT fold, col, category, count(y) AS n, avg(y) AS mean FROM (
    SELECT fold, 'o_orderpriority' AS col, o_orderpriority AS category, price AS y FROM members WHERE role = 'train'
    UNION ALL SELECT fold, 'o_custkey', CAST(o_custkey AS VARCHAR), price FROM members WHERE role = 'train'
  ) WHERE category IS NOT NULL GROUP BY 1, 2, 3
), encodings AS (
  SELECT s.fold, col, category, n, mean, prior, n / (n + 1.0) * mean + (1 - n / (n + 1.0)) * prior AS enc
  FROM stats s JOIN priors p ON p.fold = s.fold
)"""
OOF_COLUMNS = ["o_orderpriority", "o_custkey"]


def folded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = priced(spark, sf_dir).select("o_orderkey", "o_orderdate", "price", *OOF_COLUMNS)
    return folds.fold_columns(orders, "o_orderdate", folds.rolling_folds(orders, "o_orderdate", CV))


@query(
    "fold_encodings",
    f"""{OOF_SQL} SELECT fold, col, category, n, round(mean, {PRICE_DIGITS}) AS mean,
          round(prior, {PRICE_DIGITS}) AS prior, round(enc, {PRICE_DIGITS}) AS enc FROM encodings""",
)
def _(spark, sf_dir):
    out = target_encoding.fold_encodings(folded_orders(spark, sf_dir), OOF_COLUMNS, "price", CV.n_splits)
    return rounded(widened(out.drop("rows"), "fold"), "mean", "prior", "enc", digits=PRICE_DIGITS)


@query(
    "target_encode_oof",
    f"""{OOF_SQL} SELECT m.fold, m.o_orderkey, round(coalesce(a.enc, p.prior), {PRICE_DIGITS}) AS o_orderpriority_target_enc,
          round(coalesce(b.enc, p.prior), {PRICE_DIGITS}) AS o_custkey_target_enc
        FROM members m JOIN priors p ON p.fold = m.fold
        LEFT JOIN encodings a ON a.fold = m.fold AND a.col = 'o_orderpriority' AND a.category = m.o_orderpriority
        LEFT JOIN encodings b ON b.fold = m.fold AND b.col = 'o_custkey' AND b.category = CAST(m.o_custkey AS VARCHAR)
        WHERE m.role = 'test'""",
)
def _(spark, sf_dir):
    rows = folded_orders(spark, sf_dir)
    out = target_encoding.encode_out_of_fold(rows, OOF_COLUMNS, "price", CV.n_splits)
    names = [target_encoding.encoded_name(c) for c in OOF_COLUMNS]
    return rounded(widened(out.select("fold", "o_orderkey", *names), "fold"), *names, digits=PRICE_DIGITS)


ORDERED_COLUMNS = ("o_custkey", "o_orderpriority")


def ordered_sql() -> str:
    w = "(PARTITION BY {c} ORDER BY md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR))) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    parts = [
        f"""round(CASE WHEN {c} IS NULL THEN prior ELSE (coalesce(sum(price) OVER {w.format(c=c)}, 0) + prior)
              / (count(price) OVER {w.format(c=c)} + 1) END, {PRICE_DIGITS}) AS {c}_target_enc"""
        for c in ORDERED_COLUMNS
    ]
    return f"SELECT o_orderkey, {', '.join(parts)} FROM {PRICED_SQL} CROSS JOIN (SELECT avg(price) AS prior FROM {PRICED_SQL})"


@query("target_encode_ordered", ordered_sql())
def _(spark, sf_dir):
    """Every order's categories by the earlier orders of a random order."""
    orders = priced(spark, sf_dir).select("o_orderkey", "price", *ORDERED_COLUMNS)
    out = ordered_stats.ordered_target_stats(orders, ORDERED_COLUMNS, "price", ["o_orderkey"], block_rows=1000)
    names = [target_encoding.encoded_name(c) for c in ORDERED_COLUMNS]
    return rounded(out.select("o_orderkey", *names), *names, digits=PRICE_DIGITS)


@query(
    "fold_fill_values",
    f"""WITH {MEMBERS_SQL} SELECT fold, round(median(price), {PRICE_DIGITS}) AS price, round(median(o_custkey), 4) AS o_custkey
        FROM members WHERE role = 'train' GROUP BY 1""",
)
def _(spark, sf_dir):
    """Exact medians of the training rows of all folds, from shared passes."""
    orders = priced(spark, sf_dir).select("o_orderdate", "price", "o_custkey")
    split = folds.rolling_folds(orders, "o_orderdate", CV)
    marked = folds.fold_columns(orders, "o_orderdate", split)
    fill = numeric.fit_imputer_folds(marked, ["price", "o_custkey"], CV.n_splits)
    rows = [(f.fold, fill[f.fold]["price"], fill[f.fold]["o_custkey"]) for f in split]
    out = spark.createDataFrame(rows, "fold bigint, price double, o_custkey double")
    return rounded(out, "price", "o_custkey", digits=PRICE_DIGITS)


@query(
    "quantile_state_merged",
    """SELECT 'l_quantity' AS col, count(l_quantity) AS n, true AS within FROM lineitem
       UNION ALL SELECT 'l_extendedprice', count(l_extendedprice), true FROM lineitem""",
)
def _(spark, sf_dir):
    """Medians from sketches of each shipping month, merged: whether their ranks are within 0.5 % of the middle."""
    names = ["l_quantity", "l_extendedprice"]
    lines = table(spark, sf_dir, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    states = materialise(numeric.quantile_states(lines, names, ["month"]))
    merged = materialise(numeric.state_quantiles(numeric.merge_quantile_states(states)))
    value = {r["col"]: r["value"] for r in merged.collect()}
    checks = []
    for c in names:
        below, up_to = F.count(F.when(F.col(c) < value[c], 1)), F.count(F.when(F.col(c) <= value[c], 1))
        middle, slack = F.count(c) / 2, F.count(c) * 0.005 + 1
        checks.append(lines.agg(F.lit(c).alias("col"), ((below <= middle + slack) & (up_to >= middle - slack)).alias("within")))
    return merged.select("col", "n").join(checks[0].unionByName(checks[1]), "col")


# ---------------------------------------------------------------------- text


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def tokens_sql(source: str = "documents", key: str = "doc_id") -> str:
    """CTEs ``tok`` (key, words) and ``terms`` (key, grams) over a text column."""
    plain = f"translate(lower(coalesce(text, '')), {', '.join(quoted(t) for t in accent_table())})"
    words = ", ".join(quoted(w) for w in ENGLISH)
    return f"""tok AS (
      SELECT {key}, list_filter(regexp_extract_all({plain}, '{TOKEN_PATTERN}'),
             lambda t: NOT list_contains([{words}], t)) AS words FROM {source}
    ), pairs AS (
      SELECT {key}, words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) AS bigrams
      FROM tok
    ), grams AS (
      SELECT {key}, unnest(list_concat(words, bigrams)) AS term FROM pairs
    ), per_doc AS (SELECT {key}, term, count(*) AS tf FROM grams GROUP BY 1, 2
    ), stats AS (SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM per_doc GROUP BY 1)"""


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", *columns)


def digest(words: Column) -> Column:
    return F.md5(F.array_join(words, " "))


@query("tokenize", lambda: f"WITH {tokens_sql()} SELECT doc_id, len(words) AS n, md5(array_to_string(words, ' ')) AS digest FROM tok")
def _(spark, sf_dir):
    out = text_encoding.with_tokens(documents(spark, sf_dir), "text", out="words")
    return widened(out.select("doc_id", F.size("words").alias("n"), digest(F.col("words")).alias("digest")), "n")


@query(
    "ngrams",
    lambda: f"WITH {tokens_sql()} SELECT doc_id, len(bigrams) AS n, md5(array_to_string(bigrams, ' ')) AS digest FROM pairs",
)
def _(spark, sf_dir):
    out = text_encoding.with_tokens(documents(spark, sf_dir), "text", out="words")
    out = out.select("doc_id", ngrams(F.col("words"), 2).alias("pairs"))
    return widened(out.select("doc_id", F.size("pairs").alias("n"), digest(F.col("pairs")).alias("digest")), "n")


@query("term_stats", lambda: f"WITH {tokens_sql()} SELECT term, tf, df FROM stats")
def _(spark, sf_dir):
    return text_encoding.term_stats(documents(spark, sf_dir), "text")


VOCAB_SQL = """vocab AS (
  SELECT term, tf, df, ln((1 + n) / (1.0 + df)) + 1 AS idf FROM (
    SELECT * FROM stats, (SELECT count(*) AS n FROM documents) WHERE df >= 5 AND df <= 0.95 * n
    ORDER BY tf DESC, term LIMIT 500)
)"""


@query(
    "tfidf_vocab",
    lambda: f"""WITH {tokens_sql()}, {VOCAB_SQL}
      SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_index, tf, df, round(idf, 6) AS idf FROM vocab""",
)
def _(spark, sf_dir):
    stats, docs = text_encoding.frequent_stats(documents(spark, sf_dir), "text")
    out = text_encoding.vocabulary(stats.drop("fold"), docs[0])
    return rounded(widened(out, "term_index"), "idf")


@query(
    "fold_vocabularies",
    lambda: f"""WITH {tokens_sql()}, folds AS (SELECT unnest(range(0, 4)) AS fold), counted AS (
        SELECT fold, term, sum(tf) AS tf, count(*) AS df FROM per_doc JOIN folds ON doc_id % 5 <= fold GROUP BY 1, 2
      ), sized AS (SELECT fold, count(*) AS n FROM documents JOIN folds ON doc_id % 5 <= fold GROUP BY 1)
      SELECT c.fold, term, round(ln((1 + n) / (1.0 + df)) + 1, 6) AS idf FROM counted c JOIN sized s ON s.fold = c.fold
      WHERE df >= 5 AND df <= 0.95 * n
      QUALIFY row_number() OVER (PARTITION BY c.fold ORDER BY tf DESC, term) <= 100""",
)
def _(spark, sf_dir):
    """The vocabularies of four growing parts of the documents, from one summary and one count."""
    part = F.col("doc_id") % 5
    docs = documents(spark, sf_dir).withColumn("first_train_fold", F.when(part < 4, part.cast("int")))
    learned = text_encoding.fit_tfidf_folds(docs, "text", 4, EncoderSpec(tfidf_terms=100))
    rows = [(k, term, idf) for k, t in enumerate(learned) for term, idf in zip(t.terms, t.idf)]
    return rounded(spark.createDataFrame(rows, "fold bigint, term string, idf double"), "idf")


WEIGHTS_SQL = """weights AS (
  SELECT doc_id, p.term, p.tf * v.idf AS w FROM per_doc p JOIN vocab v ON v.term = p.term
), tfidf AS (
  SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS tfidf FROM weights
)"""


@query(
    "tfidf",
    lambda: f"WITH {tokens_sql()}, {VOCAB_SQL}, {WEIGHTS_SQL} SELECT doc_id, term, round(tfidf, 6) AS tfidf FROM tfidf",
)
def _(spark, sf_dir):
    docs = text_encoding.tokenised(documents(spark, sf_dir), "text")
    return rounded(text_encoding.fit_tfidf(docs, "text").long(docs), "tfidf")


def hex_sql(start: int) -> str:
    return f"('0x' || substr(md5('text|' || coalesce(text, '')), {start}, 8))::UBIGINT"


HASH_SQL = f"""SELECT doc_id, CAST({hex_sql(1)} % 1000 AS BIGINT) AS bucket,
  CASE WHEN {hex_sql(9)} % 2 = 0 THEN 1 ELSE -1 END AS sign FROM documents"""


@query("feature_hash", f"SELECT doc_id, bucket, CAST(sign AS BIGINT) AS sign FROM ({HASH_SQL})")
def _(spark, sf_dir):
    hashed = text_encoding.HashEncoding("text", EncoderSpec()).long(documents(spark, sf_dir))
    return widened(hashed, "bucket", "sign")


@query("feature_hash_vector", f"SELECT doc_id, bucket, CAST(sign AS DOUBLE) AS value FROM ({HASH_SQL})")
def _(spark, sf_dir):
    """The sparse vector, read back entry by entry."""
    vectors = text_encoding.HashEncoding("text", EncoderSpec()).apply(documents(spark, sf_dir))
    entries = F.transform(
        vector_to_array("text_hash"), lambda v, i: F.struct(i.cast("bigint").alias("bucket"), v.alias("value"))
    )
    listed = vectors.select("doc_id", F.inline_outer(F.filter(entries, lambda e: e["value"] != 0)))
    return listed.filter(F.col("bucket").isNotNull())


LABELLED_DOCS_SQL = """docs AS (
  SELECT d.doc_id, d.lang, d.source, l.quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
)"""


@query(
    "encode_all",
    lambda: f"""WITH {tokens_sql()}, {VOCAB_SQL}, {WEIGHTS_SQL}, {LABELLED_DOCS_SQL}, encoded AS (
        {encode_sql("r.doc_id", ("lang", "source"), "quality", "docs", "docs", SMOOTH_SQL)}
      ) SELECT e.*, t.term, round(t.tfidf, 6) AS tfidf FROM encoded e LEFT JOIN tfidf t ON t.doc_id = e.doc_id""",
)
def _(spark, sf_dir):
    docs = documents(spark, sf_dir, "lang", "source").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    # The join and the tokens, which fit and apply both need, are made once.
    docs = text_encoding.tokenised(docs.select("doc_id", "text", "lang", "source", "quality"), "text")
    learned = encoders.fit_encoders(docs, ["lang", "source"], ["text"], "quality")
    terms = F.lit(learned.text[0].terms)
    weights = F.transform(vector_to_array("text_tfidf"), lambda w, i: F.struct(F.get(terms, i).alias("term"), w.alias("tfidf")))
    kept = F.filter(weights, lambda e: e["tfidf"] > 0)
    out = learned.apply(docs).select("doc_id", "lang_target_enc", "source_target_enc", F.inline_outer(kept))
    return rounded(out, "lang_target_enc", "source_target_enc", "tfidf")


# -------------------------------------------------------------------- models

FORECAST = PipelineSpec(
    panel=PanelSpec(
        customer_col="o_custkey", date_col="period",
        high_cardinality_cols=("c_mktsegment",), skewed_cols=("transaction_amount", "c_acctbal"),
        numeric_id_cols=("c_nationkey",),
    ),
    # A small model on purpose: the spec is a parameter of the query's operators.
    model=ModelSpec(kind="gbt", rounds=10, params={"maxDepth": 4, "stepSize": 0.2, "seed": 42}, patience=3),
)


def forecast_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepare.build_panel(
        table(spark, sf_dir, "orders"), FORECAST,
        source_customer="o_custkey", source_date="o_orderdate", amount="o_totalprice",
    )
    who = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    return rows.join(who, "o_custkey", "left")


@query("model_cv_predictions")
def _(spark, sf_dir):
    """Out-of-fold forecasts of a boosted-tree model, all folds."""
    features = materialise(prepare.stateless_features(forecast_features(spark, sf_dir), FORECAST))
    return train.cross_validate(features, FORECAST).predictions


def fitted(spark: SparkSession, sf_dir: str):
    rows = materialise(forecast_features(spark, sf_dir))
    features = materialise(prepare.stateless_features(rows, FORECAST))
    return rows, train.fit_forecaster(features, FORECAST)


@query("model_importance")
def _(spark, sf_dir):
    return fitted(spark, sf_dir)[1].model.importance(spark)


@query("model_scores")
def _(spark, sf_dir):
    """Forecast of every customer's newest month, with the history behind it."""
    rows, forecaster = fitted(spark, sf_dir)
    w = Window.partitionBy("o_custkey").orderBy("period")
    marked = rows.withColumn("_newest", F.lead("period").over(w).isNull())
    newest = marked.filter("_newest").drop("_newest")
    history = marked.filter(~F.col("_newest")).drop("_newest")
    return score.score(newest, forecaster, history)
