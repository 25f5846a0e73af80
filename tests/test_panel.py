from datetime import date

from pyspark.sql import functions as F

from plans import count
from tallycast.config import PanelSpec, PipelineSpec
from tallycast.operators.panel import dense_panel, forward_label, periodic_panel
from tallycast.plans.prepare import build_panel


def months(*ms):
    return [date(2021 + (m - 1) // 12, (m - 1) % 12 + 1, 1) for m in ms]


def test_panel_counts_and_drops_null_keys(spark):
    df = spark.createDataFrame(
        [(1, date(2021, 1, 3), 2.0), (1, date(2021, 1, 9), 3.0), (None, date(2021, 1, 1), 1.0), (1, None, 1.0)],
        "c long, d date, v double",
    )
    out = periodic_panel(df, "c", "d", measures={"v": F.sum("v")}).collect()
    assert [tuple(r) for r in out] == [(1, date(2021, 1, 1), 2, 5.0)]


def test_dense_panel_fills_gaps(spark):
    rows = [(1, d, n, 1.5, "x") for d, n in zip(months(1, 4, 5), (3, 1, 2))] + [(2, months(2)[0], 7, None, "y")]
    df = spark.createDataFrame(rows, "c long, period date, txn_count long, amount double, seg string")
    out = dense_panel(df, "c", constant=["seg"]).orderBy("c", "period").collect()
    assert [r["txn_count"] for r in out if r["c"] == 1] == [3, 0, 0, 1, 2]
    assert [r["period"] for r in out if r["c"] == 1] == months(1, 2, 3, 4, 5)
    assert [r["amount"] for r in out if r["c"] == 1] == [1.5, None, None, 1.5, 1.5]
    assert {r["seg"] for r in out if r["c"] == 1} == {"x"}
    assert len([r for r in out if r["c"] == 2]) == 1


def test_dense_panel_until_a_date(spark):
    df = spark.createDataFrame([(1, months(11)[0], 3)], "c long, period date, txn_count long")
    out = dense_panel(df, "c", until=F.lit(date(2022, 2, 1))).orderBy("period").collect()
    assert [tuple(r) for r in out] == list(zip([1] * 4, months(11, 12, 13, 14), [3, 0, 0, 0]))


def test_silent_customers_get_labels(spark):
    """A customer's rows go on to the newest period of the data, and silence counts as zero."""
    rows = [(1, date(2021, 1, 5), 1.0), (2, date(2021, 1, 9), 1.0), (2, date(2021, 6, 9), 1.0)]
    spec = PipelineSpec(panel=PanelSpec(customer_col="c", date_col="period"))
    df = spark.createDataFrame(rows, "c long, d date, v double")
    out = build_panel(df, spec, source_customer="c", source_date="d", amount="v")
    mine = out.filter("c = 1").orderBy("period").collect()
    assert [r["txn_count"] for r in mine] == [1, 0, 0, 0, 0, 0]
    assert [r["next_3m_txn_count"] for r in mine] == [0, 0, 0, None, None, None]


def test_forward_label_needs_all_periods(spark):
    df = spark.createDataFrame(
        [(1, d, n) for d, n in zip(months(1, 2, 3, 4), (1, 0, 2, 4))], "c long, period date, txn_count long"
    )
    out = forward_label(df, "c").orderBy("period").collect()
    assert [r["next_3m_txn_count"] for r in out] == [6, None, None, None]


def test_panel_label_shuffles_twice(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    out = forward_label(dense_panel(periodic_panel(orders, "o_custkey", "o_orderdate"), "o_custkey"), "o_custkey")
    assert count(out, "Exchange") == 2
