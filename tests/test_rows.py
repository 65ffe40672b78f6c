"""Hand-made edge rows."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from txlens.functions import money, rules
from txlens.functions import timeparts as tp
from txlens.functions.money import money_avg, money_sum, percentage, round_half_up
from txlens.operators import (anomalies, cleaning, correlation, customers, features, joins,
                              lookup, ordering, profile, quantiles, returned, sales)


def values(df, column):
    return [row[column] for row in df.collect()]


def test_dates(spark):
    df = spark.createDataFrame(
        [("12/1/2010 8:26",), ("12/13/2010 08:26",), ("zz",), (None,)], "InvoiceDate string")
    assert values(features.with_invoice_time(df), "InvoiceDate") == [
        datetime(2010, 12, 1, 8, 26), datetime(2010, 12, 13, 8, 26), None, None]


def test_header_blanks(spark):
    df = spark.createDataFrame([(1, "x")], "` Quantity` int, `Country ` string")
    assert cleaning.strip_column_names(df).columns == ["Quantity", "Country"]


def test_number_text(spark):
    df = spark.createDataFrame([("5",), ("C536",), ("",), (None,), ("NaN",)], "q string")
    assert values(cleaning.coerce_numeric(df, ["q", "absent"]), "q") == [5, None, None, None, None]
    assert values(cleaning.require_numbers(df, ["q"]), "q") == [5]


def test_revenue_edges(spark):
    df = spark.createDataFrame([(300.0,), (300.01,), (1000.0,), (1000.01,)], "TotalPrice double")
    assert values(features.with_revenue_category(df), "RevenueCategory") == [
        "Low", "Medium", "Medium", "High"]


def test_reason_precedence(spark):
    df = spark.createDataFrame(
        [(101.0, 2000.0, 200.0), (101.0, 2000.0, 100.0), (101.0, 1000.0, 1.0), (100.0, 1.0, 1.0)],
        "Quantity double, TotalPrice double, UnitPrice double")
    assert values(df.select(rules.anomaly_reason().alias("r")), "r") == [
        "Expensive Product", "High Transaction", "Large Quantity", "Normal"]


def test_customer_labels(spark):
    df = spark.createDataFrame(
        [(5001.0, 51, 0), (5001.0, 50, 0), (2000.0, 21, 0), (2000.0, 20, 91), (1.0, 1, 90)],
        "Monetary double, Frequency int, Recency int")
    assert values(df.select(rules.customer_segment().alias("s")), "s") == [
        "VIP Customer", "Loyal Customer", "Frequent Buyer", "Inactive Customer",
        "Low Value Customer"]
    spent = spark.createDataFrame([(5000.01,), (5000.0,), (1000.0,)], "TotalSpent double")
    assert values(spent.select(rules.customer_type().alias("t")), "t") == [
        "VIP", "Regular", "Low Value"]


def test_rate_levels(spark):
    df = spark.createDataFrame([(10.0,), (10.1,), (5.0,), (5.1,)], "r double")
    assert values(df.select(rules.rate_level(F.col("r")).alias("x")), "x") == [
        "Watch", "High", "Normal", "Watch"]
    assert values(df.select(rules.rate_alert(F.col("r")).alias("x")), "x") == [
        "Safe", "Alert", "Safe", "Safe"]


def test_encoder_ties(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "b", "a", "c", "a", "d", None]], "k string")
    by_count = {r["k"]: r["c"] for r in lookup.encode_by_frequency(df, "k", "c").collect()}
    assert by_count == {"a": 0, "b": 1, "c": 2, "d": 3, None: 4}
    codes = lookup.frequency_codes(df, "k", "c")
    unseen = spark.createDataFrame([("z",), ("a",)], "k string")
    assert {r["k"]: r["c"] for r in lookup.apply_codes(unseen, codes, "k", "c", 4.0).collect()} \
        == {"z": 4, "a": 0}
    by_name = {r["k"]: r["c"] for r in lookup.encode_alphabetical(df, "k", "c").collect()}
    assert by_name == {"a": 0, "b": 1, "c": 2, "d": 3, None: -1}


def test_weekdays(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 5),)], "t timestamp").select(
        tp.weekday_number("t"), tp.weekday_number("t", "monday"), tp.day_name("t"),
        tp.month_label("t"), tp.timestamp_text("t"), tp.calendar_day("t"))
    assert tuple(df.first()) == (1.0, 0.0, "Monday", "2024-01", "2024-01-01 05:00:00",
                                 date(2024, 1, 1))
    with pytest.raises(ValueError):
        tp.weekday_number("t", "friday")


def test_id_text(spark):
    df = spark.createDataFrame([("17850.0",), ("x",), (None,)], "c string")
    assert values(df.select(tp.id_text("c").alias("c")), "c") == ["17850", None, None]


def test_missing_weekday_stays(spark):
    rows = [(datetime(2024, 1, day), 1.5) for day in (1, 2, 3, 4, 5, 6)]
    df = spark.createDataFrame(rows, "InvoiceDate timestamp, TotalPrice double")
    assert values(sales.weekday_revenue(df), "Revenue") == [1.5] * 6 + [None]


def test_heatmap_fills_zero(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 5), 2.0)],
                               "InvoiceDate timestamp, TotalPrice double")
    row = sales.weekday_hour_heatmap(df).first()
    assert (row["Day"], row["H05"], row["H06"]) == ("Monday", 2.0, 0.0)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in range(11)], "v double")
    assert values(profile.histogram(df, "v", 5), "Count") == [2, 2, 2, 2, 3]
    same = spark.createDataFrame([(7.0,), (7.0,), (None,)], "v double")
    assert values(profile.histogram(same, "v", 3), "Count") == [2, 0, 0]


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0)],
                               "a double, b double, c double")
    found = {(r["Left"], r["Right"]): r["Correlation"]
             for r in correlation.correlation_pairs(df, ["a", "b", "c"]).collect()}
    assert found[("a", "b")] == pytest.approx(1.0)
    assert found[("a", "c")] is None and found[("b", "c")] is None
    own = {r["Feature"]: r for r in correlation.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert own["a"]["a"] == 1.0 and own["c"]["c"] is None


@pytest.mark.parametrize("count,first,delta", [(5, 2.0, 50.0), (1, 0.0, 0.0), (0, 0.0, 0.0)])
def test_halves(spark, count, first, delta):
    rows = [(datetime(2024, 1, 1), 1.0, f"k{i}") for i in range(count)]
    df = spark.createDataFrame(rows, "InvoiceDate timestamp, TotalPrice double, RowKey string")
    row = ordering.revenue_delta(df, "RowKey").first()
    assert (row["Rows"], row["FirstHalf"], row["RevenueDelta"]) == (count, first, delta)
    assert row["SecondHalf"] == (count - first if count > 1 else 0.0)


def test_money_is_exact(spark):
    cases = [[1.00004] * 3, [0.1] * 10, [float("nan"), 2.5, None], [-0.000001, 1e9, 3e-12], [1e16, 0.25], [float("inf"), 1.0],
             [float("nan")], [123456.654321, -99999.999999] * 500]
    for values in cases:
        df = spark.createDataFrame([(v,) for v in values], "v double")
        total, mean, rounded = df.agg(money.money_sum("v"), money.money_avg("v"), money.round_half_up(F.max("v"), 2)).first()
        real = [v for v in values if v is not None and not math.isnan(v)]
        assert total == (math.fsum(real) if real else None)
        assert mean == (pytest.approx(math.fsum(real) / len(real)) if real else None)
    assert spark.sql("SELECT 1e20 AS v").select(money.round_half_up("v", 2)).first()[0] == 1e20


def test_histogram_leaves_out_nan(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 9.0, 10.0, float("nan"), None)], "v double")
    assert [r["Count"] for r in profile.histogram(df, "v", 2).collect()] == [2, 2]
    assert quantiles.exact_quantiles(df, ["v"], [0.5]) == {"v": [5.0]}


def test_search_patterns(spark):
    df = spark.createDataFrame(
        [("C5", "1", 1), ("c6", None, 1), (None, "cx", 1), ("C7", "2", 0), ("a.b", "3", 1)],
        "InvoiceNo string, CustomerID string, anomaly int")
    assert anomalies.search_anomalies(df, "^c").count() == 3
    assert anomalies.search_anomalies(df, "a.b", literal=True).count() == 1
    assert anomalies.search_anomalies(df, "zz").count() == 0


def test_returns(spark):
    df = spark.createDataFrame(
        [("x", -2.0, -10.0), ("x", 3.0, 9.0), (None, -1.0, -1.0)],
        "Description string, Quantity double, TotalPrice double")
    row = returned.return_kpis(df).first()
    assert (row["Returns"], row["ReturnValue"], row["ReturnPercent"]) == (2, 11.0, 66.7)
    assert [tuple(r) for r in returned.returns_by_product(df).collect()] == [("x", 2.0)]


def test_filters(spark):
    df = spark.createDataFrame([(1.0, 0, "a"), (2.0, 1, "a"), (3.0, 0, "b")],
                               "TotalPrice double, anomaly int, Country string")
    assert sales.filter_transactions(df).count() == 3
    assert sales.filter_transactions(df, 1.0, 2.0).count() == 2
    assert sales.filter_transactions(df, kind="anomaly").count() == 1
    assert sales.filter_transactions(df, country="b", kind="normal").count() == 1


def test_empty_tables_give_zeros(spark):
    df = spark.createDataFrame([], "Quantity double, UnitPrice double, TotalPrice double, "
                               "anomaly int, InvoiceDate timestamp, Hour double, Country string")
    kpis = sales.headline_kpis(df).first()
    assert (kpis["Transactions"], kpis["AnomalyPercent"], kpis["Revenue"]) == (0, 0.0, None)
    assert anomalies.anomaly_summary(df).first()["EstimatedLoss"] == 0.0
    assert values(anomalies.anomaly_distribution(df), "Percent") == [0.0, 0.0]
    assert returned.return_kpis(df).first()["ReturnValue"] == 0.0
    assert profile.document_counts(df).first()["AnomalyPercent"] == 0.0
    assert cleaning.cleaning_report(df).first()["KeptPercent"] == 0.0
    assert values(profile.column_profile(df), "NullPercent") == [0.0] * 7
    assert joins.consistency_check(df, df, "Country").first()["Status"] == "INVALID"
    assert joins.integration_stats(df, df).first()["AnomalyPercent"] == 0.0
    assert profile.box_summary(df, "TotalPrice").count() == 2
    assert values(profile.histogram(df, "TotalPrice", 3), "Count") == [0, 0, 0]
    assert ordering.page_count(df).first()["Pages"] == 1


def test_foreign_document_is_noticed(spark):
    everything = spark.createDataFrame([("a",), ("b",)], "k string")
    subset = spark.createDataFrame([("z", 1)], "k string, extra int")
    row = joins.consistency_check(everything, subset, "k").first()
    assert row["SubsetByCount"] and row["MissingKeys"] == 1 and row["FieldsOnlyInDocuments"] == 1


def test_country_without_normal_rows(spark):
    df = spark.createDataFrame([("a", 1), ("b", 0), ("b", 1), (None, 1)],
                               "Country string, anomaly int")
    expected = {("a", 1, 0, 1, 100.0), ("b", 1, 1, 2, 50.0)}
    columns = ["Country", "Anomalies", "Normals", "Total", "AnomalyPercent"]
    for found in (joins.merge_country_counts(df), anomalies.anomaly_rate_by_country(df)):
        assert {tuple(r) for r in found.select(columns).collect()} == expected


def test_single_line_customer_has_no_deviation(spark):
    df = spark.createDataFrame([("c", 2.0, 1.0)], "CustomerID string, TotalPrice double, "
                               "Quantity double")
    rows = features.fill_defaults(features.with_customer_features(df))
    assert rows.first()["CustomerPriceStd"] == 0.0


def test_customers_without_rows_of_their_own_frequency(spark):
    rows = [("c", "i1", datetime(2024, 1, 1), 10.0, 1.0), ("c", "i1", datetime(2024, 1, 1), 5.005, 1.0),
            ("d", "i2", datetime(2024, 3, 1), 1.0, 2.0)]
    df = spark.createDataFrame(rows, "CustomerID string, InvoiceNo string, InvoiceDate timestamp, "
                               "TotalPrice double, Quantity double")
    found = {r["CustomerID"]: r for r in customers.customer_rfm(df).collect()}
    assert found["c"]["Frequency"] == 1 and found["c"]["Recency"] == 60
    assert found["c"]["Monetary"] == 15.01 and found["d"]["Recency"] == 0


def test_money(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (-0.3,), (1e12,), (None,)], "v double")
    row = df.agg(money_sum("v").alias("s"), money_avg("v").alias("a")).first()
    assert row["s"] == 1e12 and row["a"] == 2.5e11
    assert df.where("v is null").agg(money_sum("v").alias("s")).first()["s"] is None
    cents = spark.range(10_000).select((F.col("id") * 0.01).alias("v"))
    assert cents.agg(money_sum("v").alias("s")).first()["s"] == 499950.0
    ties = spark.createDataFrame([(1.005,), (58306.924999999996,)], "v double")
    assert values(ties.select(round_half_up("v", 2).alias("r")), "r") == [1.01, 58306.93]
    none = spark.createDataFrame([(1, 0)], "a int, b int")
    assert none.select(percentage("a", "b", 1).alias("p")).first()["p"] == 0.0
