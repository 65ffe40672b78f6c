"""All queries. ``CATALOG[name]`` holds the operator ids, the query and its SQL twin."""

from dataclasses import replace
from typing import NamedTuple

from pyspark.sql import functions as F

from catalog.frames import (LAYERS_SQL, cleaned, featured, flagged, mavg, msum, priced, raw,
                            rounded, scored_features, timed)
from txlens.functions import timeparts as tp
from txlens.functions.money import percentage
from txlens.functions.rules import revenue_category
from txlens.operators import (anomalies, cleaning, correlation, customers, features, forest, joins, lookup, ordering,
                              pages, profile, quantiles, returned, sales, sketches)
from txlens.params import FOREST_FEATURES, FOREST_SAMPLE, FOREST_SEED, FOREST_TREES
from txlens.plans import run, stages
from txlens.schemas import NUMERIC_FEATURES, REPORT_COLUMNS, SAMPLE_COLUMNS, WAREHOUSE_COLUMNS
from txlens.sources import bucketed, files, publishing, warehouse
from txlens.sources.retail_tables import TABLE_LIMITS
from txlens.staging import run_folder, stage

CATALOG = {}


class Query(NamedTuple):
    ids: str
    run: object
    sql: str | None


def add(name, ids, run, sql=None):
    CATALOG[name] = Query(ids, run, LAYERS_SQL + sql if sql else None)


def rounding(df, digits, *columns):
    return df.withColumns({name: F.round(name, digits) for name in columns})


def new_folder(spark):
    import uuid

    return f"{run_folder(spark)}/query-{uuid.uuid4().hex}"


# --- cleaning --------------------------------------------------------------------------

add("complete_rows", "C1",
    lambda s, d: cleaning.drop_incomplete(raw(s, d)).select("RowKey", "CustomerID", "Quantity"),
    "SELECT RowKey, CustomerID, Quantity FROM raw WHERE CustomerID IS NOT NULL")

add("positive_quantity_rows", "C2",
    lambda s, d: cleaning.filter_positive_quantity(raw(s, d)).select("RowKey", "Quantity"),
    "SELECT RowKey, Quantity FROM raw WHERE Quantity > 0")

add("positive_price_rows", "C3",
    lambda s, d: cleaning.filter_positive_price(raw(s, d)).select("RowKey", "UnitPrice"),
    "SELECT RowKey, UnitPrice FROM raw WHERE UnitPrice > 0")

add("total_price", "C4",
    lambda s, d: cleaning.with_total_price(raw(s, d)).select("RowKey", "TotalPrice"),
    "SELECT RowKey, TotalPrice FROM priced")

add("cleaned_lines", "P1",
    lambda s, d: cleaned(s, d),
    """SELECT InvoiceNo, StockCode, Description, Quantity,
              strftime(InvoiceDate, '%-m/%-d/%Y %-H:%M') AS InvoiceDate, UnitPrice,
              CustomerID, Country, RowKey, TotalPrice FROM timed""")


def _text_quantities(s, d):
    bad = F.col("StockCode").endswith("7")
    text = F.when(bad, F.concat(F.lit("C"), F.col("InvoiceNo"))).otherwise(
        F.col("Quantity").cast("string"))
    return raw(s, d).select("RowKey", text.alias("Quantity"), "UnitPrice")


add("coerced_numbers", "C5",
    lambda s, d: cleaning.coerce_numeric(_text_quantities(s, d), ["Quantity"]),
    """SELECT RowKey, UnitPrice, TRY_CAST(CASE WHEN StockCode LIKE '%7' THEN 'C' || InvoiceNo
              ELSE CAST(Quantity AS VARCHAR) END AS DOUBLE) AS Quantity FROM raw""")

add("required_numbers", "C5",
    lambda s, d: cleaning.require_numbers(_text_quantities(s, d), ["Quantity", "UnitPrice"])
    .agg(F.count("*").alias("Rows"), F.sum("Quantity").alias("Quantity")),
    """SELECT count(*) AS Rows, sum(Quantity) AS Quantity FROM raw
       WHERE StockCode NOT LIKE '%7'""")

add("filled_customer_features", "C6",
    lambda s, d: rounding(features.fill_defaults(features.customer_features(cleaned(s, d))), 4,
                          "CustomerPriceStd"),
    f"""SELECT CustomerID, AvgCustomerSpend, CAST(CustomerFrequency AS BIGINT)
               AS CustomerFrequency, CustomerTotalQty,
               {rounded('CustomerPriceStd', 4)} AS CustomerPriceStd FROM customer_stats""")

add("numeric_casts", "C7",
    lambda s, d: features.cast_numeric(
        timed(s, d).withColumn("Quantity", F.col("Quantity").cast("int"))
    ).select("RowKey", "Quantity", "Hour", "WeekdayNum"),
    "SELECT RowKey, Quantity, Hour, WeekdayNum FROM timed")

_sample_fields = [c for c in SAMPLE_COLUMNS if c != "InvoiceDate"]
add("featured_sample", "C8 I3",
    lambda s, d: features.project_available(
        ordering.preview(featured(s, d).drop("InvoiceDate"), 100, "RowKey"), SAMPLE_COLUMNS),
    f"SELECT {', '.join(_sample_fields)} FROM featured ORDER BY RowKey LIMIT 100")

_report_fields = [c for c in REPORT_COLUMNS if c not in ("InvoiceDate", "CustomerPriceStd")]
add("featured_report_sample", "C8 I3 B6",
    lambda s, d: features.project_available(
        ordering.preview(featured(s, d).drop("InvoiceDate", "CustomerPriceStd"), 20, "RowKey"),
        REPORT_COLUMNS),
    f"SELECT {', '.join(_report_fields)} FROM featured ORDER BY RowKey LIMIT 20")

add("anomalous_rows", "C9",
    lambda s, d: anomalies.split_anomaly(flagged(s, d))[0].select("RowKey", "TotalPrice"),
    "SELECT RowKey, TotalPrice FROM flagged WHERE anomaly = 1")

add("normal_rows", "C9",
    lambda s, d: anomalies.split_anomaly(flagged(s, d))[1].select("RowKey", "TotalPrice"),
    "SELECT RowKey, TotalPrice FROM flagged WHERE anomaly = 0")

add("filtered_transactions", "C10",
    lambda s, d: sales.filter_transactions(flagged(s, d), 20_000, 60_000, "normal", "NATION_3")
    .select("RowKey", "Country", "TotalPrice", "anomaly"),
    """SELECT RowKey, Country, TotalPrice, anomaly FROM flagged
       WHERE TotalPrice BETWEEN 20000 AND 60000 AND anomaly = 0 AND Country = 'NATION_3'""")

add("filtered_anomalies", "C10",
    lambda s, d: sales.filter_transactions(flagged(s, d), price_min=98_000, kind="anomaly")
    .select("RowKey", "Country", "TotalPrice", "anomaly"),
    """SELECT RowKey, Country, TotalPrice, anomaly FROM flagged
       WHERE TotalPrice >= 98000 AND anomaly = 1""")

add("searched_anomalies", "C11",
    lambda s, d: anomalies.search_anomalies(flagged(s, d), "^1.*5$")
    .select("RowKey", "InvoiceNo", "CustomerID"),
    """SELECT RowKey, InvoiceNo, CustomerID FROM flagged WHERE anomaly = 1
       AND (regexp_matches(InvoiceNo, '^1.*5$', 'i') OR regexp_matches(CustomerID, '^1.*5$', 'i'))""")

add("searched_anomalies_literal", "C11",
    lambda s, d: anomalies.search_anomalies(flagged(s, d), "42", literal=True)
    .select("RowKey", "InvoiceNo", "CustomerID"),
    """SELECT RowKey, InvoiceNo, CustomerID FROM flagged WHERE anomaly = 1
       AND (contains(InvoiceNo, '42') OR contains(CustomerID, '42'))""")

add("returned_lines", "C12 D9",
    lambda s, d: cleaning.returns(priced(s, d)).select("RowKey", "Quantity", "Quantity_Abs"),
    "SELECT RowKey, Quantity, abs(Quantity) AS Quantity_Abs FROM raw WHERE Quantity < 0")

_raw_columns = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
                "CustomerID", "Country"]
_missing = ", ".join(f"count(*) FILTER ({c} IS NULL) AS Missing_{c}" for c in _raw_columns)
add("cleaning_report", "C13 D11",
    lambda s, d: cleaning.cleaning_report(raw(s, d).select(_raw_columns)),
    f"""SELECT *, InitialRows - RowsComplete AS DroppedIncomplete,
               RowsComplete - RowsPositiveQuantity AS DroppedQuantity,
               RowsPositiveQuantity - RowsPositivePrice AS DroppedPrice,
               InitialRows - RowsPositivePrice AS DroppedTotal,
               {rounded('RowsPositivePrice / InitialRows * 100', 1)} AS KeptPercent
        FROM (SELECT count(*) AS InitialRows, {_missing},
                     count(*) FILTER (CustomerID IS NOT NULL) AS RowsComplete,
                     count(*) FILTER (CustomerID IS NOT NULL AND Quantity > 0)
                       AS RowsPositiveQuantity,
                     count(*) FILTER (CustomerID IS NOT NULL AND Quantity > 0 AND UnitPrice > 0)
                       AS RowsPositivePrice FROM raw)""")

add("revenue_categories", "C14",
    lambda s, d: cleaned(s, d).select(
        "RowKey", revenue_category(TABLE_LIMITS).alias("RevenueCategory")),
    "SELECT RowKey, RevenueCategory FROM timed")

add("anomaly_reasons", "C15",
    lambda s, d: flagged(s, d).select("RowKey", "anomaly_reason"),
    "SELECT RowKey, anomaly_reason FROM flagged")

add("status_labels", "C20",
    lambda s, d: anomalies.with_status(flagged(s, d)).groupBy("Status")
    .agg(F.count("*").alias("Count")),
    """SELECT CASE WHEN anomaly = 1 THEN 'Anomaly' ELSE 'Normal' END AS Status,
              count(*) AS Count FROM flagged GROUP BY Status""")

for _name, _frame, _table, _rows, _ids in (
    ("sampled_transactions", flagged, "flagged", 2000, "C21"),
    ("sampled_anomalies", lambda s, d: anomalies.only_anomalies(flagged(s, d)),
     "flagged WHERE anomaly = 1", 1000, "C21"),
):
    add(_name, _ids,
        lambda s, d, f=_frame, n=_rows: ordering.sample_n(
            f(s, d).select("RowKey", "Quantity", "UnitPrice", "TotalPrice", "anomaly"),
            n, 42, "RowKey"),
        f"""SELECT RowKey, Quantity, UnitPrice, TotalPrice, anomaly FROM {_table}
            ORDER BY md5(RowKey || '|42'), RowKey LIMIT {_rows}""")

add("sampled_customers", "C21 F23",
    lambda s, d: ordering.sample_n(
        customers.customer_spend_frequency(cleaned(s, d)), 500, 42, "CustomerID"),
    f"""SELECT CustomerID, {msum('TotalPrice')} AS TotalSpend, count(*) AS Frequency
        FROM timed GROUP BY CustomerID ORDER BY md5(CustomerID || '|42'), CustomerID LIMIT 500""")

# --- scalar functions ------------------------------------------------------------------

add("time_features", "D1 D2 D3 D4",
    lambda s, d: timed(s, d).select("RowKey", "Hour", "Day", "MonthNum", "WeekdayNum", "Month"),
    "SELECT RowKey, Hour, Day, MonthNum, WeekdayNum, Month FROM timed")

add("time_labels", "D3 D5 D6 D12",
    lambda s, d: features.with_invoice_time(raw(s, d)).select(
        "RowKey", tp.weekday_number("InvoiceDate", "monday").alias("MondayBased"),
        tp.day_name("InvoiceDate").alias("DayOfWeek"),
        tp.calendar_day("InvoiceDate").alias("Date"),
        tp.timestamp_text("InvoiceDate").alias("InvoiceTime")),
    """SELECT RowKey, CAST(isodow(InvoiceDate) - 1 AS DOUBLE) AS MondayBased,
              dayname(InvoiceDate) AS DayOfWeek, CAST(InvoiceDate AS DATE) AS Date,
              strftime(InvoiceDate, '%Y-%m-%d %H:%M:%S') AS InvoiceTime FROM raw""")


def _unreadable_dates(s, d):
    text = F.when(F.col("StockCode").endswith("7"), F.lit("zz")).otherwise(F.col("InvoiceDate"))
    return features.with_invoice_time(raw(s, d).withColumn("InvoiceDate", text))


add("unreadable_dates", "D1",
    lambda s, d: _unreadable_dates(s, d).agg(
        F.count("*").alias("Rows"), F.count_if(F.col("InvoiceDate").isNull()).alias("Unreadable")),
    """SELECT count(*) AS Rows, count(*) FILTER (StockCode LIKE '%7') AS Unreadable FROM raw""")

add("days_since_purchase", "D7 D8 D10",
    lambda s, d: timed(s, d).select(
        "RowKey",
        tp.days_between(F.lit("2002-01-01").cast("date"), F.col("InvoiceDate")).alias("Days"),
        F.round("TotalPrice", 2).alias("Total"),
        F.col("CustomerID").cast("double").alias("CustomerID"),
    ).withColumn("CustomerID", tp.id_text("CustomerID")),
    f"""SELECT RowKey, CAST(date_diff('day', CAST(InvoiceDate AS DATE), DATE '2002-01-01')
               AS INTEGER) AS Days, {rounded('TotalPrice', 2)} AS Total, CustomerID FROM timed""")

add("flagged_percentage", "D11",
    lambda s, d: flagged(s, d).groupBy("Country").agg(
        F.count("*").alias("Rows"), F.sum("anomaly").alias("Flagged"),
        F.count_if(F.col("Quantity") > 1000).alias("Bulk"),
    ).select("Country", percentage("Flagged", "Rows", 2).alias("Percent"),
             percentage("Flagged", "Bulk", 1).alias("OfNothing")),
    f"""SELECT Country, {rounded('sum(anomaly) / count(*) * 100', 2)} AS "Percent",
               0.0::DOUBLE AS OfNothing FROM flagged GROUP BY Country""")

# --- statistics ------------------------------------------------------------------------

add("raw_stats", "F1",
    lambda s, d: rounding(profile.raw_stats(raw(s, d)), 4, "AvgUnitPrice"),
    """SELECT min(Quantity) AS MinQuantity, max(Quantity) AS MaxQuantity,
              avg(Quantity) AS AvgQuantity, min(UnitPrice) AS MinUnitPrice,
              max(UnitPrice) AS MaxUnitPrice, round(avg(UnitPrice), 4) AS AvgUnitPrice FROM raw""")

add("total_price_stats", "F2",
    lambda s, d: rounding(profile.total_price_stats(cleaned(s, d)), 4, "StdTotalPrice"),
    f"""SELECT min(TotalPrice) AS MinTotalPrice, max(TotalPrice) AS MaxTotalPrice,
               round(stddev_samp(TotalPrice), 4) AS StdTotalPrice,
               {mavg('TotalPrice')} AS AvgTotalPrice FROM timed""")

add("time_feature_stats", "F3",
    lambda s, d: profile.time_feature_stats(timed(s, d)),
    """SELECT min(Hour) AS MinHour, max(Hour) AS MaxHour, avg(Hour) AS AvgHour,
              min(Day) AS MinDay, max(Day) AS MaxDay, min(MonthNum) AS MinMonth,
              max(MonthNum) AS MaxMonth FROM timed""")

add("product_frequency_stats", "F4",
    lambda s, d: rounding(profile.product_frequency_stats(
        features.with_product_frequency(cleaned(s, d))), 6, "AvgFrequency", "StdFrequency"),
    """SELECT CAST(min(ProductFrequency) AS BIGINT) AS MinFrequency,
              CAST(max(ProductFrequency) AS BIGINT) AS MaxFrequency,
              round(avg(ProductFrequency), 6) AS AvgFrequency,
              round(stddev_samp(ProductFrequency), 6) AS StdFrequency FROM featured""")

add("customer_feature_stats", "F5",
    lambda s, d: rounding(profile.customer_feature_stats(featured(s, d)), 4,
                          "AvgSpend", "AvgFrequency", "AvgTotalQty", "AvgPriceStd"),
    """SELECT min(AvgCustomerSpend) AS MinSpend, max(AvgCustomerSpend) AS MaxSpend,
              round(avg(AvgCustomerSpend), 4) AS AvgSpend,
              max(CustomerFrequency) AS MaxFrequency,
              round(avg(CustomerFrequency), 4) AS AvgFrequency,
              max(CustomerTotalQty) AS MaxTotalQty, round(avg(CustomerTotalQty), 4) AS AvgTotalQty,
              round(avg(CustomerPriceStd), 4) AS AvgPriceStd FROM featured""")

add("load_stats", "F6",
    lambda s, d: profile.load_stats(cleaned(s, d)),
    f"""SELECT count(*) AS TotalRecords, min(TotalPrice) AS MinPrice, max(TotalPrice) AS MaxPrice,
               {mavg('TotalPrice')} AS AvgPrice, min(Quantity) AS MinQty, max(Quantity) AS MaxQty,
               avg(Quantity) AS AvgQty FROM timed""")

# --- sales -----------------------------------------------------------------------------

add("rows_by_country", "F7",
    lambda s, d: sales.rows_by_country(raw(s, d)),
    "SELECT Country, count(*) AS Rows FROM raw GROUP BY Country ORDER BY Rows DESC, Country LIMIT 10")

add("rows_by_country_loaded", "F7",
    lambda s, d: sales.rows_by_country(cleaned(s, d), 5),
    "SELECT Country, count(*) AS Rows FROM timed GROUP BY Country ORDER BY Rows DESC, Country LIMIT 5")

add("revenue_category_distribution", "F8",
    lambda s, d: sales.revenue_category_distribution(timed(s, d)),
    "SELECT RevenueCategory, count(*) AS Count FROM timed GROUP BY RevenueCategory")

add("revenue_category_of_anomalies", "F8",
    lambda s, d: sales.revenue_category_distribution(anomalies.only_anomalies(flagged(s, d))),
    """SELECT RevenueCategory, count(*) AS Count FROM flagged WHERE anomaly = 1
       GROUP BY RevenueCategory""")

add("revenue_by_country", "F9",
    lambda s, d: sales.revenue_by_country(cleaned(s, d)),
    f"SELECT Country, {msum('TotalPrice')} AS Revenue FROM timed GROUP BY Country")

add("top_countries_by_revenue", "F9",
    lambda s, d: sales.revenue_by_country(cleaned(s, d), 15),
    f"""SELECT Country, {msum('TotalPrice')} AS Revenue FROM timed GROUP BY Country
        ORDER BY Revenue DESC, Country LIMIT 15""")

add("transactions_by_country", "F10",
    lambda s, d: sales.transactions_by_country(cleaned(s, d)),
    """SELECT Country, count(*) AS Transactions FROM timed GROUP BY Country
       ORDER BY Transactions DESC, Country LIMIT 15""")

add("products_by_lines", "F11",
    lambda s, d: sales.products_by_lines(cleaned(s, d)),
    """SELECT Description, count(*) AS TotalSold FROM timed GROUP BY Description
       ORDER BY TotalSold DESC, Description LIMIT 10""")

add("products_by_quantity", "F12",
    lambda s, d: sales.products_by_quantity(cleaned(s, d)),
    """SELECT Description, sum(Quantity) AS Quantity FROM timed GROUP BY Description
       ORDER BY Quantity DESC, Description LIMIT 10""")

add("products_by_revenue", "F13",
    lambda s, d: sales.products_by_revenue(cleaned(s, d)),
    f"""SELECT Description, {msum('TotalPrice')} AS Revenue FROM timed GROUP BY Description
        ORDER BY Revenue DESC, Description LIMIT 10""")

add("product_summary", "F14",
    lambda s, d: sales.product_summary(cleaned(s, d)),
    f"""SELECT Description, sum(Quantity) AS Volume, {msum('TotalPrice')} AS Revenue,
               count(TotalPrice) AS Transactions FROM timed GROUP BY Description
        ORDER BY Revenue DESC, Description LIMIT 50""")

add("top_products", "F15",
    lambda s, d: rounding(sales.top_products(cleaned(s, d)), 4, "AvgPrice"),
    """SELECT StockCode, Description, count(*) AS TransactionCount,
              sum(Quantity) AS TotalQuantity, round(avg(UnitPrice), 4) AS AvgPrice FROM timed
       GROUP BY StockCode, Description
       ORDER BY TransactionCount DESC, StockCode, Description LIMIT 10""")

add("top_product_frequency", "F16",
    lambda s, d: sales.top_product_frequency(features.with_product_frequency(cleaned(s, d))),
    """SELECT StockCode, CAST(ProductFrequency AS BIGINT) AS Frequency FROM product_stats
       ORDER BY Frequency DESC, StockCode LIMIT 10""")

_kpis_sql = f"""SELECT count(*) AS Transactions, {rounded(msum('TotalPrice'), 2)} AS Revenue,
  count(*) FILTER (anomaly = 1) AS Anomalies, count(*) FILTER (anomaly = 0) AS Normals,
  max(TotalPrice) AS MaxTransaction, {rounded(mavg('TotalPrice'), 2)} AS AvgOrderValue,
  {rounded('count(*) FILTER (anomaly = 1) / count(*) * 100', 2)} AS AnomalyPercent,
  count(*) FILTER (anomaly = 1) * {rounded(mavg('TotalPrice'), 2)} AS FraudLoss,
  {rounded('count(*) FILTER (anomaly = 1) * ' + mavg('TotalPrice'), 2)} AS EstimatedLoss
  FROM flagged"""
add("headline_kpis", "F24 D11", lambda s, d: sales.headline_kpis(flagged(s, d)), _kpis_sql)

_targets = replace(TABLE_LIMITS, target_revenue=2.5e12, target_anomalies=300,
                   target_order_value=1e6, target_loss=1e12)
add("kpi_vs_target", "C19",
    lambda s, d: sales.kpi_vs_target(sales.headline_kpis(flagged(s, d)), _targets),
    f"""SELECT least(Revenue / 2.5e12 * 100, 100.0) AS RevenuePercent,
               least(AvgOrderValue / 1e6 * 100, 100.0) AS OrderValuePercent,
               least(Anomalies / 300.0::DOUBLE, 1.0) AS AnomalyProgress,
               CASE WHEN Anomalies > 300 THEN 'Exceeded' ELSE 'Safe' END AS AnomalyStatus,
               least(FraudLoss / 1e12, 1.0) AS LossProgress,
               CASE WHEN FraudLoss > 1e12 THEN 'Exceeded' ELSE 'Safe' END AS LossStatus
        FROM ({_kpis_sql})""")

add("revenue_delta", "F25 Q7",
    lambda s, d: ordering.revenue_delta(timed(s, d), "RowKey"),
    f"""SELECT CAST(count(*) AS BIGINT) AS Rows, {msum('CASE WHEN p <= n // 2 THEN TotalPrice END')} AS FirstHalf,
               {msum('TotalPrice')} - {msum('CASE WHEN p <= n // 2 THEN TotalPrice END')} AS SecondHalf,
               {rounded(f"({msum('TotalPrice')} - 2 * {msum('CASE WHEN p <= n // 2 THEN TotalPrice END')}) / {msum('CASE WHEN p <= n // 2 THEN TotalPrice END')} * 100", 2)} AS RevenueDelta
        FROM (SELECT TotalPrice, count(*) OVER () AS n,
                     row_number() OVER (ORDER BY InvoiceDate, RowKey) AS p FROM timed)""")

_by_hour = f"SELECT Hour, {msum('TotalPrice')} AS Revenue FROM timed GROUP BY Hour"
_by_day_name = f"""SELECT dayname(InvoiceDate) AS Day, {msum('TotalPrice')} AS Revenue
                   FROM timed GROUP BY 1"""
add("peak_hour", "F26", lambda s, d: sales.peak_hour(timed(s, d)),
    f"{_by_hour} ORDER BY Revenue DESC, Hour LIMIT 1")
add("peak_day", "F26", lambda s, d: sales.peak_day(timed(s, d)),
    f"{_by_day_name} ORDER BY Revenue DESC, Day LIMIT 1")
add("daily_revenue", "F27", lambda s, d: sales.daily_revenue(timed(s, d)),
    f"""SELECT CAST(InvoiceDate AS DATE) AS Date, {msum('TotalPrice')} AS Revenue
        FROM timed GROUP BY 1""")
add("hourly_revenue", "F28", lambda s, d: sales.hourly_revenue(timed(s, d)), _by_hour)
_week = "(SELECT CAST(i AS INTEGER) AS DayNum, dayname(DATE '2024-01-01' + CAST(i AS INTEGER)) AS Day FROM range(7) r(i))"
add("weekday_revenue", "F29 Q19", lambda s, d: sales.weekday_revenue(timed(s, d)),
    f"""SELECT w.DayNum, w.Day, Revenue FROM {_week} w
        LEFT JOIN (SELECT isodow(InvoiceDate) - 1 AS n, {msum('TotalPrice')} AS Revenue
                   FROM timed GROUP BY 1) ON n = w.DayNum""")
add("weekday_revenue_closed_day", "F29 Q19",
    lambda s, d: sales.weekday_revenue(timed(s, d).where(F.weekday("InvoiceDate") != 5)),
    f"""SELECT w.DayNum, w.Day, Revenue FROM {_week} w
        LEFT JOIN (SELECT isodow(InvoiceDate) - 1 AS n, {msum('TotalPrice')} AS Revenue
                   FROM timed WHERE isodow(InvoiceDate) <> 6 GROUP BY 1) ON n = w.DayNum""")
add("monthly_revenue", "F30", lambda s, d: sales.monthly_revenue(timed(s, d)),
    f"SELECT Month, {msum('TotalPrice')} AS Revenue FROM timed GROUP BY Month")
add("weekday_hour_revenue", "F31", lambda s, d: sales.weekday_hour_revenue(timed(s, d)),
    f"""SELECT CAST(isodow(InvoiceDate) - 1 AS INTEGER) AS DayNum, dayname(InvoiceDate) AS Day,
               CAST(hour(InvoiceDate) AS INTEGER) AS Hour, {msum('TotalPrice')} AS Revenue
        FROM timed GROUP BY 1, 2, 3""")
_hours = ", ".join(
    f"coalesce({msum(f'CASE WHEN Hour = {h} THEN TotalPrice END')}, 0.0) AS H{h:02d}"
    for h in range(24))
add("weekday_hour_heatmap", "F31", lambda s, d: sales.weekday_hour_heatmap(timed(s, d)),
    f"""SELECT CAST(isodow(InvoiceDate) - 1 AS INTEGER) AS DayNum, dayname(InvoiceDate) AS Day,
               {_hours} FROM timed GROUP BY 1, 2""")

add("top_transactions", "I1",
    lambda s, d: sales.top_transactions(cleaned(s, d), 10, "RowKey"),
    """SELECT InvoiceNo, CustomerID, Description, Quantity, UnitPrice, TotalPrice, Country
       FROM timed ORDER BY TotalPrice DESC, RowKey LIMIT 10""")

# --- customers -------------------------------------------------------------------------

_rfm_sql = f"""SELECT CustomerID, strftime(max(InvoiceDate), '%Y-%m-%d %H:%M:%S')
    AS LastPurchaseDate, count(DISTINCT InvoiceNo) AS Frequency,
    {rounded(msum('TotalPrice'), 2)} AS Monetary, {rounded(mavg('TotalPrice'), 2)} AS AvgTransaction,
    sum(Quantity) AS TotalQuantity,
    CAST(date_diff('day', CAST(max(InvoiceDate) AS DATE),
         (SELECT CAST(max(InvoiceDate) AS DATE) FROM timed)) AS INTEGER) AS Recency
    FROM timed GROUP BY CustomerID"""


def _with_text(df, column):
    return df.withColumn(column, tp.timestamp_text(column))


add("customer_rfm", "F20",
    lambda s, d: _with_text(customers.customer_rfm(timed(s, d)), "LastPurchaseDate"), _rfm_sql)

add("customer_segments", "F21 C16",
    lambda s, d: _with_text(
        customers.customer_segments(timed(s, d), TABLE_LIMITS), "LastPurchaseDate"),
    f"""SELECT *, CASE WHEN Monetary > 2200000 AND Frequency > 8 THEN 'VIP Customer'
                       WHEN Monetary > 1800000 THEN 'Loyal Customer'
                       WHEN Frequency > 7 THEN 'Frequent Buyer'
                       WHEN Recency > 300 THEN 'Inactive Customer'
                       ELSE 'Low Value Customer' END AS Segment FROM ({_rfm_sql})""")

add("customer_behavior", "F22 C17",
    lambda s, d: _with_text(
        customers.customer_behavior(timed(s, d), TABLE_LIMITS), "LastTransactionDate"),
    f"""SELECT *, CASE WHEN TotalSpent > 1800000 THEN 'VIP' WHEN TotalSpent > 800000
                       THEN 'Regular' ELSE 'Low Value' END AS CustomerType
        FROM (SELECT CustomerID, count(DISTINCT InvoiceNo) AS TotalTransactions,
                     {msum('TotalPrice')} AS TotalSpent,
                     {mavg('TotalPrice')} AS AverageTransactionValue,
                     avg(Quantity) AS AverageQuantity,
                     strftime(max(InvoiceDate), '%Y-%m-%d %H:%M:%S') AS LastTransactionDate
              FROM timed GROUP BY CustomerID)""")

add("top_customers_by_avg_spend", "F17 Q5",
    lambda s, d: customers.top_customers_by_avg_spend(featured(s, d)),
    """SELECT CustomerID, max(AvgCustomerSpend) AS AvgSpend,
              max(CustomerFrequency) AS TransactionCount, max(CustomerTotalQty) AS TotalQty,
              min(Country) AS Country FROM featured GROUP BY CustomerID
       ORDER BY AvgSpend DESC, CustomerID LIMIT 10""")

add("top_customers_by_revenue", "F18",
    lambda s, d: customers.top_customers_by_revenue(cleaned(s, d)),
    f"""SELECT CustomerID, {msum('TotalPrice')} AS Revenue FROM timed GROUP BY CustomerID
        ORDER BY Revenue DESC, CustomerID LIMIT 10""")

add("top_customers_by_lines", "F19",
    lambda s, d: customers.top_customers_by_lines(cleaned(s, d)),
    """SELECT CustomerID, count(*) AS Frequency FROM timed GROUP BY CustomerID
       ORDER BY Frequency DESC, CustomerID LIMIT 10""")

add("customer_spend_frequency", "F23",
    lambda s, d: customers.customer_spend_frequency(cleaned(s, d)),
    f"""SELECT CustomerID, {msum('TotalPrice')} AS TotalSpend, count(TotalPrice) AS Frequency
        FROM timed GROUP BY CustomerID""")

# --- anomalies -------------------------------------------------------------------------

add("flagged_lines", "E6",
    lambda s, d: rounding(flagged(s, d).select("RowKey", "anomaly", "anomaly_score"), 6,
                          "anomaly_score"),
    "SELECT RowKey, anomaly, round(anomaly_score, 6) AS anomaly_score FROM flagged")

add("anomaly_distribution", "F32",
    lambda s, d: anomalies.anomaly_distribution(flagged(s, d)),
    f"""SELECT CASE WHEN anomaly = 1 THEN 'Anomaly' ELSE 'Normal' END AS Status,
               count(*) AS Count,
               {rounded('count(*) / (SELECT count(*) FROM flagged) * 100', 1)} AS "Percent"
        FROM flagged GROUP BY 1""")

add("anomaly_distribution_filtered", "F32 C10",
    lambda s, d: anomalies.anomaly_distribution(
        sales.filter_transactions(flagged(s, d), price_min=60_000)),
    f"""SELECT CASE WHEN anomaly = 1 THEN 'Anomaly' ELSE 'Normal' END AS Status,
               count(*) AS Count,
               {rounded('count(*) / (SELECT count(*) FROM flagged WHERE TotalPrice >= 60000) * 100', 1)}
               AS "Percent" FROM flagged WHERE TotalPrice >= 60000 GROUP BY 1""")

_alerts = replace(TABLE_LIMITS, alert_rate=1.5, alert_high=10, alert_watch=1)
add("anomaly_summary", "F33 C18",
    lambda s, d: anomalies.anomaly_summary(flagged(s, d), _alerts),
    f"""SELECT *, CASE WHEN AnomalyPercent > 1.5 THEN 'Alert' ELSE 'Safe' END AS Alert,
               CASE WHEN AnomalyPercent > 10 THEN 'High' WHEN AnomalyPercent > 1 THEN 'Watch'
                    ELSE 'Normal' END AS Level
        FROM (SELECT count(*) AS Transactions, count(*) FILTER (anomaly = 1) AS Anomalies,
                {rounded('count(*) FILTER (anomaly = 1) / count(*) * 100', 2)} AS AnomalyPercent,
                {rounded(mavg('CASE WHEN anomaly = 1 THEN TotalPrice END'), 2)} AS AvgAnomalyPrice,
                {rounded('max(CASE WHEN anomaly = 1 THEN TotalPrice END)', 2)} AS MaxAnomalyPrice,
                {rounded('count(*) FILTER (anomaly = 1) * ' + mavg('TotalPrice'), 2)} AS EstimatedLoss
              FROM flagged)""")

_rate_sql = f"""SELECT Country, count(*) FILTER (anomaly = 1) AS Anomalies,
    count(*) FILTER (anomaly = 0) AS Normals, count(*) AS Total,
    {rounded('count(*) FILTER (anomaly = 1) / count(*) * 100', 1)} AS AnomalyPercent
    FROM flagged GROUP BY Country HAVING Anomalies > 0
    ORDER BY Anomalies DESC, Country LIMIT 15"""
add("anomaly_rate_by_country", "F34",
    lambda s, d: anomalies.anomaly_rate_by_country(flagged(s, d)), _rate_sql)
add("merged_country_counts", "H3",
    lambda s, d: joins.merge_country_counts(flagged(s, d)), _rate_sql)

add("anomaly_count_by_country", "F35",
    lambda s, d: anomalies.anomaly_count_by_country(flagged(s, d)),
    """SELECT Country, count(*) AS Count FROM flagged WHERE anomaly = 1 GROUP BY Country
       ORDER BY Count DESC, Country LIMIT 15""")
add("anomaly_revenue_by_country", "F36",
    lambda s, d: anomalies.anomaly_revenue_by_country(flagged(s, d)),
    f"""SELECT Country, {msum('TotalPrice')} AS Revenue FROM flagged WHERE anomaly = 1
        GROUP BY Country ORDER BY Revenue DESC, Country LIMIT 15""")
add("daily_anomalies", "F37", lambda s, d: anomalies.daily_anomalies(flagged(s, d)),
    """SELECT CAST(InvoiceDate AS DATE) AS Date, count(*) AS Count FROM flagged
       WHERE anomaly = 1 GROUP BY 1""")
add("hourly_anomalies", "F38", lambda s, d: anomalies.hourly_anomalies(flagged(s, d)),
    "SELECT Hour, count(*) AS Count FROM flagged WHERE anomaly = 1 GROUP BY Hour")
add("weekday_anomalies", "F39 Q19", lambda s, d: anomalies.weekday_anomalies(flagged(s, d)),
    f"""SELECT w.DayNum, w.Day, Count FROM {_week} w
        LEFT JOIN (SELECT isodow(InvoiceDate) - 1 AS n, count(*) AS Count
                   FROM flagged WHERE anomaly = 1 GROUP BY 1) ON n = w.DayNum""")
add("anomaly_reason_breakdown", "F40",
    lambda s, d: anomalies.anomaly_reason_breakdown(flagged(s, d)),
    """SELECT anomaly_reason, count(*) AS Count FROM flagged WHERE anomaly = 1
       GROUP BY anomaly_reason""")
add("top_anomalies", "I2",
    lambda s, d: anomalies.top_anomalies(flagged(s, d), 20, "RowKey")
    .select("RowKey", "CustomerID", "TotalPrice", "anomaly_reason"),
    """SELECT RowKey, CustomerID, TotalPrice, anomaly_reason FROM flagged WHERE anomaly = 1
       ORDER BY TotalPrice DESC, RowKey LIMIT 20""")

# --- returns ---------------------------------------------------------------------------

add("return_kpis", "F41", lambda s, d: returned.return_kpis(priced(s, d)),
    f"""SELECT count(*) AS Transactions, count(*) FILTER (Quantity < 0) AS Returns,
               {msum('CASE WHEN Quantity < 0 THEN abs(TotalPrice) END')} AS ReturnValue,
               {rounded('count(*) FILTER (Quantity < 0) / count(*) * 100', 1)} AS ReturnPercent
        FROM priced""")
add("returns_by_product", "F42", lambda s, d: returned.returns_by_product(priced(s, d)),
    """SELECT Description, sum(abs(Quantity)) AS Units FROM raw WHERE Quantity < 0
       GROUP BY Description ORDER BY Units DESC, Description LIMIT 10""")
add("returns_by_country", "F43", lambda s, d: returned.returns_by_country(priced(s, d)),
    """SELECT Country, sum(abs(Quantity)) AS Units FROM raw WHERE Quantity < 0
       GROUP BY Country ORDER BY Units DESC, Country LIMIT 10""")
add("daily_returns", "F44", lambda s, d: returned.daily_returns(priced(s, d)),
    """SELECT CAST(InvoiceDate AS DATE) AS Date, sum(abs(Quantity)) AS Units FROM raw
       WHERE Quantity < 0 GROUP BY 1""")

# --- distributions and profiles --------------------------------------------------------


def _histogram_sql(value, source, bins):
    return f"""SELECT CAST(b AS INTEGER) AS Bin, lo + (b - 1) * ((hi - lo) / {bins}) AS LowEdge,
        lo + b * ((hi - lo) / {bins}) AS HighEdge, CAST(coalesce(n, 0) AS BIGINT) AS Count
      FROM range(1, {bins + 1}) r(b)
      CROSS JOIN (SELECT min({value}) AS lo, max({value}) AS hi FROM {source}) e
      LEFT JOIN (SELECT CAST(least(floor(({value} - lo) * {bins} / (hi - lo)) + 1, {bins})
                        AS INTEGER) AS g, count(*) AS n
                 FROM (SELECT {value} FROM {source}) v
                 CROSS JOIN (SELECT min({value}) AS lo, max({value}) AS hi FROM {source}) w
                 GROUP BY g) c ON g = b"""


add("total_price_histogram", "F45",
    lambda s, d: profile.histogram(cleaned(s, d), "TotalPrice", 60),
    _histogram_sql("TotalPrice", "timed", 60))
add("anomaly_price_histogram", "F45",
    lambda s, d: profile.histogram(anomalies.only_anomalies(flagged(s, d)), "TotalPrice", 40),
    _histogram_sql("TotalPrice", "flagged WHERE anomaly = 1", 40))
add("anomaly_score_histogram", "F45",
    lambda s, d: rounding(profile.histogram(flagged(s, d), "anomaly_score", 50), 6, "LowEdge", "HighEdge"),
    f"""SELECT Bin, round(LowEdge, 6) AS LowEdge, round(HighEdge, 6) AS HighEdge, Count
        FROM ({_histogram_sql("anomaly_score", "flagged", 50)})""")
add("price_histogram_by_status", "F45 F46",
    lambda s, d: profile.histogram_by_status(flagged(s, d), "TotalPrice", 30),
    """SELECT CAST(b AS INTEGER) AS Bin, CAST(coalesce(x, 0) AS BIGINT) AS Normal,
              CAST(coalesce(y, 0) AS BIGINT) AS Anomaly FROM range(1, 31) r(b)
       LEFT JOIN (SELECT CAST(least(floor((TotalPrice - lo) * 30 / (hi - lo)) + 1, 30) AS INTEGER)
                         AS g, count(*) FILTER (anomaly = 0) AS x, count(*) FILTER (anomaly = 1) AS y
                  FROM flagged CROSS JOIN (SELECT min(TotalPrice) AS lo, max(TotalPrice) AS hi
                                           FROM flagged) e GROUP BY g) c ON g = b""")


def _box_sql(value):
    return f"""SELECT Status, count({value}) AS Count, min({value}) AS Min,
        round(any_value(q1), 6) AS Q1, round(any_value(q2), 6) AS Median,
        round(any_value(q3), 6) AS Q3, max({value}) AS Max,
        min({value}) FILTER ({value} >= q1 - 1.5 * (q3 - q1)) AS LowerWhisker,
        max({value}) FILTER ({value} <= q3 + 1.5 * (q3 - q1)) AS UpperWhisker
      FROM (SELECT {value}, anomaly, CASE WHEN anomaly = 1 THEN 'Anomaly' ELSE 'Normal' END
                   AS Status FROM flagged) f
      JOIN (SELECT anomaly, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS q2,
                   quantile_cont({value}, 0.75) AS q3 FROM flagged GROUP BY anomaly) q
        USING (anomaly) GROUP BY Status"""


for _column, _name in (("Quantity", "quantity_box_summary"), ("TotalPrice", "price_box_summary")):
    add(_name, "F46",
        lambda s, d, c=_column: rounding(profile.box_summary(flagged(s, d), c), 6,
                                         "Q1", "Median", "Q3"),
        _box_sql(_column))

_described = ["Quantity", "UnitPrice", "TotalPrice", "Hour", "Day", "MonthNum", "WeekdayNum"]
add("numeric_description", "F47",
    lambda s, d: profile.describe_numeric(timed(s, d), _described),
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "Column", count({c}) AS Count, {rounded(f'avg({c})', 2)} AS Mean,
            {rounded(f'stddev_samp({c})', 2)} AS Std, {rounded(f'min({c})', 2)} AS Min,
            {rounded(f'quantile_cont({c}, 0.25)', 2)} AS P25,
            {rounded(f'quantile_cont({c}, 0.5)', 2)} AS P50,
            {rounded(f'quantile_cont({c}, 0.75)', 2)} AS P75,
            {rounded(f'max({c})', 2)} AS Max FROM timed"""
        for c in _described))

_types = dict(zip(_raw_columns, ("string", "string", "string", "double", "string", "double",
                                 "string", "string")))
add("column_profile", "F48",
    lambda s, d: profile.column_profile(raw(s, d).select(_raw_columns)),
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "Column", '{_types[c]}' AS Type, count({c}) AS NonNull,
            count(*) - count({c}) AS Nulls,
            {rounded(f'(count(*) - count({c})) / count(*) * 100', 1)} AS NullPercent FROM raw"""
        for c in _raw_columns))

add("distinct_countries", "F49", lambda s, d: profile.distinct_values(raw(s, d), "Country"),
    "SELECT DISTINCT Country FROM raw")
add("distinct_product_count", "F49",
    lambda s, d: profile.count_distinct(raw(s, d), "StockCode"),
    "SELECT count(DISTINCT StockCode) AS DistinctValues FROM raw")
add("price_range", "F50", lambda s, d: profile.value_range(cleaned(s, d), "TotalPrice"),
    "SELECT min(TotalPrice) AS MinValue, max(TotalPrice) AS MaxValue FROM timed")
add("document_counts", "F51",
    lambda s, d: profile.document_counts(anomalies.only_anomalies(flagged(s, d))),
    """SELECT count(*) AS Documents, count(*) FILTER (anomaly = 1) AS Anomalies,
              count(Hour) AS WithHour, 100.0::DOUBLE AS AnomalyPercent
       FROM flagged WHERE anomaly = 1""")
add("distinct_price_categories", "F52",
    lambda s, d: profile.distinct_rows(timed(s, d), ["TotalPrice", "RevenueCategory"], 10),
    """SELECT DISTINCT TotalPrice, RevenueCategory FROM timed
       ORDER BY TotalPrice, RevenueCategory LIMIT 10""")
add("distinct_customer_features", "F52",
    lambda s, d: profile.distinct_rows(
        featured(s, d), ["CustomerID", "AvgCustomerSpend", "CustomerFrequency",
                         "CustomerTotalQty"], 10),
    """SELECT DISTINCT CustomerID, AvgCustomerSpend, CustomerFrequency, CustomerTotalQty
       FROM featured ORDER BY CustomerID LIMIT 10""")

# --- per-key features ------------------------------------------------------------------

add("product_frequency", "G1 H4",
    lambda s, d: features.with_product_frequency(cleaned(s, d))
    .select("RowKey", "StockCode", "ProductFrequency"),
    """SELECT RowKey, StockCode, count(*) OVER (PARTITION BY StockCode) AS ProductFrequency
       FROM timed""")
add("customer_features", "G2 G3 G4 G5 H4",
    lambda s, d: rounding(features.with_customer_features(cleaned(s, d)).select(
        "RowKey", "CustomerID", "AvgCustomerSpend", "CustomerFrequency", "CustomerTotalQty",
        "CustomerPriceStd"), 4, "CustomerPriceStd"),
    f"""SELECT RowKey, CustomerID,
               {msum('TotalPrice', 'OVER c')} / count(*) OVER c
                 AS AvgCustomerSpend,
               count(*) OVER c AS CustomerFrequency, sum(Quantity) OVER c AS CustomerTotalQty,
               round(stddev_samp(TotalPrice) OVER c, 4) AS CustomerPriceStd
        FROM timed WINDOW c AS (PARTITION BY CustomerID)""")
add("dashboard_features", "H4 G1 G2 G3 G4",
    lambda s, d: features.with_dashboard_features(priced(s, d).select(
        "RowKey", "StockCode", "CustomerID", "Quantity", "TotalPrice")).select(
        "RowKey", "ProductFrequency", "AvgCustomerSpend", "CustomerFrequency",
        "CustomerTotalQty"),
    f"""SELECT RowKey, count(*) OVER (PARTITION BY StockCode) AS ProductFrequency,
               CASE WHEN CustomerID IS NULL THEN (SELECT {mavg('TotalPrice')} FROM priced)
                    ELSE {msum('TotalPrice', 'OVER c')}
                         / count(*) OVER c END AS AvgCustomerSpend,
               CASE WHEN CustomerID IS NULL THEN 1 ELSE count(*) OVER c END AS CustomerFrequency,
               CASE WHEN CustomerID IS NULL THEN 0 ELSE sum(Quantity) OVER c END
                 AS CustomerTotalQty
        FROM priced WINDOW c AS (PARTITION BY CustomerID)""")

# --- encodings, model, correlation -----------------------------------------------------

add("frequency_encoding", "E1",
    lambda s, d: lookup.encode_by_frequency(cleaned(s, d), "Country", "CountryEncoded")
    .select("RowKey", "Country", "CountryEncoded"),
    "SELECT RowKey, Country, CountryEncoded FROM featured")
add("frequency_encoding_with_nulls", "E1",
    lambda s, d: lookup.encode_by_frequency(raw(s, d), "CustomerID", "Code")
    .select("RowKey", "CustomerID", "Code"),
    """SELECT RowKey, r.CustomerID, coalesce(c.code, (SELECT count(DISTINCT CustomerID)
              FROM raw))::DOUBLE AS Code
       FROM raw r LEFT JOIN (SELECT CustomerID,
              row_number() OVER (ORDER BY count(*) DESC, CustomerID) - 1 AS code FROM raw
              WHERE CustomerID IS NOT NULL GROUP BY CustomerID) c USING (CustomerID)""")
add("alphabetical_encoding", "E2",
    lambda s, d: lookup.encode_alphabetical(raw(s, d), "CustomerID", "Code")
    .select("RowKey", "CustomerID", "Code"),
    """SELECT RowKey, r.CustomerID, coalesce(c.code, -1)::DOUBLE AS Code
       FROM raw r LEFT JOIN (SELECT CustomerID, row_number() OVER (ORDER BY CustomerID) - 1 AS code
              FROM raw WHERE CustomerID IS NOT NULL GROUP BY CustomerID) c USING (CustomerID)""")
add("country_mapping", "E3",
    lambda s, d: lookup.label_mapping(
        lookup.encode_by_frequency(cleaned(s, d), "Country", "CountryEncoded"),
        "Country", "CountryEncoded"),
    "SELECT DISTINCT Country, CountryEncoded FROM featured")

# A small forest with known nodes, to check scoring against nested CASE expressions:
# (tree, node, depth, feature, threshold, size); children of node i are 2i+1 and 2i+2.
PINNED_FOREST = [
    (0, 0, 0, 2, 50000.0, 256), (0, 1, 1, 0, 10.0, 150), (0, 2, 1, 2, 90000.0, 106),
    (0, 3, 2, -1, 0.0, 60), (0, 4, 2, -1, 0.0, 90), (0, 5, 2, 1, 4000.0, 105),
    (0, 6, 2, -1, 0.0, 1), (0, 11, 3, -1, 0.0, 75), (0, 12, 3, -1, 0.0, 30),
    (1, 0, 0, 1, 20000.0, 256), (1, 1, 1, 0, 45.0, 240), (1, 2, 1, 2, 80000.0, 16),
    (1, 3, 2, 2, 30000.0, 200), (1, 4, 2, -1, 0.0, 40), (1, 5, 2, -1, 0.0, 14),
    (1, 6, 2, -1, 0.0, 2), (1, 7, 3, -1, 0.0, 120), (1, 8, 3, -1, 0.0, 80),
    (2, 0, 0, 0, 25.0, 256), (2, 1, 1, -1, 0.0, 130), (2, 2, 1, 1, 2000.0, 126),
    (2, 5, 2, -1, 0.0, 100), (2, 6, 2, 2, 95000.0, 26), (2, 13, 3, -1, 0.0, 23),
    (2, 14, 3, -1, 0.0, 3),
]


def _average_path_sql(n):
    """Mean depth of a failed search among n rows: 2 H(n-1) - 2 (n-1)/n, 1 for two, 0 for one."""
    return (f"(CASE WHEN {n} > 2 THEN 2 * (ln({n} - 1) + 0.5772156649015329) - 2 * ({n} - 1.0) / {n} "
            f"WHEN {n} = 2 THEN 1.0 ELSE 0.0 END)")


def _tree_sql(nodes, node=0):
    _, _, depth, feature, threshold, size = nodes[node]
    if feature == forest.LEAF:
        return f"({depth} + {_average_path_sql(size)})"
    return (f"CASE WHEN {FOREST_FEATURES[feature]} <= {threshold} "
            f"THEN {_tree_sql(nodes, 2 * node + 1)} ELSE {_tree_sql(nodes, 2 * node + 2)} END")


def _forest_sql():
    trees = sorted({row[0] for row in PINNED_FOREST})
    paths = " + ".join(_tree_sql({r[1]: r for r in PINNED_FOREST if r[0] == t}) for t in trees)
    return (f"SELECT RowKey, round(-pow(2, -(({paths}) / {len(trees)}.0) / {_average_path_sql(256)}), 9) AS score "
            "FROM timed")


def _pinned_scores(s, d):
    nodes = s.createDataFrame(PINNED_FOREST, forest.NODE_SCHEMA)
    return rounding(forest.score_isolation_forest(cleaned(s, d), nodes), 9, "score")


add("pinned_forest_scores", "E5",
    lambda s, d: _pinned_scores(s, d).select("RowKey", "score"), _forest_sql())
# The forest in SQL: samples by hash, trees by a recursive table of (tree, node) groups, whose
# feature and threshold follow from md5(seed|tree|node|...).
def _hash_sql(word, tree="tree", node="node"):
    within = f" || '|' || {node}" if node else ""
    return f"CAST('0x' || left(md5('{FOREST_SEED}|' || {tree}{within} || '|{word}'), 13) AS BIGINT)"


_places = ["q", "u", "t"]
_spread = ", ".join(f"CASE WHEN {c}1 > {c}0 THEN {i} END" for i, c in enumerate(_places))
_limits = ", ".join(f"min({c}) OVER g AS {c}0, max({c}) OVER g AS {c}1" for c in _places)
_split = f"""
  SELECT *, CASE feature WHEN 0 THEN q0 WHEN 1 THEN u0 ELSE t0 END AS low,
         CASE feature WHEN 0 THEN q1 WHEN 1 THEN u1 ELSE t1 END AS high,
         CASE feature WHEN 0 THEN q WHEN 1 THEN u ELSE t END AS v
  FROM (SELECT *, CASE WHEN depth >= top OR size < 2 OR len(spread) = 0 THEN -1
                  ELSE spread[{_hash_sql('feature')} % len(spread) + 1] END AS feature
        FROM (SELECT *, list_filter([{_spread}], lambda x: x IS NOT NULL) AS spread
              FROM (SELECT *, count(*) OVER g AS size, {_limits} FROM grown
                    WINDOW g AS (PARTITION BY tree, node))))"""
_cut = f"""SELECT *, CASE WHEN place >= low AND place < high THEN place ELSE low END AS threshold
  FROM (SELECT *, low + {_hash_sql('threshold')} / pow(16.0::DOUBLE, 13) * (high - low) AS place FROM ({_split}))"""
_samples_sql = f"""
, pool AS MATERIALIZED (
  SELECT RowKey, Quantity, UnitPrice, TotalPrice, md5(RowKey || '|{FOREST_SEED}') AS h FROM timed
  ORDER BY h, RowKey LIMIT {FOREST_TREES * FOREST_SAMPLE}
), numbered AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY h, RowKey) - 1 AS place, count(*) OVER () AS n FROM pool
), starts AS MATERIALIZED (
  SELECT tree, n, {_hash_sql('start', node=None)} % n AS start, {_hash_sql('step', node=None)} % n AS step
  FROM (SELECT CAST(i AS INTEGER) AS tree FROM range({FOREST_TREES}) r(i)), (SELECT DISTINCT n FROM numbered)
), walks AS MATERIALIZED (
  SELECT tree, n, start, (SELECT min(step + i) FROM range(1000) r(i) WHERE gcd(step + i, n) = 1) AS step FROM starts
), drawn AS MATERIALIZED (
  SELECT tree, h AS hash, Quantity, UnitPrice, TotalPrice
  FROM walks, range({FOREST_SAMPLE}) r(k), numbered
  WHERE k < walks.n AND place = (start + k * step) % walks.n
)"""
_nodes_sql = f"""{_samples_sql}
, levels AS MATERIALIZED (
  WITH RECURSIVE grown AS (
    SELECT tree, 0::BIGINT AS node, 0 AS depth, Quantity AS q, UnitPrice AS u, TotalPrice AS t,
           CAST(ceil(log2(greatest(count(*) OVER (PARTITION BY tree), 2))) AS INTEGER) AS top FROM drawn
    UNION ALL
    SELECT tree, 2 * node + CASE WHEN v <= threshold THEN 1 ELSE 2 END, depth + 1, q, u, t, top
    FROM ({_cut}) WHERE feature >= 0
  ) SELECT * FROM grown
), nodes AS MATERIALIZED (
  SELECT DISTINCT tree, CAST(node AS INTEGER) AS node, depth, CAST(feature AS INTEGER) AS feature,
         CASE WHEN feature < 0 THEN 0.0 ELSE threshold END AS threshold, CAST(size AS INTEGER) AS size
  FROM ({_cut.replace('FROM grown', 'FROM levels')})
)"""
_forest_lines_sql = f"""{_nodes_sql}
, walked AS (
  WITH RECURSIVE walk AS (
    SELECT RowKey, Quantity AS q, UnitPrice AS u, TotalPrice AS p, n.* FROM timed JOIN nodes n ON n.node = 0
    UNION ALL
    SELECT w.RowKey, w.q, w.u, w.p, n.* FROM walk w JOIN nodes n ON w.feature >= 0 AND n.tree = w.tree
      AND n.node = 2 * w.node + CASE WHEN (CASE w.feature WHEN 0 THEN q WHEN 1 THEN u ELSE p END)
                                          <= w.threshold THEN 1 ELSE 2 END
  ) SELECT RowKey, tree, depth + {_average_path_sql('size')} AS path FROM walk WHERE feature < 0
), forest_scores AS MATERIALIZED (
  SELECT RowKey, -pow(2, -(list_reduce(list(path ORDER BY tree), lambda a, b: a + b) / {FOREST_TREES}.0)
         / (SELECT {_average_path_sql('max(size)')} FROM nodes WHERE node = 0)) AS score
  FROM walked GROUP BY RowKey
), forest_lines AS MATERIALIZED (
  SELECT RowKey, score - (SELECT quantile_cont(score, 0.02) FROM forest_scores) AS anomaly_score,
         anomaly_reason FROM forest_scores JOIN flagged USING (RowKey)
)"""

_sampled = lambda s, d: stage(cleaned(s, d).select("RowKey", *FOREST_FEATURES))
add("forest_samples", "E4",
    lambda s, d: forest.draw_samples(_sampled(s, d)).withColumnRenamed("_hash", "hash"),
    f"{_samples_sql} SELECT tree, hash, Quantity, UnitPrice, TotalPrice FROM drawn")
add("isolation_forest_nodes", "E4",
    lambda s, d: rounding(forest.fit_isolation_forest(_sampled(s, d)), 6, "threshold"),
    f"{_nodes_sql} SELECT tree, node, depth, feature, round(threshold, 6) AS threshold, size FROM nodes")
add("isolation_forest_lines", "E4 E5 E6 P3",
    lambda s, d: rounding(stages.detect(stage(featured(s, d)), TABLE_LIMITS, ("RowKey",)), 9, "anomaly_score")
    .select("RowKey", "anomaly", "anomaly_score", "anomaly_reason"),
    f"""{_forest_lines_sql} SELECT RowKey, CASE WHEN anomaly_score < 0 THEN 1 ELSE 0 END AS anomaly,
               round(anomaly_score, 9) AS anomaly_score, anomaly_reason FROM forest_lines""")

_numbers = [*NUMERIC_FEATURES, "anomaly", "anomaly_score"]


def _r(a, b):
    return f"round(CASE WHEN stddev_pop({a}) * stddev_pop({b}) = 0 THEN NULL ELSE corr({a}, {b}) END, 6)"


def _one_pass_sql(rows, source="scored_features"):
    """Rows of (name, SQL value) columns from one aggregate over the source."""
    cells = ", ".join("{" + ", ".join(f"'{name}': {value}" for name, value in row) + "}" for row in rows)
    return f"SELECT unnest(cells, recursive := true) FROM (SELECT [{cells}] AS cells FROM {source})"


add("correlation_pairs", "E7",
    lambda s, d: rounding(correlation.correlation_pairs(scored_features(s, d), _numbers), 6, "Correlation"),
    _one_pass_sql([(("Left", f"'{a}'"), ("Right", f"'{b}'"), ("Correlation", _r(a, b)))
                   for i, a in enumerate(_numbers) for b in _numbers[i + 1:]]))
add("correlation_matrix", "E7",
    lambda s, d: rounding(correlation.correlation_matrix(scored_features(s, d), _numbers), 6, *_numbers),
    _one_pass_sql([[("Feature", f"'{a}'"), *[(b, _r(a, b) if a != b else "1.0::DOUBLE") for b in _numbers]]
                   for a in _numbers]))
add("top_anomaly_correlations", "E8 Q20",
    lambda s, d: rounding(correlation.top_anomaly_correlations(scored_features(s, d), _numbers), 6,
                          "Correlation", "Strength"),
    "SELECT *, abs(Correlation) AS Strength, CASE WHEN Correlation > 0 THEN 'Positive' "
    "ELSE 'Negative' END AS Direction FROM ("
    + _one_pass_sql([(("Feature", f"'{a}'"), ("Correlation", _r(a, "anomaly")))
                     for a in _numbers if a != "anomaly"]) + ") ORDER BY Strength DESC, Feature LIMIT 10")

# --- stages ----------------------------------------------------------------------------

_feature_fields = ", ".join(c for c in NUMERIC_FEATURES if c != "CustomerPriceStd")
add("featured_lines", "P2",
    lambda s, d: rounding(_with_text(featured(s, d), "InvoiceDate"), 4, "CustomerPriceStd"),
    f"""SELECT InvoiceNo, StockCode, Description, RowKey, CustomerID, Country, Month,
               RevenueCategory, strftime(InvoiceDate, '%Y-%m-%d %H:%M:%S') AS InvoiceDate,
               {_feature_fields}, {rounded('CustomerPriceStd', 4)} AS CustomerPriceStd
        FROM featured""")

# --- joins and checks ------------------------------------------------------------------

add("positional_join", "H1",
    lambda s, d: (lambda f: joins.positional_join(
        f, anomalies.only_anomalies(f), ["InvoiceDate", "RowKey"], ["InvoiceDate", "RowKey"])
    )(stage(flagged(s, d))),
    """SELECT row_id, Quantity, UnitPrice, TotalPrice, b.anomaly
       FROM (SELECT *, row_number() OVER (ORDER BY InvoiceDate, RowKey) AS row_id FROM flagged) a
       JOIN (SELECT anomaly, row_number() OVER (ORDER BY InvoiceDate, RowKey) AS row_id
             FROM flagged WHERE anomaly = 1) b USING (row_id)""")
add("joined_anomalies", "H2",
    lambda s, d: rounding(joins.join_anomalies(
        cleaned(s, d), anomalies.only_anomalies(flagged(s, d)).select("RowKey", "anomaly_score", "anomaly_reason"),
        "RowKey"), 9, "anomaly_score").select(
        "RowKey", "CustomerID", "Country", "TotalPrice", "anomaly_score", "anomaly_reason"),
    """SELECT RowKey, CustomerID, Country, TotalPrice, round(anomaly_score, 9) AS anomaly_score, anomaly_reason
       FROM flagged WHERE anomaly = 1""")
add("consistency_check", "H5 Q16",
    lambda s, d: (lambda f: joins.consistency_check(
        f, anomalies.only_anomalies(f).drop("score"), "RowKey"))(stage(flagged(s, d))),
    """SELECT count(*) AS TotalRecords, count(*) FILTER (anomaly = 1) AS TotalDocuments,
              20 AS TotalColumns, 19 AS TotalFields, 1 AS ColumnsOnlyInTable,
              0 AS FieldsOnlyInDocuments, 'VALID' AS Status, TRUE AS SubsetByCount,
              0::BIGINT AS MissingKeys, TRUE AS ReadyForDashboard FROM flagged""")
add("verification_report", "H6",
    lambda s, d: (lambda f: joins.verification_report(
        f, anomalies.only_anomalies(f), ["RowKey"], "lines", "flagged"))(stage(flagged(s, d))).select(
        F.col("relational.total_records").alias("TotalRecords"),
        F.array_join("relational.columns", ",").alias("Columns"),
        F.col("documents.total_documents").alias("TotalDocuments"),
        F.col("consistency_check.status").alias("Status"),
        F.col("consistency_check.missing_keys").alias("MissingKeys")),
    """SELECT count(*) AS TotalRecords,
              'Country,CustomerID,Day,Description,Hour,InvoiceDate,InvoiceNo,Month,MonthNum,Quantity,RevenueCategory,RowKey,StockCode,TotalPrice,UnitPrice,WeekdayNum,anomaly,anomaly_reason,anomaly_score,score'
                AS Columns,
              count(*) FILTER (anomaly = 1) AS TotalDocuments, 'VALID' AS Status,
              0::BIGINT AS MissingKeys FROM flagged""")
add("integration_stats", "H7",
    lambda s, d: (lambda f: joins.integration_stats(
        f, anomalies.only_anomalies(f)))(stage(flagged(s, d))),
    f"""SELECT count(*) AS TotalRecords, count(*) FILTER (anomaly = 1) AS TotalDocuments,
               {rounded('count(*) FILTER (anomaly = 1) / count(*) * 100', 2)} AS AnomalyPercent,
               'VALID' AS IntegrationStatus FROM flagged""")

# --- order -----------------------------------------------------------------------------

add("row_positions", "I4",
    lambda s, d: ordering.row_number_global(
        timed(s, d).select("InvoiceDate", "RowKey"), ["InvoiceDate", "RowKey"]
    ).select("row_id", "RowKey"),
    "SELECT row_number() OVER (ORDER BY InvoiceDate, RowKey) AS row_id, RowKey FROM timed")
for _name, _page, _shallow in (("transactions_page", 3, ordering.SHALLOW_ROWS),
                               ("deep_transactions_page", 60, 1000)):
    add(_name, "I5",
        lambda s, d, n=_page, m=_shallow: ordering.page(
            timed(s, d).select("RowKey", "TotalPrice"), ["RowKey"], n, shallow=m),
        f"""SELECT RowKey, TotalPrice FROM timed ORDER BY RowKey
            LIMIT 50 OFFSET {(_page - 1) * 50}""")


def _kept_page(s, d, number):
    """A page of a table that is kept in order: only the files that hold it are read."""
    folder = new_folder(s)
    pages.write_ordered(timed(s, d).select("RowKey", "TotalPrice"), ["RowKey"], folder, rows_per_file=20_000)
    return pages.read_page(s, folder, number)


def _kept_page_count(s, d):
    folder = new_folder(s)
    pages.write_ordered(timed(s, d).select("RowKey", "TotalPrice"), ["RowKey"], folder)
    return pages.ordered_page_count(s, folder)


add("kept_transactions_page", "I4 I5", lambda s, d: _kept_page(s, d, 60),
    "SELECT RowKey, TotalPrice FROM timed ORDER BY RowKey LIMIT 50 OFFSET 2950")
add("kept_page_count", "I5", _kept_page_count,
    "SELECT count(*) AS Rows, CAST(greatest(1, (count(*) - 1) // 50 + 1) AS BIGINT) AS Pages FROM timed")
add("page_count", "I5", lambda s, d: ordering.page_count(cleaned(s, d)),
    "SELECT count(*) AS Rows, CAST(greatest(1, (count(*) - 1) // 50 + 1) AS BIGINT) AS Pages FROM timed")
add("ordered_preview", "I3",
    lambda s, d: ordering.preview(raw(s, d).select("RowKey", "Quantity"), 5, "RowKey"),
    "SELECT RowKey, Quantity FROM raw ORDER BY RowKey LIMIT 5")


def _sketched_prices(s, d, by):
    """Whether quartiles from merged sketches have a rank within half a percent of the wanted one."""
    rows = stage(anomalies.with_status(flagged(s, d)).select("Month", "Status", "TotalPrice"))
    kept = stage(sketches.quantile_sketches(rows, "TotalPrice", ["Month", "Status"]))
    found = sketches.sketched_boxes(kept, by).withColumnRenamed("Rows", "Sketched")
    ranked = rows.join(F.broadcast(found), list(by)).groupBy(*by).agg(
        F.count("*").alias("Rows"), F.max("Sketched").alias("Sketched"), *[F.struct(
            (F.count_if(F.col("TotalPrice") < F.col(q)) / F.count("*")).alias("below"),
            (F.count_if(F.col("TotalPrice") <= F.col(q)) / F.count("*")).alias("upto")).alias(q)
            for q in ("Q1", "Median", "Q3")])
    return ranked.select(*by, "Rows", "Sketched", *[
        ((F.col(f"{q}.below") <= p + 0.005) & (F.col(f"{q}.upto") >= p - 0.005)).alias(q)
        for q, p in (("Q1", 0.25), ("Median", 0.5), ("Q3", 0.75))])


for _name, _by in (("sketched_price_boxes", ("Status",)), ("sketched_month_boxes", ("Month",))):
    add(_name, "F46 F47", lambda s, d, by=_by: _sketched_prices(s, d, by),
        f"""SELECT {_by[0]}, count(*) AS Rows, count(*) AS Sketched, TRUE AS Q1, TRUE AS Median, TRUE AS Q3
            FROM (SELECT *, CASE WHEN anomaly = 1 THEN 'Anomaly' ELSE 'Normal' END AS Status FROM flagged)
            GROUP BY {_by[0]}""")
add("total_price_quantiles", "E6 F46",
    lambda s, d: (lambda q: cleaned(s, d).agg(
        F.count("*").alias("Rows"), *[F.lit(v).alias(f"Q{i}") for i, v in enumerate(q)])
    )([round(v, 6) for v in quantiles.exact_quantiles(
        cleaned(s, d), ["TotalPrice"], [0.02, 0.5, 0.98], limit=1000)["TotalPrice"]]),
    """SELECT count(*) AS Rows, round(quantile_cont(TotalPrice, 0.02), 6) AS Q0,
              round(quantile_cont(TotalPrice, 0.5), 6) AS Q1,
              round(quantile_cont(TotalPrice, 0.98), 6) AS Q2 FROM timed""")

# --- sources and sinks -----------------------------------------------------------------


def _through_csv(s, d):
    folder = new_folder(s)
    files.export_csv(raw(s, d).select(_raw_columns), folder, compression="gzip")
    return files.read_raw_csv(s, folder)


add("raw_csv_round_trip", "A1 B2", _through_csv,
    """SELECT InvoiceNo, StockCode, Description, Quantity,
              strftime(InvoiceDate, '%-m/%-d/%Y %-H:%M') AS InvoiceDate, UnitPrice, CustomerID,
              Country FROM raw""")


def _through_odd_csv(s, d):
    """A folder of files with two headers: columns in another order, a further one, and a quantity that
    is no number in a twentieth of the rows."""
    folder = new_folder(s)
    rows = stage(raw(s, d)).withColumn("Quantity", F.when(F.col("RowKey").endswith("7"), "many").otherwise(
        F.col("Quantity").cast("string")))
    first = F.col("RowKey").substr(1, 1) == "1"
    files.export_csv(rows.where(first).select(
        F.col("Country").alias(" Country"), "CustomerID", "RowKey", "UnitPrice", F.col("Quantity").alias("Quantity "),
        "InvoiceDate", "Description", "StockCode", "InvoiceNo"), f"{folder}/one")
    files.export_csv(rows.where(~first).select(_raw_columns), f"{folder}/two", compression="gzip")
    return files.read_raw_csv(s, [f"{folder}/one", f"{folder}/two"], corrupt="bad_line")


add("reordered_csv", "A1",
    lambda s, d: stage(_through_odd_csv(s, d)).groupBy("Country").agg(
        F.count("*").alias("Rows"), F.count("bad_line").alias("Unreadable"), F.count("Quantity").alias("Quantities"),
        F.count_distinct("InvoiceNo").alias("Invoices")),
    """SELECT Country, count(*) AS Rows, count(*) FILTER (RowKey LIKE '%7') AS Unreadable,
              count(*) FILTER (RowKey NOT LIKE '%7') AS Quantities, count(DISTINCT InvoiceNo) AS Invoices
       FROM raw GROUP BY Country""")
add("csv_of_two_headers", "A1", lambda s, d: _through_odd_csv(s, d).drop("bad_line"),
    """SELECT InvoiceNo, StockCode, Description, CASE WHEN RowKey NOT LIKE '%7' THEN Quantity END AS Quantity,
              strftime(InvoiceDate, '%-m/%-d/%Y %-H:%M') AS InvoiceDate, UnitPrice, CustomerID, Country FROM raw""")


def _through_report(s, d):
    folder = new_folder(s)
    report = features.project_available(
        ordering.preview(featured(s, d).drop("InvoiceDate", "CustomerPriceStd"), 20, "RowKey"), REPORT_COLUMNS)
    files.write_report(report, folder)
    return s.read.option("header", True).schema(report.schema).csv(folder)


add("report_round_trip", "B6 C8", _through_report,
    f"SELECT {', '.join(_report_fields)} FROM featured ORDER BY RowKey LIMIT 20")


def _through_text_csv(s, d):
    folder = new_folder(s)
    files.export_csv(cleaned(s, d).select("Country", "Description", "TotalPrice"), folder)
    return sales.revenue_by_country(files.read_text_csv(s, folder), 10)


add("text_csv_revenue", "A2 F9", _through_text_csv,
    f"""SELECT Country, {msum('TotalPrice')} AS Revenue FROM timed GROUP BY Country
        ORDER BY Revenue DESC, Country LIMIT 10""")


def _through_layer(s, d):
    folder = new_folder(s)
    spaced = timed(s, d).select("RowKey", "Month", F.col("Quantity").alias(" Quantity"),
                                F.col("Country").alias("Country "))
    files.write_layer(spaced, folder, partition_by="Month")
    return files.read_layer(s, folder)


add("layer_round_trip", "A3 A6 B1", _through_layer,
    "SELECT RowKey, Month, Quantity, Country FROM timed")


def _published_twice(s, d):
    """Two versions of a layer, a write that fails, and what was counted while writing."""
    folder = new_folder(s)
    files.write_layer(raw(s, d).select("RowKey", "Quantity"), folder)
    sent = publishing.publish(timed(s, d).select("RowKey", "TotalPrice", "CustomerID"), folder, count=("CustomerID",))
    try:
        publishing.publish(raw(s, d).limit(0), folder, least=1)
    except ValueError:
        pass
    stored = files.read_layer(s, folder)
    return stored.agg(F.count("*").alias("Rows"), F.lit(sent.rows).cast("bigint").alias("Sent"),
                      F.lit(sent.known["CustomerID"]).cast("bigint").alias("KnownCustomers"),
                      F.lit(len(stored.columns)).alias("Columns"))


add("published_layer", "B1 H8", _published_twice,
    """SELECT count(*) AS Rows, count(*) AS Sent, count(CustomerID) AS KnownCustomers, 3 AS Columns FROM timed""")


def _through_documents(s, d):
    folder = new_folder(s)
    rows = flagged(s, d).select("RowKey", "InvoiceNo", "TotalPrice", "Hour", "RevenueCategory",
                                "anomaly")
    files.write_documents(rows, folder)
    return files.read_documents(s, folder, rows.schema)


add("documents_round_trip", "A5 B4 H8", _through_documents,
    """SELECT RowKey, InvoiceNo, TotalPrice, Hour, RevenueCategory, anomaly FROM flagged
       WHERE anomaly = 1""")


def _written_check(s, d):
    folder = new_folder(s)
    rows = cleaned(s, d).select("RowKey", "TotalPrice")
    files.write_layer(rows, folder)
    return files.write_check(rows, files.read_layer(s, folder))


add("write_check", "H8 B1", _written_check,
    "SELECT count(*) AS RowsSent, count(*) AS RowsStored, TRUE AS Complete FROM timed")


def _through_warehouse(s, d):
    folder = new_folder(s)
    table = warehouse.conform_warehouse(timed(s, d), ["RowKey"])
    warehouse.write_warehouse(table, folder)
    stored = warehouse.read_warehouse(s, folder)
    return stored.groupBy("month").agg(
        F.count("*").alias("rows"), F.count_distinct("id").alias("ids"),
        F.count("created_at").alias("dated"), F.max("invoice_date").cast("date").alias("last"))


add("warehouse_round_trip", "B5 D13", _through_warehouse,
    """SELECT Month AS month, count(*) AS rows, count(DISTINCT RowKey) AS ids, count(*) AS dated,
              CAST(max(InvoiceDate) AS DATE) AS last FROM timed GROUP BY Month""")
_warehouse_sql = ", ".join(
    {"InvoiceDate": "strftime(InvoiceDate, '%Y-%m-%d %H:%M:%S')", "CustomerPriceStd": "round(CustomerPriceStd, 4)",
     "anomaly_score": "round(anomaly_score, 9)"}.get(source, source) + f" AS {target}"
    for source, target, _ in WAREHOUSE_COLUMNS)
add("warehouse_columns", "B5",
    lambda s, d: rounding(rounding(_with_text(warehouse.conform_warehouse(
        scored_features(s, d), ["RowKey"], created_at=False, staged=True), "invoice_date"), 4, "customer_price_std"),
        9, "anomaly_score"),
    f"SELECT row_number() OVER (ORDER BY RowKey) AS id, {_warehouse_sql} FROM scored_features")
add("warehouse_doubled_rows", "B5",
    lambda s, d: (lambda f: warehouse.conform_warehouse(f.union(f), ["RowKey"], staged=True))(stage(cleaned(s, d))).agg(
        F.count("*").alias("Rows"), F.count_distinct("id").alias("Ids"), F.max("id").alias("Last")),
    "SELECT 2 * count(*) AS Rows, 2 * count(*) AS Ids, 2 * count(*) AS Last FROM timed")



def _bucketed_lines(s, d):
    """The cleaned lines with their times, in buckets of their customer; more buckets for more lines."""
    folder, rows = new_folder(s), stage(timed(s, d))
    buckets = bucketed.bucket_number(rows.count(), 8)
    return bucketed.write_bucketed(rows, f"lines_{folder.rsplit('-', 1)[1]}", folder, "CustomerID", buckets)


add("bucketed_customer_rfm", "B5 F20",
    lambda s, d: _with_text(customers.customer_rfm(_bucketed_lines(s, d)), "LastPurchaseDate"),
    CATALOG["customer_rfm"].sql.removeprefix(LAYERS_SQL))
add("bucketed_customer_features", "B5 G2 G3 G4 G5",
    lambda s, d: rounding(features.with_customer_features_in_place(_bucketed_lines(s, d)), 4, "CustomerPriceStd")
    .select("RowKey", "CustomerID", "AvgCustomerSpend", "CustomerFrequency", "CustomerTotalQty", "CustomerPriceStd"),
    f"""SELECT RowKey, CustomerID, AvgCustomerSpend, CAST(CustomerFrequency AS BIGINT) AS CustomerFrequency, CustomerTotalQty,
               CASE WHEN CustomerFrequency > 1 THEN {rounded('CustomerPriceStd', 4)} END AS CustomerPriceStd
        FROM timed JOIN customer_stats USING (CustomerID)""")

# --- the flow --------------------------------------------------------------------------


def _flow_counts(s, d):
    """Rows of every layer, store, export and report of a run over the raw lines, and how many are flagged."""
    folder = new_folder(s)
    run.run_all(raw(s, d), folder, TABLE_LIMITS, ("RowKey",))
    sizes = []
    for name, kind in (
            *[(f"layers/{x}", "parquet") for x in (
                "cleaned", "featured", "anomaly", "customer_segments", "customer_behavior", "joined", "anomaly_context")],
            ("warehouse", "parquet"), ("documents", "json"), ("exports/cleaned", "csv"), ("exports/anomalies", "csv"),
            *[(f"reports/{x}", "csv") for x in (
                "01_country_mapping", "02_sample_featured_data", "03_revenue_category_distribution", "04_top_products",
                "05_top_customers", "07_relational_sample", "08_anomaly_sample", "09_anomaly_revenue_distribution",
                "10_integration_statistics", "featured_sample")]):
        rows = s.read.option("header", True).format(kind).load(publishing.current(s, f"{folder}/{name}"))
        anomaly = F.count_if(F.col("anomaly") == 1) if "anomaly" in rows.columns else F.lit(None)
        sizes.append(rows.agg(F.lit(name).alias("Name"), F.count("*").alias("Rows"), anomaly.cast("bigint").alias("Flagged")))
    result = sizes[0]
    for more in sizes[1:]:
        result = result.unionByName(more)
    return result


_flow_sql = " UNION ALL ".join(
    f"SELECT '{name}' AS Name, CAST({count} AS BIGINT) AS Rows, CAST({marked} AS BIGINT) AS Flagged FROM sizes"
    for name, count, marked in (
        ("layers/cleaned", "n", "NULL"), ("layers/featured", "n", "NULL"), ("layers/anomaly", "n", "f"),
        ("layers/customer_segments", "customers", "NULL"), ("layers/customer_behavior", "customers", "NULL"),
        ("layers/joined", "f", "f"), ("layers/anomaly_context", "f", "f"), ("warehouse", "n", "f"), ("documents", "f", "f"),
        ("exports/cleaned", "n", "NULL"), ("exports/anomalies", "f", "f"), ("reports/01_country_mapping", "countries", "NULL"),
        ("reports/02_sample_featured_data", "least(n, 20)", "NULL"),
        ("reports/03_revenue_category_distribution", "categories", "NULL"), ("reports/04_top_products", "least(products, 10)", "NULL"),
        ("reports/05_top_customers", "least(customers, 10)", "NULL"), ("reports/07_relational_sample", "least(n, 50)", "first50"),
        ("reports/08_anomaly_sample", "least(f, 50)", "least(f, 50)"),
        ("reports/09_anomaly_revenue_distribution", "f_categories", "NULL"), ("reports/10_integration_statistics", "1", "NULL"),
        ("reports/featured_sample", "least(n, 100)", "NULL")))
add("flow_counts", "P4", _flow_counts, f"""{_forest_lines_sql}
, judged AS MATERIALIZED (
  SELECT timed.*, CASE WHEN s.anomaly_score < 0 THEN 1 ELSE 0 END AS bad, row_number() OVER (ORDER BY RowKey) AS place
  FROM timed JOIN (SELECT RowKey, anomaly_score FROM forest_lines) s USING (RowKey)
), sizes AS MATERIALIZED (
  SELECT count(*) AS n, sum(bad) AS f, count(DISTINCT CustomerID) AS customers, count(DISTINCT Country) AS countries,
         count(DISTINCT RevenueCategory) AS categories, count(DISTINCT StockCode) AS products,
         count(DISTINCT RevenueCategory) FILTER (bad = 1) AS f_categories, sum(bad) FILTER (place <= 50) AS first50 FROM judged
) {_flow_sql}""")
