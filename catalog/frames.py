"""The layers that the queries start from, as DataFrames and as SQL."""

from pyspark.sql import functions as F

from txlens.functions.rules import anomaly_reason
from txlens.operators import cleaning, features
from txlens.operators.anomalies import flag_anomalies
from txlens.plans.stages import ROW_KEY, build_features, clean
from txlens.sources.retail_tables import TABLE_LIMITS, retail_raw
from txlens.staging import stage


def raw(spark, folder):
    return retail_raw(spark, folder)


def priced(spark, folder):
    """Every raw row with its total and time parts, returns included."""
    return features.with_time_features(cleaning.with_total_price(raw(spark, folder)))


def cleaned(spark, folder):
    return clean(raw(spark, folder), list(ROW_KEY))


def timed(spark, folder):
    """Cleaned rows with time parts and revenue category."""
    rows = features.with_time_features(cleaned(spark, folder))
    return features.with_revenue_category(rows, TABLE_LIMITS)


def featured(spark, folder):
    """The cleaned lines are staged, so that the lookup tables and the rows share one run of the joins."""
    return build_features(stage(cleaned(spark, folder)), TABLE_LIMITS, staged=True)


def scored_features(spark, folder):
    """Staged featured rows with the same plain score and flags, all columns of the last layer."""
    scored = stage(featured(spark, folder)).withColumn("score", -F.col("TotalPrice"))
    return flag_anomalies(scored).drop("score").withColumn("anomaly_reason", anomaly_reason(TABLE_LIMITS))


def flagged(spark, folder):
    """Timed rows flagged by a plain score (the dearest 2 %), so that SQL can follow."""
    scored = timed(spark, folder).withColumn("score", -F.col("TotalPrice"))
    return flag_anomalies(scored).withColumn("anomaly_reason", anomaly_reason(TABLE_LIMITS))


def msum(value, over=""):
    """The exact sum of the doubles, in parts of 1e-12, rounded once."""
    value = f"({value})"
    part = f"(({value} - floor({value})) * 1000000)"
    whole, below, rest = (f"sum(CAST({e} AS HUGEINT)) {over}" for e in (
        f"floor({value})", f"floor({part})", f"round_even(({part} - floor({part})) * 1000000, 0)"))
    return (f"CAST(CAST(({whole} * 1000000 + {below}) * 1000000 + {rest} AS VARCHAR) || 'e-12' "
            "AS DOUBLE)")


def mavg(value):
    return f"({msum(value)} / count({value}))"


LAYERS_SQL = """
WITH raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS InvoiceNo,
         CAST(l_partkey AS VARCHAR) AS StockCode,
         p_name || ' ' || p_type AS Description,
         CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS Quantity,
         o_orderdate + to_minutes((o_orderkey % 24) * 60 + (o_orderkey * 7) % 60) AS InvoiceDate,
         CASE WHEN l_linenumber = 7 AND l_quantity = 1 THEN 0.0
              ELSE l_extendedprice / l_quantity END AS UnitPrice,
         CASE WHEN l_orderkey % 7 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS CustomerID,
         n_name AS Country,
         concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                   strftime(l_shipdate, '%Y%m%d'),
                   CAST(round_even(l_extendedprice * 100, 0) AS BIGINT)) AS RowKey
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
), priced AS (
  SELECT *, Quantity * UnitPrice AS TotalPrice,
         CAST(hour(InvoiceDate) AS DOUBLE) AS Hour,
         CAST(day(InvoiceDate) AS DOUBLE) AS Day,
         CAST(month(InvoiceDate) AS DOUBLE) AS MonthNum,
         CAST(dayofweek(InvoiceDate) AS DOUBLE) AS WeekdayNum,
         strftime(InvoiceDate, '%Y-%m') AS Month
  FROM raw
), timed AS (
  SELECT *, CASE WHEN TotalPrice > 60000 THEN 'High' WHEN TotalPrice > 20000 THEN 'Medium'
                 ELSE 'Low' END AS RevenueCategory
  FROM priced
  WHERE InvoiceNo IS NOT NULL AND StockCode IS NOT NULL AND Description IS NOT NULL
    AND Quantity > 0 AND InvoiceDate IS NOT NULL AND UnitPrice > 0
    AND CustomerID IS NOT NULL AND Country IS NOT NULL
), country_codes AS (
  SELECT Country, CAST(row_number() OVER (ORDER BY count(*) DESC, Country) - 1 AS DOUBLE)
         AS CountryEncoded
  FROM timed GROUP BY Country
), product_stats AS (
  SELECT StockCode, CAST(count(*) AS DOUBLE) AS ProductFrequency FROM timed GROUP BY StockCode
), customer_stats AS (
  SELECT CustomerID,
         """ + msum("TotalPrice") + """ / count(*) AS AvgCustomerSpend,
         CAST(count(*) AS DOUBLE) AS CustomerFrequency,
         sum(Quantity) AS CustomerTotalQty,
         coalesce(stddev_samp(TotalPrice), 0.0) AS CustomerPriceStd
  FROM timed GROUP BY CustomerID
), featured AS (
  SELECT t.*, CountryEncoded, ProductFrequency, AvgCustomerSpend, CustomerFrequency,
         CustomerTotalQty, CustomerPriceStd
  FROM timed t JOIN country_codes USING (Country) JOIN product_stats USING (StockCode)
  JOIN customer_stats USING (CustomerID)
), score_limit AS (
  SELECT quantile_cont(-TotalPrice, 0.02) AS score_limit FROM timed
), flagged AS (
  SELECT timed.*, -TotalPrice - score_limit AS anomaly_score,
         CASE WHEN -TotalPrice - score_limit < 0 THEN 1 ELSE 0 END AS anomaly,
         CASE WHEN UnitPrice > 20000 THEN 'Expensive Product'
              WHEN TotalPrice > 95000 THEN 'High Transaction'
              WHEN Quantity > 45 THEN 'Large Quantity' ELSE 'Normal' END AS anomaly_reason
  FROM timed CROSS JOIN score_limit
), scored_features AS (
  SELECT featured.*, anomaly_score, anomaly, anomaly_reason
  FROM featured JOIN (SELECT RowKey, anomaly_score, anomaly, anomaly_reason FROM flagged)
    USING (RowKey)
)
"""


def rounded(value, digits):
    """Half-up rounding of the decimal value, as Spark rounds doubles."""
    return f"CAST(round(CAST({value} AS DECIMAL(28,9)), {digits}) AS DOUBLE)"
