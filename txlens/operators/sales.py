"""Revenue tables by country, product, time and transaction."""

from pyspark.sql import functions as F

from txlens.functions import timeparts as tp
from txlens.functions.money import money_avg, money_sum, percentage, round_half_up
from txlens.operators.ordering import top_k
from txlens.params import DEFAULTS
from txlens.schemas import TOP_TRANSACTION_COLUMNS


def _known(df, *keys):
    """Rows whose grouping keys are known; dashboard tables leave the others out."""
    return df.dropna(subset=list(keys))


def filter_transactions(df, price_min=None, price_max=None, kind=None, country=None):
    """Inclusive price range, ``kind`` normal or anomaly, one country; None means all."""
    if price_min is not None:
        df = df.where(F.col("TotalPrice") >= price_min)
    if price_max is not None:
        df = df.where(F.col("TotalPrice") <= price_max)
    if kind is not None:
        df = df.where(F.col("anomaly") == {"normal": 0, "anomaly": 1}[kind])
    if country is not None:
        df = df.where(F.col("Country") == country)
    return df


def rows_by_country(df, n=10):
    return top_k(df.groupBy("Country").agg(F.count("*").alias("Rows")), "Rows", n, "Country")


def revenue_by_country(df, n=None):
    """Revenue per country, largest first; all countries when ``n`` is None."""
    grouped = _known(df, "Country").groupBy("Country").agg(
        money_sum("TotalPrice").alias("Revenue")
    )
    if n is None:
        return grouped.orderBy(F.col("Revenue").desc(), "Country")
    return top_k(grouped, "Revenue", n, "Country")


def transactions_by_country(df, n=15):
    grouped = _known(df, "Country").groupBy("Country").agg(F.count("*").alias("Transactions"))
    return top_k(grouped, "Transactions", n, "Country")


def revenue_category_distribution(df):
    grouped = df.groupBy("RevenueCategory").agg(F.count("*").alias("Count"))
    return grouped.orderBy(F.col("Count").desc(), "RevenueCategory")


def products_by_lines(df, n=10):
    grouped = df.groupBy("Description").agg(F.count("*").alias("TotalSold"))
    return top_k(grouped, "TotalSold", n, "Description")


def products_by_quantity(df, n=10):
    grouped = _known(df, "Description").groupBy("Description").agg(
        F.sum("Quantity").alias("Quantity")
    )
    return top_k(grouped, "Quantity", n, "Description")


def products_by_revenue(df, n=10):
    grouped = _known(df, "Description").groupBy("Description").agg(
        money_sum("TotalPrice").alias("Revenue")
    )
    return top_k(grouped, "Revenue", n, "Description")


def product_summary(df, n=50):
    grouped = _known(df, "Description").groupBy("Description").agg(
        F.sum("Quantity").alias("Volume"),
        money_sum("TotalPrice").alias("Revenue"),
        F.count("TotalPrice").alias("Transactions"),
    )
    return top_k(grouped, "Revenue", n, "Description")


def top_products(df, n=10):
    grouped = df.groupBy("StockCode", "Description").agg(
        F.count("*").alias("TransactionCount"),
        F.sum("Quantity").alias("TotalQuantity"),
        F.avg("UnitPrice").alias("AvgPrice"),
    )
    return top_k(grouped, "TransactionCount", n, "StockCode", "Description")


def top_product_frequency(df, n=10):
    grouped = df.groupBy("StockCode").agg(F.max("ProductFrequency").alias("Frequency"))
    return top_k(grouped, "Frequency", n, "StockCode")


def headline_kpis(df):
    """Rows, revenue, order value, anomalies and expected loss, in one pass.

    ``FraudLoss`` multiplies the rounded order value, ``EstimatedLoss`` the exact one.
    """
    base = df.agg(
        F.count("*").alias("Transactions"),
        round_half_up(money_sum("TotalPrice"), 2).alias("Revenue"),
        F.count_if(F.col("anomaly") == 1).alias("Anomalies"),
        F.count_if(F.col("anomaly") == 0).alias("Normals"),
        money_avg("TotalPrice").alias("_mean"),
        F.max("TotalPrice").alias("MaxTransaction"),
    )
    order_value = round_half_up("_mean", 2)
    return base.select(
        "Transactions", "Revenue", "Anomalies", "Normals", "MaxTransaction",
        order_value.alias("AvgOrderValue"),
        percentage("Anomalies", "Transactions", 2).alias("AnomalyPercent"),
        (F.col("Anomalies") * order_value).alias("FraudLoss"),
        round_half_up(F.col("Anomalies") * F.col("_mean"), 2).alias("EstimatedLoss"),
    )


def kpi_vs_target(kpis, limits=DEFAULTS):
    """Progress of the headline numbers towards their targets."""
    def within(value, limit):
        return F.when(value > limit, "Exceeded").otherwise("Safe")

    def share(value, limit, cap):
        return F.least(F.try_divide(value, F.lit(float(limit))) * cap, F.lit(float(cap)))

    revenue, anomalies = F.col("Revenue"), F.col("Anomalies")
    value, loss = F.col("AvgOrderValue"), F.col("FraudLoss")
    return kpis.select(
        share(revenue, limits.target_revenue, 100).alias("RevenuePercent"),
        share(value, limits.target_order_value, 100).alias("OrderValuePercent"),
        share(anomalies, limits.target_anomalies, 1).alias("AnomalyProgress"),
        within(anomalies, limits.target_anomalies).alias("AnomalyStatus"),
        share(loss, limits.target_loss, 1).alias("LossProgress"),
        within(loss, limits.target_loss).alias("LossStatus"),
    )


def daily_revenue(df):
    days = df.groupBy(tp.calendar_day("InvoiceDate").alias("Date"))
    return _known(days.agg(money_sum("TotalPrice").alias("Revenue")), "Date").orderBy("Date")


def hourly_revenue(df):
    hours = _known(df, "Hour").groupBy("Hour").agg(money_sum("TotalPrice").alias("Revenue"))
    return hours.orderBy("Hour")


def monthly_revenue(df):
    months = _known(df, "Month").groupBy("Month").agg(money_sum("TotalPrice").alias("Revenue"))
    return months.orderBy("Month")


def _by_weekday(df, value):
    days = df.groupBy(F.weekday("InvoiceDate").alias("DayNum")).agg(value)
    calendar = tp.weekday_table(df.sparkSession)
    return calendar.join(days, "DayNum", "left").orderBy("DayNum")


def weekday_revenue(df):
    """Seven rows, Monday first; a day without sales has NULL revenue."""
    return _by_weekday(df, money_sum("TotalPrice").alias("Revenue"))


def weekday_count(df, name="Count"):
    return _by_weekday(df, F.count("*").alias(name))


def _weekday_hour(df):
    return df.where(F.col("InvoiceDate").isNotNull()).groupBy(
        F.weekday("InvoiceDate").alias("DayNum"),
        tp.day_name("InvoiceDate").alias("Day"),
        F.hour("InvoiceDate").alias("Hour"),
    )


def weekday_hour_revenue(df):
    """Long form of the heatmap: one row per weekday and hour that has sales."""
    return _weekday_hour(df).agg(money_sum("TotalPrice").alias("Revenue")).orderBy(
        "DayNum", "Hour"
    )


def weekday_hour_heatmap(df):
    """One row per weekday with sales, one column per hour, 0 where nothing was sold."""
    hours = range(24)
    revenue = _weekday_hour(df).agg(money_sum("TotalPrice").alias("Revenue"))
    table = revenue.groupBy("DayNum", "Day").pivot("Hour", list(hours)).sum("Revenue").na.fill(0.0)
    return table.select(
        "DayNum", "Day", *[F.col(str(hour)).alias(f"H{hour:02d}") for hour in hours]
    ).orderBy("DayNum")


def peak_hour(df):
    return top_k(hourly_revenue(df), "Revenue", 1, "Hour")


def peak_day(df):
    days = df.where(F.col("InvoiceDate").isNotNull()).groupBy(
        tp.day_name("InvoiceDate").alias("Day")
    )
    return top_k(days.agg(money_sum("TotalPrice").alias("Revenue")), "Revenue", 1, "Day")


def top_transactions(df, n=10, *ties):
    return top_k(df, "TotalPrice", n, *ties).select(
        [name for name in TOP_TRANSACTION_COLUMNS if name in df.columns]
    )
