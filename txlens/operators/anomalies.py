"""Flagging of scored rows and the tables about flagged rows."""

from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from txlens.functions.money import money_avg, money_sum, percentage, round_half_up
from txlens.functions.rules import rate_alert, rate_level, status_label
from txlens.functions.timeparts import calendar_day
from txlens.operators.ordering import top_k
from txlens.operators.quantiles import exact_quantiles
from txlens.operators.sales import weekday_count
from txlens.params import DEFAULTS


def flag_anomalies(df, score="score", contamination=DEFAULTS.contamination):
    """``anomaly`` = 1 for scores below the contamination quantile of all scores."""
    offset = exact_quantiles(df, [score], [contamination])[score][0]
    shifted = F.col(score) - F.lit(offset)
    return df.withColumn("anomaly_score", shifted).withColumn(
        "anomaly", F.when(F.col("anomaly_score") < 0, 1).otherwise(0)
    )


def only_anomalies(df):
    return df.where(F.col("anomaly") == 1)


def only_normal(df):
    return df.where(F.col("anomaly") == 0)


def split_anomaly(df):
    return only_anomalies(df), only_normal(df)


def search_anomalies(df, pattern, columns=("InvoiceNo", "CustomerID"), literal=False):
    """Flagged rows where any of the columns matches, whatever the letter case."""
    def matches(name):
        text = F.col(name).cast("string")
        if literal:
            found = F.contains(F.lower(text), F.lower(F.lit(pattern)))
        else:
            found = text.rlike(f"(?i){pattern}")
        return F.coalesce(found, F.lit(False))

    tests = [matches(name) for name in columns if name in df.columns]
    return only_anomalies(df).where(reduce(or_, tests, F.lit(False)))


def anomaly_distribution(df):
    """Count and share of normal and flagged rows."""
    counts = df.agg(
        F.count("*").alias("Total"),
        F.count_if(F.col("anomaly") == 0).alias("Normal"),
        F.count_if(F.col("anomaly") == 1).alias("Anomaly"),
    )
    rows = counts.select("Total", F.inline(F.array(*[
        F.struct(F.lit(name).alias("Status"), F.col(name).alias("Count"))
        for name in ("Normal", "Anomaly")
    ])))
    return rows.select("Status", "Count", percentage("Count", "Total", 1).alias("Percent"))


def anomaly_summary(df, limits=DEFAULTS):
    flagged = F.col("anomaly") == 1
    base = df.agg(
        F.count("*").alias("Transactions"),
        F.count_if(flagged).alias("Anomalies"),
        round_half_up(money_avg(F.when(flagged, F.col("TotalPrice"))), 2).alias("AvgAnomalyPrice"),
        round_half_up(F.max(F.when(flagged, F.col("TotalPrice"))), 2).alias("MaxAnomalyPrice"),
        money_avg("TotalPrice").alias("_mean"),
    )
    rated = base.withColumn("AnomalyPercent", percentage("Anomalies", "Transactions", 2))
    loss = round_half_up(F.col("Anomalies") * F.col("_mean"), 2)
    return rated.select(
        "Transactions", "Anomalies", "AnomalyPercent", "AvgAnomalyPrice", "MaxAnomalyPrice",
        F.coalesce(loss, F.lit(0.0)).alias("EstimatedLoss"),
        rate_alert(F.col("AnomalyPercent"), limits).alias("Alert"),
        rate_level(F.col("AnomalyPercent"), limits).alias("Level"),
    )


def anomaly_rate_by_country(df, n=15):
    """Countries with most flagged rows: both counts and the flagged share."""
    counts = df.where(F.col("Country").isNotNull()).groupBy("Country").agg(
        F.count_if(F.col("anomaly") == 1).alias("Anomalies"),
        F.count_if(F.col("anomaly") == 0).alias("Normals"),
    ).where(F.col("Anomalies") > 0)
    rated = counts.withColumn("Total", F.col("Anomalies") + F.col("Normals")).withColumn(
        "AnomalyPercent", percentage("Anomalies", "Total", 1)
    )
    return top_k(rated, "Anomalies", n, "Country")


def anomaly_count_by_country(df, n=15):
    grouped = only_anomalies(df).where(F.col("Country").isNotNull()).groupBy("Country")
    return top_k(grouped.agg(F.count("*").alias("Count")), "Count", n, "Country")


def anomaly_revenue_by_country(df, n=15):
    grouped = only_anomalies(df).where(F.col("Country").isNotNull()).groupBy("Country")
    return top_k(grouped.agg(money_sum("TotalPrice").alias("Revenue")), "Revenue", n, "Country")


def daily_anomalies(df):
    days = only_anomalies(df).where(F.col("InvoiceDate").isNotNull()).groupBy(
        calendar_day("InvoiceDate").alias("Date")
    )
    return days.agg(F.count("*").alias("Count")).orderBy("Date")


def hourly_anomalies(df):
    hours = only_anomalies(df).where(F.col("Hour").isNotNull()).groupBy("Hour")
    return hours.agg(F.count("*").alias("Count")).orderBy("Hour")


def weekday_anomalies(df):
    return weekday_count(only_anomalies(df))


def anomaly_reason_breakdown(df):
    grouped = only_anomalies(df).where(F.col("anomaly_reason").isNotNull())
    grouped = grouped.groupBy("anomaly_reason").agg(F.count("*").alias("Count"))
    return grouped.orderBy(F.col("Count").desc(), "anomaly_reason")


def top_anomalies(df, n=20, *ties):
    return top_k(only_anomalies(df), "TotalPrice", n, *ties)


def with_status(df):
    return df.withColumn("Status", status_label())
