"""Tables about returned goods. Input: rows before cleaning, with TotalPrice."""

from pyspark.sql import functions as F

from txlens.functions.money import money_sum, percentage
from txlens.functions.timeparts import calendar_day
from txlens.operators.cleaning import returns
from txlens.operators.ordering import top_k


def return_kpis(df):
    returned = F.col("Quantity") < 0
    counts = df.agg(
        F.count("*").alias("Transactions"),
        F.count_if(returned).alias("Returns"),
        F.coalesce(money_sum(F.when(returned, F.abs("TotalPrice"))), F.lit(0.0)).alias("ReturnValue"),
    )
    return counts.withColumn("ReturnPercent", percentage("Returns", "Transactions", 1))


def _returned_units(df, key, n):
    grouped = returns(df).where(F.col(key).isNotNull()).groupBy(key).agg(
        F.sum("Quantity_Abs").alias("Units")
    )
    return top_k(grouped, "Units", n, key)


def returns_by_product(df, n=10):
    return _returned_units(df, "Description", n)


def returns_by_country(df, n=10):
    return _returned_units(df, "Country", n)


def daily_returns(df):
    days = returns(df).where(F.col("InvoiceDate").isNotNull()).groupBy(
        calendar_day("InvoiceDate").alias("Date")
    )
    return days.agg(F.sum("Quantity_Abs").alias("Units")).orderBy("Date")
