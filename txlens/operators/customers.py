"""Customer tables: recency, frequency, spend and the labels built on them."""

from pyspark.sql import functions as F

from txlens.functions.money import money_avg, money_sum, round_half_up
from txlens.functions.rules import customer_segment, customer_type
from txlens.functions.timeparts import days_between
from txlens.operators.ordering import top_k
from txlens.params import DEFAULTS


def customer_rfm(df):
    """One row per customer; ``Frequency`` counts invoices, not lines."""
    newest = df.agg(F.max("InvoiceDate")).scalar()
    return df.groupBy("CustomerID").agg(
        F.max("InvoiceDate").alias("LastPurchaseDate"),
        F.countDistinct("InvoiceNo").alias("Frequency"),
        round_half_up(money_sum("TotalPrice"), 2).alias("Monetary"),
        round_half_up(money_avg("TotalPrice"), 2).alias("AvgTransaction"),
        F.sum("Quantity").alias("TotalQuantity"),
    ).withColumn("Recency", days_between(newest, F.col("LastPurchaseDate")))


def customer_segments(df, limits=DEFAULTS):
    """RFM table with its segment; sort it (by Monetary) only to present it."""
    return customer_rfm(df).withColumn("Segment", customer_segment(limits))


def customer_behavior(df, limits=DEFAULTS):
    return df.groupBy("CustomerID").agg(
        F.countDistinct("InvoiceNo").alias("TotalTransactions"),
        money_sum("TotalPrice").alias("TotalSpent"),
        money_avg("TotalPrice").alias("AverageTransactionValue"),
        F.avg("Quantity").alias("AverageQuantity"),
        F.max("InvoiceDate").alias("LastTransactionDate"),
    ).withColumn("CustomerType", customer_type(limits))


def top_customers_by_avg_spend(df, n=10):
    """Takes the featured layer. A customer of several countries shows the first by name.

    The least of a text cannot be kept in a hash table and would sort all rows; so countries are
    grouped first, and only one row for each customer and country is sorted.
    """
    measures = ("AvgCustomerSpend", "CustomerFrequency", "CustomerTotalQty")
    by_country = df.groupBy("CustomerID", "Country").agg(*[F.max(name).alias(name) for name in measures])
    grouped = by_country.groupBy("CustomerID").agg(
        F.max("AvgCustomerSpend").alias("AvgSpend"),
        F.max("CustomerFrequency").alias("TransactionCount"),
        F.max("CustomerTotalQty").alias("TotalQty"),
        F.min("Country").alias("Country"),
    )
    return top_k(grouped, "AvgSpend", n, "CustomerID")


def customer_spend_frequency(df):
    return df.where(F.col("CustomerID").isNotNull()).groupBy("CustomerID").agg(
        money_sum("TotalPrice").alias("TotalSpend"), F.count("TotalPrice").alias("Frequency")
    )


def top_customers_by_revenue(df, n=10):
    grouped = df.where(F.col("CustomerID").isNotNull()).groupBy("CustomerID").agg(
        money_sum("TotalPrice").alias("Revenue")
    )
    return top_k(grouped, "Revenue", n, "CustomerID")


def top_customers_by_lines(df, n=10):
    grouped = df.where(F.col("CustomerID").isNotNull()).groupBy("CustomerID").agg(
        F.count("*").alias("Frequency")
    )
    return top_k(grouped, "Frequency", n, "CustomerID")
