"""Feature columns of the invoice lines."""

from pyspark.sql import functions as F

from txlens.functions import timeparts as tp
from txlens.functions.money import money_avg
from txlens.functions.rules import revenue_category
from txlens.operators.lookup import attach
from txlens.params import DEFAULTS
from txlens.schemas import FEATURE_DEFAULTS, NUMERIC_FEATURES
from txlens.staging import stage


def with_invoice_time(df):
    """InvoiceDate text to timestamp; a timestamp column passes through."""
    if dict(df.dtypes)["InvoiceDate"] == "string":
        return df.withColumn("InvoiceDate", tp.parse_invoice_date("InvoiceDate"))
    return df


def with_time_features(df, week_start="sunday"):
    return with_invoice_time(df).withColumns({
        "Hour": tp.hour_number("InvoiceDate"),
        "Day": tp.day_number("InvoiceDate"),
        "MonthNum": tp.month_number("InvoiceDate"),
        "WeekdayNum": tp.weekday_number("InvoiceDate", week_start),
        "Month": tp.month_label("InvoiceDate"),
    })


def with_revenue_category(df, limits=DEFAULTS):
    return df.withColumn("RevenueCategory", revenue_category(limits))


def product_frequency(df):
    return df.where(F.col("StockCode").isNotNull()).groupBy("StockCode").agg(
        F.count("*").alias("ProductFrequency")
    )


def customer_features(df):
    return df.where(F.col("CustomerID").isNotNull()).groupBy("CustomerID").agg(
        money_avg("TotalPrice").alias("AvgCustomerSpend"),
        F.count("*").alias("CustomerFrequency"),
        F.sum("Quantity").alias("CustomerTotalQty"),
        F.stddev("TotalPrice").alias("CustomerPriceStd"),
    )


def with_product_frequency(df, source=None):
    """``source``: the rows to count, where they are cheaper to read than ``df``."""
    return attach(df, product_frequency(source or df), "StockCode", {"ProductFrequency": 0})


def with_customer_features(df, source=None):
    """Mean, lines, quantity and sample deviation of the row's customer."""
    return attach(df, customer_features(source or df), "CustomerID")


def with_customer_features_in_place(df):
    """The same for a layer in buckets of CustomerID: grouped and joined where the rows are."""
    return df.join(customer_features(df), "CustomerID", "left")


def with_dashboard_features(df):
    """The dashboard's variant: no frequency below 1, unknown customers get the mean.

    The rows are staged, as the mean and the two lookup tables read them too.
    """
    df = stage(df)
    overall = df.agg(money_avg("TotalPrice").alias("m")).first()["m"]
    rows = attach(df, product_frequency(df), "StockCode", {"ProductFrequency": 1})
    return attach(rows, customer_features(df), "CustomerID", {
        "AvgCustomerSpend": overall,
        "CustomerFrequency": 1,
        "CustomerTotalQty": 0.0,
        "CustomerPriceStd": 0.0,
    })


def fill_defaults(df, defaults=FEATURE_DEFAULTS):
    return df.fillna({name: value for name, value in defaults.items() if name in df.columns})


def cast_numeric(df, columns=NUMERIC_FEATURES):
    return df.withColumns(
        {name: F.col(name).cast("double") for name in columns if name in df.columns}
    )


def project_available(df, wanted):
    return df.select([name for name in wanted if name in df.columns])
