"""Descriptive statistics of columns and tables."""

from pyspark.sql import functions as F

from txlens.functions.money import known, money_avg, percentage, round_half_up
from txlens.operators.quantiles import exact_quantiles
from txlens.staging import stage


def _spread(column, label, *measures):
    known = {
        "Min": F.min, "Max": F.max, "Avg": F.avg, "Std": F.stddev,
    }
    return [known[name](column).alias(f"{name}{label}") for name in measures]


def raw_stats(df):
    return df.agg(*_spread("Quantity", "Quantity", "Min", "Max", "Avg"),
                  *_spread("UnitPrice", "UnitPrice", "Min", "Max", "Avg"))


def total_price_stats(df):
    return df.agg(*_spread("TotalPrice", "TotalPrice", "Min", "Max", "Std"),
                  money_avg("TotalPrice").alias("AvgTotalPrice"))


def time_feature_stats(df):
    return df.agg(*_spread("Hour", "Hour", "Min", "Max", "Avg"),
                  *_spread("Day", "Day", "Min", "Max"),
                  *_spread("MonthNum", "Month", "Min", "Max"))


def product_frequency_stats(df):
    return df.agg(*_spread("ProductFrequency", "Frequency", "Min", "Max", "Avg", "Std"))


def customer_feature_stats(df):
    return df.agg(*_spread("AvgCustomerSpend", "Spend", "Min", "Max", "Avg"),
                  *_spread("CustomerFrequency", "Frequency", "Max", "Avg"),
                  *_spread("CustomerTotalQty", "TotalQty", "Max", "Avg"),
                  *_spread("CustomerPriceStd", "PriceStd", "Avg"))


def load_stats(df):
    return df.agg(F.count("*").alias("TotalRecords"),
                  *_spread("TotalPrice", "Price", "Min", "Max"),
                  money_avg("TotalPrice").alias("AvgPrice"),
                  *_spread("Quantity", "Qty", "Min", "Max", "Avg"))


def value_range(df, column):
    return df.agg(*_spread(column, "Value", "Min", "Max"))


def distinct_values(df, column):
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def count_distinct(df, column, approximate=False):
    counter = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(counter(column).alias("DistinctValues"))


def distinct_rows(df, columns, n):
    """The first ``n`` distinct combinations, in their own order."""
    return df.select(*columns).distinct().orderBy(*columns).limit(n)


def _binned(df, column, bins):
    """Values with their bin 1..bins, and the lowest and highest value of all."""
    values = df.withColumn("_value", known(column)).where(F.col("_value").isNotNull())
    edges = values.agg(
        F.struct(F.min("_value").alias("low"), F.max("_value").alias("high"))
    ).scalar()
    low, high = edges.getField("low"), edges.getField("high")
    position = F.floor(F.try_divide((F.col("_value") - low) * bins, high - low))
    number = F.least(F.coalesce(position, F.lit(0)).cast("int") + 1, F.lit(bins))
    return values.withColumn("Bin", number), low, high


def _all_bins(spark, bins):
    return spark.range(1, bins + 1).select(F.col("id").cast("int").alias("Bin"))


def histogram(df, column, bins):
    """Equal-width bins from minimum to maximum; the maximum belongs to the last bin."""
    binned, low, high = _binned(df, column, bins)
    counts = binned.groupBy("Bin").agg(F.count("*").alias("Count"))
    width = (high - low) / bins
    return _all_bins(df.sparkSession, bins).join(counts, "Bin", "left").select(
        "Bin",
        (low + (F.col("Bin") - 1) * width).alias("LowEdge"),
        (low + F.col("Bin") * width).alias("HighEdge"),
        F.coalesce("Count", F.lit(0)).alias("Count"),
    ).orderBy("Bin")


def histogram_by_status(df, column, bins):
    """The outline of a violin: one histogram per class over a common range."""
    binned, _, _ = _binned(df, column, bins)
    counts = binned.groupBy("Bin").agg(
        F.count_if(F.col("anomaly") == 0).alias("Normal"),
        F.count_if(F.col("anomaly") == 1).alias("Anomaly"),
    )
    return _all_bins(df.sparkSession, bins).join(counts, "Bin", "left").na.fill(0).orderBy("Bin")


def box_summary(df, column, limit=None):
    """Quartiles, extremes and whiskers (1.5 quartile ranges) of both classes.

    One pass over the source; the quartiles of both classes are searched together.
    """
    options = {} if limit is None else {"limit": limit}
    value = known(column)
    classes = {"Normal": 0, "Anomaly": 1}
    values = stage(df.select(*[F.when(F.col("anomaly") == flag, value).alias(name)
                               for name, flag in classes.items()]))
    quartiles = exact_quantiles(values, classes, [0.25, 0.5, 0.75], staged=True, **options)
    measures = []
    for name, (q1, median, q3) in quartiles.items():
        reach = None if q1 is None else 1.5 * (q3 - q1)
        inside_low = F.lit(None).cast("double") if q1 is None else F.when(F.col(name) >= q1 - reach, F.col(name))
        inside_high = F.lit(None).cast("double") if q1 is None else F.when(F.col(name) <= q3 + reach, F.col(name))
        measures.append(F.struct(
            F.lit(name).alias("Status"),
            F.count(name).alias("Count"),
            F.min(name).alias("Min"),
            F.lit(q1).cast("double").alias("Q1"),
            F.lit(median).cast("double").alias("Median"),
            F.lit(q3).cast("double").alias("Q3"),
            F.max(name).alias("Max"),
            F.min(inside_low).alias("LowerWhisker"),
            F.max(inside_high).alias("UpperWhisker"),
        ))
    return values.agg(F.array(*measures).alias("_classes")).select(F.inline("_classes"))


def _one_row_per_column(row, columns, parts):
    """Turn one wide row ``<part>_<i>`` into one row per column."""
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("Column"),
                 *[F.col(f"{part}_{i}").alias(part) for part in parts])
        for i, name in enumerate(columns)
    ])))


def describe_numeric(df, columns, limit=None):
    """Count, mean, deviation, extremes and quartiles, one row per column, 2 digits."""
    options = {} if limit is None else {"limit": limit}
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], **options)
    measures = []
    for i, name in enumerate(columns):
        q1, median, q3 = quartiles[name]
        for part, value in (
            ("Mean", F.avg(name)), ("Std", F.stddev(name)), ("Min", F.min(name)),
            ("P25", F.lit(q1)), ("P50", F.lit(median)), ("P75", F.lit(q3)), ("Max", F.max(name)),
        ):
            measures.append(round_half_up(value.cast("double"), 2).alias(f"{part}_{i}"))
        measures.append(F.count(name).alias(f"Count_{i}"))
    parts = ("Count", "Mean", "Std", "Min", "P25", "P50", "P75", "Max")
    return _one_row_per_column(df.agg(*measures), columns, parts)


def column_profile(df):
    """Type, filled and empty values of every column, from one pass."""
    types = dict(df.dtypes)
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count(F.col(f"`{name}`")).alias(f"NonNull_{i}") for i, name in enumerate(df.columns)],
    )
    long = counts.select("_rows", F.inline(F.array(*[
        F.struct(F.lit(name).alias("Column"), F.lit(types[name]).alias("Type"),
                 F.col(f"NonNull_{i}").alias("NonNull"))
        for i, name in enumerate(df.columns)
    ])))
    empty = F.col("_rows") - F.col("NonNull")
    return long.select("Column", "Type", "NonNull", empty.alias("Nulls"),
                       percentage(empty, "_rows", 1).alias("NullPercent"))


def document_counts(df):
    """Stored documents, flagged ones and those with a known hour."""
    counts = df.agg(
        F.count("*").alias("Documents"),
        F.count_if(F.col("anomaly") == 1).alias("Anomalies"),
        F.count("Hour").alias("WithHour"),
    )
    return counts.withColumn("AnomalyPercent", percentage("Anomalies", "Documents", 2))
