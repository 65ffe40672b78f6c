"""Row cleaning: incomplete rows, returns and free items leave, TotalPrice arrives."""

from pyspark.sql import functions as F

from txlens.functions.money import percentage


def strip_column_names(df):
    return df.toDF(*[name.strip() for name in df.columns])


def drop_incomplete(df, columns=None):
    """Drop rows with an empty value, in any column or in the given ones."""
    return df.dropna(subset=columns)


def filter_positive_quantity(df):
    return df.where(F.col("Quantity") > 0)


def filter_positive_price(df):
    return df.where(F.col("UnitPrice") > 0)


def with_total_price(df):
    return df.withColumn("TotalPrice", F.col("Quantity") * F.col("UnitPrice"))


def coerce_numeric(df, columns):
    """Text to double; text that is no number (or spells NaN) becomes NULL."""
    def number(name):
        value = F.col(name).try_cast("double")
        return F.when(~F.isnan(value), value)

    return df.withColumns({name: number(name) for name in columns if name in df.columns})


def require_numbers(df, columns):
    """Coerce, then drop every row that lacks one of the numbers."""
    present = [name for name in columns if name in df.columns]
    return coerce_numeric(df, present).dropna(subset=present)


def returns(df):
    """Lines with a negative quantity; takes rows that were not cleaned yet."""
    return df.where(F.col("Quantity") < 0).withColumn("Quantity_Abs", F.abs("Quantity"))


def cleaning_report(df):
    """What every cleaning step removes, from one pass over the raw rows."""
    complete = F.lit(True)
    for name in df.columns:
        complete = complete & F.col(name).isNotNull()
    sold = complete & (F.col("Quantity") > 0)
    priced = sold & (F.col("UnitPrice") > 0)
    counts = df.agg(
        F.count("*").alias("InitialRows"),
        *[F.count_if(F.col(name).isNull()).alias(f"Missing_{name}") for name in df.columns],
        F.count_if(complete).alias("RowsComplete"),
        F.count_if(sold).alias("RowsPositiveQuantity"),
        F.count_if(priced).alias("RowsPositivePrice"),
    )
    return counts.withColumns({
        "DroppedIncomplete": F.col("InitialRows") - F.col("RowsComplete"),
        "DroppedQuantity": F.col("RowsComplete") - F.col("RowsPositiveQuantity"),
        "DroppedPrice": F.col("RowsPositiveQuantity") - F.col("RowsPositivePrice"),
        "DroppedTotal": F.col("InitialRows") - F.col("RowsPositivePrice"),
        "KeptPercent": percentage("RowsPositivePrice", "InitialRows", 1),
    })
