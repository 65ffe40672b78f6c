"""Quantiles under changing filters from mergeable sketches.

One pass keeps a KLL sketch of the values for each group of the finest filter (a month and a
status, say). Sketches of any choice of groups are merged when a filter is set, so the rows are
not read again. The rank of a value found differs from the one asked for by about
``2.3 / size ** 0.9`` of the rows at most (99 of 100 times).
"""

from pyspark.sql import functions as F

from txlens.functions.money import known

SIZE = 2048


def quantile_sketches(df, column, by, size=SIZE):
    """One sketch (``Sketch``) of the known values for each group, with their number ``Rows``."""
    values = df.select(*by, known(column).cast("double").alias("_value"))
    return values.groupBy(*by).agg(
        F.count("_value").alias("Rows"), F.kll_sketch_agg_double("_value", size).alias("Sketch"))


def sketched_quantiles(sketches, probabilities, by=(), size=SIZE):
    """Rows and approximate quantiles (``Quantiles``) for each group of ``by``, from merged sketches."""
    merged = sketches.where("Rows > 0").groupBy(*by).agg(
        F.sum("Rows").alias("Rows"), F.kll_merge_agg_double("Sketch", size).alias("_merged"))
    ranks = F.array(*[F.lit(float(p)) for p in probabilities])
    return merged.select(*by, "Rows", F.kll_sketch_get_quantile_double("_merged", ranks).alias("Quantiles"))


def sketched_boxes(sketches, by=("Status",), size=SIZE):
    """Approximate quartiles and median for each group of ``by``."""
    found = sketched_quantiles(sketches, (0.25, 0.5, 0.75), by, size)
    return found.select(*by, "Rows", *[F.col("Quantiles")[i].alias(name) for i, name in enumerate(("Q1", "Median", "Q3"))])
