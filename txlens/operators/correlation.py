"""Pearson correlations of numeric columns from a shared table of moments.

One scan: every task turns its Arrow batches into products of the value matrix and of the mask
of known values, which hold counts, means and central sums of all pairs at once, over the rows
where both values are known. A hundred sums of pairs in one aggregate would be a method too
long for the JVM to compile. The tables of the tasks are small; their means are combined
first, then the sums around the combined means, so nothing is lost to large means.
"""

import sys
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from txlens.functions.rules import direction_label
from txlens.staging import stage

# Tasks get the helpers below by value: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOMENTS = ("n", "mx", "my", "sxx", "syy", "sxy", "lx", "hx", "ly", "hy")


def _ends(values, known, right, other):
    """Least and highest value of every column (``other``: of every right column) over each pair's rows."""
    if known.all():
        low, high = (np.broadcast_to(v[:, None], (len(v), len(right))) for v in (values.min(axis=0), values.max(axis=0)))
        return [np.broadcast_to(v[right, 0], v.shape) for v in (low, high)] if other else [low, high]
    found = []
    for reduce, empty in ((np.min, np.inf), (np.max, -np.inf)):
        found.append(np.stack([
            reduce(np.where(known & known[:, [j]], values[:, [j]] if other else values, empty), axis=0)
            for j in right], axis=1))
    return found


def _batch_moments(values, known, right):
    """Moments (columns by right columns) of one batch."""
    first = np.where(known.any(axis=0), values[known.argmax(axis=0), np.arange(values.shape[1])], 0.0)
    near, mask = np.where(known, values - first, 0.0), known.astype(float)
    n = mask.T @ mask[:, right]
    some = np.maximum(n, 1)
    sx, sy = near.T @ mask[:, right], mask.T @ near[:, right]
    return np.stack([
        n, first[:, None] + sx / some, first[right] + sy / some, (near**2).T @ mask[:, right] - sx**2 / some,
        mask.T @ (near[:, right]**2) - sy**2 / some, near.T @ near[:, right] - sx * sy / some,
        *_ends(values, known, right, False), *_ends(values, known, right, True)])


def _merged(one, two):
    """The moments of two sets of rows together."""
    n = one[0] + two[0]
    share = two[0] / np.maximum(n, 1)
    dx, dy, weight = two[1] - one[1], two[2] - one[2], one[0] * share
    dx, dy = np.where(weight > 0, dx, 0.0), np.where(weight > 0, dy, 0.0)
    only = one[0] == 0
    return np.stack([
        n, np.where(only, two[1], one[1] + dx * share), np.where(only, two[2], one[2] + dy * share),
        one[3] + two[3] + dx * dx * weight, one[4] + two[4] + dy * dy * weight, one[5] + two[5] + dx * dy * weight,
        np.minimum(one[6], two[6]), np.maximum(one[7], two[7]), np.minimum(one[8], two[8]), np.maximum(one[9], two[9])])


def _coefficients(df, columns, right):
    """(Left, Right, Correlation) of every column with every one of ``right``.

    NULL where a side is constant over the rows of the pair.
    """
    places = [columns.index(name) for name in right]

    def run(batches):
        held = None
        for batch in batches:
            if batch.num_rows:
                known = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
                values = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
                part = _batch_moments(values, known, places)
                held = part if held is None else _merged(held, part)
        if held is not None:
            pairs = [(i, j) for i in range(len(columns)) for j in range(len(places))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([columns[i] for i, _ in pairs]), pa.array([right[j] for _, j in pairs]),
                 *[pa.array([table[i, j] for i, j in pairs], pa.float64()) for table in held]], ["Left", "Right", *MOMENTS])

    numbers = df.select(*[F.col(name).cast("double").alias(name) for name in columns])
    kinds = ", ".join(f"{name} double" for name in MOMENTS)
    parts = stage(numbers.mapInArrow(run, f"Left string, Right string, {kinds}"))
    whole = parts.groupBy("Left", "Right").agg(
        (F.sum(F.col("mx") * F.col("n")) / F.greatest(F.sum("n"), F.lit(1.0))).alias("ax"),
        (F.sum(F.col("my") * F.col("n")) / F.greatest(F.sum("n"), F.lit(1.0))).alias("ay"))
    dx, dy = F.col("mx") - F.col("ax"), F.col("my") - F.col("ay")
    sums = parts.join(whole, ["Left", "Right"]).groupBy("Left", "Right").agg(
        F.sum(F.col("sxx") + F.col("n") * dx * dx).alias("sxx"), F.sum(F.col("syy") + F.col("n") * dy * dy).alias("syy"),
        F.sum(F.col("sxy") + F.col("n") * dx * dy).alias("sxy"),
        ((F.min("lx") < F.max("hx")) & (F.min("ly") < F.max("hy"))).alias("varies"))
    value = F.try_divide("sxy", F.sqrt("sxx") * F.sqrt("syy"))
    return sums.select("Left", "Right", F.when(F.col("varies"), value).alias("Correlation"))


def correlation_pairs(df, columns):
    """Long form (Left, Right, Correlation), each unordered pair once.

    Every pair uses the rows where both values are known; a constant column correlates with
    nothing (NULL).
    """
    columns = list(columns)
    return _named(_coefficients(df, columns, columns), df, list(combinations(columns, 2)))


def _named(found, df, pairs):
    """The coefficients of the pairs named; NULL where there are no rows at all."""
    wanted = df.sparkSession.createDataFrame(pairs, "Left string, Right string")
    return wanted.join(found, ["Left", "Right"], "left")


def correlation_matrix(df, columns):
    """Wide form: one row and one column per feature."""
    columns = list(columns)
    pairs = [(a, b) for a in columns for b in columns]
    found = _named(_coefficients(df, columns, columns), df, pairs)
    value = F.when(F.col("Left") == F.col("Right"), F.when(F.col("Correlation").isNotNull(), 1.0)).otherwise(F.col("Correlation"))
    return found.groupBy(F.col("Left").alias("Feature")).agg(
        *[F.max(F.when(F.col("Right") == name, value)).alias(name) for name in columns])


def top_anomaly_correlations(df, columns, target="anomaly", n=10):
    """Features by strength of their correlation with the flag: one pair for each of them."""
    others = [name for name in columns if name != target]
    found = _coefficients(df, [*others, target], [target])
    strongest = _named(found, df, [(name, target) for name in others]).select(
        F.col("Left").alias("Feature"), "Correlation",
        F.abs("Correlation").alias("Strength"), direction_label("Correlation").alias("Direction"),
    )
    return strongest.orderBy(F.col("Strength").desc_nulls_last(), "Feature").limit(n)
