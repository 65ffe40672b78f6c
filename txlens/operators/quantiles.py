"""Exact quantiles with linear interpolation, for columns of any size.

Up to ``limit`` values per column the built-in ``percentile`` does it. Beyond that its
state (every distinct value in one buffer) is too large. Then two approximate quantiles
enclose each wanted rank; rows below, at and between the two values are counted, and the
rank is found at one of them or lies in an open band that no longer holds them, so every
pass makes the band smaller, whatever values are frequent. When few rows are left in a
band, they are looked at one by one. Every step is one pass for all columns and
probabilities together, over a staged copy of just these columns.
"""

from math import ceil, floor

from pyspark.sql import Window
from pyspark.sql import functions as F

from txlens.functions.money import known
from txlens.staging import stage

DIRECT_ROWS = 100_000
ACCURACY = 10_000


class _Search:
    """Where the value of one column at one rank is looked for: above ``low``, below ``high``."""

    def __init__(self, column, rank, size):
        self.column, self.rank, self.inside = column, rank, size
        self.low = self.high = self.found = None
        self.below = 0

    def in_band(self):
        value = F.col(self.column)
        inside = value.isNotNull()
        if self.low is not None:
            inside = inside & (value > self.low)
        if self.high is not None:
            inside = inside & (value < self.high)
        return inside

    def open(self, limit):
        return self.found is None and self.inside > limit

    def bounds(self, accuracy):
        """Two values of the band, a little below and above the rank."""
        margin = 4 / accuracy
        place = (self.rank - self.below) / self.inside
        return F.percentile_approx(F.when(self.in_band(), F.col(self.column)),
                                   [max(place - margin, 0.0), min(place + margin, 1.0)], accuracy)

    def counts(self, low, high):
        value, band = F.col(self.column), self.in_band()
        return F.struct(*[F.count_if(band & test).alias(name) for name, test in (
            ("under", value < low), ("at_low", value == low), ("between", (value > low) & (value < high)),
            ("at_high", (value == high) & F.lit(low < high)))])

    def narrow(self, low, high, under, at_low, between, at_high):
        place = self.rank - self.below
        if place < under:
            self.high, self.inside = low, under
        elif place < under + at_low:
            self.found = low
        elif place < under + at_low + between:
            self.low, self.high, self.inside = low, high, between
            self.below += under + at_low
        elif place < under + at_low + between + at_high:
            self.found = high
        else:
            passed = under + at_low + between + at_high
            self.low, self.inside, self.below = high, self.inside - passed, self.below + passed


def _one_pass(df, parts):
    return df.agg(*[part.alias(str(i)) for i, part in enumerate(parts)]).first()


def _values_at_ranks(df, searches):
    """One pass over the rows of all bands; equal values are counted before they move.

    A band holds at most ``limit`` rows, which also bounds the window's partitions.
    """
    members = F.array(*[
        F.when(search.in_band(), F.struct(F.lit(i).alias("i"), F.col(search.column).alias("v")))
        for i, search in enumerate(searches)
    ])
    steps = df.select(F.inline(F.filter(members, lambda m: m.isNotNull()))).groupBy("i", "v").count()
    running = Window.partitionBy("i").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.withColumn("upto", F.sum("count").over(running))
    wanted = F.lit(False)
    for i, search in enumerate(searches):
        place = search.rank - search.below
        wanted = wanted | ((F.col("i") == i) & (F.col("upto") > place)
                           & (F.col("upto") - F.col("count") <= place))
    for row in steps.where(wanted).collect():
        searches[row["i"]].found = row["v"]


def exact_quantiles(df, columns, probabilities, limit=DIRECT_ROWS, accuracy=ACCURACY, staged=False):
    """``{column: [value per probability]}``; NULL and NaN are left out, no rows gives None.

    ``staged``: ``df`` is a plain scan already and need not be written first.
    """
    columns, probabilities = list(columns), list(probabilities)
    numbers = df.select(*[known(name).alias(name) for name in columns])
    numbers = numbers if staged else stage(numbers)
    sizes = dict(zip(columns, _one_pass(numbers, [F.count(name) for name in columns])))
    small = [name for name in columns if sizes[name] <= limit]
    result = {}
    if small:
        row = _one_pass(numbers, [F.percentile(name, probabilities) for name in small])
        result = {name: values or [None] * len(probabilities) for name, values in zip(small, row)}
    searches = {}
    for name in columns:
        if name not in result:
            for p in probabilities:
                position = (sizes[name] - 1) * p
                for rank in {floor(position), ceil(position)}:
                    searches.setdefault((name, rank), _Search(name, rank, sizes[name]))
    while wide := [search for search in searches.values() if search.open(limit)]:
        bands = _one_pass(numbers, [search.bounds(accuracy) for search in wide])
        counts = _one_pass(numbers, [s.counts(*band) for s, band in zip(wide, bands)])
        for search, band, count in zip(wide, bands, counts):
            search.narrow(*band, *count)
    if left := [search for search in searches.values() if search.found is None]:
        _values_at_ranks(numbers, left)
    for name in columns:
        if name not in result:
            result[name] = []
            for p in probabilities:
                position = (sizes[name] - 1) * p
                lower, upper = searches[name, floor(position)].found, searches[name, ceil(position)].found
                share = position - floor(position)
                result[name].append(float(lower) if lower == upper else (1 - share) * lower + share * upper)
    return result
