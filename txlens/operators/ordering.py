"""Sorted extracts and row positions.

Positions are found without a window over the whole table: rows are range-partitioned
on the full ordering, every range is numbered on its own, and the (few) range totals
supply the offsets. Ties in the leading key are split by the following ones, so one
frequent value does not end up in one task.
"""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from txlens.functions.money import money_sum, round_half_up
from txlens.staging import stage

#: Pages that end by this row are simply sorted and cut.
SHALLOW_ROWS = 10_000
#: Rows of one range, that is, of one sorting task, when positions are given out.
ROWS_PER_RANGE = 500_000


def top_k(df, by, n, *ties):
    """The ``n`` largest rows by one column, equal values in key order."""
    return df.orderBy(F.col(by).desc_nulls_last(), *ties).limit(n)


def preview(df, n, *key):
    return df.orderBy(*key).limit(n)


def ordered_ranges(df, order, rows_per_range=ROWS_PER_RANGE, staged=False):
    """Rows in order with a generated ``_id``, from one shuffle.

    Every range is one task that sorts and numbers its rows: the upper bits of the id are the
    range, the lower 33 the place in it. The rows are read three times (counted, sampled,
    moved), so they are written first unless ``df`` is a plain scan already (``staged``).
    """
    df = df if staged else stage(df)
    rows = df.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    ranges = max(-(-rows // rows_per_range), min(cores, -(-rows // SHALLOW_ROWS)), 1)
    ordered = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return ordered.withColumn("_id", F.monotonically_increasing_id())


def _ranged(df, order, rows_per_range, staged=False, keep=None):
    """Staged rows in order, with ``_range`` and the place ``_at`` in it; only the columns in ``keep`` are staged."""
    placed = ordered_ranges(df, order, rows_per_range, staged)
    placed = stage(placed if keep is None else placed.select(*keep, "_id"))
    return placed.withColumns({
        "_range": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND((1 << 33) - 1)}).drop("_id")


def _offsets(ranged, amount):
    """Sum before every range; one row per range, so the plain window stays small."""
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(F.sum(amount).alias("_own"))
    return totals.withColumn("_before", F.coalesce(F.sum("_own").over(earlier), F.lit(0)))


def running_total(df, order, name, weight, rows_per_range=ROWS_PER_RANGE, staged=False):
    """Add the running sum of ``weight`` in the given order."""
    ranged = _ranged(df, order, rows_per_range, staged)
    within = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.join(F.broadcast(_offsets(ranged, F.col(weight))), "_range")
        .withColumn(name, F.col("_before") + F.sum(weight).over(within))
        .drop("_range", "_at", "_before", "_own")
    )


def row_number_global(df, order, name="row_id", rows_per_range=ROWS_PER_RANGE, staged=False, keep=None):
    """Positions 1, 2, 3, … over the whole table: one shuffle, no window over the rows.

    ``staged``: ``df`` is a plain scan already and need not be written first. ``keep``: the columns
    wanted beside the position, all by default; those that only give the order are not staged.
    """
    ranged = _ranged(df, order, rows_per_range, staged, keep)
    return (
        ranged.join(F.broadcast(_offsets(ranged, F.lit(1).cast("bigint"))), "_range")
        .withColumn(name, F.col("_before") + F.col("_at") + 1)
        .drop("_range", "_at", "_before", "_own")
    )


def page_count(df, size=50):
    """Number of pages, never less than one."""
    rows = df.agg(F.count("*").alias("Rows"))
    full = F.floor((F.col("Rows") - 1) / size).cast("bigint") + 1
    return rows.select("Rows", F.greatest(F.lit(1).cast("bigint"), full).alias("Pages"))


def _not_before(order, key):
    """Rows at or after a key in column order; NULL comes first, as in a plain sort."""
    test = F.lit(True)
    for name in reversed(order):
        value, column = key[name], F.col(name)
        if value is None:
            test = column.isNotNull() | test
        else:
            test = (column > value) | ((column == value) & test)
    first = key[order[0]]
    return test if first is None else (F.col(order[0]) >= first) & test


def _not_after(order, key):
    test = F.lit(True)
    for name in reversed(order):
        value, column = key[name], F.col(name)
        if value is None:
            test = column.isNull() & test
        else:
            test = column.isNull() | (column < value) | ((column == value) & test)
    return test


def page(df, order, number, size=50, shallow=SHALLOW_ROWS, rows_per_range=ROWS_PER_RANGE):
    """One page of the ordered table.

    Beyond ``shallow`` rows only the order's own columns are put in order; the keys at both ends
    of the page then select its rows from the source.
    """
    order, first = list(order), (number - 1) * size
    if first + size <= shallow:
        return df.orderBy(*order).offset(first).limit(size)
    numbered = row_number_global(df.select(*order), order, "_position", rows_per_range)
    on_page = F.col("_position").between(first + 1, first + size)
    keys = numbered.where(on_page).orderBy("_position").collect()
    if not keys:
        return df.limit(0)
    same = F.lit(True)
    for name in order:
        same = same & F.col(name).eqNullSafe(F.lit(keys[0][name]))
    # rows equal to the page's first one in every order column may begin on an earlier page
    start = numbered.where(same).agg(F.min("_position")).first()[0]
    inside = df.where(_not_before(order, keys[0]) & _not_after(order, keys[-1]))
    return inside.orderBy(*order).offset(first + 1 - start).limit(size)


def smallest_by_hash(df, hash_column, n, *ties):
    """The ``n`` rows with the smallest 32-digit hex hash.

    One pass counts the rows below a ladder of bounds; the lowest bound with enough rows then
    leaves a few times ``n`` rows for the final sort, however many tasks scan. It only ever
    removes rows that cannot be among the ``n`` smallest.
    """
    bounds = [f"{1 << (32 - 2 * k):08x}" for k in range(1, 17)]
    below = df.agg(*[F.count_if(F.col(hash_column) < bound) for bound in bounds]).first()
    enough = [bound for bound, rows in zip(bounds, below) if rows >= n]
    kept = df.where(F.col(hash_column) < enough[-1]) if enough else df
    return kept.orderBy(hash_column, *ties).limit(n)


def sample_n(df, n, seed, *key):
    """Exactly ``n`` rows (or all), the same ones for the same seed and keys."""
    text = reduce(lambda left, right: F.concat(left, F.lit("|"), right),
                  [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in key])
    hashed = df.withColumn("_hash", F.md5(F.concat(text, F.lit(f"|{seed}"))))
    return smallest_by_hash(hashed, "_hash", n, *key).drop("_hash")


def revenue_delta(df, *ties):
    """Revenue of the second half of the rows against the first, in percent.

    Halves follow (InvoiceDate, ties); with an odd number the extra row is in the
    second half. Only rows of the one moment at the middle are put in order.
    """
    moments = df.groupBy("InvoiceDate").agg(
        F.count("*").alias("_rows"), money_sum("TotalPrice").alias("_revenue")
    )
    moments = running_total(moments, ["InvoiceDate"], "_upto", "_rows")
    rows = moments.agg(F.max("_upto")).first()[0] or 0
    middle = rows // 2
    split = moments.where(
        (F.col("_upto") > middle) & (F.col("_upto") - F.col("_rows") < middle)
    ).first()
    first_half = moments.where(F.col("_upto") <= middle).select(
        F.col("_revenue").alias("TotalPrice")
    )
    if split is not None:
        take = middle - (split["_upto"] - split["_rows"])
        at_split = df.where(F.col("InvoiceDate").eqNullSafe(F.lit(split["InvoiceDate"])))
        at_split = at_split.select("TotalPrice", *ties)
        if take <= SHALLOW_ROWS:
            part = at_split.orderBy(*ties).limit(take)
        else:
            part = row_number_global(at_split, list(ties), "_p").where(F.col("_p") <= take)
        first_half = first_half.unionByName(part.select("TotalPrice"))
    first = F.coalesce(F.col("FirstHalf"), F.lit(0.0))
    second = F.coalesce(F.col("Total"), F.lit(0.0)) - first
    total = moments.agg(money_sum("_revenue").alias("Total"))
    halves = total.select(
        F.lit(rows).cast("bigint").alias("Rows"), "Total",
        first_half.agg(money_sum("TotalPrice").alias("s")).scalar().alias("FirstHalf"),
    )
    change = F.when(
        (first > 0) & (F.col("Rows") > 1), round_half_up(F.try_divide(second - first, first) * 100, 2)
    ).otherwise(0.0)
    second_half = F.when(F.col("Rows") > 1, second).otherwise(0.0)
    return halves.select("Rows", first.alias("FirstHalf"), second_half.alias("SecondHalf"),
                         change.alias("RevenueDelta"))
