"""Bringing one value per key back to every row.

The per-key table is aggregated (with partial aggregation, so a hot key costs no more
than any other), staged, and measured. A table within the bounds is broadcast and the
rows stay where they are. A larger one is joined through a shuffle; as a staged table it
is a plain scan, so both sides are plain shuffle stages and adaptive execution can split
the partition of a hot key.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from txlens.operators.ordering import row_number_global
from txlens.params import BROADCAST_BYTES, BROADCAST_ROWS
from txlens.staging import stage


def _fits_broadcast(table, limit):
    """Rows and text bytes of a staged table against the broadcast bounds."""
    width = F.octet_length(F.concat_ws("", *[F.col(c).cast("string") for c in table.columns]))
    rows, size = table.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= limit and size <= BROADCAST_BYTES


def attach(df, table, key, defaults=None, limit=BROADCAST_ROWS, staged=False):
    """Left-join ``table`` (one row per ``key``) to ``df``; missing values get defaults."""
    table = table if staged else stage(table)
    side = F.broadcast(table) if _fits_broadcast(table, limit) else table
    joined = df.join(side, key, "left")
    filled = {name: F.coalesce(F.col(name), F.lit(value))
              for name, value in (defaults or {}).items()}
    return joined.withColumns(filled) if filled else joined


def numbered_labels(labels, order, name, limit=BROADCAST_ROWS):
    """Codes 0, 1, 2, … for a table of distinct labels, in the given order."""
    labels = stage(labels)
    if labels.count() <= limit:
        return labels.withColumn(name, F.row_number().over(Window.orderBy(*order)) - 1)
    numbered = row_number_global(labels, order, name, staged=True)
    return numbered.withColumn(name, F.col(name) - 1)


def frequency_codes(df, column, name="Code"):
    """Label table: 0 for the most frequent label, equal counts in label order."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).count()
    codes = numbered_labels(counts, [F.col("count").desc(), column], name)
    return codes.select(column, F.col(name).cast("double").alias(name))


def alphabetical_codes(df, column, name="Code"):
    labels = df.where(F.col(column).isNotNull()).select(column).distinct()
    codes = numbered_labels(labels, [column], name)
    return codes.select(column, F.col(name).cast("double").alias(name))


def apply_codes(df, codes, column, name, default):
    """Codes of a fitted label table; NULL and unseen labels get the default."""
    return attach(df, codes, column, {name: default})


def encode_by_frequency(df, column, name, source=None):
    """Frequency rank of the label; NULL gets the number of labels."""
    codes = frequency_codes(source or df, column, name)
    return attach(df, codes, column, {name: float(codes.count())}, staged=True)


def encode_alphabetical(df, column, name):
    """Alphabetical code of the label; NULL gets −1."""
    return apply_codes(df, alphabetical_codes(df, column, name), column, name, -1.0)


def label_mapping(df, column, code):
    """Every (label, code) pair once, by code."""
    return df.select(column, code).distinct().orderBy(code, column)
