"""A kept table in order, with an index of its files, so that a page reads only its own files."""

from urllib.parse import unquote

from pyspark.sql import Window
from pyspark.sql import functions as F

from txlens.operators.ordering import ROWS_PER_RANGE, ordered_ranges
from txlens.sources.publishing import current, publish


def write_ordered(df, order, path, rows_per_file=ROWS_PER_RANGE):
    """Publish ``df`` in order at ``path/rows`` and its index at ``path/files``.

    A file is one range of the order. The index has a line per file: its name, its number of
    rows, the position before its first row, and its first key. Equal keys keep the order
    that this call gave them.
    """
    spark, order = df.sparkSession, list(order)
    sent = publish(ordered_ranges(df, order, rows_per_file), f"{path}/rows")
    rows = spark.read.parquet(sent.path)
    files = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), F.min("_id").alias("first"), F.min_by(F.struct(*order), "_id").alias("key"))
    # one line per file; the file that holds the lowest generated ids comes first
    earlier = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    index = files.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0).cast("long")))
    publish(index.select("file", "rows", "before", "first", "key"), f"{path}/files")
    return sent.rows


def read_page(spark, path, number, size=50):
    """One page of a table kept by ``write_ordered``: only the files that hold its rows are read."""
    first = (number - 1) * size
    index = spark.read.parquet(current(spark, f"{path}/files"))
    held = index.where((F.col("before") < first + size) & (F.col("before") + F.col("rows") > first)).collect()
    if not held:
        return spark.read.parquet(current(spark, f"{path}/rows")).drop("_id").limit(0)
    rows = spark.read.parquet(*[unquote(row["file"]) for row in held])
    start = spark.createDataFrame([(row["first"] >> 33, row["before"]) for row in held], "_range long, _before long")
    placed = rows.join(F.broadcast(start), F.shiftright("_id", 33) == F.col("_range")).withColumn(
        "_position", F.col("_before") + F.col("_id").bitwiseAND((1 << 33) - 1))
    on_page = F.col("_position").between(first, first + size - 1)
    return placed.where(on_page).orderBy("_position").drop("_id", "_range", "_before", "_position")


def ordered_page_count(spark, path, size=50):
    """Rows and pages of a kept table, from its index alone."""
    rows = spark.read.parquet(current(spark, f"{path}/files")).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("Rows"))
    full = F.floor((F.col("Rows") - 1) / size).cast("bigint") + 1
    return rows.select("Rows", F.greatest(F.lit(1).cast("bigint"), full).alias("Pages"))
