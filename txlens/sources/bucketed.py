"""A layer stored in buckets of a key: what is grouped or joined by the key needs no shuffle.

A bucket is read by one task. So a key that holds too large a share of the rows is measured
first and refused: such a layer stays as it is, and its groups are pre-aggregated before a
shuffle as usual.
"""

from pyspark.sql import functions as F

#: A key may hold this many times the rows of an average bucket.
MOST_OF_A_BUCKET = 4.0
#: Rows of an average bucket, that is, of one task.
ROWS_PER_BUCKET = 400_000


def bucket_number(rows, least, rows_per_bucket=ROWS_PER_BUCKET):
    """Buckets for that many rows, ``least`` of them or more, so that no task's share grows with the table."""
    return max(least, -(-rows // rows_per_bucket))


def largest_share(df, key):
    """The share of the rows that the most frequent key holds; 0 for an empty table."""
    sizes = df.groupBy(key).count().agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
    return sizes["most"] / sizes["all"] if sizes["all"] else 0.0


def write_bucketed(df, table, path, key, buckets, most=MOST_OF_A_BUCKET):
    """Save ``df`` at ``path`` as ``table`` in buckets of ``key``, one file each, sorted by it."""
    share = largest_share(df, key)
    if share > most / buckets:
        raise ValueError(f"one {key} holds {share:.0%} of the rows, too much for one of {buckets} buckets")
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return df.sparkSession.table(table)


def open_bucketed(spark, table, path, key, buckets):
    """The table at ``path``, for a session whose catalog does not know it yet."""
    if not spark.catalog.tableExists(table):
        columns = spark.read.parquet(path).schema.toDDL()
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)
