"""The relational table: its columns, a Parquet form of it, and JDBC access."""

from pyspark.sql import functions as F

from txlens.operators.ordering import row_number_global
from txlens.schemas import WAREHOUSE_COLUMNS
from txlens.sources.publishing import current, publish


def conform_warehouse(df, key=None, created_at=True, staged=False):
    """Rename and cast to the table's columns; the id is the row's position in key order.

    Without a key column all raw columns together order the rows. Equal rows get ids of their
    own, so the id can be a primary key. ``staged``: ``df`` is a plain scan already. Columns that
    the table lacks are not moved, except for the key, which is not staged.
    """
    key = list(key or ("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate",
                       "UnitPrice", "CustomerID", "Country"))
    kept = [source for source, _, _ in WAREHOUSE_COLUMNS if source in df.columns]
    needed = df.select(*dict.fromkeys([*key, *kept]))
    numbered = row_number_global(needed, key, "_warehouse_id", staged=staged, keep=kept)
    columns = [F.col("_warehouse_id").alias("id")]
    columns += [F.col(source).cast(kind).alias(target)
                for source, target, kind in WAREHOUSE_COLUMNS if source in kept]
    if created_at:
        columns.append(F.current_timestamp().alias("created_at"))
    return numbered.select(*columns)


def write_warehouse(table, path, run=None):
    """One folder per month; inside a file rows lie by customer and date.

    Within a month rows are spread over tasks by their customer and id, so that neither
    a busy month nor a busy customer is written by a single task. Returns what was sent.
    """
    ordered = (table.repartitionByRange("month", "customer_id", "invoice_date", "id")
               .sortWithinPartitions("month", "customer_id", "invoice_date"))
    return publish(ordered, path, partition_by="month", run=run, count=("id", "anomaly") if "anomaly" in table.columns else ("id",))


def read_warehouse(spark, path):
    return spark.read.parquet(current(spark, path))


def jdbc_options(url, table, driver=None, user=None, password=None, **more):
    options = {"url": url, "dbtable": table, "driver": driver, "user": user,
               "password": password, **more}
    return {name: str(value) for name, value in options.items() if value is not None}


def partition_options(column, lower, upper, partitions):
    """Let ``partitions`` tasks read ranges of a numeric or date column side by side."""
    return {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(partitions)}


def read_jdbc(spark, url, table, partition_by=None, **connection):
    """``partition_by``: (column, lower, upper, partitions); without it one task reads all."""
    reader = spark.read.format("jdbc").options(**jdbc_options(url, table, **connection))
    if partition_by:
        reader = reader.options(**partition_options(*partition_by))
    return reader.load()


def write_jdbc(df, url, table, batch=5000, **connection):
    """Replace the rows but keep the table definition and its indexes."""
    options = jdbc_options(url, table, truncate="true", batchsize=batch, **connection)
    df.write.mode("overwrite").format("jdbc").options(**options).save()
