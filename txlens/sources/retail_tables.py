"""Invoice lines derived from an order-entry schema (lineitem, orders, customer, …)."""

from pyspark.sql import functions as F

from txlens.params import Thresholds

# Thresholds that leave every branch of the rules populated on these tables.
TABLE_LIMITS = Thresholds(
    revenue_high=60_000, revenue_medium=20_000,
    segment_vip_monetary=2_200_000, segment_vip_frequency=8,
    segment_loyal_monetary=1_800_000, segment_frequent=7, segment_inactive_days=300,
    type_vip=1_800_000, type_regular=800_000,
    reason_unit_price=20_000, reason_total_price=95_000, reason_quantity=45,
)


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df, *keys):
    """Use all cores for a source that has fewer splits than there are cores.

    A large source has more splits than cores, also in one file, and is left as it is, unshuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def retail_raw(spark, folder):
    """The raw layer (plus ``RowKey``), with returns, free items and missing customers.

    Orders meet their customers first, so that the lines are shuffled twice at most, and names
    come last.
    """
    orders = table(spark, folder, "orders").join(
        table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    lines = (
        spread(table(spark, folder, "lineitem"), "l_orderkey", "l_partkey", "l_linenumber")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    quantity = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity"))
    free = (F.col("l_linenumber") == 7) & (F.col("l_quantity") == 1)
    minutes = F.expr("cast((o_orderkey % 24) * 60 + (o_orderkey * 7) % 60 as int)")
    moment = F.timestamp_add("MINUTE", minutes, F.col("o_orderdate"))
    return lines.select(
        F.col("l_orderkey").cast("string").alias("InvoiceNo"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.concat("p_name", F.lit(" "), "p_type").alias("Description"),
        quantity.otherwise(F.col("l_quantity")).alias("Quantity"),
        F.date_format(moment, "M/d/yyyy H:mm").alias("InvoiceDate"),
        F.when(free, 0.0).otherwise(F.col("l_extendedprice") / F.col("l_quantity"))
        .alias("UnitPrice"),
        F.when(F.col("l_orderkey") % 7 != 0, F.col("o_custkey").cast("string"))
        .alias("CustomerID"),
        F.col("n_name").alias("Country"),
        F.concat_ws(
            "|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
            F.date_format("l_shipdate", "yyyyMMdd"),
            F.rint(F.col("l_extendedprice") * 100).cast("bigint"),
        ).alias("RowKey"),
    )
