"""Joins and checks between the full table and the stored anomalies."""

from pyspark.sql import functions as F

from txlens.functions.money import percentage
from txlens.operators.anomalies import only_anomalies, only_normal
from txlens.operators.ordering import row_number_global, top_k
from txlens.operators.reduction import keep_possible
from txlens.staging import stage


def positional_join(left, right, left_order, right_order, staged=False):
    """Pair row 1 with row 1, row 2 with row 2, … of two explicitly ordered tables.

    ``staged``: both are plain scans already and need not be written first.
    """
    def numbered(df, order, *columns):
        needed = df.select(*dict.fromkeys([*order, *columns]))
        return row_number_global(needed, order, staged=staged, keep=columns).select("row_id", *columns)

    rows = numbered(left, left_order, "Quantity", "UnitPrice", "TotalPrice")
    return rows.join(numbered(right, right_order, "anomaly"), "row_id")


def join_anomalies(transactions, anomalies, *key):
    """Full context of the flagged rows, found by key: the transaction and what only the document has.

    Transactions without a flagged key are left out before the join shuffles them.
    """
    more = [name for name in anomalies.columns if name not in transactions.columns]
    flagged = stage(anomalies.select(*key, *more))
    return keep_possible(transactions, flagged, *key).join(flagged, list(key))


def merge_country_counts(df, n=15):
    """Flagged rows per country next to its normal rows; none counts as 0."""
    known = df.where(F.col("Country").isNotNull())
    flagged = top_k(
        only_anomalies(known).groupBy("Country").agg(F.count("*").alias("Anomalies")),
        "Anomalies", n, "Country",
    )
    normal = only_normal(known).groupBy("Country").agg(F.count("*").alias("Normals"))
    merged = flagged.join(normal, "Country", "left").fillna({"Normals": 0})
    total = F.col("Anomalies") + F.col("Normals")
    return merged.withColumn("Total", total).withColumn(
        "AnomalyPercent", percentage("Anomalies", "Total", 1)
    )


def consistency_check(everything, subset, *key):
    """Counts, schemas and membership of the stored anomalies, as one row.

    ``SubsetByCount`` compares sizes only; ``MissingKeys`` counts stored rows that the
    full table does not have.
    """
    shared = set(everything.columns) & set(subset.columns)
    total, stored = F.col("TotalRecords"), F.col("TotalDocuments")
    both = (total > 0) & (stored > 0)
    stored_keys = stage(subset.select(*key))
    possible = keep_possible(everything.select(*key), stored_keys, *key)
    missing = stored_keys.join(possible, list(key), "left_anti")
    counts = everything.agg(F.count("*").alias("TotalRecords")).select(
        "TotalRecords",
        subset.agg(F.count("*")).scalar().alias("TotalDocuments"),
        missing.agg(F.count("*")).scalar().alias("MissingKeys"),
    )
    return counts.select(
        "TotalRecords", "TotalDocuments",
        F.lit(len(everything.columns)).alias("TotalColumns"),
        F.lit(len(subset.columns)).alias("TotalFields"),
        F.lit(len(set(everything.columns) - shared)).alias("ColumnsOnlyInTable"),
        F.lit(len(set(subset.columns) - shared)).alias("FieldsOnlyInDocuments"),
        F.when(both, "VALID").otherwise("INVALID").alias("Status"),
        (stored <= total).alias("SubsetByCount"),
        "MissingKeys",
        both.alias("ReadyForDashboard"),
    )


def verification_report(everything, subset, key, table, collection):
    """The nested verification document: both stores (by their given names) and the checks."""
    check = consistency_check(everything, subset, *key)
    names = F.array(*[F.lit(name) for name in sorted(everything.columns)])
    return check.select(
        F.struct(
            F.lit(table).alias("table"),
            F.col("TotalRecords").alias("total_records"),
            F.col("TotalColumns").alias("total_columns"),
            names.alias("columns"),
        ).alias("relational"),
        F.struct(
            F.lit(collection).alias("collection"),
            F.col("TotalDocuments").alias("total_documents"),
            F.when(F.col("TotalDocuments") > 0, F.col("TotalFields")).otherwise(0)
            .alias("total_fields"),
        ).alias("documents"),
        F.struct(
            F.col("Status").alias("status"),
            F.col("SubsetByCount").alias("documents_are_subset"),
            F.col("MissingKeys").alias("missing_keys"),
            F.col("ReadyForDashboard").alias("data_ready_for_dashboard"),
        ).alias("consistency_check"),
    )


def with_report_time(report):
    return report.withColumn("timestamp", F.current_timestamp())


def integration_stats(everything, subset):
    counts = everything.agg(F.count("*").alias("TotalRecords")).select(
        "TotalRecords", subset.agg(F.count("*")).scalar().alias("TotalDocuments")
    )
    valid = (F.col("TotalRecords") > 0) & (F.col("TotalDocuments") > 0)
    return counts.select(
        "TotalRecords", "TotalDocuments",
        percentage("TotalDocuments", "TotalRecords", 2).alias("AnomalyPercent"),
        F.when(valid, "VALID").otherwise("INVALID").alias("IntegrationStatus"),
    )
