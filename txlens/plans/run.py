"""The whole batch flow in one session: layers, stores, customer tables, checks, reports.

A failing step raises, so nothing after it runs on stale data. Layers are handed on as
Parquet, which is also what makes a lost executor or a restart cheap.

Disk holds what the flow keeps and what the step at hand needs: every step removes the tables it
has staged, every query its shuffle files, and the raw rows are read before anything is kept.
"""

import argparse

from pyspark.sql import functions as F

from txlens.operators import anomalies, cleaning, customers, features, joins, ordering, sales
from txlens.operators.lookup import label_mapping
from txlens.params import DEFAULTS, FOREST_SAMPLE, FOREST_SEED, FOREST_TREES
from txlens.plans.stages import ROW_KEY, build_features, clean, detect
from txlens.schemas import REPORT_COLUMNS, SAMPLE_COLUMNS
from txlens.session import build_session
from txlens.sources import files, warehouse
from txlens.sources.publishing import finished
from txlens.staging import lean_disk, staged_run


def write_layers(raw, target, limits=DEFAULTS, key=ROW_KEY, run=None, **forest):
    """Cleaned, featured and scored layers plus the two customer tables.

    Each layer is published as a whole. Layers that the named ``run`` has published already are
    read, not made again.
    """
    spark = raw.sparkSession
    layers = {}

    def saved(name, build, partition_by=None):
        path = f"{target}/layers/{name}"
        if not (run and finished(spark, path, run)):
            with staged_run(spark):
                files.write_layer(build(), path, partition_by, run)
        layers[name] = files.read_layer(spark, path)

    saved("cleaned", lambda: clean(raw))
    saved("featured", lambda: build_features(layers["cleaned"], limits, staged=True), "Month")
    saved("anomaly", lambda: detect(layers["featured"], limits, key, **forest), "Month")
    saved("customer_segments", lambda: customers.customer_segments(layers["featured"], limits))
    saved("customer_behavior", lambda: customers.customer_behavior(layers["featured"], limits))
    return layers


def store(scored, target, key=ROW_KEY, jdbc=None, run=None):
    """All rows to the relational table, flagged rows to the document collection.

    The rows sent are counted by the writes themselves, and compared with the rows stored.
    """
    spark = scored.sparkSession
    files.require_loadable(scored, "anomaly")
    with staged_run(spark):
        table = warehouse.conform_warehouse(scored, key, staged=True)
        sent = warehouse.write_warehouse(table, f"{target}/warehouse", run)
        files.require_stored(sent, warehouse.read_warehouse(spark, f"{target}/warehouse"), "warehouse")
        if jdbc:
            warehouse.write_jdbc(table, **jdbc)
            access = {name: value for name, value in jdbc.items() if name != "batch"}
            files.require_stored(sent, warehouse.read_jdbc(spark, **access), "jdbc")
    flagged = files.write_documents(scored, f"{target}/documents", run=run)
    documents = files.read_documents(spark, f"{target}/documents", scored.schema)
    files.require_stored(flagged, documents, "documents")
    return documents


def write_cleaning_report(raw, target):
    """The one report that reads the raw rows."""
    with staged_run(raw.sparkSession):
        files.write_report(cleaning.cleaning_report(raw), f"{target}/reports/00_data_cleaning")


def write_reports(layers, documents, target, key=ROW_KEY):
    """The bounded report files of the layers, and the exports of whole layers."""
    folder = f"{target}/reports"
    featured, scored = layers["featured"], layers["anomaly"]
    spark = scored.sparkSession
    reports = {
        "01_country_mapping": label_mapping(featured, "Country", "CountryEncoded"),
        "02_sample_featured_data": features.project_available(
            ordering.preview(featured, 20, *key), REPORT_COLUMNS),
        "03_revenue_category_distribution": sales.revenue_category_distribution(featured),
        "04_top_products": sales.top_products(featured),
        "05_top_customers": customers.top_customers_by_avg_spend(featured),
        "07_relational_sample": ordering.preview(scored, 50, *key),
        "08_anomaly_sample": ordering.preview(documents, 50, *key),
        "09_anomaly_revenue_distribution": sales.revenue_category_distribution(documents),
        "10_integration_statistics": joins.integration_stats(scored, documents),
        "featured_sample": features.project_available(
            ordering.preview(featured, 100, *key), SAMPLE_COLUMNS),
    }
    for name, report in reports.items():
        with staged_run(spark):
            files.write_report(report, f"{folder}/{name}")
    with staged_run(spark):
        verification = joins.with_report_time(joins.verification_report(
            scored, documents, key, "retail_transactions", "retail_anomalies"))
        files.write_report(verification, f"{folder}/06_integration_verification", kind="json")
    files.export_csv(layers["cleaned"], f"{target}/exports/cleaned")
    files.export_csv(anomalies.only_anomalies(scored), f"{target}/exports/anomalies")
    return folder


def run_all(raw, target, limits=DEFAULTS, key=ROW_KEY, jdbc=None, trees=FOREST_TREES,
            sample=FOREST_SAMPLE, seed=FOREST_SEED, run=None):
    """Run every step on a raw frame. ``jdbc``: url, table, … of a relational store.

    ``run`` names the run: started again under its name after a failure, it goes on from the
    layers that it has published. Tables staged on the way are removed at the end.
    """
    with staged_run(raw.sparkSession), lean_disk(raw.sparkSession):
        return _run_all(cleaning.strip_column_names(raw), target, limits, list(key), jdbc,
                        trees, sample, seed, run)


def _run_all(raw, target, limits, key, jdbc, trees, sample, seed, run):
    spark = raw.sparkSession
    write_cleaning_report(raw, target)
    layers = write_layers(raw, target, limits, key, run, trees=trees, sample=sample, seed=seed)
    documents = store(layers["anomaly"], target, key, jdbc, run)
    order = ["InvoiceDate", *[name for name in key if name != "InvoiceDate"]]
    with staged_run(spark):
        joined = joins.positional_join(layers["anomaly"], documents, order, order, staged=True)
        files.write_layer(joined, f"{target}/layers/joined")
    with staged_run(spark):
        context = joins.join_anomalies(layers["anomaly"], documents, *key)
        files.write_layer(context.where(F.col("anomaly") == 1), f"{target}/layers/anomaly_context")
    write_reports(layers, documents, target, key)
    return layers


def main():
    parser = argparse.ArgumentParser(description="Run the retail flow on a CSV of invoice lines.")
    parser.add_argument("source", help="CSV path, plain or gzip")
    parser.add_argument("target", help="output folder")
    parser.add_argument("--run", help="name of the run; the same name goes on after a failure")
    parser.add_argument("--partitions", type=int, help="spread a gzip source over this many tasks")
    options = parser.parse_args()
    spark = build_session("retail-flow")
    run_all(files.read_raw_csv(spark, options.source, options.partitions), options.target, run=options.run)


if __name__ == "__main__":
    main()
