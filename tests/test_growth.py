"""Work that must not grow faster than the table: rows made once, shares of tasks bounded."""

import os
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from catalog import frames
from txlens import staging
from txlens.operators import customers, features, forest, joins, lookup, ordering, pages
from txlens.plans import run, stages
from txlens.sources import bucketed, files, publishing, retail_tables, warehouse
from txlens.staging import stage


def counted(df):
    """``df``, and an accumulator of the rows that were made."""
    made = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), made


def lines(spark, n):
    return stage(spark.range(n).select(
        F.format_string("k%06d", "id").alias("RowKey"), (F.col("id") % 7).cast("string").alias("StockCode"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 13).cast("string")).alias("CustomerID"),
        F.lit(2.0).alias("Quantity"), (F.col("id") * 0.5).alias("TotalPrice")))


def test_rows_are_made_once_for_positions(spark, tmp_path):
    df, made = counted(lines(spark, 3000))
    assert ordering.row_number_global(df, ["RowKey"], rows_per_range=700).agg(F.max("row_id")).first()[0] == 3000
    assert made.value == 3000
    df, made = counted(lines(spark, 3000))
    assert pages.write_ordered(df, ["RowKey"], str(tmp_path / "kept"), rows_per_file=700) == 3000
    assert made.value == 3000


def test_a_range_holds_a_task_of_rows(spark):
    df = stage(spark.range(4_100_000).select(F.hash("id").alias("k"), "id"))
    sizes = [r["count"] for r in ordering.ordered_ranges(df, ["k", "id"], staged=True).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4_100_000 and len(sizes) > 8 and max(sizes) < 1_000_000
    sizes = ordering.ordered_ranges(df, ["k", "id"], 200_000, staged=True).groupBy(F.spark_partition_id()).count().count()
    assert sizes == 21


def test_rows_are_made_once_for_dashboard_features(spark):
    df, made = counted(lines(spark, 2000))
    got = features.with_dashboard_features(df).agg(F.count("*"), F.min("ProductFrequency"), F.min("CustomerFrequency")).first()
    assert tuple(got) == (2000, 285, 1) and made.value == 2000


def test_a_report_is_made_once(spark, tmp_path):
    df, made = counted(lines(spark, 50).coalesce(1))
    files.write_report(df, str(tmp_path / "report"))
    assert spark.read.option("header", True).csv(str(tmp_path / "report")).count() == 50 and made.value == 50


def test_buckets_follow_the_rows(spark):
    assert [bucketed.bucket_number(n, 8) for n in (0, 1, 3_200_000, 3_200_001, 123_000_000)] == [8, 8, 8, 9, 308]


def test_top_customers_sort_no_lines(spark):
    df = spark.createDataFrame([("a", "Y", 1.0, 2.0, 3.0), ("a", "X", 5.0, 1.0, 1.0), ("b", None, 2.0, 2.0, 2.0), (None, "Z", 9.0, 1.0, 1.0)],
                               "CustomerID string, Country string, AvgCustomerSpend double, CustomerFrequency double, CustomerTotalQty double")
    top = customers.top_customers_by_avg_spend(df)
    assert [tuple(r) for r in top.collect()] == [(None, 9.0, 1.0, 1.0, "Z"), ("a", 5.0, 2.0, 3.0, "X"), ("b", 2.0, 2.0, 2.0, None)]
    lowest = [x for x in top._jdf.queryExecution().executedPlan().toString().splitlines() if "Aggregate" in x][-1]
    assert "HashAggregate" in lowest and "Sort" not in lowest


def test_cells_hold_the_leaves_of_the_walk(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = pd.DataFrame({"Quantity": rng.integers(1, 20, 900).astype(float), "UnitPrice": rng.uniform(1, 9, 900).round(2)})
    rows["TotalPrice"] = rows["Quantity"] * rows["UnitPrice"]
    rows.loc[::50, "UnitPrice"] = np.inf
    df = stage(spark.createDataFrame(rows.assign(RowKey=[f"k{i}" for i in range(len(rows))])))
    nodes = stage(forest.fit_isolation_forest(df, trees=12, sample=64))
    by_cells = {r["RowKey"]: r["score"] for r in forest.score_isolation_forest(df, nodes).collect()}
    monkeypatch.setattr(forest, "GRID_CELLS", 0)
    assert {r["RowKey"]: r["score"] for r in forest.score_isolation_forest(df, nodes).collect()} == by_cells


def test_headers_are_read_without_python(spark, tmp_path):
    for name, compression in (("a", "none"), ("b", "gzip")):
        spark.range(3000).select(F.col("id").alias(f"x{name}"), F.lit("y").alias("y")).repartition(3).write.option(
            "header", True).csv(str(tmp_path / name), compression=compression)
    rows = files._first_line_rows(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert "InArrow" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["value"] for r in rows.collect()) == ["xa,y"] * 3 + ["xb,y"] * 3


def test_one_large_file_is_not_spread(spark, tmp_path):
    path = str(tmp_path / "one")
    spark.range(200_000).coalesce(1).write.option("parquet.block.size", 65536).parquet(path)
    assert retail_tables.spread(spark.read.parquet(path), "id").rdd.getNumPartitions() >= 8
    other = spark.newSession()
    other.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    other.conf.set("spark.sql.files.openCostInBytes", "1")
    spread = retail_tables.spread(other.read.parquet(path), "id")
    assert "Exchange" not in spread._jdf.queryExecution().executedPlan().toString()


def test_featured_rows_come_from_one_run_of_the_joins(spark, small):
    for frame in (frames.featured(spark, small), frames.scored_features(spark, small)):
        assert not any("lineitem" in name for name in frame.inputFiles())


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {path.rsplit("/", 1)[-1] for path in found.mkString("\n").split("\n")}
    return {name for name in names if name.startswith("shuffle_")}


def left_after(spark, before, seconds=10):
    """Shuffle files that are there beside those ``before``; Spark removes files in the background."""
    end = time.time() + seconds
    while (more := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.1)
    return more


def test_queries_of_a_run_leave_no_shuffle_files(spark, tmp_path):
    settings = {name: spark.conf.get(name, None) for name in staging.LEAN}
    before = shuffle_files(spark)
    with staging.lean_disk(spark):
        published = publishing.publish(spark.range(5000).repartition(4, "id").withColumn("m", F.col("id") % 3), str(tmp_path / "t"), partition_by="m")
        assert published.rows == 5000 and spark.read.parquet(published.path).groupBy("m").count().count() == 3
        assert not left_after(spark, before)
    with pytest.raises(ZeroDivisionError), staging.lean_disk(spark):
        1 / 0
    assert {name: spark.conf.get(name, None) for name in staging.LEAN} == settings


def test_steps_of_the_flow_leave_nothing_behind(spark, small, tmp_path, monkeypatch):
    """At the beginning of each step: no table staged by a step before, no shuffle file of this run, raw rows read first."""
    before, begun, target = shuffle_files(spark), [], str(tmp_path / "out")

    def step(owner, name):
        real = getattr(owner, name)

        def run_step(*args, **more):
            folder = staging.run_folder(spark)
            staged = os.listdir(folder) if os.path.exists(folder) else []
            begun.append((name, os.path.exists(f"{target}/layers"), staged, left_after(spark, before)))
            return real(*args, **more)

        monkeypatch.setattr(owner, name, run_step)

    for owner, name in ((run.cleaning, "cleaning_report"), (run, "build_features"), (run, "detect"), (run, "store"), (files, "write_documents"),
                        (joins, "positional_join"), (joins, "join_anomalies"), (run, "write_reports")):
        step(owner, name)
    run.run_all(retail_tables.retail_raw(spark, small), target, retail_tables.TABLE_LIMITS, ("RowKey",), trees=5)
    assert begun == [("cleaning_report", False, [], set())] + [(name, True, [], set()) for name in (
        "build_features", "detect", "store", "write_documents", "positional_join", "join_anomalies", "write_reports")]
    assert spark.read.option("header", True).csv(f"{target}/reports/00_data_cleaning").count() == 1


def staged_columns(monkeypatch):
    """The columns of every table staged by ``ordering`` from now on."""
    found = []
    monkeypatch.setattr(ordering, "stage", lambda df: found.append(df.columns) or stage(df))
    return found


def test_positions_stage_only_what_is_kept(spark, monkeypatch):
    df = lines(spark, 2000)
    found = staged_columns(monkeypatch)
    table = warehouse.conform_warehouse(df, ["RowKey"], created_at=False, staged=True)
    assert found == [["StockCode", "Quantity", "CustomerID", "TotalPrice", "_id"]]
    assert table.columns == ["id", "stock_code", "quantity", "customer_id", "total_price"]
    assert [tuple(r) for r in table.orderBy("id").select("id", "total_price").collect()] == [(i + 1, i * 0.5) for i in range(2000)]
    found.clear()
    flagged = lines(spark, 30).withColumn("anomaly", F.lit(1))
    pairs = joins.positional_join(df.withColumn("UnitPrice", F.lit(1.0)), flagged, ["RowKey"], ["RowKey"], staged=True)
    assert found == [["Quantity", "UnitPrice", "TotalPrice", "_id"], ["anomaly", "_id"]]
    assert sorted(tuple(r) for r in pairs.collect()) == [(i + 1, 2.0, 1.0, i * 0.5, 1) for i in range(30)]


def test_rows_meet_large_lookups_before_they_grow(spark, small, monkeypatch):
    rows = stage(frames.cleaned(spark, small))
    plain = stages.build_features(rows, retail_tables.TABLE_LIMITS, staged=True)
    wanted, expected = plain.columns, {tuple(r) for r in plain.collect()}
    monkeypatch.setattr(lookup.attach, "__defaults__", (None, 0, False))
    shuffled = stages.build_features(rows, retail_tables.TABLE_LIMITS, staged=True)
    assert wanted == shuffled.columns == [
        "CustomerID", "StockCode", "Country", "InvoiceNo", "Description", "Quantity", "InvoiceDate", "UnitPrice", "RowKey", "TotalPrice",
        "Hour", "Day", "MonthNum", "WeekdayNum", "Month", "RevenueCategory", *stages.LOOKED_UP]
    assert {tuple(r) for r in shuffled.collect()} == expected
    text = shuffled._jdf.queryExecution().optimizedPlan().toString()
    below = text[text.index("Join"):]
    assert below.count("Join") == 3 and not any(name in below for name in ("Hour", "WeekdayNum", "RevenueCategory"))
