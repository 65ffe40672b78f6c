"""Files, stores and the whole flow."""

import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from txlens import staging
from txlens.operators import customers, features
from txlens.operators.anomalies import only_anomalies
from txlens.plans.run import run_all, write_layers
from txlens.sources import bucketed, files, publishing, warehouse
from txlens.sources.retail_tables import TABLE_LIMITS, retail_raw

HEADER = "InvoiceNo,StockCode, Description ,Quantity,InvoiceDate,UnitPrice,CustomerID,Country \n"


def test_gzip_csv_with_blank_headers_and_bad_numbers(spark, tmp_path):
    path = tmp_path / "lines.csv.gz"
    with gzip.open(path, "wt") as out:
        out.write(HEADER)
        out.write('536365,85123A,"HEART, WHITE",6,12/1/2010 8:26,2.55,17850,France\n')
        out.write("536366,22633,HAND,x,12/1/2010 8:28,1.85,17850,France\n")
        out.write("536367,22633,,2,12/1/2010 8:28,1.85,,France\n")
    rows = files.read_raw_csv(spark, str(path), partitions=4)
    assert rows.columns[2] == "Description" and rows.rdd.getNumPartitions() == 4
    found = {r["InvoiceNo"]: r for r in rows.collect()}
    assert found["536365"]["Description"] == "HEART, WHITE"
    assert found["536366"]["Quantity"] is None
    assert found["536367"]["CustomerID"] is None


def test_documents_drop_the_store_id(spark, tmp_path):
    path = tmp_path / "docs"
    path.mkdir()
    (path / "a.json").write_text('{"_id": "x", "Hour": 3.0, "anomaly": 1}\n')
    rows = files.read_documents(spark, str(path), "_id string, Hour double, anomaly int")
    assert rows.columns == ["Hour", "anomaly"] and rows.first()["Hour"] == 3.0


def test_sinks_refuse_unusable_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "anomaly int")
    normal = spark.createDataFrame([(0,)], "anomaly int")
    plain = spark.createDataFrame([(0,)], "x int")
    for df, text in ((empty, "empty"), (normal, "empty"), (plain, "missing columns")):
        with pytest.raises(ValueError, match=text):
            files.write_documents(df, str(tmp_path / "d"))


def test_single_file_only_for_small_results(spark, tmp_path):
    files.export_csv(spark.range(5), str(tmp_path / "one"), single_file=True)
    assert len(glob.glob(str(tmp_path / "one" / "*.csv"))) == 1
    with pytest.raises(ValueError, match="one CSV file"):
        files.export_csv(spark.range(5), str(tmp_path / "two"), single_file=True, single_file_rows=3)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text(" Country,CustomerID,Extra,UnitPrice,Quantity,InvoiceDate,Description,StockCode,InvoiceNo \n"
                    "France,1,e,2.5,3,12/1/2010 8:26,HEART,85,536\nFrance,1,e,2.5,many,12/1/2010 8:26,HEART,85,537\n")
    rows = files.read_raw_csv(spark, str(path), corrupt="bad_line").cache()
    found = {r["InvoiceNo"]: r for r in rows.collect()}
    assert (found["536"]["Country"], found["536"]["Quantity"], found["536"]["bad_line"]) == ("France", 3.0, None)
    assert found["537"]["Quantity"] is None and "many" in found["537"]["bad_line"]
    assert tuple(files.unreadable_rows(rows, "bad_line").first()) == (2, 1)
    path.write_text("Country,CustomerID\nFrance,1\n")
    with pytest.raises(ValueError, match="missing columns: InvoiceNo"):
        files.read_raw_csv(spark, str(path))


LINES = {"InvoiceNo": "536", "StockCode": "85", "Description": "HEART", "Quantity": "3", "InvoiceDate": "12/1/2010 8:26",
         "UnitPrice": "2.5", "CustomerID": "1", "Country": "France"}


def test_every_file_goes_by_its_own_header(spark, tmp_path):
    names = list(LINES)
    folder = tmp_path / "many files"
    folder.mkdir()
    for i in range(12):  # three headers, one of them with a further column, one file without rows, one empty
        order = [names, names[::-1], ["Extra", *names[3:], *names[:3]]][i % 3]
        lines = [",".join(f" {n}" if i == 1 else n for n in order)]
        lines += [",".join({**LINES, "InvoiceNo": f"{i}-{k}", "Extra": "e"}[n] for n in order) for k in range(3 if i != 4 else 0)]
        (folder / f"part {i}.csv").write_text("\n".join(lines) + "\n")
    (folder / "empty.csv").write_text("")
    with gzip.open(folder / "more.csv.gz", "wt") as out:
        out.write(",".join(names[::-1]) + "\n" + ",".join({**LINES, "InvoiceNo": "gz"}[n] for n in names[::-1]) + "\n")
    rows = files.read_raw_csv(spark, str(folder)).collect()
    assert sorted(r["InvoiceNo"] for r in rows) == sorted([f"{i}-{k}" for i in range(12) if i != 4 for k in range(3)] + ["gz"])
    assert {tuple(r)[1:] for r in rows} == {("85", "HEART", 3.0, "12/1/2010 8:26", 2.5, "1", "France")}
    (folder / "lacking.csv").write_text("InvoiceNo,StockCode\n1,2\n")
    with pytest.raises(ValueError, match="missing columns: Description.*lacking.csv"):
        files.read_raw_csv(spark, str(folder))


def failing(spark, rows):
    return spark.range(rows).select(F.when(F.col("id") == rows - 1, F.raise_error("broken")).otherwise(F.col("id")).alias("id"))


def test_a_failed_write_leaves_the_old_layer(spark, tmp_path):
    path = str(tmp_path / "layer")
    files.write_layer(spark.range(5), path)
    reader = files.read_layer(spark, path)
    with pytest.raises(Exception, match="broken"):
        files.write_layer(failing(spark, 1000), path)
    assert files.read_layer(spark, path).count() == 5
    sent = files.write_layer(spark.range(7), path)
    assert sent.rows == 7 and files.read_layer(spark, path).count() == 7
    assert reader.count() == 5  # a reader of the version before still finds it
    files.write_layer(spark.range(8), path)
    assert len(publishing._versions(spark, path)) == 2
    with pytest.raises(ValueError, match="empty"):
        publishing.publish(spark.range(0), path, least=1)
    assert files.read_layer(spark, path).count() == 8
    spark.range(3).write.parquet(str(tmp_path / "plain"))
    assert files.read_layer(spark, str(tmp_path / "plain")).count() == 3


def test_a_run_goes_on_from_its_layers(spark, small, tmp_path):
    raw = retail_raw(spark, small)
    target = str(tmp_path / "out")
    first = write_layers(raw, target, TABLE_LIMITS, ("RowKey",), run="one", trees=5)
    broken = raw.withColumn("Quantity", F.raise_error("read again").cast("double"))
    again = write_layers(broken, target, TABLE_LIMITS, ("RowKey",), run="one", trees=5)
    assert again["anomaly"].count() == first["anomaly"].count()
    with pytest.raises(Exception, match="read again"):
        write_layers(broken, target, TABLE_LIMITS, ("RowKey",), run="two", trees=5)
    assert files.read_layer(spark, f"{target}/layers/cleaned").count() == first["cleaned"].count()


def counting(df, rows):
    """``df``, and an accumulator of how often a row of it is made."""
    seen = rows.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), seen


def test_rows_sent_are_counted_by_the_write(spark, tmp_path):
    df, seen = counting(spark.range(500).select("id", (F.col("id") % 5 == 0).cast("int").alias("anomaly")), spark)
    sent = files.write_documents(df, str(tmp_path / "documents"))
    assert (sent.rows, seen.value) == (100, 500)
    documents = files.read_documents(spark, str(tmp_path / "documents"), "id long, anomaly int")
    assert files.require_stored(sent, documents, "documents") == 100 and seen.value == 500
    with pytest.raises(ValueError, match="documents: sent 100, found 99"):
        files.require_stored(sent, documents.limit(99), "documents")
    sent = publishing.publish(df.withColumn("none", F.lit(None).cast("int")), str(tmp_path / "layer"), count=("id", "none"))
    assert (sent.rows, sent.known, seen.value) == (500, {"id": 500, "none": 0}, 1000)


def test_reports_in_json_are_bounded(spark, tmp_path):
    with pytest.raises(ValueError, match="one JSON file"):
        files.write_report(spark.range(5), str(tmp_path / "r"), kind="json", rows=4)


def test_bucketed_layer_needs_no_shuffle(spark, tmp_path):
    rows = spark.range(3000).select(
        F.concat(F.lit("c"), F.col("id") % 97).alias("CustomerID"), F.col("id").cast("string").alias("InvoiceNo"),
        (F.col("id") / 7).alias("TotalPrice"), F.lit(2.0).alias("Quantity"), F.timestamp_seconds("id").alias("InvoiceDate"))
    table = bucketed.write_bucketed(rows, "lines_by_customer", str(tmp_path / "b"), "CustomerID", 4)
    for frame in (customers.customer_behavior(table), features.customer_features(table), features.with_customer_features_in_place(table)):
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(CustomerID" not in text and "Bucketed: true" in text
    # customer_rfm also takes the newest date of all rows, which is one number per task
    text = customers.customer_rfm(table)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(CustomerID" not in text and "Bucketed: true" in text
    found = [sorted(tuple(r)[:4] for r in features.customer_features(frame).collect()) for frame in (table, rows)]
    assert found[0] == found[1]
    spark.sql("DROP TABLE lines_by_customer")
    again = bucketed.open_bucketed(spark, "lines_by_customer", str(tmp_path / "b"), "CustomerID", 4)
    assert again.count() == 3000 and "hashpartitioning" not in features.customer_features(again)._jdf.queryExecution().executedPlan().toString()
    hot = rows.withColumn("CustomerID", F.when(F.col("Quantity") > 1, "one").otherwise("other"))
    with pytest.raises(ValueError, match="100% of the rows"):
        bucketed.write_bucketed(hot, "hot_lines", str(tmp_path / "h"), "CustomerID", 8)
    assert bucketed.largest_share(rows.limit(0), "CustomerID") == 0


def test_jdbc_settings():
    assert warehouse.jdbc_options("jdbc:x", "t", user="u", fetchsize=9) == {
        "url": "jdbc:x", "dbtable": "t", "user": "u", "fetchsize": "9"}
    assert warehouse.partition_options("id", 0, 100, 8) == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "8"}


def test_staging_folder_comes_from_the_session(spark):
    assert staging.staging_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_staged_tables_go_with_their_run(spark):
    with staging.staged_run(spark) as folder:
        assert staging.stage(spark.range(3)).count() == 3 and os.listdir(folder)
    assert not os.path.exists(folder)
    with pytest.raises(ZeroDivisionError), staging.staged_run(spark) as folder:
        staging.stage(spark.range(3))
        1 / 0
    assert not os.path.exists(folder)


def test_ids_of_equal_lines_differ(spark):
    line = ("536", "85", "HEART", 1.0, "12/1/2010 8:26", 2.5, "1", "France")
    df = spark.createDataFrame([line] * 5, "InvoiceNo string, StockCode string, Description string, Quantity double, "
                               "InvoiceDate string, UnitPrice double, CustomerID string, Country string")
    table = warehouse.conform_warehouse(df.drop("InvoiceDate").withColumn("InvoiceDate", F.timestamp_seconds(F.lit(0))))
    assert sorted(r["id"] for r in table.collect()) == [1, 2, 3, 4, 5]


def test_whole_flow(spark, small, tmp_path):
    source, target = str(tmp_path / "csv"), str(tmp_path / "out")
    raw = retail_raw(spark, small).drop("RowKey")
    files.export_csv(raw, source, compression="gzip")
    before = set(os.listdir(staging.staging_folder(spark)))
    layers = run_all(files.read_raw_csv(spark, source, 4), target, TABLE_LIMITS, trees=20)
    assert set(os.listdir(staging.staging_folder(spark))) == before
    assert glob.glob(f"{target}/layers/featured/v*/Month=*")
    assert layers["cleaned"].count() == layers["anomaly"].count() == 3462
    assert len(layers["anomaly"].columns) == 24
    flagged = only_anomalies(layers["anomaly"]).count()
    assert abs(flagged - 0.02 * 3462) <= 3
    assert files.read_documents(spark, f"{target}/documents").count() == flagged
    stored = warehouse.read_warehouse(spark, f"{target}/warehouse")
    assert stored.count() == 3462 and len(stored.columns) == 26
    assert files.read_layer(spark, f"{target}/layers/joined").count() == flagged
    check = spark.read.json(f"{target}/reports/06_integration_verification").first()
    assert check["consistency_check"]["status"] == "VALID"
    assert check["consistency_check"]["missing_keys"] == 0
    names = {path.rsplit("/", 1)[1][:2] for path in glob.glob(f"{target}/reports/*")}
    assert {f"{i:02d}" for i in range(11)} <= names
    top = spark.read.option("header", True).csv(f"{target}/reports/04_top_products")
    assert top.count() == 10
    segments = files.read_layer(spark, f"{target}/layers/customer_segments")
    assert segments.groupBy("Segment").count().count() == 5
    assert spark.read.option("header", True).csv(f"{target}/exports/anomalies").count() == flagged
    assert stored.where(F.col("month").isNull()).count() == 0
