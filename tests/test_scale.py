"""What must hold for any table size: exactness, skew, and the shape of plans."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog import frames
from txlens.operators import (correlation, features, forest, joins, lookup, ordering, pages, profile, quantiles, reduction,
                              sales, sketches)
from txlens.operators.anomalies import flag_anomalies
from txlens.staging import stage


def plan(df):
    return df._jdf.queryExecution().toString()


def skewed(spark, rows=20_000):
    """A third of the rows share one key, one moment and one amount."""
    hot = F.col("id") % 3 == 0
    return spark.range(rows).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 997)).alias("CustomerID"),
        F.when(hot, 50.0).otherwise((F.col("id") * 7919 % 10007) / 100).alias("TotalPrice"),
        F.lit(1.0).alias("Quantity"),
        F.when(hot, F.timestamp_seconds(F.lit(10**9))).otherwise(
            F.timestamp_seconds(10**9 + (F.col("id") * 31 % 5000) - 2500)).alias("InvoiceDate"),
        F.format_string("%08d", "id").alias("RowKey"),
    )


@pytest.mark.parametrize("limit,accuracy", [(10**6, 10_000), (500, 1000), (50, 200)])
def test_quantiles_are_exact(spark, limit, accuracy):
    df = stage(skewed(spark).withColumn("Other", F.col("TotalPrice") * -3 + F.hash("RowKey") % 5))
    wanted = [0.0, 0.02, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = quantiles.exact_quantiles(df, ["TotalPrice", "Other"], wanted, limit, accuracy)
    data = df.select("TotalPrice", "Other").toPandas()
    for name in ("TotalPrice", "Other"):
        assert found[name] == pytest.approx(list(np.quantile(data[name], wanted)), abs=1e-9)


@pytest.mark.parametrize("limit,accuracy", [(1000, 200), (10, 50)])
def test_quantiles_between_two_heavy_values(spark, limit, accuracy):
    place = F.col("id") % 1000
    df = stage(spark.range(200_000).select(F.when(place < 499, 0.0).when(place < 998, 1e6).otherwise(
        F.col("id").cast("double")).alias("v")))
    wanted = [0.1, 0.499, 0.4995, 0.5, 0.5005, 0.9]
    found = quantiles.exact_quantiles(df, ["v"], wanted, limit, accuracy)["v"]
    assert found == pytest.approx(list(np.quantile(df.toPandas()["v"], wanted)), abs=1e-9)


def counting(df):
    """``df``, and an accumulator of how often a row of it is made."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), seen


def test_box_and_correlation_read_their_source_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    flag_anomalies(skewed(spark, 3000).withColumn("score", -F.col("TotalPrice"))).write.parquet(path)
    df = spark.read.parquet(path)
    for build in (lambda f: correlation.correlation_matrix(f, ["TotalPrice", "Quantity", "anomaly", "anomaly_score"]),
                  lambda f: correlation.top_anomaly_correlations(f, ["TotalPrice", "Quantity", "anomaly_score"])):
        counted, seen = counting(df)
        build(counted).collect()
        assert seen.value == 3000
    box = profile.box_summary(df, "TotalPrice", limit=100)
    assert box._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    data = df.toPandas()
    for row in box.collect():
        values = data[data["anomaly"] == (row["Status"] == "Anomaly")]["TotalPrice"]
        assert (row["Q1"], row["Median"], row["Q3"]) == pytest.approx(tuple(np.quantile(values, [0.25, 0.5, 0.75])))


def test_correlations_with_nulls_and_large_means(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(4000, 5)) * [1, 1e3, 1e-3, 1, 0] + [1e7, 0, 5, 0, 0.1]
    data[:, 1] += data[:, 0] - 1e7
    rows = [[None if rng.random() < 0.2 and j in (1, 3) else float(v) for j, v in enumerate(row)] for row in data]
    for row in rows:
        if row[1] is not None:
            row[3] = 4.25  # constant wherever the other one is known
    names = list("abcde")
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(7)
    plain = df.toPandas().corr()
    for row in correlation.correlation_pairs(df, names).collect():
        expected = plain.loc[row["Left"], row["Right"]]
        if "e" in row[:2] or set(row[:2]) == {"b", "d"}:
            assert row["Correlation"] is None
        else:
            assert row["Correlation"] == pytest.approx(expected, abs=1e-9)
    # pairs with the target only
    assert correlation._coefficients(df, names, ["c"]).count() == len(names)
    empty = correlation.correlation_matrix(df.limit(0), names).collect()
    assert len(empty) == 5 and all(v is None for row in empty for v in row[1:])


def test_forest_walks_visit_places_once():
    for rows in (1, 2, 7, 256, 25_600):
        for tree in range(20):
            start, step = forest._walk(42, tree, rows)
            assert len({(start + k * step) % rows for k in range(min(rows, 300))}) == min(rows, 300)


def test_forest_samples_are_linear_in_the_sample(spark):
    """No frame of trees times the pool: the walks make one row for each sampled row."""
    df = stage(skewed(spark, 3000).withColumn("UnitPrice", F.col("TotalPrice")))
    drawn = forest.draw_samples(df, trees=10, sample=32)
    assert drawn.groupBy("tree").count().select("count").distinct().collect()[0][0] == 32 and drawn.count() == 320
    assert drawn.select("_hash").distinct().count() > 150
    few = forest.draw_samples(df.limit(20), trees=3, sample=32)
    assert [r["count"] for r in few.groupBy("tree").count().collect()] == [20] * 3
    assert forest.draw_samples(df.limit(0), trees=3, sample=32).count() == 0


def test_rows_are_dropped_before_the_join_shuffles(spark):
    rows = stage(skewed(spark, 20_000))
    flagged = stage(rows.where(F.substring("RowKey", 7, 2) == "13").select("RowKey", F.lit(1).alias("anomaly")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        possible = reduction.keep_possible(rows, flagged, "RowKey")
        kept = possible.count()
        joined = joins.join_anomalies(rows, flagged, "RowKey")
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 200 and 200 <= kept < 3000
        # the filter lies below the exchange of the large side
        side = text[text.index("Sort "):]
        assert side.index("hashpartitioning(RowKey") < side.index("getbit") < side.index("BroadcastExchange")
        check = joins.consistency_check(rows, flagged.union(flagged.limit(3).withColumn("RowKey", F.lit("none"))), "RowKey").first()
        assert check["MissingKeys"] == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # with too few bits the rows come back as they are; nothing is lost with one word either
    assert reduction.keep_possible(rows, flagged, "RowKey", words=1).count() == 20_000
    assert reduction.keep_possible(rows, flagged.limit(20), "RowKey", words=1).join(flagged.limit(20), "RowKey").count() == 20
    nulls = stage(flagged.withColumn("RowKey", F.lit(None).cast("string")))
    assert reduction.keep_possible(rows, nulls, "RowKey").count() == 0


def test_a_kept_page_reads_its_own_files(spark, tmp_path):
    df = stage(skewed(spark, 20_000).withColumn("tie", F.lit(1)))
    path = str(tmp_path / "kept")
    assert pages.write_ordered(df, ["TotalPrice", "RowKey"], path, rows_per_file=1500) == 20_000
    expected = [r["RowKey"] for r in df.orderBy("TotalPrice", "RowKey").collect()]
    for number in (1, 30, 31, 200, 400):
        page = pages.read_page(spark, path, number)
        assert len(page.inputFiles()) <= 2 and page.columns == df.columns
        assert [r["RowKey"] for r in page.collect()] == expected[(number - 1) * 50:number * 50]
    assert pages.read_page(spark, path, 401).count() == 0
    assert tuple(pages.ordered_page_count(spark, path).first()) == (20_000, 400)
    # equal keys: pages follow the order that was written, nothing twice and nothing left out
    pages.write_ordered(df, ["tie"], path, rows_per_file=1500)
    assert sorted(r["RowKey"] for n in range(1, 401) if n % 100 == 0 for r in pages.read_page(spark, path, n // 100, 5000).collect()) == sorted(expected)


def test_sketches_merge_within_their_error(spark):
    df = stage(skewed(spark, 60_000).withColumn("Month", F.col("RowKey").substr(8, 1)).withColumn(
        "Status", F.when(F.col("RowKey").substr(7, 1) == "3", "Anomaly").otherwise("Normal")).withColumn(
        "TotalPrice", F.when(F.col("Month") == "9", None).otherwise(F.col("TotalPrice"))))
    kept = stage(sketches.quantile_sketches(df, "TotalPrice", ["Month", "Status"]))
    assert kept.count() == 20
    wanted = [0.01, 0.25, 0.5, 0.75, 0.99]
    data = df.toPandas().dropna(subset=["TotalPrice"])
    whole = sketches.sketched_quantiles(kept, wanted).first()
    some = {r["Status"]: r for r in sketches.sketched_quantiles(kept.where("Month in ('1', '2')"), wanted, ["Status"]).collect()}
    cases = [(whole, data)] + [(row, data[data["Month"].isin(["1", "2"]) & (data["Status"] == s)]) for s, row in some.items()]
    for row, part in cases:
        values = np.sort(part["TotalPrice"].to_numpy())
        assert row["Rows"] == len(values)
        for p, found in zip(wanted, row["Quantiles"]):
            low, high = (np.searchsorted(values, found, side) / len(values) for side in ("left", "right"))
            assert low <= p + 0.005 and high >= p - 0.005
    assert sketches.sketched_quantiles(kept.limit(0), wanted).count() in (0, 1)


def test_positions_take_one_shuffle(spark):
    df = stage(skewed(spark, 5000))
    spark.sparkContext.setJobGroup("positions", "positions")
    numbered = ordering.row_number_global(df, ["RowKey"], rows_per_range=700)
    text = numbered._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text.split("BroadcastExchange")[0] and "rangepartitioning" not in text
    assert [r["row_id"] for r in numbered.orderBy("RowKey").collect()] == list(range(1, 5001))


def test_deep_pages_with_ties_and_nulls(spark):
    rows = [(i % 7 if i % 5 else None, i % 3, i) for i in range(700)]
    df = spark.createDataFrame(rows, "a long, b long, c long")
    for order in (["a", "b", "c"], ["b", "a", "c"]):
        for number in (1, 3, 14, 15):
            deep = ordering.page(df, order, number, size=50, shallow=0, rows_per_range=100)
            assert deep.collect() == ordering.page(df, order, number, size=50).collect()
    assert ordering.page(df, ["a"], 5, size=50, shallow=0).count() == 50


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert quantiles.exact_quantiles(df, ["v"], [0.5]) == {"v": [None]}


def test_positions_split_hot_values(spark):
    df = skewed(spark)
    numbered = ordering.row_number_global(df, ["CustomerID", "RowKey"])
    rows = [tuple(r) for r in numbered.select("CustomerID", "RowKey", "row_id").collect()]
    expected = sorted(row[:2] for row in rows)
    assert [row[:2] for row in sorted(rows, key=lambda r: r[2])] == expected
    assert sorted(row[2] for row in rows) == list(range(1, len(rows) + 1))
    sizes = [r["count"] for r in df.repartitionByRange(8, "CustomerID", "RowKey")
             .groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 0.25 * sum(sizes)


def test_deep_page_equals_shallow_page(spark):
    df = skewed(spark, 2000).select("RowKey", "TotalPrice")
    deep = ordering.page(df, ["RowKey"], 7, size=50, shallow=0)
    assert deep.collect() == ordering.page(df, ["RowKey"], 7, size=50).collect()


@pytest.mark.parametrize("shallow", [10_000, 10])
def test_halves_inside_one_busy_moment(spark, monkeypatch, shallow):
    monkeypatch.setattr(ordering, "SHALLOW_ROWS", shallow)
    df = skewed(spark, 3001)
    row = ordering.revenue_delta(df, "RowKey").first()
    data = df.toPandas().sort_values(["InvoiceDate", "RowKey"])
    first = data["TotalPrice"].iloc[: len(data) // 2].sum()
    assert row["FirstHalf"] == pytest.approx(first)
    assert row["FirstHalf"] + row["SecondHalf"] == pytest.approx(data["TotalPrice"].sum())


def test_hash_bound_changes_nothing(spark):
    df = skewed(spark)
    text = F.md5(F.concat("RowKey", F.lit("|1")))
    plain = df.orderBy(text).limit(30).collect()
    assert ordering.sample_n(df, 30, 1, "RowKey").collect() == plain and len(plain) == 30
    assert ordering.sample_n(df.repartition(3), 30, 1, "RowKey").collect() == plain
    assert ordering.sample_n(df, 30, 2, "RowKey").collect() != plain
    assert ordering.sample_n(df.limit(5), 30, 1, "RowKey").count() == 5


def test_lookup_is_broadcast_only_within_the_bound(spark):
    df = skewed(spark)
    table = features.customer_features(df)
    small = lookup.attach(df, table, "CustomerID")
    assert "BroadcastHashJoin" in plan(small)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        large = lookup.attach(df, table, "CustomerID", limit=10)
        assert "SortMergeJoin" in plan(large) and "Broadcast" not in plan(large)
        columns = ["RowKey", "AvgCustomerSpend", "CustomerFrequency"]
        assert sorted(large.select(columns).collect()) == sorted(small.select(columns).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_wide_lookup_is_not_broadcast(spark, monkeypatch):
    labels = spark.range(100).select(F.repeat(F.col("id").cast("string"), 50).alias("CustomerID"))
    assert lookup._fits_broadcast(labels, 1000) and not lookup._fits_broadcast(labels, 99)
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 5000)
    assert not lookup._fits_broadcast(labels, 1000)


def test_hot_key_of_a_large_lookup_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    previous = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        df = stage(skewed(spark, 200_000).repartition(8))
        joined = lookup.attach(df, features.customer_features(df), "CustomerID", limit=10)
        longest = joined.agg(F.max(F.concat("RowKey", "InvoiceDate", "CustomerFrequency")))
        longest.collect()
        assert "skew=true" in plan(longest)
    finally:
        for name, value in previous.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_large_label_tables_are_numbered_the_same(spark):
    df = skewed(spark)
    labels = df.groupBy("CustomerID").count()
    order = [F.col("count").desc(), "CustomerID"]
    small = lookup.numbered_labels(labels, order, "Code")
    large = lookup.numbered_labels(labels, order, "Code", limit=10)
    key = ["CustomerID", "Code"]
    assert sorted(small.select(key).collect()) == sorted(large.select(key).collect())


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    skewed(spark, 100).withColumns({"Country": F.lit("a"), "anomaly": F.lit(1)}) \
        .write.parquet(path)
    df = sales.filter_transactions(spark.read.parquet(path), 1.0, 9.0, "anomaly", "a")
    text = plan(df.groupBy("Country").count())
    for pushed in ("GreaterThanOrEqual(TotalPrice,1.0)", "LessThanOrEqual(TotalPrice,9.0)",
                   "EqualTo(anomaly,1)", "EqualTo(Country,a)"):
        assert pushed in text
    assert "RowKey" not in text.split("ReadSchema")[-1]


def test_reports_scan_once(spark, small):
    from txlens.operators.cleaning import cleaning_report

    for report in (cleaning_report, profile.column_profile):
        text = report(frames.raw(spark, small))._jdf.queryExecution().executedPlan().toString()
        assert text.count("lineitem.parquet") == 1


def test_top_k_does_not_sort_everything(spark, small):
    text = plan(sales.top_transactions(frames.cleaned(spark, small), 10, "RowKey"))
    assert "TakeOrderedAndProject" in text


def test_key_join_keeps_every_flagged_row_once(spark):
    df = flag_anomalies(skewed(spark).withColumn("score", -F.col("TotalPrice")))
    flagged = df.where("anomaly = 1")
    documents = flagged.select("RowKey", F.lit("r").alias("reason"))
    joined = joins.join_anomalies(df, documents, "RowKey")
    assert joined.count() == flagged.count() and sorted(joined.columns) == sorted([*df.columns, "reason"])


def forest_input(spark, rows=4000):
    """Evenly spread rows; one in a thousand is far out in every column."""
    def spread(salt, width, start):
        far = F.lit(float(100 * (width + start)))
        even = F.pmod(F.hash(F.lit(salt), "id"), width * 10) / 10 + start
        return F.when(F.col("id") % 1000 == 0, far).otherwise(even)

    return spark.range(rows).select(
        F.format_string("%06d", "id").alias("RowKey"),
        spread(1, 100, 1).alias("Quantity"),
        spread(2, 20, 5).alias("UnitPrice"),
        spread(3, 1000, 10).alias("TotalPrice"),
    )


def test_forest_does_not_depend_on_partitions(spark):
    df = stage(forest_input(spark))
    order = ["tree", "node"]
    one = forest.fit_isolation_forest(df.coalesce(1), trees=20, sample=64).orderBy(order).collect()
    many = forest.fit_isolation_forest(df.repartition(7), trees=20, sample=64).orderBy(order)
    assert many.collect() == one
    other = forest.fit_isolation_forest(df, trees=20, sample=64, seed=7).orderBy(order).collect()
    assert other != one


@pytest.mark.parametrize("sample", [64, 256])
def test_forest_finds_the_outliers(spark, sample):
    df = stage(forest_input(spark))
    nodes = stage(forest.fit_isolation_forest(df, trees=60, sample=sample))
    assert nodes.select("tree").distinct().count() == 60
    roots = {r["size"] for r in nodes.where("node = 0").select("size").collect()}
    assert roots == {sample}
    assert nodes.count() <= 60 * 2 * sample
    scored = stage(forest.score_isolation_forest(df, nodes))
    low, high = scored.agg(F.min("score"), F.max("score")).first()
    assert -1 < low < high < 0
    flagged = flag_anomalies(scored, "score", 0.02)
    share = flagged.agg(F.avg("anomaly")).first()[0]
    assert share == pytest.approx(0.02, abs=0.002)
    assert flagged.where("TotalPrice > 2000 and anomaly = 0").count() == 0


def test_forest_on_fewer_rows_than_wanted(spark):
    df = forest_input(spark, 40)
    nodes = forest.fit_isolation_forest(df, trees=10, sample=32)
    assert nodes.where("node = 0").count() == 10
    assert {r["size"] for r in nodes.where("node = 0").collect()} == {32}
    scored = forest.score_isolation_forest(df.union(df.selectExpr(
        "RowKey", "cast(null as double)", "UnitPrice", "TotalPrice")), nodes)
    assert scored.count() == 40


def test_node_sizes_add_up(spark):
    nodes = {(r["tree"], r["node"]): r for r in forest.fit_isolation_forest(
        forest_input(spark), trees=5, sample=128).collect()}
    for (tree, node), row in nodes.items():
        if row["feature"] != forest.LEAF:
            left, right = nodes[tree, 2 * node + 1], nodes[tree, 2 * node + 2]
            assert left["size"] + right["size"] == row["size"]
            assert min(left["size"], right["size"]) > 0
