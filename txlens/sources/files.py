"""CSV, Parquet and JSON sources and sinks."""

import csv
from urllib.parse import unquote

from pyspark.sql import functions as F

from txlens.operators.anomalies import only_anomalies
from txlens.operators.cleaning import strip_column_names
from txlens.schemas import LAYERS, RAW
from txlens.sources.publishing import current, publish
from txlens.staging import stage

#: Rows that a single file may hold, unless the caller says otherwise.
SINGLE_FILE_ROWS = 1_000_000


def _first_line_rows(spark, path):
    """(file, first line) of every file with a line, read by one task per file.

    A session of its own lets every file be one split, so the first line is the first row of its
    task; the other rows are passed over where they are read.
    """
    probe = spark.newSession()
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        probe.conf.set(name, str(1 << 40))
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    lines = probe.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value", place.alias("_place"))
    return lines.where("_place = 0").drop("_place")


def _first_lines(spark, path):
    return {row["file"]: row["value"] for row in _first_line_rows(spark, path).collect()}


def _header_groups(spark, path):
    """{column names: files}; files without a line are left out."""
    groups = {}
    for file, line in sorted(_first_lines(spark, path).items()):
        names = tuple(name.strip() for name in next(csv.reader([line.lstrip("\ufeff")])))
        groups.setdefault(names, []).append(file)
    return groups


def _read_csv_files(spark, files, names, kinds, broken):
    schema = ", ".join([*[f"`{name}` {kinds.get(name, 'string')}" for name in names], f"`{broken}` string"])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", broken)
        .csv(files)
    )


def read_raw_csv(spark, path, partitions=None, corrupt=None):
    """Invoice lines from CSV (plain or gzip), without a schema inference pass.

    Columns are found by their header names, blanks stripped, in any order; further columns are
    left out and missing ones refused. Every file of ``path`` goes by its own header: files of
    one header are one read, and the reads are united by name. Unreadable values become NULL;
    ``corrupt`` names a column that keeps the text of such rows (see ``unreadable_rows``). A
    gzip file is read by one task, so its rows are spread over ``partitions`` tasks, by default
    as many as there are cores.
    """
    kinds = dict(field.split() for field in RAW.split(", "))
    broken = corrupt or "_corrupt_record"
    groups = _header_groups(spark, path)
    rows, read = None, []
    for names, files in groups.items():
        lacking = [name for name in kinds if name not in names]
        if lacking:
            raise ValueError(f"missing columns: {', '.join(lacking)} in {files[0]}")
        files = [unquote(file) for file in files]
        part = _read_csv_files(spark, files, names, kinds, broken).select(*kinds, *([broken] if corrupt else []))
        rows = part if rows is None else rows.unionByName(part)
        read += files
    if rows is None:
        raise ValueError(f"missing columns: {', '.join(kinds)}: no line in {path}")
    cores = spark.sparkContext.defaultParallelism
    if partitions is None and len(read) < cores and any(f.endswith(".gz") for f in read):
        partitions = cores
    return rows.repartition(partitions) if partitions else rows


def unreadable_rows(rows, corrupt):
    """One row: all rows read, and those with a value that could not be read."""
    return rows.agg(F.count("*").alias("Rows"), F.count(corrupt).alias("Unreadable"))


def read_text_csv(spark, path, casts=None):
    """A CSV file with all columns as text, some of them cast afterwards."""
    rows = strip_column_names(spark.read.option("header", True).csv(path))
    return rows.withColumns({
        name: F.col(name).try_cast(kind)
        for name, kind in (casts or {"TotalPrice": "double"}).items()
    })


def read_layer(spark, path, layer=None):
    """The current version of a layer, or the plain table at ``path``."""
    reader = spark.read.schema(LAYERS[layer]) if layer else spark.read
    return strip_column_names(reader.parquet(current(spark, path)))


def write_layer(df, path, partition_by=None, run=None):
    """Publish ``df`` as the layer at ``path``; returns what was sent (see ``publish``)."""
    return publish(df, path, partition_by=partition_by, run=run)


def _bounded(df, rows, kind):
    """The rows, made once and staged, in one task; too many are refused before all are made."""
    held = stage(df.limit(rows + 1))
    if held.count() > rows:
        raise ValueError(f"more than {rows} rows do not belong in one {kind} file")
    return held.coalesce(1)


def export_csv(df, path, single_file=False, compression="none", single_file_rows=SINGLE_FILE_ROWS):
    """CSV with a header; one file is refused for more than ``single_file_rows`` rows."""
    if single_file:
        df = _bounded(df, single_file_rows, "CSV")
    df.write.mode("overwrite").option("header", True).csv(path, compression=compression)


def write_report(df, path, kind="csv", rows=SINGLE_FILE_ROWS):
    """A bounded report in one file."""
    if kind == "json":
        _bounded(df, rows, "JSON").write.mode("overwrite").json(path)
    else:
        export_csv(df, path, single_file=True, single_file_rows=rows)


def require_loadable(df, *columns):
    """Refuse an empty table or one that lacks a column the sink depends on."""
    lacking = [name for name in columns if name not in df.columns]
    if lacking:
        raise ValueError(f"missing columns: {', '.join(lacking)}")
    if df.isEmpty():
        raise ValueError("nothing to store: the table is empty")
    return df


def write_documents(df, path, records_per_file=0, run=None):
    """Replace the document collection by the flagged rows, one JSON object each.

    Files follow the tasks that write them; ``records_per_file`` (0: no limit) cuts them further.
    The rows are scanned once; returns what was sent (see ``publish``).
    """
    lacking = [name for name in ("anomaly",) if name not in df.columns]
    if lacking:
        raise ValueError(f"missing columns: {', '.join(lacking)}")
    return publish(only_anomalies(df), path, "json", run=run, least=1, maxRecordsPerFile=records_per_file)


def read_documents(spark, path, schema=LAYERS["anomaly"]):
    rows = spark.read.schema(schema).json(current(spark, path))
    return rows.drop("_id")


def write_check(sent, stored):
    """One row: rows sent, rows found, and whether they agree."""
    counts = sent.agg(F.count("*").alias("RowsSent")).select(
        "RowsSent", stored.agg(F.count("*")).scalar().alias("RowsStored")
    )
    return counts.withColumn("Complete", F.col("RowsSent") == F.col("RowsStored"))


def require_stored(sent, stored, name):
    """Refuse a store that does not hold as many rows as were counted when they were sent."""
    found = stored.count()
    if found != sent.rows:
        raise ValueError(f"{name}: sent {sent.rows}, found {found}")
    return found
