"""Tables that are replaced as a whole: a reader meets the old version or the new one.

A table is a folder of versions. A new version is written beside the others, its rows are
counted by the write itself, and an empty marker file then makes it the current one: the
current version is the highest one that has the marker. A failed write leaves the current
version as it is. One writer at a time is assumed; the version before the current one is kept
for readers that are still at it.
"""

import re
import uuid
from typing import NamedTuple

from pyspark.sql import Observation
from pyspark.sql import functions as F

MARKER = "_PUBLISHED"
VERSION = re.compile(r"v(\d{9})-(.+)")


class Published(NamedTuple):
    path: str
    rows: int
    known: dict


def _store(spark, path):
    """The file system of a path, and the path as the file system names it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _versions(spark, path):
    """(number, name, whether it is published) of every version, lowest first."""
    system, place = _store(spark, path)
    if not system.exists(place):
        return []
    names = [entry.getPath().getName() for entry in system.listStatus(place)]
    found = [(int(m[1]), name) for name in names if (m := VERSION.fullmatch(name))]
    marks = [system.exists(_store(spark, f"{path}/{name}/{MARKER}")[1]) for _, name in found]
    return sorted((number, name, mark) for (number, name), mark in zip(found, marks))


def current(spark, path):
    """The folder to read: the current version, or the path itself where nothing was published."""
    done = [name for _, name, mark in _versions(spark, path) if mark]
    return f"{path}/{done[-1]}" if done else path


def finished(spark, path, run):
    """Whether the current version was published by the named run."""
    return current(spark, path).endswith(f"-{run}")


def publish(df, path, kind="parquet", partition_by=None, run=None, least=0, count=(), **options):
    """Write ``df`` as a new version and make it the current one.

    Returns where it is, how many rows were sent and how many values of each column in
    ``count`` are known, all taken while writing. Fewer than ``least`` rows are refused and
    never become current. ``run`` names the version, see ``finished``.
    """
    spark = df.sparkSession
    before = _versions(spark, path)
    name = f"v{(before[-1][0] if before else 0) + 1:09d}-{run or uuid.uuid4().hex}"
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"known_{c}") for c in count])
    writer = writer.write.options(**options)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.format(kind).save(f"{path}/{name}")
    metrics = seen.get
    system, place = _store(spark, f"{path}/{name}")
    if metrics["rows"] < least:
        system.delete(place, True)
        raise ValueError("nothing to store: the table is empty")
    system.create(_store(spark, f"{path}/{name}/{MARKER}")[1]).close()
    kept = [old for _, old, mark in before if mark][-1:]
    for _, old, _ in before:
        if old not in kept:
            system.delete(_store(spark, f"{path}/{old}")[1], True)
    return Published(f"{path}/{name}", metrics["rows"], {c: metrics[f"known_{c}"] for c in count})
