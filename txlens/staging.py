"""Intermediate tables in the shared checkpoint folder.

A staged table cuts the lineage, can be read again after an executor is lost, and
knows its own size, which the lookup joins check before they broadcast anything.

All tables of a session lie in one folder. ``staged_run`` opens a folder for one run and
removes it when the run ends; ``clear_staged`` removes the session's folder, which also
happens when the driver's Python ends normally.
"""

import atexit
import tempfile
import uuid
from contextlib import contextmanager, suppress

#: Settings of ``lean_disk``: Spark drops the shuffle files of a query when it ends, not when the
#: driver happens to collect its garbage, and Parquet is written smaller.
LEAN = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}

_local_folder = None
_session_folders = {}
_runs = []


def staging_folder(spark):
    """The folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="txlens-")
    return _local_folder.name


def _remove(spark, path):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _new_folder(spark):
    return f"{staging_folder(spark).rstrip('/')}/txlens-{uuid.uuid4().hex}"


def run_folder(spark):
    """The folder of the innermost open run, or else of the session."""
    if _runs:
        return _runs[-1]
    key = (spark.sparkContext.applicationId, staging_folder(spark))
    if key not in _session_folders:
        _session_folders[key] = _new_folder(spark)
        atexit.register(_clear_at_exit, spark, key)
    return _session_folders[key]


def _clear_at_exit(spark, key):
    if key in _session_folders and spark.sparkContext._jsc is not None:
        with suppress(Exception):  # the JVM may be gone, and so may the folder
            _remove(spark, _session_folders.pop(key))


def clear_staged(spark):
    """Remove every table staged by this session outside a run; frames over them end here."""
    path = _session_folders.pop((spark.sparkContext.applicationId, staging_folder(spark)), None)
    if path:
        _remove(spark, path)


@contextmanager
def staged_run(spark):
    """Tables staged inside lie in one folder, which is removed at the end, also after an error.

    Frames over them must not be used afterwards; write results elsewhere first.
    """
    _runs.append(_new_folder(spark))
    try:
        yield _runs[-1]
    finally:
        _remove(spark, _runs.pop())


@contextmanager
def lean_disk(spark):
    """Queries run inside leave no shuffle files and write Parquet as ``LEAN`` says; the session's settings come back after.

    Calling ``collect`` twice on one frame inside would run its shuffles twice; frames made from it are not concerned.
    """
    before = {name: spark.conf.get(name, None) for name in LEAN}
    for name, value in LEAN.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def stage(df):
    """Write ``df`` once and return it as read back."""
    path = f"{run_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
