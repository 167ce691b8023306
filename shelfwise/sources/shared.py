"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_fallback: dict[str, str] = {}
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a one-machine session gets a temporary folder of its own;
    anything else is an error, since executors could not see such a folder.
    """
    folder = spark.conf.get(SHARED_DIR, None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set {SHARED_DIR} to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _fallback:
        _fallback[application] = tempfile.mkdtemp(prefix="shelfwise-")
    return _fallback[application]


def written(df: DataFrame, name: str, beside: DataFrame | None = None) -> DataFrame:
    """The same rows, written once to the shared folder and read back; with ``beside``, a
    result of ``written``, together with the rows of that.

    This cuts lineage: what reads the result survives lost executors without
    recomputing ``df``, and Spark knows the size of the table when it plans joins. So the shuffle files of
    the job are not needed again, and go at its end. The tables of an application share a
    folder, which ``remove_written`` deletes; ``dropped`` deletes one of them.
    """
    spark = df.sparkSession
    path = _folders[beside] if beside is not None else f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.mode("append").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    _folders[table] = path
    return table


def dropped(table: DataFrame) -> None:
    """Deletes a result of ``written`` that nothing will read any more."""
    remove_folder(table.sparkSession, _folders[table])


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/shelfwise-{spark.sparkContext.applicationId}"


def remove_written(spark: SparkSession) -> None:
    """Deletes all that ``written`` has written for this application.

    Call it once the results are saved: results that are not, read those tables.
    """
    remove_folder(spark, _own_dir(spark))


def _path(spark: SparkSession, folder: str):
    """A Hadoop path and its file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of any file system that Spark reads; one that is not there is fine."""
    path, system = _path(spark, folder)
    system.delete(path, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Renames a folder. One that bears the new name gives way, and comes back if the renaming
    fails."""
    (old, system), (new, _) = _path(spark, source), _path(spark, target)
    aside, _ = _path(spark, f"{source}-before")
    replaces = system.exists(new)
    if replaces and not system.rename(new, aside):
        raise OSError(f"cannot move {target}")
    if not system.rename(old, new):
        if replaces:
            system.rename(aside, new)
        raise OSError(f"cannot rename {source} to {target}")
    if replaces:
        system.delete(aside, True)
