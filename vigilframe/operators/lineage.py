"""Cutting lineage with tables on shared storage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Folders made for local sessions that name none, by application.
_own: dict[str, str] = {}
# Tables landed without a path of their own, by application.
_landed: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A local session that names none gets a temporary folder, which goes when Python ends.  On a
    cluster a folder of the driver's own would be invisible to executors, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on a cluster ({master})")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="vigilframe-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return _own[app]


def scratch_path(spark: SparkSession, name: str = "landed") -> str:
    """A new path in the shared folder, known to ``release``."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _landed.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at a path of any store; other errors rise."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path in whatever store it is; a missing path is no error."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def scratch_paths(spark: SparkSession) -> list[str]:
    """What this application has landed without a path of its own and not released, in order."""
    return list(_landed.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Deletes some (None: all) of ``scratch_paths``: to be called once results that need them are stored."""
    known = _landed.get(spark.sparkContext.applicationId, [])
    for path in list(known) if paths is None else [p for p in paths if p in known]:
        remove(spark, path)
        known.remove(path)


def landed(df: DataFrame, path: str | None = None) -> DataFrame:
    """Writes a table and reads it back.

    What is read has no lineage to redo when executors are lost, is computed once however often
    it is used, and has a known size, by which Spark decides whether to broadcast it.
    """
    spark = df.sparkSession
    target = path or scratch_path(spark)
    df.write.mode("overwrite").parquet(target)
    return spark.read.schema(df.schema).parquet(target)
