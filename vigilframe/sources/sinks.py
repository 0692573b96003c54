"""Sinks: register snapshots, the audit log, exports.  All writes are parallel and repeatable."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilframe.operators.lineage import exists, remove


def snapshot_path(path: str, run_id: str) -> str:
    return f"{path}/run_id={run_id}"


def write_register(register: DataFrame, path: str, run_id: str) -> str:
    """S-11: a new immutable snapshot per run; writing it again replaces it."""
    target = snapshot_path(path, run_id)
    register.write.mode("overwrite").parquet(target)
    return target


def save_register_table(register: DataFrame, table: str, key: str, buckets: int) -> None:
    """S-11 as a table bucketed by register key.

    Later joins by key (flag updates, snapshot differences) then read co-located buckets and
    shuffle nothing; choose the number of buckets so that one holds a few hundred MB.
    """
    register.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def append_audit(audit: DataFrame, path: str, run_id: str) -> None:
    """S-08: adds a run's rows to the log, partitioned by day and run.

    Repeating a run replaces its own partitions and no other, so a retry never doubles rows, also
    on a later day.
    """
    spark = audit.sparkSession
    if exists(spark, path):
        logged = spark.read.parquet(path).where(F.col("run_id").cast("string") == run_id)
        for row in logged.select("run_date").distinct().collect():  # the days of one run
            remove(spark, f"{path}/run_date={row.run_date}/run_id={run_id}")
    dated = audit.withColumn("run_date", F.to_date("UpdatedAt")).withColumn("run_id", F.lit(run_id))
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date", "run_id")
        .parquet(path)
    )


def export_path(name: str, folder: str, at: datetime) -> str:
    return f"{folder}/{name}_Export_{at:%Y-%m-%d_%H-%M-%S}"


def export_table(df: DataFrame, name: str, folder: str, at: datetime) -> str:
    """S-09, S-10: a table as CSV with header rows in a folder named after table and time.

    One file per partition, each with the header; the table is not squeezed into one task.
    A repeated run replaces its own export.
    """
    target = export_path(name, folder, at)
    df.write.mode("overwrite").option("header", True).csv(target)
    return target
