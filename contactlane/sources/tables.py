"""Reading inputs and writing the intake/review tables.

Inputs are Parquet read with column pruning and pushdown left to Catalyst.
Outputs are Parquet tables: the queue is rewritten per run into a new
location (a table cannot be overwritten while it is read), the review tables
only ever take appends.
"""

from __future__ import annotations

import atexit
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from . import schemas


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, ``{base_dir}/{name}.parquet``."""
    return spark.read.parquet(os.path.join(base_dir, f"{name}.parquet"))


def read_emails(spark: SparkSession, path: str) -> DataFrame:
    """Raw e-mails (``email_id, sender, body, sap_id``) with a fixed schema."""
    return spark.read.schema(schemas.EMAILS).parquet(path)


def read_queue(spark: SparkSession, path: str) -> DataFrame:
    """A queue snapshot (possibly partitioned by ``queue_type``) in its fixed
    column order; filters on partition columns prune whole folders."""
    return conform(spark.read.parquet(path), schemas.REVIEW_QUEUE)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns in order, cast to its types."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


# Output tables partitioned by a date derived from their stamp: the action log
# only grows, and time-bounded reads then prune whole folders.
DATE_PARTITIONS = {"review_actions": ("action_date", "created_at")}


def ensure_tables(spark: SparkSession, warehouse: str,
                  tables: dict[str, T.StructType] | None = None,
                  database: str | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS for each output table, Parquet at ``warehouse``.

    ``review_actions`` gets an extra ``action_date`` partition column (the
    date of ``created_at``); its other columns are the fixed ones.
    """
    prefix = f"`{database}`." if database else ""
    for name, schema in (tables or schemas.REVIEW_OUTPUTS).items():
        location = os.path.join(warehouse, name)
        cols, part = schemas.ddl(schema), ""
        if name in DATE_PARTITIONS:
            cols += f", `{DATE_PARTITIONS[name][0]}` DATE"
            part = f" PARTITIONED BY (`{DATE_PARTITIONS[name][0]}`)"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}`{name}` ({cols}) "
                  f"USING parquet{part} LOCATION '{location}'")


def append(df: DataFrame, table: str, schema: T.StructType | None = None) -> None:
    """Append rows to a catalog table (bulk, one job). A date partition column
    of the target (see ``DATE_PARTITIONS``) is derived from the row's stamp."""
    out = conform(df, schema) if schema is not None else df
    target = df.sparkSession.table(table).columns
    for part, stamp in DATE_PARTITIONS.values():
        if part in target and part not in out.columns:
            out = out.withColumn(part, F.to_date(F.col(stamp)))
    out.select(*target).write.mode("append").insertInto(table)


def write_snapshot(df: DataFrame, path: str, schema: T.StructType | None = None,
                   partition_by: list[str] | None = None) -> None:
    """Write a full snapshot to a new ``path`` (overwrite of that path only)."""
    out = conform(df, schema) if schema is not None else df
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def save_table(df: DataFrame, table: str, location: str, schema: T.StructType | None = None,
               partition_by: list[str] | None = None) -> None:
    """Write a full snapshot to the new ``location`` and then let the catalog table
    ``table`` point there. A write that fails leaves an older table as it was. One
    without partitions and of the same columns just gets the new location;
    else the table is replaced in the catalog once the files are there (for
    snapshots that are never missing, see ``runs.RunStore``)."""
    out = conform(df, schema) if schema is not None else df
    spark, by = df.sparkSession, partition_by or []
    writer = out.write.mode("errorifexists")
    (writer.partitionBy(*by) if by else writer).parquet(location)
    columns = [f for f in out.schema if f.name not in by] + [out.schema[c] for c in by]
    same = not by and spark.catalog.tableExists(table) and [
        (f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in columns]
    if same and not any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        part = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in by)})" if by else ""
        spark.sql(f"CREATE TABLE {table} ({schemas.ddl(T.StructType(columns))}) USING parquet{part} LOCATION '{location}'")
    if by:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    spark.catalog.refreshTable(table)


# Stamps in CSV files keep their microseconds.
CSV_STAMPS = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


def export_csv(df: DataFrame, path: str) -> None:
    """CSV export with a header line (one file per partition)."""
    df.write.mode("overwrite").options(header=True, **CSV_STAMPS).csv(path)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir``, if set."""
    return (spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
            or spark.sparkContext.getCheckpointDir())


_ROOTS: dict[str, str] = {}


def materialized_root(spark: SparkSession) -> str:
    """One folder per application under the checkpoint folder, removed when the
    driver exits."""
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        _ROOTS[app] = os.path.join(ensure_checkpoint_dir(spark), f"materialized-{app}")
        atexit.register(_remove_at_exit, spark, _ROOTS[app])
    return _ROOTS[app]


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:  # the session may be stopped already
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder written by :func:`materialize_at` that no plan reads any more."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def materialize_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Cut lineage by writing ``df`` under the session's checkpoint folder; also
    gives the folder, so that the caller can remove it after use.

    Later stages re-read the written table instead of recomputing it, also
    after an executor is lost.
    """
    spark = df.sparkSession
    path = os.path.join(materialized_root(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """:func:`materialize_at` for a table whose last reader is not known; its
    folder goes when the driver exits."""
    return materialize_at(df, name)[0]
