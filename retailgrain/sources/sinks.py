"""Writers: catalog tables, full refresh, CSV exports."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from retailgrain.rules.fixed_values import CUBE_COLUMNS
from retailgrain.session import settings

# What an export should leave out; the caller says so.
PERSONAL_COLUMNS = ("first_name", "last_name", "email", "phone", "address", "street")


def cube_schema() -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in CUBE_COLUMNS))


def create_table(spark: SparkSession, name: str, schema: T.StructType, location: str, partitioned_by: Sequence[str] = ()) -> None:
    """Create an empty external table with the declared columns unless it exists.

    The partitions of a partitioned table are found in its folder rather than listed one by one in the catalog, so
    pointing the table at another folder switches all of them at once (see ``publish_version``).
    """
    if spark.catalog.tableExists(name):
        return
    # Partition columns come last, as in any folder of partitions.
    columns = [f for f in schema if f.name not in partitioned_by] + [schema[c] for c in partitioned_by]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partitioned_by)})" if partitioned_by else ""
    with settings(spark, {"spark.sql.hive.manageFilesourcePartitions": "false"}):
        spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet {parts} LOCATION '{location}'")


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def publish_version(rows: DataFrame, name: str, new_location: str | None = None) -> str:
    """Make the table hold exactly these rows: write them to a new folder, then point the table at it.

    Readers see the old rows or the new ones, and a failure before the switch leaves the old ones. Returns the old
    folder, which stays until the caller is sure that nobody reads it. Partitioned tables must come from ``create_table``.
    """
    spark = rows.sparkSession
    about = _described(spark, name)
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if partitions and about.get("Partition Provider") == "Catalog":
        raise ValueError(f"the catalog lists the partitions of {name} one by one, so they cannot be switched in one step")
    old = about["Location"]
    target = new_location or f"{old.rstrip('/')}-v{uuid.uuid4().hex}"
    writer = rows.select(*[F.col(f.name).cast(f.dataType) for f in spark.table(name).schema]).write.mode("errorifexists")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(target)
    _switch(spark, name, target)
    return old


def _switch(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    spark.catalog.refreshTable(name)


def append_rows(df: DataFrame, name: str) -> None:
    """Append by column name, in the table's column order and types."""
    table = df.sparkSession.table(name)
    df.select(*[F.col(f.name).cast(f.dataType) for f in table.schema]).write.insertInto(name)


def _listed_partitions(spark: SparkSession, name: str) -> bool:
    """Whether the catalog keeps a list of partitions, each with a folder of its own."""
    return any(c.isPartition for c in spark.catalog.listColumns(name)) and _described(spark, name).get("Partition Provider") == "Catalog"


def replace_rows(df: DataFrame, name: str) -> None:
    """Full refresh: the table holds exactly these rows afterwards, partitions that got no row included.

    One step for readers, as in ``publish_version``; only a table whose partitions the catalog lists is overwritten in place.
    """
    spark = df.sparkSession
    if not _listed_partitions(spark, name):
        publish_version(df, name)
        return
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in spark.table(name).schema])
    with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "static"}):
        rows.write.insertInto(name, overwrite=True)


def delete_not_null(spark: SparkSession, name: str, key: str, new_location: str) -> None:
    """Delete the rows whose key is not NULL.

    The rest is written to a new folder and the table is pointed at it in one step,
    so readers see either the old rows or the new ones. Where the catalog lists the partitions, these keep
    their own folders; there the rest is stored first and then replaces all of them.
    """
    rest = spark.table(name).where(F.col(key).isNull())
    if not _listed_partitions(spark, name):
        publish_version(rest, name, new_location)
        return
    rest.write.mode("errorifexists").parquet(new_location)
    replace_rows(spark.read.schema(spark.table(name).schema).parquet(new_location), name)


def write_csv(df: DataFrame, path: str, drop: Sequence[str], header: bool = True) -> None:
    """CSV dump without the columns to drop (see ``PERSONAL_COLUMNS``); one file per partition."""
    df.drop(*drop).write.mode("overwrite").option("header", header).csv(path)


def write_recon_export(rows: DataFrame, path: str, error: str = "no data") -> None:
    """Export reconciled rows; without any, a one-column table that says so. The rows are made once."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("header", True).csv(path)
    if not seen.get["rows"]:
        nothing = rows.sparkSession.range(1).select(F.lit(error).alias("error"))
        nothing.write.mode("overwrite").option("header", True).csv(path)
