"""Readers: order tables, sales facts, stock snapshots, stock files, channel lists."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from retailgrain.functions.text import row_digest
from retailgrain.operators.filters import date_range, on_day
from retailgrain.operators.yoy import SUM_METRICS
from retailgrain.session import settings

SALES_FACT_SCHEMA = T.StructType([
    T.StructField("full_date", T.DateType()),
    T.StructField("month", T.IntegerType()),
    *[T.StructField(c, T.StringType()) for c in ("region", "company", "channel", "shop_name")],
    *[T.StructField(m, T.DoubleType()) for m in SUM_METRICS],
])
STOCK_SCHEMA = T.StructType([T.StructField("barcode", T.StringType()), T.StructField("quantity", T.DoubleType())])
CHANNEL_SESSIONS_SCHEMA = "channel string, sessions bigint"


@dataclass(frozen=True)
class JdbcSource:
    """A database table read in parallel slices of a numeric or date column."""

    url: str
    table: str
    partition_column: str
    lower: str
    upper: str
    partitions: int = 64
    properties: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": self.table,
            "partitionColumn": self.partition_column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.partitions),
            "fetchsize": "10000",
            "pushDownPredicate": "true",
            "pushDownAggregate": "true",
            # Dates and times of the database have no zone; the machine's zone must not move them.
            "preferTimestampNTZ": "true",
            **self.properties,
        }


def read_table(spark: SparkSession, source: str | JdbcSource) -> DataFrame:
    """A parquet path, a catalog table, or a database table."""
    if isinstance(source, JdbcSource):
        return spark.read.format("jdbc").options(**source.options()).load()
    if "/" in source or source.endswith(".parquet"):
        return spark.read.parquet(source)
    return spark.read.table(source)


def read_orders(
    spark: SparkSession,
    headers: str | JdbcSource,
    date_column: str,
    start: dt.date,
    end: dt.date,
    columns: Sequence[str] | None = None,
    closed: str = "left",
) -> DataFrame:
    """Order headers of a date range; range and columns reach the scan."""
    rows = date_range(read_table(spark, headers), date_column, start, end, closed)
    return rows.select(*columns) if columns else rows


def read_sales_facts(spark: SparkSession, source: str | JdbcSource) -> DataFrame:
    table = read_table(spark, source)
    return table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SALES_FACT_SCHEMA])


def read_snapshot(
    spark: SparkSession, source: str | JdbcSource, day: dt.date, columns: Sequence[str], day_column: str
) -> DataFrame:
    """Named columns of one day's stock snapshot; a table partitioned by day is pruned to one partition."""
    return on_day(read_table(spark, source), day_column, day).select(*columns)


# A file is one partition, whatever its size, so its first line needs no exchange and the scan stops behind it.
_WHOLE_FILES = {"spark.sql.files.maxPartitionBytes": str(1 << 40), "spark.sql.files.openCostInBytes": str(1 << 40)}
_HEADS_A_JOB, _JOBS_AT_ONCE = 32, 8


@dataclass(frozen=True)
class Layout:
    """The trimmed column names that some files have, in their order, and the files."""

    names: tuple[str, ...]
    paths: tuple[str, ...]


def first_lines(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """The first line that is not blank of each file that has one.

    A limit on each file's own scan makes it stop after its first buffer. Files are handled many to a job, and several jobs run at once.
    """

    def job(some: Sequence[str]) -> list:
        heads = [spark.read.text(p).where("trim(value) <> ''").limit(1).select("value", F.lit(p).alias("path")) for p in some]
        return reduce(DataFrame.unionAll, heads).collect()

    chunks = [paths[i : i + _HEADS_A_JOB] for i in range(0, len(paths), _HEADS_A_JOB)]
    with settings(spark, _WHOLE_FILES), ThreadPoolExecutor(_JOBS_AT_ONCE) as pool:
        return {r["path"]: r["value"] for rows in pool.map(job, chunks) for r in rows}


def stock_layouts(spark: SparkSession, source: str | Sequence[str], glob: str = "*.csv") -> list[Layout]:
    """The layouts of a folder's files, or of the given files; files without any line are left out.

    Reads the beginning of each file only. Header lines are parsed by Spark's CSV rules, so quoted
    names may hold commas. The driver gets the names of the files and a line of each, little more than a listing.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(source if isinstance(source, str) else list(source))
    paths = sorted(plain_path(r["path"]) for r in files.where("length > 0").select("path").collect()) if source else []
    files_of: dict[str, list[str]] = {}
    for path, line in sorted(first_lines(spark, paths).items()):
        files_of.setdefault(line.lstrip("\ufeff"), []).append(path)
    if not files_of:
        return []
    width = max(line.count(",") for line in files_of) + 1
    cells = ", ".join(f"_c{i} string" for i in range(width))
    texts = spark.createDataFrame([(line,) for line in files_of], "line string")
    parsed = texts.select("line", F.from_csv("line", cells).alias("names")).collect()
    return sorted((Layout(_trimmed(r["names"]), tuple(files_of[r["line"]])) for r in parsed), key=lambda layout: (layout.names, layout.paths))


def _trimmed(names: Sequence[str | None]) -> tuple[str, ...]:
    """Names without outer blanks and without the empty ones at the end."""
    out = [(n or "").strip() for n in names]
    while out and not out[-1]:
        out.pop()
    return tuple(out)


def plain_path(uri: str) -> str:
    """A file's address as a path that names this file only."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(uri))


def read_layout(spark: SparkSession, layout: Layout, columns: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """The wanted columns of a layout's files by name, with ``source_file``; missing ones are NULL, of equal names the first counts."""
    cells = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(max(len(layout.names), 1))])
    rows = spark.read.option("header", True).schema(cells).csv(list(layout.paths))

    def named(name: str) -> Column:
        text = F.col(f"_c{layout.names.index(name)}") if name in layout.names else F.lit(None).cast("string")
        return (text if schema is None else text.try_cast(schema[name].dataType)).alias(name)

    # Spark gives file names as in an address; a plus sign there is a plus sign.
    source_file = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    return rows.select(*[named(c) for c in columns], source_file.alias("source_file"))


def read_stock_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | None = None,
    glob: str = "*.csv",
    run_ts: dt.datetime | None = None,
    hash_rows: bool = False,
    hash_files: bool = False,
) -> DataFrame:
    """All stock files of a folder, columns found by their trimmed names, with ``source_file`` and ``run_ts``.

    Files may order their columns differently or lack some, which are then NULL. Without a schema every
    column is text, and the columns are those of all files. The files of each layout are one scan, so every file is read
    once, besides its beginning (``stock_layouts``). ``hash_rows`` adds ``content_hash``, a digest of each row, ``hash_files`` adds ``file_hash``, the sum of
    the digests of a file's rows (see ``file_fingerprints``).
    """
    layouts = stock_layouts(spark, folder, glob)
    every = [n for layout in layouts for n in layout.names if n]
    names = [f.name for f in schema] if schema is not None else list(dict.fromkeys(every))
    if not layouts:
        fields = [T.StructField(n, schema[n].dataType if schema is not None else T.StringType()) for n in names]
        rows = spark.createDataFrame([], T.StructType([*fields, T.StructField("source_file", T.StringType())]))
    else:
        rows = reduce(DataFrame.unionAll, [read_layout(spark, layout, names, schema) for layout in layouts])
    if hash_rows:
        rows = rows.withColumn("content_hash", row_digest(names))
    if hash_files:
        digests = file_fingerprints(rows, names).select("source_file", F.col("content_hash").alias("file_hash"))
        rows = rows.join(digests, "source_file").select(*rows.columns, "file_hash")
    return rows.withColumn("run_ts", F.lit(run_ts).cast("timestamp") if run_ts else F.current_timestamp())


def file_fingerprints(rows: DataFrame, columns: Sequence[str], file_column: str = "source_file") -> DataFrame:
    """One digest per file that depends on its rows but not on their order."""
    digest = F.sum(row_digest(list(columns))).cast("string")
    return rows.groupBy(file_column).agg(digest.alias("content_hash"), F.count(F.lit(1)).alias("row_count"))


def read_channel_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Headerless two-column list; both line-ending styles are understood."""
    return spark.read.schema(CHANNEL_SESSIONS_SCHEMA).csv(path)
