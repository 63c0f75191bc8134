"""Drop-folder intake: every new stock file is read exactly once, whatever its layout.

The stream carries names of files, not their content. Each batch looks at the heads of its files, reads those that hold the wanted
columns by name, and lists the others. Rows, digests and the list are published together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from retailgrain.sources.readers import STOCK_SCHEMA, file_fingerprints, plain_path, read_layout, stock_layouts
from retailgrain.streaming.parts import PartStore

FILES_SCHEMA = "source_file string, content_hash string, row_count bigint"
REFUSED_SCHEMA = "source_file string, columns array<string>, missing array<string>"


def stock_file_stream(
    spark: SparkSession, folder: str, glob: str = "*.csv", archive: str | None = None, files_per_batch: int = 1000
) -> DataFrame:
    """New files with the wanted extension, as a stream of (path, length); their content is not read."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(folder).select("path", "length")


def intake_stock_files(
    spark: SparkSession,
    folder: str,
    table_path: str,
    checkpoint: str,
    schema: T.StructType = STOCK_SCHEMA,
    glob: str = "*.csv",
    archive: str | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    """Take in all files not taken in before and return the rows of all of them, with ``source_file`` and ``run_ts``.

    The checkpoint remembers the files and the store the batches, so a restart neither skips nor repeats one. A file that lacks
    one of the columns, or holds blank lines only, is listed in ``quarantined_files`` and does not stop the stream (files without a byte are not seen by Spark's file source). ``taken_files`` holds a digest of each file.
    """
    store, names = PartStore(spark, table_path), [f.name for f in schema]

    def take(files: DataFrame, batch: int) -> None:
        if store.taken(batch):
            return
        listed = [plain_path(r["path"]) for r in files.collect()]  # as many as a batch may hold
        layouts = stock_layouts(spark, listed, glob) if listed else []
        good = [layout for layout in layouts if set(names) <= set(layout.names)]
        known = {path for layout in layouts for path in layout.paths}
        bad = [(path, list(layout.names), [n for n in names if n not in layout.names]) for layout in layouts if layout not in good for path in layout.paths]
        bad += [(path, [], names) for path in listed if path not in known]
        empty = T.StructType([*schema.fields, T.StructField("source_file", T.StringType())])
        rows = reduce(DataFrame.unionAll, [read_layout(spark, layout, names, schema) for layout in good]) if good else spark.createDataFrame([], empty)
        taken = store.stage("rows", rows.withColumn("run_ts", F.current_timestamp()), batch)
        digests = file_fingerprints(store.staged(taken), names)
        every = spark.createDataFrame([(_name(path),) for layout in good for path in layout.paths], "source_file string")
        digests = every.join(digests, "source_file", "left").select("source_file", "content_hash", F.coalesce("row_count", F.lit(0)).alias("row_count"))
        refused = spark.createDataFrame([(_name(path), have, lack) for path, have, lack in bad], REFUSED_SCHEMA)
        store.commit(batch, [
            taken,
            store.stage("files", digests, batch),
            store.stage("quarantine", refused.withColumn("seen_ts", F.current_timestamp()), batch),
        ])

    query = (
        stock_file_stream(spark, folder, glob, archive, files_per_batch)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(take)
        .start()
    )
    query.awaitTermination()
    return store.read("rows", schema=T.StructType([*schema.fields, T.StructField("source_file", T.StringType()), T.StructField("run_ts", T.TimestampType())]))


def _name(path: str) -> str:
    return path.replace("\\", "").rsplit("/", 1)[-1]


def taken_files(spark: SparkSession, table_path: str) -> DataFrame:
    """(source_file, content_hash, row_count) of every file taken in; the digest does not depend on the order of rows."""
    return PartStore(spark, table_path).read("files", schema=FILES_SCHEMA)


def quarantined_files(spark: SparkSession, table_path: str) -> DataFrame:
    """(source_file, columns, missing, seen_ts) of every file that lacks wanted columns."""
    return PartStore(spark, table_path).read("quarantine", schema=f"{REFUSED_SCHEMA}, seen_ts timestamp")
