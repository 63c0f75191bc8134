"""What the operators share: inputs, stored steps, gapless ranks and connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from retailgrain.session import CLEAN_CONF, shared_dir

# Bounds what one Arrow batch holds in a Python worker, however long the texts are.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}

_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Set the batch limits that all Python steps rely on; give the workers this library's modules.

    The modules travel as a zip, once per application, as with ``--py-files``.
    """
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        target = os.path.join(tempfile.mkdtemp(prefix="retailgrain-py-"), "retailgrain.zip")
        with zipfile.ZipFile(target, "w") as archive:
            for file in package.rglob("*.py"):
                archive.write(file, file.relative_to(package.parent))
        context.addPyFile(target)
        _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class Steps:
    """Intermediate tables in one fresh folder below ``spark.checkpoint.dir``.

    A stored step survives lost executors and ends the lineage before it.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.root = shared_dir(spark, purpose)
        prepare(spark)

    def save(self, name: str, df: DataFrame) -> DataFrame:
        with settings(self.spark, CLEAN_CONF):
            df.write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def finish(self, df: DataFrame) -> DataFrame:
        """Store the result and remove all other steps."""
        out = self.save("result", df)
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        store = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        self.drop(*[n for s in store.listStatus(root) if (n := s.getPath().getName()) != "result"])
        return out

    def drop(self, *names: str) -> None:
        """Remove stored steps that no later plan reads."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def ranked(df: DataFrame, group: list[str], cell: str, order: list[str], name: str, weight: str | None = None) -> DataFrame:
    """Running position within ``group``: by ``cell`` and, inside a cell, by ``order``.

    ``group`` and ``cell`` must not be null. Counts rows from 0, or sums ``weight`` over the rows before. Only a cell is ordered
    in one task; ``cell`` cuts each group into parts by a hash, so a group of any size is
    spread and what the second window orders is one row for each cell.
    """
    amount = F.lit(1) if weight is None else F.col(weight)
    sums = df.groupBy(*group, cell).agg(F.sum(amount).alias("_sum"))
    before = W.partitionBy(*group).orderBy(cell).rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(
        *[F.col(c).alias(f"_{c}") for c in (*group, cell)],
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"),
    )
    same = [F.col(c) == F.col(f"_{c}") for c in (*group, cell)]
    inside = W.partitionBy(*group, cell).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    within = F.row_number().over(W.partitionBy(*group, cell).orderBy(*order)) - 1 if weight is None else F.coalesce(F.sum(amount).over(inside), F.lit(0))
    placed = df.withColumn("_within", within).join(starts, same)
    return placed.withColumn(name, F.col("_start") + F.col("_within")).drop("_start", "_within", *[f"_{c}" for c in (*group, cell)])


def hex_cell(text: Column, digits: int = 2) -> Column:
    """Leading hex digits of an md5: a part of a group, chosen by hash."""
    return F.substring(F.md5(text.cast("binary")), 1, digits)


def components(steps: Steps, edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Contraction: each round every node takes its smallest neighbour, chains of such choices
    are followed by doubling, and the edges are rewritten to the chosen nodes until none is
    left. A node only ever maps to a smaller one, so what remains is the smallest. Rounds
    grow with the logarithm of the size; a hub is a hot key of a join and of a partial
    minimum, which Spark splits and combines, and nothing is collected.
    """
    pair = lambda df: df.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = steps.save(f"{name}-edges0", pair(edges))
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels, turn = nodes.withColumn("component", F.col("node")), 0
    while not edges.isEmpty():
        parents = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
        parents, hops = steps.save(f"{name}-parents{turn}-0", parents), 0
        while True:  # follow chains: two steps at a time, until the second leads nowhere
            up = lambda c: parents.select(F.col("node").alias(c), F.col("component").alias(f"{c}_up"))  # noqa: B023, E731
            moved = parents.withColumnRenamed("component", "one").join(up("one"), "one", "left").withColumnRenamed("one_up", "two").join(up("two"), "two", "left")
            moved = moved.select("node", F.coalesce("two_up", "two", "one").alias("component"), F.col("two_up").isNotNull().alias("far"))
            moved = steps.save(f"{name}-parents{turn}-{hops + 1}", moved)
            steps.drop(f"{name}-parents{turn}-{hops}")
            parents, hops = moved.select("node", "component"), hops + 1
            if moved.where("far").isEmpty():
                break
        to = lambda c: parents.select(F.col("node").alias(c), F.col("component").alias(f"_{c}"))  # noqa: B023, E731
        relabelled = labels.join(to("component"), "component", "left").select("node", F.coalesce("_component", "component").alias("component"))
        relabelled = steps.save(f"{name}-labels{turn}", relabelled)
        renamed = edges.join(to("a"), "a", "left").join(to("b"), "b", "left")
        renamed = renamed.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
        contracted = steps.save(f"{name}-edges{turn + 1}", pair(renamed))
        steps.drop(f"{name}-labels{turn - 1}", f"{name}-edges{turn}", f"{name}-parents{turn}-{hops}")
        labels, edges, turn = relabelled, contracted, turn + 1
    return labels
