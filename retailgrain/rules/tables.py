"""Business rules as data: typed rows on the driver, small tables in Spark.

A rule list is configuration, a few dozen to a few hundred rows, and is compiled into plain
column expressions when the plan is built. A rule table of any length stays a table and is
matched with equi-joins (see ``operators.rule_joins``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class CityRule:
    ordinal: int
    pattern: str
    city: str


@dataclass(frozen=True)
class ShopRule:
    ordinal: int
    address: str
    city: str
    and_city: bool = False
    equal: bool = False

    @property
    def label(self) -> str:
        return f"{self.address}, {self.city}"


@dataclass(frozen=True)
class MetricRule:
    """Count an order when ``field`` satisfies ``op``; ``any`` always counts."""

    metric: str
    field: str | None = None
    op: str = "any"  # any | in | contains
    values: tuple[str, ...] = ()
    normalize: bool = False


@dataclass(frozen=True)
class BucketBound:
    ordinal: int
    label: str
    lower: float | None = None
    upper: float | None = None
    lower_inclusive: bool = False
    upper_inclusive: bool = True


_ARROW = {
    CityRule: pa.schema([("ordinal", pa.int32()), ("pattern", pa.string()), ("city", pa.string())]),
    ShopRule: pa.schema([
        ("ordinal", pa.int32()), ("address", pa.string()), ("city", pa.string()),
        ("and_city", pa.bool_()), ("equal", pa.bool_()),
    ]),
    MetricRule: pa.schema([
        ("metric", pa.string()), ("field", pa.string()), ("op", pa.string()),
        ("values", pa.list_(pa.string())), ("normalize", pa.bool_()),
    ]),
    BucketBound: pa.schema([
        ("ordinal", pa.int32()), ("label", pa.string()), ("lower", pa.float64()), ("upper", pa.float64()),
        ("lower_inclusive", pa.bool_()), ("upper_inclusive", pa.bool_()),
    ]),
}
BARCODE_SCHEMA = pa.schema([("from_code", pa.string()), ("to_code", pa.string())])


def local_table(spark: SparkSession, rows: Iterable[Mapping], schema: pa.Schema) -> DataFrame:
    """Driver rows as a table whose exact size the optimizer knows, so joins broadcast it by size."""
    return spark.createDataFrame(pa.Table.from_pylist([dict(r) for r in rows], schema=schema))


def rule_table(spark: SparkSession, rules: Sequence) -> DataFrame:
    kind = type(rules[0])
    return local_table(spark, ({**asdict(r)} for r in rules), _ARROW[kind])


def barcode_table(spark: SparkSession, mapping: Mapping[str, str]) -> DataFrame:
    return local_table(
        spark, ({"from_code": k, "to_code": v} for k, v in mapping.items()), BARCODE_SCHEMA
    )
