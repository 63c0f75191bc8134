"""Column-wise operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from retailgrain.functions.matching import first_substring
from retailgrain.functions.text import str_normalize
from retailgrain.rules.fixed_values import CHANNEL_BY_COMPANY, CHANNEL_OTHER, OTHER_CITIES
from retailgrain.rules.tables import CityRule


def channel_of(company: Column, names: Mapping = CHANNEL_BY_COMPANY, other: str = CHANNEL_OTHER) -> Column:
    out = None
    for company_id, name in names.items():
        hit = company == company_id
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out.otherwise(F.lit(other))


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def exclude_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)


def columns_like(df: DataFrame, words: Sequence[str]) -> DataFrame:
    """Keep the columns whose lower-cased name contains one of the words."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if any(w in c.lower() for w in words)])


def tag_first_substring(
    df: DataFrame,
    text: str,
    out: str,
    rules: Sequence[CityRule],
    default: str = OTHER_CITIES,
    strategy: str = "first",
) -> DataFrame:
    """Label each row by the first rule found in its text; normalizes the text once per row."""
    tagged = df.withColumn("_subject", str_normalize(F.col(text)))
    label = first_substring(F.col("_subject"), rules, default, strategy, is_normalized=True)
    return tagged.withColumn(out, label).drop("_subject")


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULLs by the given value or column per column name."""
    filled = {
        c: F.coalesce(F.col(c), v if isinstance(v, Column) else F.lit(v)) for c, v in defaults.items()
    }
    return df.withColumns(filled)
