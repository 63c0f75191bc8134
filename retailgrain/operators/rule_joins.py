"""Rule tables matched through equi-joins on a piece of the pattern.

A pattern of 20 characters can only occur in a text that holds every 16 characters of the
pattern. So every text is reduced to its distinct pieces, candidates come from an
equi-join of pieces, and a substring test confirms them. The piece size is the longest of
``PIECE_SIZES`` that fits in the pattern, and of a pattern's pieces the one found in the fewest texts is joined,
so rules that begin alike do not meet every text that begins so. Texts are made distinct
first, therefore a text that fills a third of the table is matched once, and pieces carry a hash of their text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from retailgrain.functions.text import str_normalize
from retailgrain.operators.projections import tag_first_substring
from retailgrain.rules.fixed_values import OTHER_CITIES
from retailgrain.rules.tables import CityRule


PIECE_SIZES = (16, 4, 1)


def _pieces(text: Column, size: int) -> Column:
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    cut = F.transform(starts, lambda i: F.substring(text, i, F.lit(size)))
    return F.when(F.length(text) >= size, F.array_distinct(cut)).otherwise(F.array().cast("array<string>"))


def _own_pieces(pattern: Column) -> Column:
    """Pieces of the largest size that fits; the empty pattern is its own piece."""
    return F.coalesce(*[F.when(F.length(pattern) >= size, _pieces(pattern, size)) for size in PIECE_SIZES], F.array(F.lit("")))


def substring_pairs(texts: DataFrame, rules: DataFrame, pattern: str) -> DataFrame:
    """All (text, rule) pairs where the rule's pattern occurs in the text.

    ``texts`` has one normalized column ``subject``, ``rules`` any columns. As with any substring test,
    an empty pattern occurs in every text and a NULL pattern in none.
    """
    ready = rules.withColumn("_pattern", str_normalize(F.col(pattern))).where(F.col("_pattern").isNotNull())
    patterns = ready.select("_pattern").distinct().select("_pattern", F.explode(_own_pieces(F.col("_pattern"))).alias("_piece"))
    subjects = texts.select("subject", F.xxhash64("subject").alias("_hash"))
    # Pieces of different length never compare equal, so one join serves all sizes.
    cut = F.concat(F.array(F.lit("")), *[_pieces(F.col("subject"), size) for size in PIECE_SIZES])
    held = subjects.select("_hash", F.explode(cut).alias("_piece")).join(patterns.select("_piece").distinct(), "_piece", "left_semi")
    seen = held.groupBy("_piece").agg(F.count(F.lit(1)).alias("_texts"))
    # A piece that no text holds rules its pattern out.
    rare = patterns.join(seen, "_piece", "left").groupBy("_pattern").agg(
        F.min_by("_piece", F.struct(F.coalesce("_texts", F.lit(0)), F.col("_piece"))).alias("_piece")
    )
    candidates = held.join(rare, "_piece").select("_hash", "_pattern")
    found = candidates.join(subjects, "_hash").where(F.contains("subject", "_pattern")).select("subject", "_pattern").distinct()
    return found.join(ready, "_pattern").drop("_pattern")


def tag_first_substring_by_join(
    df: DataFrame, text: str, out: str, rules: DataFrame, default: str, strategy: str = "first", source: DataFrame | None = None
) -> DataFrame:
    """Same result as ``tag_first_substring`` for a rule table (ordinal, pattern, city) of any length.

    ``source``: rows that ``df`` was made of and that hold all its texts, if those cost less.
    """
    if strategy not in ("first", "longest"):
        raise ValueError(f"unknown strategy {strategy!r}")
    keyed = df.withColumn("subject", str_normalize(F.col(text)))
    # Texts come from the exchange that their rows come from: all columns are asked for and no filter goes below the count,
    # else Spark would make the rows a second time.
    rows = df if source is None else source
    held = rows.withColumn("subject", str_normalize(F.col(text))).groupBy("subject").agg(
        F.count(F.when(F.col("subject").isNotNull(), F.xxhash64(*rows.columns))).alias("_rows")
    )
    texts = held.where("_rows > 0").select(F.when(F.col("_rows") > 0, F.col("subject")).alias("subject"))
    length = F.length(str_normalize(F.col("pattern")))
    rank = F.struct("ordinal", "city") if strategy == "first" else F.struct(-length, F.col("ordinal"), F.col("city"))
    best = substring_pairs(texts, rules, "pattern").groupBy("subject").agg(F.min_by("city", rank).alias(out))
    return keyed.join(best, "subject", "left").drop("subject").withColumn(
        out, F.coalesce(out, F.lit(default))
    )


def tag_by_rules(
    df: DataFrame,
    text: str,
    out: str,
    rules: Sequence[CityRule] | DataFrame,
    default: str = OTHER_CITIES,
    strategy: str = "first",
    source: DataFrame | None = None,
) -> DataFrame:
    """First matching rule: a list is compiled into expressions, a table is joined, both with the same result."""
    if isinstance(rules, DataFrame):
        return tag_first_substring_by_join(df, text, out, rules, default, strategy, source)
    return tag_first_substring(df, text, out, rules, default, strategy)


def shop_pairs_by_join(df: DataFrame, address: str, rules: DataFrame) -> DataFrame:
    """(subject, ordinal) of every shop rule a distinct address satisfies, for rule tables of any length."""
    texts = df.select(str_normalize(F.col(address)).alias("subject")).where(F.col("subject").isNotNull()).distinct()
    hit = substring_pairs(texts, rules, "address")
    equal = ~F.col("equal") | (F.col("subject") == str_normalize(F.col("address")))
    in_city = ~F.col("and_city") | F.contains(F.col("subject"), str_normalize(F.col("city")))
    return hit.where(equal & in_city).select("subject", "ordinal")
