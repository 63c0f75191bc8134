"""Stock reconciliation: a supplier's file against our snapshot, by barcode."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from retailgrain.functions import half_even_int, normalize_barcode, trunc_int
from retailgrain.operators.joins import full_outer_match, map_lookup
from retailgrain.operators.skew import chunk_copies, collapse_copies, expand_copies

PROVENANCE = ("source_file", "content_hash", "run_ts")


@dataclass(frozen=True)
class MatchLabels:
    both: str = "Sujungta"
    supplier_only: str = "Nerasta sandėlyje"
    own_only: str = "Nerasta ataskaitoje"


def match_type(side: Column, labels: MatchLabels) -> Column:
    """Label by the side a row came from, whatever its key holds."""
    return (
        F.when(side == "both", F.lit(labels.both))
        .when(side == "left", F.lit(labels.supplier_only))
        .otherwise(F.lit(labels.own_only))
    )


def no_stock(quantity: str) -> Column:
    return trunc_int(F.coalesce(quantity, F.lit(0.0))) == 0


def zero_orphan(labels: MatchLabels) -> Column:
    """One-sided rows that hold no stock."""
    own = (F.col("match_type") == labels.own_only) & no_stock("own_quantity")
    theirs = (F.col("match_type") == labels.supplier_only) & no_stock("quantity")
    return own | theirs


def reconcile(
    supplier: DataFrame,
    snapshot: DataFrame,
    exceptions: DataFrame,
    labels: MatchLabels = MatchLabels(),
    only_differences: bool = False,
    expand: bool = True,
    ordered: bool = True,
) -> DataFrame:
    """Reconciled rows, largest absolute difference first.

    Equal rows of either side are joined once and carry their number in ``copies``,
    which ``expand`` turns back into rows. Duplicate barcodes with different content
    pair up as in any join.
    """
    theirs = supplier.withColumn("barcode", normalize_barcode(F.col("barcode"))).where(F.col("barcode").isNotNull())
    theirs = map_lookup(theirs, "barcode", exceptions, "from_code", "to_code")
    theirs = collapse_copies(theirs.drop(*PROVENANCE), "_theirs", no_stock("quantity"))
    own = snapshot.select(
        F.col("barcode").alias("own_barcode"),
        F.col("quantity").alias("own_quantity"),
        F.col("name").alias("own_name"),
        F.col("short_name").alias("own_short_name"),
    )
    own = collapse_copies(own, "_own", no_stock("own_quantity"))

    rows = full_outer_match(theirs, own, "barcode", "own_barcode")
    rows = rows.withColumn("match_type", match_type(F.col("side"), labels)).na.fill(
        0, subset=["quantity", "own_quantity"]
    )
    rows = rows.withColumns({
        "diff": trunc_int(F.col("own_quantity")) - trunc_int(F.col("quantity")),
        "copies": F.abs(F.coalesce("_theirs", F.lit(1)) * F.coalesce("_own", F.lit(1))),
    })
    # One-sided rows without stock are left out; the sign of their number marks them.
    orphan = F.when(F.col("side") == "left", F.col("_theirs") < 0).when(F.col("side") == "right", F.col("_own") < 0)
    rows = rows.where(~F.coalesce(orphan, F.lit(False))).drop("side", "_theirs", "_own")
    if only_differences:
        rows = rows.where(F.col("diff") != 0)
    if not ordered:
        return expand_copies(rows) if expand else rows
    # All columns take part in the order: it is total, and equal differences can be spread over tasks.
    rest = [c for c in rows.columns if c not in ("diff", "barcode", "copies")]
    chunked = chunk_copies(rows) if expand else rows
    ties = ["barcode", *rest, *(["copy_chunk"] if expand else [])]
    in_order = chunked.orderBy(F.abs("diff").desc(), *ties)
    return expand_copies(in_order) if expand else in_order


def recon_summary(rows: DataFrame, labels: MatchLabels = MatchLabels()) -> DataFrame:
    """Ten figures over reconciled rows, in compact or expanded form; percentages are 0 without rows."""
    weight = F.col("copies") if "copies" in rows.columns else F.lit(1)

    def count(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0)).cast("bigint")

    matched = F.col("match_type") == labels.both
    figures = rows.agg(
        count(F.lit(True)).alias("rows_total"),
        count(matched).alias("matched"),
        count(F.col("match_type") == labels.supplier_only).alias("supplier_only"),
        count(F.col("match_type") == labels.own_only).alias("own_only"),
        F.coalesce(F.sum(F.when(matched, F.abs("diff") * weight)), F.lit(0)).cast("bigint").alias("units_mismatched"),
        count(matched & (F.col("diff") > 0)).alias("surplus_rows"),
        count(matched & (F.col("diff") < 0)).alias("shortage_rows"),
    )
    share = {
        f"{c}_pct": F.coalesce(half_even_int(F.try_divide(F.col(c), F.col("rows_total")) * 100), F.lit(0))
        for c in ("matched", "supplier_only", "own_only")
    }
    return figures.withColumns(share)
