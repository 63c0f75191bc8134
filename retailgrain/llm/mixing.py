"""Mixing sources to target weights: temperature mixing realised as budgeted block permutations.

Natural token shares are raised to an exponent in [0, 1] and normalised. The exponent is bisected
downwards from 1 until the weights reach a target entropy, or until the most repeated source
reaches its limit. The source whose share the exponent lowers most is used exactly once, so every
document is kept; the others are repeated in epochs, each its own permutation, up to their budget.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailgrain.llm.common import Steps, ranked

LEVELS, JOBS = 5, 6  # 30 halvings, five of them in each job


def documents_of(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """One row per (id, text, source): its words and how many equal rows it stands for."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = F.col(source_col).cast("string")
    return (
        df.select(
            F.col(id_col).alias("doc_id"),
            F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source)).alias("_key"),
            F.md5(text.cast("binary")).alias("text_md5"),
            F.regexp_count(text, F.lit("[^ \\t\\n\\r]+")).cast("long").alias("tokens"),
        )
        .groupBy("doc_id", "_key", "text_md5")
        .agg(F.first("tokens").alias("tokens"), F.count("*").alias("n_rows"))
        .withColumn("_mass", F.col("tokens") * F.col("n_rows"))
    )


def exponent(sources: DataFrame, entropy: float, max_repeats: float) -> float:
    """Bisect the exponent. ``entropy`` is a fraction of the entropy of equal weights.

    Each job tries all points that the next five halvings can reach, and brings back one row.
    """
    low, high = 0.0, 1.0
    total = F.sum("_mass").over(_all())
    shares = sources.where("_mass > 0").select(F.log(F.col("_mass") / total).alias("_log"))
    for _ in range(JOBS):
        width, n = high - low, 1 << LEVELS
        grid = F.array(*[F.lit(low + width * i / n) for i in range(1, n + 1)])
        tried = (
            shares.select("_log", F.explode(grid).alias("alpha"))
            .groupBy("alpha")
            .agg(
                F.sum(F.exp(F.col("alpha") * F.col("_log"))).alias("z"),
                F.sum(F.exp(F.col("alpha") * F.col("_log")) * F.col("alpha") * F.col("_log")).alias("m"),
                F.count("*").alias("n"),
                (F.max("_log") - F.min("_log")).alias("spread"),
            )
            .select(
                "alpha",
                ((F.log("z") - F.col("m") / F.col("z") < entropy * F.log("n")) & (F.exp((1 - F.col("alpha")) * F.col("spread")) <= max_repeats)).alias("lower"),
            )
        )
        # The points where the weights may still be flattened lie above all others.
        found = tried.agg(F.max(F.when(~F.col("lower"), F.col("alpha"))).alias("stop")).first()["stop"]
        if found is None:
            high = low + width / n
        elif found >= high:
            return high  # only at 1: natural shares do already
        else:
            low, high = found, found + width / n
    return high


def _all():
    from pyspark.sql.window import Window

    return Window.partitionBy(F.lit(1))


def hashed(epoch: Column) -> Column:
    """Place in a permutation: an md5 of epoch, id and text, which any engine can repeat."""
    return F.md5(F.concat_ws(":", epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text_md5").cast("binary"))


def mix(
    spark: SparkSession,
    df: DataFrame,
    entropy: float = 0.97,
    max_repeats: float = 2.0,
    block_tokens: int = 1 << 20,
    cell_digits: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Every use of a document: (doc_id, source, text_md5, tokens, n_rows, epoch, block, position, weight).

    ``weight`` is the source's share of the mixed tokens. Each block holds every source by
    its weight, to within one document, and is permuted by ``position`` (from 0). Tokens are runs without
    space, tab or line break. Null text counts as empty, a document without tokens is used once, a null source is a
    source of its own, and equal rows (id, text, source) count as one with ``n_rows``. A hot
    source is cut into hash cells, of which only the token sums are put in order. Ties in the
    permutation go by id. An empty table gives no rows.
    """
    steps = Steps(spark, "mixing")
    docs = steps.save("documents", documents_of(df, id_col, text_col, source_col))
    sources = steps.save("sources", docs.groupBy("_key").agg(F.sum("_mass").alias("_mass")))
    alpha = exponent(sources, entropy, max_repeats)
    most = F.max("_mass").over(_all())
    repeats = F.exp((1 - F.lit(alpha)) * F.log(most / F.col("_mass")))
    plan = sources.select(
        F.col("_key"),
        F.col("_mass").alias("_own"),
        F.when(F.col("_mass") > 0, F.floor(repeats * F.col("_mass") + 0.5)).otherwise(0).cast("long").alias("_budget"),
    )
    total = F.sum("_budget").over(_all())
    plan = plan.select(
        "_key", "_own", "_budget",
        F.coalesce(F.round(F.try_divide(F.col("_budget").cast("double"), total.cast("double")), 9), F.lit(0.0)).alias("weight"),
        F.greatest(F.ceil(total / float(block_tokens)), F.lit(1)).cast("long").alias("_blocks"),
    )
    plan = steps.save("plan", plan)
    epochs = F.when(F.col("_own") > 0, F.ceil(F.col("_budget") / F.col("_own"))).otherwise(1).cast("int")
    uses = docs.join(plan, "_key").withColumn("epoch", F.explode(F.sequence(F.lit(0), epochs - 1)))
    uses = uses.where("epoch = 0 or tokens > 0").withColumn("_hash", hashed(F.col("epoch")))
    uses = uses.withColumn("_cell", F.substring("_hash", 1, cell_digits))
    uses = ranked(uses, ["_key", "epoch"], "_cell", ["_hash", "doc_id"], "_before", weight="_mass")
    at = F.col("epoch") * F.col("_own") + F.col("_before")
    uses = uses.where((F.col("epoch") == 0) | (at < F.col("_budget")))
    share = F.coalesce(F.try_divide(at.cast("double"), F.col("_budget").cast("double")), F.lit(0.0))
    uses = uses.withColumn("block", F.least(F.floor(share * F.col("_blocks")), F.col("_blocks") - 1))
    uses = uses.withColumn("_hash", hashed(F.col("epoch") + 1000)).withColumn("_cell", F.substring("_hash", 1, 1))
    uses = ranked(uses, ["block"], "_cell", ["_hash", "doc_id"], "position")
    return uses.select(
        "doc_id", F.when(F.col("_key") != "n", F.substring("_key", 2, 1 << 30)).alias("source"), "text_md5",
        "tokens", "n_rows", "epoch", "block", F.col("position").cast("long").alias("position"), "weight",
    )


def mixed_documents(spark: SparkSession, df: DataFrame, **options) -> DataFrame:
    """The rows of ``df``, each as often as the mix uses it, with its own columns only."""
    names = {k: options.get(k, v) for k, v in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source"))}
    copies = mix(spark, df, **options).groupBy("doc_id", "source", "text_md5").agg(F.count("*").cast("int").alias("copies"))
    text = F.coalesce(F.col(names["text_col"]).cast("string"), F.lit(""))
    # Whole rows travel as one column, so their own names cannot clash.
    own = df.select(
        F.struct(*df.columns).alias("row"), F.md5(text.cast("binary")).alias("own_md5"),
        F.col(names["id_col"]).alias("own_id"), F.col(names["source_col"]).cast("string").alias("own_source"),
    )
    same = (F.col("own_md5") == F.col("text_md5")) & F.col("own_id").eqNullSafe(F.col("doc_id")) & F.col("own_source").eqNullSafe(F.col("source"))
    return own.join(copies, same).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
