"""Approximate nearest neighbours by inner product: probed lists and an adaptive dimension scan.

Vectors are rotated at random, so that any block of their columns tells about the whole. Rows
lie in the lists of their nearest centre; a query scans its probed lists column block by column block. After
each block a hypothesis test compares the distance so far, scaled to all columns, with what the
query's twentieth best allows, and candidates that are very unlikely to reach it are abandoned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from retailgrain.llm.common import Steps
from retailgrain.llm.vectors import common_size, dots, matrix, usable

FOUND = "query_id bigint, vec_id bigint, score double"


SEEDS = 4096  # at most


@dataclass(frozen=True)
class Index:
    """What is fitted on a bounded sample: rotation, centres, how many lists a query probes, and seed rows."""

    rotation: np.ndarray
    centres: np.ndarray
    probes: int
    seed_ids: np.ndarray
    seeds: np.ndarray


def nearest_first(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argsort(-(x @ centres.T), axis=1, kind="stable")


def nearest_centre(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmax(x @ centres.T - 0.5 * (centres * centres).sum(axis=1), axis=1)


def fit(rows: DataFrame, size: int, total: int, sample: int, list_rows: int, most_lists: int, k: int, recall: float, turns: int) -> Index:
    """Fit on at most ``sample`` rows, chosen by hash: k-means centres, and the fewest probes that find ``recall`` there."""
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow()
    ids, x = chosen["vec_id"].to_numpy(), matrix(chosen["v"], size)
    rng = np.random.default_rng(7)
    rotation = np.linalg.qr(rng.standard_normal((size, size)))[0]
    lists = int(max(1, min(most_lists, total // list_rows, len(x))))
    y = x @ rotation
    centres = y[rng.permutation(len(y))[:lists]] if len(y) else np.zeros((1, size))
    for _ in range(turns if lists > 1 else 0):
        at = nearest_centre(y, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, y)
        count = np.bincount(at, minlength=lists)[:, None]
        centres = np.where(count > 0, sums / np.maximum(count, 1), centres)
    probes = 1
    if lists > 1:
        q = np.arange(min(256, len(y)))
        score = y[q] @ y.T
        score[q, q] = -np.inf
        best = np.argpartition(-score, min(k, len(y) - 1) - 1, axis=1)[:, :k]
        order = nearest_first(y[q], centres)
        rank = np.empty_like(order)
        rank[q[:, None], order] = np.arange(lists)
        need = np.sort(rank[q[:, None], nearest_centre(y, centres)[best]].ravel())
        probes = int(need[min(len(need) - 1, int(np.ceil(recall * len(need))))]) + 1
    seeds = max(2 * k, min(SEEDS, total // 16))  # a small share of the rows, however few there are
    return Index(rotation, centres, probes, ids[:seeds], x[:seeds])


def scan(q: np.ndarray, floor: float, blocks: list[np.ndarray], squares: list[np.ndarray], whole: np.ndarray, confidence: float) -> np.ndarray:
    """Rows of a list that the tests do not abandon for query ``q`` (rotated) and the score it must reach."""
    size, width = len(q), blocks[0].shape[1]
    reach = whole + float(q @ q) - 2 * floor  # squared distance at which the score is met
    slack = 1e-6 * (whole + float(q @ q))
    alive = np.flatnonzero(reach + slack >= 0)
    partial = np.zeros(len(alive))
    for b, block in enumerate(blocks):
        part = q[b * width : (b + 1) * width]
        rows = block[alive] if len(alive) < len(block) else block
        partial = partial + squares[b][alive] + float(part @ part) - 2 * (rows @ part)
        done = min((b + 1) * width, size)
        factor = 1.0 if done == size else (1 + confidence / np.sqrt(done)) ** 2 * done / size
        keep = partial <= np.maximum(reach[alive], 0) * factor + slack[alive]
        alive, partial = alive[keep], partial[keep]
        if not len(alive):
            break
    return alive


def search(
    spark: SparkSession,
    df: DataFrame,
    queries: DataFrame,
    k: int = 20,
    sample: int = 16_384,
    list_rows: int = 1024,
    most_lists: int = 1024,
    recall: float = 0.95,
    turns: int = 8,
    width: int = 16,
    confidence: float = 2.1,
    block_rows: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k largest inner products found among all other rows of ``df``.

    ``queries`` has the columns of ``df``. Scores are in double precision on the original vectors; ties go to
    the smaller id. Vectors of another size than most, null, zero, or with null or non-finite
    components take no part, nor do rows without id. Rows repeating an id count as one candidate with its
    best score. Fewer candidates than k: all of them. Only the fit uses a sample; every row is indexed. Lists of any
    size are cut into blocks, and queries into blocks too, so no task holds more than one of each.
    """
    steps = Steps(spark, "ann")
    size = common_size(df, vector_col)
    named = lambda x: x.where(F.col(id_col).isNotNull() & usable(vector_col, size)).select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = named(df)
    total = rows.count()
    if not total:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    index = fit(rows, size, total, sample, list_rows, most_lists, k, recall, turns)
    cuts = [(i, min(i + width, size)) for i in range(0, size, width)]

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = nearest_centre(matrix(batch.column("v"), size) @ index.rotation, index.centres)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32))], ["vec_id", "v", "list"])

    placed = steps.save("rows", rows.mapInArrow(listed, "vec_id bigint, v array<double>, list int"))
    sizes = {r["list"]: -(-r["n"] // block_rows) for r in placed.groupBy("list").agg(F.count("*").alias("n")).collect()}  # at most most_lists rows
    parts = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])

    def pack(table: pa.Table) -> pa.Table:
        first = table.slice(0, 1)
        ids, v = table["vec_id"].to_numpy(), matrix(table["v"], size)
        return pa.table({"list": first["list"], "block": first["block"], "ids": pa.array([ids.tobytes()], pa.binary()), "rows": pa.array([v.tobytes()], pa.binary())})

    blocks = placed.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), parts[F.col("list")]).cast("int"))
    blocks = blocks.groupBy("list", "block").applyInArrow(pack, "list int, block int, ids binary, rows binary")

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Score the seed rows for every query: they set the score that rows of its lists must reach."""
        for batch in batches:
            ids, v = batch.column("vec_id").to_numpy(), matrix(batch.column("v"), size)
            order = nearest_first(v @ index.rotation, index.centres)[:, : index.probes]
            out = []
            for i, q in enumerate(ids):
                rough = index.seeds @ v[i]
                rough[index.seed_ids == q] = -np.inf
                top = np.argsort(-rough, kind="stable")[: 2 * k]
                top = top[np.isfinite(rough[top])]
                score = dots(index.seeds[top], v[i])
                best = np.lexsort((index.seed_ids[top], -score))[:k]
                floor = float(score[best[-1]]) if len(best) == k else -1e300
                out.append((int(q), v[i].tobytes(), order[i].tolist(), floor, index.seed_ids[top][best].tolist(), score[best].tolist()))
            types = [pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [()] * 6, types, strict=True)], ["query_id", "q", "lists", "floor", "ids", "scores"])

    asked = steps.save("queries", named(queries).mapInArrow(start, "query_id bigint, q binary, lists array<int>, floor double, ids array<bigint>, scores array<double>"))
    turns_of = max(1, -(-asked.count() // 512))
    probes = asked.select("query_id", "q", "floor", F.pmod(F.xxhash64("query_id"), F.lit(turns_of)).cast("int").alias("part"), F.explode("lists").alias("list"))
    probes = probes.where(parts[F.col("list")].isNotNull())
    groups = probes.groupBy("list", "part").agg(F.collect_list(F.struct("query_id", "floor", "q")).alias("asked"))  # about 512 queries
    groups = groups.withColumn("block", F.explode(F.sequence(F.lit(0), parts[F.col("list")] - 1)))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column("ids")[i].as_buffer(), np.int64)
                v = np.frombuffer(batch.column("rows")[i].as_buffer(), np.float64).reshape(-1, size)
                y = v @ index.rotation
                columns = [np.ascontiguousarray(y[:, a:b]) for a, b in cuts]
                squares = [(c * c).sum(axis=1) for c in columns]
                whole = np.sum(squares, axis=0)
                out = []
                for one in batch.column("asked")[i].as_py():
                    q = np.frombuffer(one["q"], np.float64)
                    alive = scan(q @ index.rotation, one["floor"], columns, squares, whole, confidence)
                    alive = alive[ids[alive] != one["query_id"]]
                    if len(alive):
                        score = dots(v[alive], q)
                        best = np.lexsort((ids[alive], -score))[:k]
                        out.append((np.full(len(best), one["query_id"]), ids[alive][best], score[best]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["query_id", "vec_id", "score"])

    met = blocks.join(groups.hint("merge"), ["list", "block"]).select("ids", "rows", "asked").mapInArrow(scanned, FOUND)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def first(found: DataFrame) -> DataFrame:
        one = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return one.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    # The scan is the answer. Seeds only gave it a score to reach; they fill up queries whose lists hold too few such rows.
    scanned_ = steps.save("scanned", first(met))
    short = asked.join(scanned_.groupBy("query_id").agg(F.count("*").alias("n")), "query_id", "left").where(F.coalesce("n", F.lit(0)) < k)
    seeds = short.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("s")).select("query_id", F.col("s.ids").alias("vec_id"), F.col("s.scores").alias("score"))
    return first(scanned_.select("query_id", "vec_id", "score").union(seeds))
