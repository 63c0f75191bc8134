"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Every hashed n-gram has a ratio ``r``: the log of how much more often toxic than clean
training documents hold it. A document's features are the ratios of the n-grams it holds, and a
logistic regression with an L2 penalty weighs them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailgrain.llm.common import Steps, spare
from retailgrain.llm.sums import total
from retailgrain.llm.textbytes import LOWER, U64, slices, utf8

ORDERS = (4, 5, 6)
BITS = 20
PIECE = 1 << 17  # bytes looked at together
# Letters of ASCII are lowered, bytes beyond ASCII kept, all else is a blank.
FOLD = LOWER.copy()
FOLD[:128][[not chr(i).isalpha() for i in range(128)]] = 0x20


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # float32, one for each hash value: ratio times learned weight
    bias: float
    threshold: float


def grams(data: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n bytes from each position on."""
    count = len(data) - n + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    code = np.zeros(count, U64)
    for k in range(n):
        code <<= U64(8)
        code |= data[k : k + count]
    code *= U64(0x9E3779B97F4A7C15)
    code ^= code >> U64(29)
    code *= U64(0xBF58476D1CE4E5B9)
    return (code >> U64(64 - BITS)).view(np.int64)


def coded(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each order with the hashes of its n-grams, by place."""
    data = FOLD[data]
    for n in ORDERS:
        yield n, grams(data, n)


def held(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) pairs, each once, of the wanted features of many short texts."""
    rows, features = [], []
    for n, code in coded(data):
        at = np.flatnonzero(wanted[code])
        row = np.searchsorted(offsets, at, "right") - 1
        inside = at + n <= offsets[row + 1]
        rows.append(row[inside])
        features.append(code[at[inside]])
    pair = np.unique((np.concatenate(rows) << BITS) | np.concatenate(features))
    return pair >> BITS, pair & ((1 << BITS) - 1)


def held_by_long(data: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The wanted features of one text of any length, marked in a map of all features, piece by piece."""
    marked = np.zeros(1 << BITS, bool)
    for i in range(0, len(data), PIECE):
        for _, code in coded(data[i : i + PIECE + max(ORDERS) - 1]):
            marked[code] = True
    return np.flatnonzero(marked & wanted)


def rows_held(batch: pa.RecordBatch, text_col: str, wanted: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row of a stretch, and its (row, feature) pairs; what is held at a time does not grow with the texts."""
    data, offsets = utf8(batch.column(text_col))
    for i, j in slices(offsets, PIECE):
        own = data[offsets[i] : offsets[j]]
        if len(own) > PIECE and j == i + 1:
            feature = held_by_long(own, wanted)
            yield i, j, np.zeros(len(feature), np.int64), feature
        else:
            yield i, j, *held(own, offsets[i : j + 1] - offsets[i], wanted)


def held_out(id_col: str) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def ratios(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int, least: float) -> np.ndarray:
    """Log-count ratios, smoothed in proportion to the classes, so that an unseen n-gram has 0.

    An n-gram whose count among toxic documents may well be chance has 0 as well: ``least`` bounds
    the squared deviation from the expected count, in units of that count.
    """
    share = n_pos / max(n_pos + n_neg, 1)
    expected = np.maximum((pos + neg) * share, 1e-9)
    r = np.log((pos + share) / max(n_pos + share, 1e-9)) - np.log((neg + 1 - share) / max(n_neg + 1 - share, 1e-9))
    return np.where((pos - expected) ** 2 / expected >= least, r, 0.0)


def regression(row: np.ndarray, x: np.ndarray, feature: np.ndarray, y: np.ndarray, size: int, penalty: float, turns: int) -> tuple[np.ndarray, float]:
    """Logistic regression by gradient steps with per-weight scales (Adam)."""
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    w[size] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    for t in range(1, turns + 1):
        z = np.bincount(row, x * w[feature], len(y)) + w[size]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / max(len(y), 1)
        g = np.append(np.bincount(feature, x * error[row], size) + penalty * w[:size], error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w[:size], float(w[size])


def fit(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    train_rows: int = 16_000,
    threshold: float = 0.3,
    least: float = 20.0,
    penalty: float = 1e-5,
    turns: int = 150,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """Learn from at most ``train_rows`` labelled documents that are not held out, chosen by hash.

    A document with several labels is toxic if one says so. With one class or no labels, every
    document gets the class's share as its score (0 without labels).
    """
    steps = Steps(spark, "toxicity")
    ids = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("y"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(train_rows)
    )
    # At most train_rows pairs of numbers, so the broadcast has a bound.
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(ids), "_id").select("y", "text")
    texts = steps.save("texts", texts)
    size = 1 << BITS
    everything = np.ones(size, bool)

    def count(batch: pa.RecordBatch, sums: np.ndarray) -> None:
        y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.int64)
        for i, _, row, feature in rows_held(batch, "text", everything):
            np.add.at(sums, feature + y[i + row] * size, 1)
        sums[2 * size] += len(y) - y.sum()
        sums[2 * size + 1] += y.sum()

    sums = total(texts, 2 * size + 2, count)
    n_neg, n_pos = int(sums[-2]), int(sums[-1])
    if not n_neg or not n_pos:
        share = n_pos / max(n_pos + n_neg, 1)
        return Model(np.zeros(size, np.float32), float(np.log((share + 1e-9) / (1 - share + 1e-9))), threshold)
    r = ratios(sums[size : 2 * size].astype(float), sums[:size].astype(float), n_pos, n_neg, least)
    wanted = r != 0

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, row, feature in rows_held(batch, "text", wanted):
                lists = np.split(feature, np.searchsorted(row, np.arange(1, j - i)))
                yield pa.RecordBatch.from_arrays([batch.column("y")[i:j], pa.array(lists, pa.list_(pa.int32()))], ["y", "features"])

    sample = texts.mapInArrow(features, "y int, features array<int>").toArrow()  # bounded by train_rows
    y = sample["y"].to_numpy().astype(float)
    lists = sample["features"].combine_chunks()
    row, feature = np.repeat(np.arange(len(y)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()
    w, bias = regression(row, r[feature], feature, y, size, penalty, turns)
    steps.drop("texts")
    return Model((w * r).astype(np.float32), bias, threshold)


def probabilities(batch: pa.RecordBatch, model: Model, text_col: str, known: np.ndarray) -> np.ndarray:
    z = np.full(batch.num_rows, model.bias)
    for i, j, row, feature in rows_held(batch, text_col, known):
        z[i:j] += np.bincount(row, model.weights[feature], j - i)
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def score(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` with score (0 to 1) and predicted (1 from the threshold on) for each whole text.

    Columns of these names in ``df`` are replaced. A null or empty text has the score of a text
    without any known n-gram. Rows repeat as they come; an empty table stays empty.
    """
    df = df.drop("score", "predicted")
    known = model.weights != 0

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = probabilities(batch, model, text_col, known)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p), pa.array((p >= model.threshold).astype(np.int32))],
                [*batch.schema.names, "score", "predicted"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(rate, f"{fields}, score double, predicted int")


def clean(spark: SparkSession, docs: DataFrame, labels: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents that the classifier does not reject, with their own columns, whatever these are called."""
    model = fit(spark, docs, labels, text_col=text_col, **options)
    mark = spare(docs, "_rejected")
    known = model.weights != 0

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column(mark, pa.array(probabilities(batch, model, text_col, known) >= model.threshold))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(judge, f"{fields}, `{mark}` boolean").where(~F.col(mark)).drop(mark)
