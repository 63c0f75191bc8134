"""Language ID by a convolutional network on bytes.

Every byte has a small learned vector. Filters of several widths slide over a window of fixed length, each keeps its
largest response, and a softmax over the languages reads them. The network is trained
with numpy on windows of a bounded sample of labelled texts; then all windows of every text are read in
batches, and a document gets the average of its windows' probabilities, weighted by their letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from retailgrain.llm.common import Steps, spare
from retailgrain.llm.textbytes import LOWER, utf8

WINDOW = 192
WIDTHS = (2, 3, 4, 5)
FILTERS = 16  # of each width
DEPTH = 8  # of a byte's vector
BATCH = 256  # windows read at once
UNKNOWN = "und"
# ASCII letters are lowered; digits, marks and control characters are one symbol, and 0 is beyond the text.
FOLD = LOWER.copy()
FOLD[:128][[not chr(i).isalpha() for i in range(128)]] = 0x20
LETTER = np.zeros(256, np.float32)
LETTER[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = 1


@dataclass(frozen=True)
class Network:
    langs: tuple[str, ...]
    table: np.ndarray  # (256, DEPTH), row 0 is zero
    filters: tuple[np.ndarray, ...]  # (width * DEPTH, FILTERS) for each width
    shifts: np.ndarray  # of all filters
    out: np.ndarray  # (filters + 1, languages), the last row is the bias


def softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def joined(net: Network) -> np.ndarray:
    """All filters as one matrix; narrow ones see nothing of the bytes beyond their width."""
    out = np.zeros((WIDTHS[-1] * DEPTH, FILTERS * len(WIDTHS)), np.float32)
    for k, weights in enumerate(net.filters):
        out[: len(weights), k * FILTERS : (k + 1) * FILTERS] = weights
    return out


def responses(net: Network, windows: np.ndarray) -> np.ndarray:
    """(windows, places, filters): every filter at every place; beyond the window there is nothing."""
    n, width = len(windows), WIDTHS[-1]
    x = np.zeros((n, WINDOW + width - 1, DEPTH), np.float32)
    x[:, :WINDOW] = net.table[windows]
    seen = np.lib.stride_tricks.as_strided(x, (n, WINDOW, width * DEPTH), x.strides, writeable=False)
    return (seen.reshape(-1, width * DEPTH) @ joined(net)).reshape(n, WINDOW, -1)


def probabilities(net: Network, windows: np.ndarray) -> np.ndarray:
    top = responses(net, windows).max(axis=1) + net.shifts
    return softmax(np.maximum(top, 0) @ net.out[:-1] + net.out[-1])


def start(langs: tuple[str, ...], seed: int) -> Network:
    rng = np.random.default_rng(seed)
    draw = lambda rows, columns, scale: (rng.standard_normal((rows, columns)) * scale).astype(np.float32)
    table = draw(256, DEPTH, 1.0)
    table[0] = 0
    filters = tuple(draw(w * DEPTH, FILTERS, (w * DEPTH) ** -0.5) for w in WIDTHS)
    many = FILTERS * len(WIDTHS)
    return Network(langs, table, filters, np.zeros(many, np.float32), np.vstack([draw(many, len(langs), 0.1), np.zeros((1, len(langs)), np.float32)]))


def gradients(net: Network, windows: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross entropy, in the order of ``parameters``; only the places of the largest responses take part."""
    n = len(windows)
    seen = responses(net, windows)
    places, top = seen.argmax(axis=1), seen.max(axis=1) + net.shifts
    hidden = np.maximum(top, 0)
    error = softmax(hidden @ net.out[:-1] + net.out[-1])
    error[np.arange(n), y] -= 1
    error /= n
    back = (error @ net.out[:-1].T) * (top > 0)
    padded = np.concatenate([windows, np.zeros((n, WIDTHS[-1] - 1), np.uint8)], axis=1)
    table, filters = np.zeros_like(net.table), []
    for k, (width, weights) in enumerate(zip(WIDTHS, net.filters, strict=True)):
        mine = slice(k * FILTERS, (k + 1) * FILTERS)
        spots = padded[np.arange(n)[:, None, None], places[:, mine, None] + np.arange(width)]  # bytes there
        vectors = net.table[spots].reshape(n, FILTERS, width * DEPTH)
        filters.append(np.einsum("nf,nfd->df", back[:, mine], vectors))
        to_bytes = (back[:, mine, None] * weights.T[None]).reshape(-1, DEPTH)
        for d in range(DEPTH):
            table[:, d] += np.bincount(spots.ravel(), to_bytes[:, d], 256)
    table[0] = 0
    return [table, *filters, back.sum(axis=0), np.vstack([hidden.T @ error, error.sum(axis=0)])]


def parameters(net: Network) -> list[np.ndarray]:
    return [net.table, *net.filters, net.shifts, net.out]


def trained(windows: np.ndarray, y: np.ndarray, langs: tuple[str, ...], epochs: int, seed: int = 1, rate: float = 0.01) -> Network:
    """Adam over shuffled batches; languages count alike, however many windows each has."""
    rng, net = np.random.default_rng(seed), start(langs, seed)
    params = parameters(net)
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    share = 1 / np.bincount(y, minlength=len(langs))[y]
    per_epoch = -(-len(y) // BATCH)
    for t in range(1, epochs * per_epoch + 1):
        chosen = rng.choice(len(y), BATCH, p=share / share.sum())
        step = rate * min(1.0, 3 * (1 - (t - 1) / (epochs * per_epoch)))
        for p, m, v, g in zip(params, first, second, gradients(net, windows[chosen], y[chosen]), strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return net


def held_out(id_col: str) -> Column:
    """Rows whose language is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Windows of bytes [start, end), filled up with 0."""
    at = starts[:, None] + np.arange(WINDOW)
    inside = at < ends[:, None]
    return np.where(inside, FOLD[data[np.minimum(at, max(len(data) - 1, 0))]], 0).astype(np.uint8) if len(data) else np.zeros((len(starts), WINDOW), np.uint8)


def fit(
    spark: SparkSession,
    docs: DataFrame,
    train_rows: int = 4_000,
    windows_each: int = 4,
    epochs: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Network | None:
    """Learn from at most ``train_rows`` documents that are not held out, ``windows_each`` windows spread over each.

    Chosen by a hash of the text, the first of every language, then the second, and so on, so that rare languages
    are learned too. Texts without a letter teach nothing; documents that repeat a text in a language count once. None without any text to learn from.
    """
    steps = Steps(spark, "langid")
    usable = F.col(lang_col).isNotNull() & ~held_out(id_col) & F.coalesce(F.col(text_col).cast("string").rlike("\\p{L}"), F.lit(False))
    known = docs.where(usable).select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(text_col).cast("string")).alias("h")).distinct()
    # Spark keeps the first rows of each language before it sorts them together; the limit bounds the table.
    turn = F.row_number().over(W.partitionBy("lang").orderBy("h"))
    picked = known.withColumn("turn", turn).where(F.col("turn") <= train_rows).orderBy("turn", "lang").limit(train_rows).select("lang", "h")
    picked = steps.save("picked", picked)
    texts = docs.where(usable).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    texts = texts.withColumn("h", F.xxhash64("text")).join(F.broadcast(picked), ["lang", "h"])  # at most train_rows pairs

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            size = np.diff(offsets)
            step = np.maximum(size - WINDOW, 0)[:, None] * (np.arange(windows_each) / max(windows_each - 1, 1))
            starts = (offsets[:-1, None] + step.astype(np.int64)).ravel()
            rows = cut(data, starts, np.repeat(offsets[1:], windows_each))
            owner = np.repeat(np.arange(batch.num_rows), windows_each)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").take(pa.array(owner)), batch.column("h").take(pa.array(owner)), pa.array([r.tobytes() for r in rows], pa.binary())], ["lang", "h", "window"]
            )

    found = texts.mapInArrow(sample, "lang string, h bigint, window binary").distinct().toArrow()  # bounded by train_rows * windows_each
    rows = sorted(zip(*(found[c].to_pylist() for c in ("lang", "h", "window")), strict=True))
    windows = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(-1, WINDOW)
    taught = LETTER[windows].any(axis=1)
    if not taught.any():
        return None
    langs = tuple(sorted({r[0] for r, keep in zip(rows, taught, strict=True) if keep}))
    number = {x: i for i, x in enumerate(langs)}
    y = np.array([number[r[0]] for r, keep in zip(rows, taught, strict=True) if keep])
    return trained(windows[taught], y, langs, epochs)


def predict(df: DataFrame, net: Network | None, text_col: str = "text") -> DataFrame:
    """``df`` with lang_pred and score (0 to 1), the mean probability of that language over the whole text.

    Columns of these names are replaced. A text without a letter, an empty or null one, and any text without a network, is
    "und" with score 0. Rows repeat as they come; equal texts get equal results. Long texts are read window by window, a batch of windows at a time.
    """
    df = df.drop("lang_pred", "score")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    flag = spare(df, "_lettered")
    flagged = df.withColumn(flag, F.coalesce(F.col(text_col).cast("string").rlike("\\p{L}"), F.lit(False)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lettered = batch.column(flag).to_numpy(zero_copy_only=False)
            data, offsets = utf8(batch.column(text_col))
            langs = net.langs if net is not None else (UNKNOWN,)
            sums = np.zeros((batch.num_rows, len(langs)))
            if net is not None:
                counts = np.where(lettered, -(-np.diff(offsets) // WINDOW), 0)
                first = np.cumsum(counts) - counts
                for k in range(0, int(counts.sum()), BATCH):
                    number = np.arange(k, min(k + BATCH, int(counts.sum())))
                    owner = np.searchsorted(first + counts, number, "right")
                    windows = cut(data, offsets[owner] + (number - first[owner]) * WINDOW, offsets[owner + 1])
                    weight = LETTER[windows].sum(axis=1)
                    np.add.at(sums, owner, probabilities(net, windows) * weight[:, None])
            total = sums.sum(axis=1)
            best = sums.argmax(axis=1)
            score = np.where(total > 0, sums[np.arange(len(best)), best] / np.where(total > 0, total, 1), 0.0)
            names = [langs[b] if t > 0 else UNKNOWN for b, t in zip(best.tolist(), total.tolist(), strict=True)]
            kept = batch.drop_columns([flag])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(names, pa.string()), pa.array(np.minimum(score, 1.0))], [*kept.schema.names, "lang_pred", "score"])

    return flagged.mapInArrow(read, f"{fields}, lang_pred string, score double")
