"""Quality classifier: interpolated modified Kneser-Ney over bytes, one model for each language.

Counts of byte n-grams come from trusted text; each lower order counts in how many ways its n-grams
are continued to the left. Discounts come from the counts of counts, and joins of counts with their
contexts, order by order, give the probability of every seen n-gram and the weight that each
seen context leaves to the next lower order. A document's perplexity is compared with a quantile of its language,
taken over trusted documents that the model has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailgrain.llm.common import Steps, settings
from retailgrain.llm.textbytes import slices, utf8

ORDER = 5
SYMBOLS = 256
KEYS = ("doc_id", "lang", "text_md5", "model")
POOL = "\1"  # the model of all languages
# Where the ids of trusted texts fit a small filter, Spark tests them before it moves a text for training.
FEWER = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0", "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(64 << 20)}
MASK = [(1 << (8 * k)) - 1 for k in range(ORDER + 1)]


def codes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The n-gram that ends at each byte; zero bytes stand before a text."""
    out = np.zeros(len(data), np.int64)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    for k in range(ORDER):
        back = np.zeros(len(data), np.int64)
        back[k:] = data[: len(data) - k]
        if k:
            back[place < k] = 0
        out |= back << (8 * k)
    return out


def stretches(data: np.ndarray, offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, the n-grams that end at each of their bytes, and the row (from the first) of each.

    A text beyond ``limit`` bytes comes in pieces, each with the bytes before it as context.
    """
    for i, j in slices(offsets, limit):
        own = data[offsets[i] : offsets[j]]
        if j == i + 1 and len(own) > limit:
            for a in range(0, len(own), limit):
                start = max(a - (ORDER - 1), 0)
                piece = own[start : a + limit]
                code = codes(piece, np.array([0, len(piece)]))[a - start :]
                yield i, j, code, np.zeros(len(code), np.int64)
        else:
            at = offsets[i : j + 1] - offsets[i]
            yield i, j, codes(own, at), np.repeat(np.arange(j - i), np.diff(at))


def counts(texts: DataFrame) -> DataFrame:
    """(lang, g, c) from (lang, text): each task adds up its own batches first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            langs = np.array(batch.column("lang").to_pylist(), object)
            for i, j, code, owner in stretches(data, offsets, 8 << 20):
                for lang in sorted(set(langs[i:j])):
                    g, c = np.unique(code[(langs[i:j] == lang)[owner]], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(c)], ["lang", "g", "c"])

    return texts.mapInArrow(count, "lang string, g bigint, c bigint").groupBy("lang", "g").agg(F.sum("c").alias("c"))


def discount(c: Column, d: Column) -> Column:
    return F.when(c == 1, d["d1"]).when(c == 2, d["d2"]).otherwise(d["d3"])


def model(steps: Steps, top: DataFrame) -> DataFrame:
    """(lang, kind, g, value): log probabilities of seen n-grams (kind: order) and log weights of seen contexts (kind: -order)."""
    levels = {ORDER: top}
    for k in range(ORDER - 1, 0, -1):
        lower = levels[k + 1].select("lang", F.col("g").bitwiseAND(F.lit(MASK[k])).alias("g"))
        levels[k] = steps.save(f"counts{k}", lower.groupBy("lang", "g").agg(F.count("*").alias("c")))
    rows, below = [], None
    for k in range(1, ORDER + 1):
        n = [F.sum(F.when(F.col("c") == i, 1.0).otherwise(0.0)).alias(f"n{i}") for i in range(1, 5)]
        ratio = lambda a, b: F.when((F.col(b) > 0), F.col(a) / F.col(b)).otherwise(F.lit(0.5))
        y = F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1.0))
        d = [F.greatest(F.least(i - (i + 1) * y * ratio(f"n{i + 1}", f"n{i}"), F.lit(float(i))), F.lit(0.1)).alias(f"d{i}") for i in (1, 2, 3)]
        # One row for each language, as the driver sees them too.
        cut = levels[k].groupBy("lang").agg(*n).select("lang", F.struct(*d).alias("d"))
        seen = levels[k].join(F.broadcast(cut), "lang").select("lang", "g", "c", discount(F.col("c"), F.col("d")).alias("cut"), F.shiftright("g", 8).alias("h"))
        context = seen.groupBy("lang", "h").agg(F.sum("c").alias("total"), F.sum("cut").alias("left"))
        context = context.select("lang", "h", "total", (F.col("left") / F.col("total")).alias("weight"))
        full = seen.join(context, ["lang", "h"]).withColumn("s", F.col("g").bitwiseAND(F.lit(MASK[k - 1])))
        full = full.withColumn("base", F.lit(1.0 / SYMBOLS)) if below is None else full.join(below.select("lang", F.col("g").alias("s"), F.col("p").alias("base")), ["lang", "s"])
        below = steps.save(f"level{k}", full.select("lang", "g", ((F.col("c") - F.col("cut")) / F.col("total") + F.col("weight") * F.col("base")).alias("p")))
        rows.append(below.select("lang", F.lit(k).alias("kind"), "g", F.log("p").alias("value")))
        rows.append(context.select("lang", F.lit(-k).alias("kind"), F.col("h").alias("g"), F.log("weight").alias("value")))
    return steps.save("model", reduce(DataFrame.union, rows))


def shards(table: DataFrame, most: int) -> list[tuple[int, int]]:
    """Ranges of the two bytes before the scored one; a shard holds all longer n-grams behind its bytes, ``most`` rows if possible."""
    sizes = table.where("abs(kind) > 2").groupBy(before().alias("b")).agg(F.count("*").alias("n")).collect()  # 65,536 rows at most
    rows = {r["b"]: r["n"] for r in sizes}
    out, start, room = [], 0, most
    for b in range(1 << 16):  # also those that no trusted text holds
        n = rows.get(b, 0)
        if n > room and b > start:
            out.append((start, b))
            start, room = b, most
        room -= n
    return [*out, (start, 1 << 16)]


def before() -> Column:
    """The two bytes before the scored one: next to last of an n-gram, last of a context."""
    return F.when(F.col("kind") > 0, F.shiftright("g", 8)).otherwise(F.col("g")).bitwiseAND(F.lit(0xFFFF))


class Lookup:
    """Values by 64-bit keys above 0: open addressing, probed for many keys at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(int(2 * len(keys)).bit_length(), 4)
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.float32)
        left = np.arange(len(keys))
        at = self._place(keys)
        while len(left):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[left[free]]  # of several for one place the last stays
            there = self.keys[at] == keys[left]
            self.values[at[there]] = values[left[there]]
            left, at = left[~there], (at[~there] + 1) & ((1 << self.bits) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is there, and its value."""
        at = self._place(wanted)
        key = self.keys[at]
        hit = key == wanted
        left = np.flatnonzero(~hit & (key != -1))
        while len(left):
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
            key = self.keys[at[left]]
            there = key == wanted[left]
            hit[left[there]] = True
            left = left[~there & (key != -1)]
        return hit, self.values[at]


def partial(docs: DataFrame, table: DataFrame, own: tuple[int, int], langs: list[str]) -> DataFrame:
    """(doc_id, lang, text_md5, model, log_p, n) from the positions of one shard, whose rows go to every task.

    ``docs`` names in ``models`` all models that judge a text, so the text is read once for all of them and is not moved.
    """
    place = F.when(F.col("kind") > 0, F.col("kind")).otherwise(8 - F.col("kind"))
    number = F.create_map(*[F.lit(x) for pair in zip(langs, range(len(langs)), strict=True) for x in pair])[F.col("lang")]
    key = F.shiftleft(place.cast("bigint"), 56).bitwiseOR(F.shiftleft(number.cast("bigint"), 40)).bitwiseOR(F.col("g"))
    first, end = own
    part = table.where((F.abs("kind") <= 2) | before().between(first, end - 1)).select(key.alias("key"), F.col("value").cast("float").alias("value")).toArrow()
    keys, values = part["key"].to_numpy(), part["value"].to_numpy()
    numbers = {x: i for i, x in enumerate(langs)}

    def log_p(lookup: Lookup, code: np.ndarray, lang: int) -> np.ndarray:
        out, left = np.zeros(len(code), np.float64), np.arange(len(code))
        for k in range(ORDER, 0, -1):
            gram = code[left]
            seen, value = lookup.find((gram & MASK[k]) | (lang << 40) | (k << 56))
            out[left[seen]] += value[seen]
            left, gram = left[~seen], gram[~seen]
            if not len(left):
                return out
            known, weight = lookup.find(((gram & MASK[k]) >> 8) | (lang << 40) | ((8 + k) << 56))
            out[left] += np.where(known, weight, 0.0)
        out[left] -= np.log(SYMBOLS)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(keys, values)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            models = batch.column("models").to_pylist()
            rows = [(i, x) for i, names in enumerate(models) for x in names]
            at_row = {pair: k for k, pair in enumerate(rows)}
            sums, n = np.zeros(len(rows)), np.zeros(len(rows), np.int64)
            for i, j, code, owner in stretches(data, offsets):
                behind = (code >> 8) & 0xFFFF
                here = (behind >= first) & (behind < end)
                code, owner = code[here], owner[here]
                for x in sorted({x for names in models[i:j] for x in names if x in numbers}):
                    to_row = np.array([at_row.get((r, x), -1) for r in range(i, j)])[owner]
                    asked = to_row >= 0
                    some, goal = (code, to_row) if asked.all() else (code[asked], to_row[asked])
                    if len(some):
                        sums += np.bincount(goal, log_p(lookup, some, numbers[x]), len(rows))
                        n += np.bincount(goal, minlength=len(rows))
            owner = pa.array([i for i, _ in rows], pa.int64())
            columns = [batch.column(c).take(owner) for c in KEYS[:3]] + [pa.array([x for _, x in rows], pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums), pa.array(n)], [*KEYS, "log_p", "n"])

    return docs.mapInArrow(run, "doc_id bigint, lang string, text_md5 string, model string, log_p double, n bigint")


def perplexities(
    spark: SparkSession,
    df: DataFrame,
    labels: DataFrame,
    quantile: float = 0.995,
    folds: int = 1,
    shard_rows: int = 2_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    label_col: str = "quality",
) -> DataFrame:
    """(doc_id, lang, n_bytes, perplexity, threshold, kept) for every row of ``df``.

    Trusted are documents with label 1, never 0; a hash of the id halves them. With ``folds`` 1 the first half trains
    the model and the other half sets the threshold. With ``folds`` 2 each half trains a model: the trusted documents of a half are judged by
    the other's model and all set the threshold, other documents get the geometric mean of both perplexities, and
    languages without trusted text in both halves are judged by models and a threshold of all trusted text.
    All their text counts. Null and empty texts, and
    languages without a model, have no perplexity and are kept; so is a language without a threshold.
    A null language is a language of its own. Equal rows get equal results. An empty table
    gives no rows. The driver sees one shard of the model at a time.
    """
    if folds not in (1, 2):
        raise ValueError("folds must be 1 or 2")
    steps = Steps(spark, "kneser")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("\0"))
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), lang.alias("lang"), F.md5(text.cast("binary")).alias("text_md5"), text.alias("text"))
    trusted = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("doc_id"))
    trusted = trusted.agg(F.min(label_col).alias("least")).where("least = 1").select("doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2).cast("int").alias("fold"))
    trusted = steps.save("trusted", trusted)
    train = docs.join(trusted.where("fold >= 0"), "doc_id").select("lang", "text", "fold")
    if folds == 1:
        top = steps.save("counts", counts(train.where("fold = 0").select("lang", "text")))
        asked = docs.withColumn("models", F.array("lang"))
    else:
        half = lambda fold, name: F.concat(fold.cast("string"), name)
        able = train.where("text <> ''").groupBy("lang").agg(F.count_distinct("fold").alias("k")).where("k = 2")
        known = sorted(r["lang"] for r in able.collect())  # as many as there are languages
        pooled = not docs.where(~F.col("lang").isin(known)).isEmpty()
        names = [F.col("lang"), F.lit(POOL)] if pooled else [F.col("lang")]
        train = train.select(F.explode(F.array(*[half(F.col("fold"), x) for x in names])).alias("lang"), "text")
        with settings(spark, FEWER):
            top = steps.save("counts", counts(train))
        scale = F.when(F.col("lang").isin(known), F.col("lang")).otherwise(F.lit(POOL))
        # Both halves judge every text where it lies; what a trusted text must not be judged by is left out below, without its text.
        models = F.array_distinct(F.array(*[half(F.lit(x), name) for x in (0, 1) for name in (scale, *names[1:])]))
        asked = docs.withColumn("models", models)
    langs = sorted(r["lang"] for r in top.select("lang").distinct().collect())  # as many as there are languages, for each half
    table = model(steps, top)
    parts = [steps.save(f"partial{i}", partial(asked, table, own, langs)) for i, own in enumerate(shards(table, shard_rows))] if langs else []
    if not parts:
        parts = [asked.select(*KEYS[:3], F.explode("models").alias("model"), F.lit(0.0).alias("log_p"), F.lit(0).cast("bigint").alias("n"))]
    scored = reduce(DataFrame.union, parts).groupBy(*KEYS).agg(F.sum("log_p").alias("log_p"), F.sum("n").alias("n"), F.count("*").alias("k"))
    scored = scored.select(
        *KEYS, (F.col("k") / len(parts)).cast("int").alias("rows"), F.col("n"), F.when(F.col("n") > 0, -F.col("log_p") / F.col("n")).alias("loss"),
        (F.col("model") if folds == 1 else F.substring("model", 2, 1 << 20)).alias("scale"),
    )
    if folds == 2:
        own_half = F.substring("model", 1, 1).cast("int") == F.col("fold")
        needed = F.when(F.col("fold").isNull(), (F.col("scale") == F.col("lang")) | ~F.col("lang").isin(known)).otherwise(~own_half)
        scored = scored.join(trusted, "doc_id", "left").where(needed).drop("fold")
    scored = steps.save("scored", scored)
    judged = scored.join(trusted.where("fold = 1") if folds == 1 else trusted, "doc_id", "left_semi").where("loss is not null")
    limits = judged.groupBy("scale").agg(F.percentile_approx(F.exp("loss"), quantile, 100_000).alias("threshold"))
    own = scored if folds == 1 else scored.where((F.col("scale") == F.col("lang")) | ~F.col("lang").isin(known))
    own = own.groupBy("doc_id", "lang", "text_md5", "scale").agg(F.max("rows").alias("rows"), F.max("n").alias("n"), F.exp(F.avg("loss")).alias("perplexity"))
    out = own.join(F.broadcast(limits), "scale", "left").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    out = out.select(
        "doc_id", F.when(F.col("lang") != "\0", F.col("lang")).alias("lang"), (F.col("n") / F.col("rows")).cast("bigint").alias("n_bytes"), "perplexity", "threshold",
        F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("kept"),
    )
    return steps.finish(out)
