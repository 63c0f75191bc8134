"""N-gram Jaccard join by grouped prefixes.

A document is its set of distinct word shingles. All sets are sorted in one order, rare shingles
first; two sets of the wanted similarity share a shingle among their first ones, the prefix. Documents
with the same size and prefix form a group; groups meet under the shingles of their prefix,
and members are verified exactly on their whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailgrain.llm.common import Steps, components, spare
from retailgrain.llm.near import connected, shared_postings
from retailgrain.llm.sums import total
from retailgrain.llm.textbytes import LOWER, U64, hashes, mix64, signed, slices, spans, utf8

SKETCH_BITS = 20
TRAIT_BITS = 512


def shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every shingle of many texts, in row order; a shorter text is one shingle of all its words."""
    start, end, row = spans(data, offsets)
    h = hashes(LOWER[data], start, end)
    factors = mix64(np.arange(1, words + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
    count = np.bincount(row, minlength=len(offsets) - 1)
    whole = np.flatnonzero(row[: len(row) - words + 1] == row[words - 1 :]) if len(row) >= words else np.zeros(0, np.int64)
    code = np.zeros(len(whole), U64)
    for k in range(words):
        code += h[whole + k] * factors[k]
    short = np.flatnonzero((count > 0) & (count < words))
    first = np.cumsum(count) - count
    few = np.zeros(len(short), U64)
    for k in range(words - 1):
        has = count[short] > k
        few[has] += h[first[short[has]] + k] * factors[k]
    few += count[short].astype(U64) << U64(32)
    code, rows = np.concatenate([code, few]), np.concatenate([row[whole], short])
    if len(short):
        order = np.argsort(rows, kind="stable")
        code, rows = code[order], rows[order]
    return mix64(code), rows


def sets(batch_text, words: int, classes: np.ndarray | None) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct tokens of each row). A token is the frequency class and 56 bits of the hash."""
    data, offsets = utf8(batch_text)
    for i, j in slices(offsets):
        code, row = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words)
        token = code >> U64(8)
        if classes is not None:
            token |= classes[code >> U64(64 - SKETCH_BITS)].astype(U64) << U64(56)
        cuts = np.searchsorted(row, np.arange(j - i + 1))
        out = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = np.sort(token[a:b])
            out.append(part[np.append(True, part[1:] != part[:-1])] if b > a else part)
        yield i, out


def frequency_classes(texts: DataFrame, words: int) -> np.ndarray:
    """Class of every hash range by how many documents hold its shingles: a fixed-size sketch over all documents.

    Any order gives right results; this one puts shingles of many documents last.
    """

    def count(batch: pa.RecordBatch, sums: np.ndarray) -> None:
        for _, rows in sets(batch.column(0), words, None):
            if rows:
                sums += np.bincount((np.concatenate(rows) >> U64(56 - SKETCH_BITS)).astype(np.int64), minlength=len(sums))

    sums = total(texts, 1 << SKETCH_BITS, count)
    return np.minimum(6 * np.log2(1 + sums), 127).astype(np.uint8)


def least_overlap(n: Column, percent: int) -> Column:
    """Smallest overlap of a set of size n with any set that is similar enough."""
    return F.expr(f"({n} * {percent} + 99) div 100")


def signatures(docs: DataFrame, words: int, percent: int, classes: np.ndarray) -> DataFrame:
    """(doc_id, n, fp1, fp2, gkey, prefix): set size, set fingerprint, prefix fingerprint and prefix."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, rows in sets(batch.column(1), words, classes):
                n = np.array([len(r) for r in rows], np.int64)
                heads = [r[: len(r) - (len(r) * percent + 99) // 100 + 1] if len(r) else r for r in rows]
                add = lambda parts, salt: np.array([mix64(p + U64(salt)).sum(dtype=U64) for p in parts], U64)
                lists = pa.array([signed(h) for h in heads], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i : i + len(rows)], pa.array(n), *[pa.array(signed(x)) for x in (add(rows, 1), add(rows, 2), add(heads, 3))], lists],
                    ["doc_id", "n", "fp1", "fp2", "gkey", "prefix"],
                )

    return docs.mapInArrow(sign, "doc_id bigint, n bigint, fp1 bigint, fp2 bigint, gkey bigint, prefix array<bigint>")


def seven_bytes(tokens: np.ndarray) -> bytes:
    """Hashes of 56 bits without their empty byte."""
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def from_seven_bytes(raw) -> np.ndarray:
    part = np.frombuffer(raw, np.uint8).reshape(-1, 7)
    out = np.zeros((len(part), 8), np.uint8)
    out[:, :7] = part
    return out.view("<u8").ravel()


def whole_sets(docs: DataFrame, words: int) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, rows in sets(batch.column(1), words, None):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i : i + len(rows)], pa.array([seven_bytes(r) for r in rows], pa.binary())], ["m", "tokens"]
                )

    return docs.mapInArrow(make, "m bigint, tokens binary")


def linked(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, ta, tb) whose sets have the similarity."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ta"), batch.column("tb"), strict=True):
                p, q = from_seven_bytes(x.as_buffer()), from_seven_bytes(y.as_buffer())
                if len(p) > len(q):
                    p, q = q, p
                at = np.searchsorted(q, p)
                at[at == len(q)] = 0
                both = int(np.count_nonzero(q[at] == p)) if len(q) else 0
                keep.append(both > 0 and 100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "ta", "tb").mapInArrow(check, "a bigint, b bigint")


def parities(tokens: DataFrame) -> DataFrame:
    """(m, traits): for each of 512 ranges of hashes, whether an odd number of the set's tokens lies in it, as bits.

    Two sets differ in at least as many tokens as they do in bits.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.zeros((batch.num_rows, TRAIT_BITS), np.uint8)
            for i, raw in enumerate(batch.column("tokens")):
                spots = (from_seven_bytes(raw.as_buffer()) & U64(TRAIT_BITS - 1)).astype(np.int64)
                bits[i] = np.bincount(spots, minlength=TRAIT_BITS) & 1
            words = np.packbits(bits, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("m"), pa.array(list(words), pa.list_(pa.int64()))], ["m", "traits"])

    return tokens.select("m", "tokens").mapInArrow(make, "m bigint, traits array<bigint>")


def join(
    spark: SparkSession,
    df: DataFrame,
    words: int = 5,
    percent: int = 75,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row: the smallest id reachable by links.

    Two documents link when ``100 * intersection >= percent * union``. Null, empty and blank texts have
    no shingle and link with nothing. Rows with the same id are one document: each row has its own
    size, and their links count together. A row without id links with nothing and has a null
    component. Other columns are ignored. An empty table gives no rows. Shingles are compared by
    56 bits of a hash.
    """
    steps = Steps(spark, "jaccard")
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    classes = frequency_classes(docs.select("text"), words)
    signed_docs = steps.save("signatures", signatures(docs, words, percent, classes))
    head = F.when(F.col("n") > 0, F.col("prefix")[0]).alias("head")
    rows = steps.save("rows", signed_docs.select("doc_id", "n", "fp1", "fp2", "gkey", head))
    alive = rows.where("doc_id is not null and n > 0")
    # Equal sets are one class, known by its smallest id, and classes of one size and prefix one group.
    classes_ = steps.save("classes", alive.groupBy("fp1", "fp2", "n", "gkey", "head").agg(F.min("doc_id").alias("m")))
    grouped = classes_.groupBy("gkey", "n", "head").agg(F.min("m").alias("g"))
    members = steps.save("members", classes_.join(grouped, ["gkey", "n", "head"]).select("g", "m").distinct())
    heads = signed_docs.where("n > 0").withColumn("head", head).join(grouped.withColumnRenamed("g", "doc_id"), ["gkey", "n", "head", "doc_id"])
    postings = heads.select(F.col("doc_id").alias("g"), F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("pos", "key"))
    # Size and place travel as one number: a row's width is what the largest exchange of this search is made of.
    packed = postings.select("key", "g", F.shiftleft(F.col("n").cast("bigint"), 32).bitwiseOR(F.col("pos").cast("bigint")).alias("at"))
    n, pos = F.shiftright("at", 32).cast("int"), F.col("at").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    postings = packed.repartition("key").select("key", "g", n.alias("n"), pos.alias("pos"))
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)))

    def admissible(a, b) -> Column:
        both = (a("n") + b("n")) * percent
        left = F.least(a("n") - a("pos"), b("n") - b("pos"))  # tokens from the shared one on
        return (F.least(a("n"), b("n")) * 100 >= F.greatest(a("n"), b("n")) * percent) & (left * (100 + percent) >= both)

    shared = shared_postings(steps, postings, band, ["n", "g"], ["n", "pos"], admissible)
    steps.drop("signatures")
    several = members.groupBy("g").agg(F.count("*").alias("k")).where("k > 1").select("g")
    wanted = shared.select("g").union(several).distinct().join(members, "g").select(F.col("m").alias("doc_id")).distinct()
    tokens = whole_sets(docs.join(wanted.hint("merge"), "doc_id", "left_semi"), words)
    once = alive.groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1").isEmpty()
    tokens = steps.save("tokens", tokens if once else tokens.distinct())  # only a repeated id can bring a set twice

    def verify(_: str, pairs: DataFrame) -> DataFrame:
        a = tokens.select(F.col("m").alias("a"), F.col("tokens").alias("ta"))
        b = tokens.select(F.col("m").alias("b"), F.col("tokens").alias("tb"))
        return linked(pairs.join(b, "b").join(a, "a"), percent).distinct()

    def traits(nodes: DataFrame) -> DataFrame:
        return parities(tokens.join(nodes, "m", "left_semi"))

    def alike(a, b) -> Column:
        apart = sum((F.bit_count(F.get(a("traits"), i).bitwiseXOR(F.get(b("traits"), i))) for i in range(TRAIT_BITS // 64)), F.lit(0))
        both = a("n") + b("n")
        return (both - apart) * (100 + percent) >= both * (2 * percent)

    found = connected(steps, shared, members, ["n", "pos"], admissible, verify, [F.col("pos")], traits, alike)
    # An id with several texts belongs to several classes and joins them.
    of_class = classes_.select("fp1", "fp2", "n", "m")
    known = rows.where("doc_id is not null and n > 0").join(of_class, ["fp1", "fp2", "n"])
    joined = known.groupBy("doc_id").agg(F.min("m").alias("a"), F.max("m").alias("b")).where("a <> b")
    steps.drop("tokens", "shared")
    if not once and not joined.isEmpty():
        every = known.select(F.col("doc_id").alias("a"), F.col("m").alias("b")).where("a <> b")
        found = components(steps, found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(every), "ids")
    at = of_class.join(found.withColumnRenamed("node", "m"), "m", "left").select("fp1", "fp2", "n", F.coalesce("component", "m").alias("component_id"))
    placed = rows.join(at, ["fp1", "fp2", "n"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return steps.finish(placed.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id")))


def distinct_documents(spark: SparkSession, df: DataFrame, **options) -> DataFrame:
    """One document of each group, the one with the smallest id, with the columns of ``df``; rows without id stay."""
    id_col = options.get("id_col", "doc_id")
    gone = spare(df, "_gone")
    drop = join(spark, df, **options).where("component_id < doc_id").select(F.col("doc_id").alias(gone)).distinct()
    return df.join(drop, df[id_col].cast("bigint") == F.col(gone), "left_anti")
