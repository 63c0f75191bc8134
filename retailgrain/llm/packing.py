"""Packing documents into sequences by a configuration linear program.

A configuration says how many pieces of each length share one sequence. The program over the
histogram of lengths, cover every length at the least number of sequences, is solved by
multiplicative weights: a knapsack over the capacity prices the lengths, near-best fillings get
weight, and the lengths they cover lose price. The solution is rounded to whole sequences, the rest is solved again, and
what no whole filling takes is packed best fit first by decreasing length; should best fit alone need fewer sequences, its packing stands. All this works on
the histogram, whose size the capacity bounds; pieces then find their place by their rank.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from retailgrain.llm.common import Steps

PIECE = "doc_id bigint, piece int, start bigint, length int, ids_crc32 bigint, part int, local bigint"
_encodings: dict = {}

Config = dict[int, int]  # length -> pieces of it in one sequence


SPECIAL = {"<|endoftext|>": 50256}


def encoding(ranks_file: str | None):
    """Ids of a text by the byte-level BPE of 50k tokens. Its rank file gives the ids of the JSON form, several times faster.

    As there, the string of a special token inside a text is that token.
    """
    import base64

    import public_tokenizers
    import tiktoken

    path = ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken")
    if path not in _encodings:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        bpe = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
        _encodings[path] = lambda text: bpe.encode(text, allowed_special="all") if any(x in text for x in SPECIAL) else bpe.encode_ordinary(text)
    return _encodings[path]


def pieces(df: DataFrame, capacity: int, end_id: int, ranks_file: str | None, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``PIECE``: only longer documents are cut, into whole sequences behind a shorter first piece.

    ``local`` counts the pieces of a length within the task, ``part``.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoding(ranks_file), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array([*encode(text or ""), end_id], "<u4")
                start, stop = 0, (len(ids) - 1) % capacity + 1
                number = 0
                while start < len(ids):
                    length = stop - start
                    rows.append((doc, number, start, length, zlib.crc32(ids[start:stop].tobytes()), part, int(seen[length])))
                    seen[length] += 1
                    start, stop, number = stop, stop + capacity, number + 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "local"]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return df.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(cut, PIECE)


def knapsack(lengths: np.ndarray, price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Most price that fits in each capacity, and the piece (its index) taken last, -1 for none."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        fits = np.searchsorted(lengths, c, "right")
        if fits:
            worth = best[c - lengths[:fits]] + price[:fits]
            k = int(np.argmax(worth))
            best[c], last[c] = worth[k], k
    return best, last


def filling(first: int, lengths: np.ndarray, last: np.ndarray, capacity: int) -> Config:
    config, room, k = {}, capacity, first
    while k >= 0:
        size = int(lengths[k])
        config[size] = config.get(size, 0) + 1
        room -= size
        k = int(last[room])
    return config


def fractional(counts: Config, capacity: int, rounds: int, width: int, slack: float, rate: float) -> list[tuple[Config, float]]:
    """Multiplicative weights on the covering program: configurations and their amounts.

    Prices start at the share of the capacity that a length takes, which is optimal if all
    sequences can be filled. Every round takes the ``width`` best fillings whose price is within
    ``slack`` of the best, covers a part of their lengths, and lowers those prices.
    """
    lengths = np.array(sorted(counts))
    demand = np.array([counts[x] for x in lengths], float)
    place = {int(x): i for i, x in enumerate(lengths)}
    price, covered = lengths / capacity, np.zeros(len(lengths))
    amounts: dict[tuple, float] = {}
    for _ in range(rounds):
        best, last = knapsack(lengths, price, capacity)
        worth = price + best[capacity - lengths]
        gain = np.zeros(len(lengths))
        for first in np.argsort(-worth, kind="stable")[:width]:
            if worth[first] < (1 - slack) * best[capacity]:
                break
            config = filling(int(first), lengths, last, capacity)
            at = [place[x] for x in config]
            many = np.array(list(config.values()), float)
            step = float(np.min(demand[at] / many)) / 4
            key = tuple(sorted(config.items()))
            amounts[key] = amounts.get(key, 0.0) + step
            gain[at] += many * step / demand[at]
        covered += gain
        price = price * np.exp(-rate * gain)
        if covered.min() >= 1:
            break
    volume = sum(v * sum(a * b for a, b in k) for k, v in amounts.items())
    scale = float(lengths @ demand) / volume
    return [(dict(k), v * scale) for k, v in sorted(amounts.items(), key=lambda x: (-x[1], x[0]))]


def best_fit(counts: Config, capacity: int) -> list[tuple[Config, int]]:
    """Best fit by decreasing length, on groups of equal sequences rather than on pieces."""
    room: dict[int, list[list]] = {}
    spaces: list[int] = []

    def put(space: int, config: Config, copies: int) -> None:
        if space not in room:
            bisect.insort(spaces, space)
            room[space] = []
        room[space].append([config, copies])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(spaces, length)
            if at == len(spaces):
                config, copies, space = {}, left, capacity  # new sequences
            else:
                space = spaces[at]
                config, copies = room[space].pop()
                if not room[space]:
                    del room[space]
                    spaces.pop(at)
            many = space // length
            full = min(copies, left // many)
            if full:
                put(space - many * length, {**config, length: many}, full)
                left -= full * many
            if copies > full and 0 < left < many:
                put(space - left * length, {**config, length: left}, 1)
                left, full = 0, full + 1
            if config and copies > full:
                put(space, config, copies - full)
    return [(c, n) for group in room.values() for c, n in group]


def rounded(solution: list[tuple[Config, float]], rest: Config) -> list[tuple[Config, int]]:
    """Whole copies of the configurations, taken out of ``rest``: the whole parts first, then one more by falling remainder where the pieces are there."""
    out = []

    def take(config: Config, most: int) -> None:
        copies = min([most, *(rest[x] // k for x, k in config.items())])
        if copies > 0:
            out.append((config, copies))
            for x, k in config.items():
                rest[x] -= k * copies

    for config, amount in solution:
        take(config, int(amount))
    for config, _ in sorted(solution, key=lambda x: (-(x[1] % 1), sorted(x[0].items()))):
        take(config, 1)
    return out


def sequences(configs: list[tuple[Config, int]]) -> int:
    return sum(copies for _, copies in configs)


def configurations(counts: Config, capacity: int, rounds: int = 60, width: int = 48, slack: float = 0.002, rate: float = 0.05, passes: int = 5) -> list[tuple[Config, int]]:
    """Whole numbers of sequences for each configuration that take exactly ``counts``, never more than best fit alone needs."""
    wanted = {x: n for x, n in counts.items() if n}
    plain = best_fit(wanted, capacity)
    rest, out = {x: n for x, n in wanted.items() if x < capacity}, [({capacity: 1}, wanted[capacity])] if capacity in wanted else []
    for _ in range(passes):
        if not rest:
            break
        whole = rounded(fractional(rest, capacity, rounds, width, slack, rate), rest)
        out += whole
        rest = {x: n for x, n in rest.items() if n}
        if not whole:
            break
    out += best_fit(rest, capacity)
    return out if sequences(out) <= sequences(plain) else plain


def runs(configs: list[tuple[Config, int]], capacity: int) -> tuple[np.ndarray, ...]:
    """For each length, the stretches of ranks that configurations take.

    Arrays sorted by (length, first rank): key, first rank, pieces for each sequence, first sequence, offset.
    """
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for config, copies in configs:
        offset = 0
        for length in sorted(config, reverse=True):
            rank = taken.get(length, 0)
            rows.append(((length << 44) | rank, rank, config[length], sequence, offset))
            taken[length] = rank + config[length] * copies
            offset += length * config[length]
        sequence += copies
    return tuple(np.array(c, np.int64) for c in zip(*sorted(rows), strict=True)) if rows else (np.zeros(0, np.int64),) * 5


def pack(
    spark: SparkSession,
    df: DataFrame,
    capacity: int = 2048,
    end_id: int = 0,
    ranks_file: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every row.

    A null or empty text is the end id alone. Rows with equal or null ids are packed each by
    itself. Other columns are ignored. An empty table gives no rows. The driver sees one count
    for each length and sends out the stretches of ranks, whose number depends on the
    capacity and the solver's rounds, not on the documents.
    """
    steps = Steps(spark, "packing")
    cut = steps.save("pieces", pieces(df, capacity, end_id, ranks_file, id_col, text_col))
    sizes = steps.save("sizes", cut.groupBy("part", "length").agg(F.count("*").alias("n")))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    key, first, many, sequence, offset = runs(configurations(histogram, capacity), capacity)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy().astype(np.int64)
            rank = batch.column("rank").to_numpy().astype(np.int64)
            run = np.searchsorted(key, (length << 44) | rank, "right") - 1
            step = rank - first[run]
            columns = [batch.column(c) for c in ("doc_id", "piece", "start")]
            columns += [pa.array(length), batch.column("ids_crc32"), pa.array(sequence[run] + step // many[run])]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(offset[run] + step % many[run] * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    known = cut.join(starts.hint("merge"), ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("local")).alias("rank"))
    return known.mapInArrow(place, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
