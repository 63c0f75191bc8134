"""Conversation structure repair: faults, cheapest edits of the roles, and the repaired turns.

Turns are told by short facts (kind of role, first fault), which alone are gathered for the alignment
(``alignment``). The audits then meet the turns in one sorted stream, so a text moves once and no
conversation's texts are held together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from retailgrain.llm.alignment import ASSISTANT, BLANK, DUPLICATE, OTHER, SYSTEM, TRUNCATED, USER, cheapest, target
from retailgrain.llm.common import Steps

BLANKS = " \t\n\x0b\x0c\r"
FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
AUDIT = "conv_id bigint, " + ", ".join(f"{c} bigint" for c in FIGURES) + ", audit string"
NAMES = {"u": b"user", "a": b"assistant"}


def turns(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text); a null role or text is one space."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return df.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), *said)


def damaged(df: DataFrame) -> DataFrame:
    """Known faults, chosen by the CRC-32 of "conv_id:turn" modulo 20: turns dropped, emptied, cut, repeated, given to the user."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = turns(df).withColumn("_fault", F.crc32(key.cast("binary")) % 20).where("_fault <> 0")
    text = F.when(F.col("_fault") == 1, F.lit("")).when(F.col("_fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_fault") == 4, F.lit("user")).otherwise(F.col("role"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), "_fault")
    times = F.when(F.col("_fault") == 3, F.lit([1, 2])).otherwise(F.lit([1]))
    return rows.withColumn("_copy", F.explode(times)).drop("_copy", "_fault")


def digest() -> Column:
    return F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary"))


def facts(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, code): what the alignment has to know of each turn, without its text."""
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    named = rows.select("conv_id", "turn", "role", digest().alias("digest"), F.right(end, F.lit(1)).alias("last"))
    earlier = F.row_number().over(W.partitionBy("conv_id", "digest").orderBy("turn")) > 1
    state = F.when(F.col("last") == "", BLANK).when(earlier, DUPLICATE).when(~F.col("last").isin(".", "!", "?"), TRUNCATED).otherwise(0)
    first = F.substring("role", 1, 1)
    kind = F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(OTHER)
    return named.select("conv_id", "turn", "role", "digest", (kind + 4 * state).cast("int").alias("code"))


def groups(batch: pa.RecordBatch) -> Iterator[tuple[int | None, int, int]]:
    """Conversation, first and last row of every run of rows with one conv_id."""
    ids = batch.column("conv_id")
    valid, value = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
    cuts = np.flatnonzero((value[1:] != value[:-1]) | (valid[1:] != valid[:-1])) + 1
    edges = [0, *cuts.tolist(), len(value)]
    for i, j in zip(edges[:-1], edges[1:], strict=True):
        if i < j:
            yield (int(value[i]) if valid[i] else None), i, j


def figures(codes: np.ndarray, days: np.ndarray, size: int) -> tuple:
    kind, state = codes & 3, codes >> 2
    days = np.unique(days)
    before, after = kind[:-1], kind[1:]
    legal = ((before == SYSTEM) & (after == USER)) | ((before == USER) & (after == ASSISTANT)) | ((before == ASSISTANT) & (after == USER))
    cost, audit = cheapest(codes.tobytes(), size)
    gaps = int(days[-1]) - int(days[0]) + 1 - len(days) if len(days) else 0
    return (gaps, *[int((state == s).sum()) for s in (BLANK, DUPLICATE, TRUNCATED)], int((~legal).sum()), cost, audit)


def audits(rows: DataFrame, ids: DataFrame | None = None, size: int = 128) -> DataFrame:
    """One row for each conversation: gaps, faults, illegal neighbours, cost and audit of the cheapest edits.

    ``rows``: see ``turns``. Conversations of ``ids`` that have no turn get zeros and an empty audit. Turns are ordered
    by turn (nulls first), role and the digest of role and text; a null conv_id is a
    conversation of its own. One task sees a conversation's facts, a few bytes for each turn.
    """
    told = facts(rows).select("conv_id", "turn", "role", "digest", "code")
    if ids is not None:
        nobody = [F.lit(None).cast(kind).alias(c) for c, kind in (("turn", "bigint"), ("role", "string"), ("digest", "string"))]
        told = told.union(ids.select(F.col("conv_id").cast("bigint")).distinct().select("conv_id", *nobody, F.lit(-1)))
    told = told.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest").select("conv_id", "turn", "code")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, codes, days = (), [], []

        def closed() -> tuple:
            every = np.concatenate(codes)
            return (*now, *figures(every[every >= 0].astype(np.uint8), np.concatenate(days), size))

        for batch in batches:
            out, code, day = [], batch.column("code").to_numpy(), batch.column("turn")
            known, day = day.is_valid().to_numpy(zero_copy_only=False), day.fill_null(0).to_numpy()
            for conv, i, j in groups(batch):
                if now != (conv,):
                    if now:
                        out.append(closed())
                    now, codes, days = (conv,), [], []
                codes.append(code[i:j])
                days.append(day[i:j][known[i:j]])
            yield audit_rows(out)
        if now:
            yield audit_rows([closed()])

    return told.mapInArrow(align, AUDIT)


def audit_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * (1 + len(FIGURES)) + [pa.string()]
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["conv_id", *FIGURES, "audit"])


def stream(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """Each conversation's audit and behind it its turns, in order, for a step that reads them once."""
    said = ["role", "text"]
    heads = audited.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"), *[F.lit(None).cast("string").alias(c) for c in (*said, "digest")], F.struct(*FIGURES, "audit").alias("head"))
    follow = rows.select("conv_id", F.lit(1).alias("kind"), "turn", *said, digest().alias("digest"), F.lit(None).cast(heads.schema["head"].dataType).alias("head"))
    both = heads.union(follow).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    return both.select("conv_id", "turn", *[F.col(c).cast("binary").alias(c) for c in said], "head")


class Repair:
    """Applies one audit to turns that come one by one."""

    def __init__(self, audit: str):
        self.audit, self.roles, self.at, self.place = audit, target(audit), 0, 0

    def _role(self) -> str:
        self.place += 1
        return self.roles[self.place - 1]

    def inserted(self) -> Iterator[tuple[str, bytes]]:
        """Turns to insert before the next one, or at the end: edit, role."""
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield "I", NAMES[self._role()]

    def edited(self, role: bytes) -> tuple[str, bytes]:
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return edit, role
        wanted = self._role()
        return edit, role if edit == "K" else NAMES[wanted]


def hashed(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """The audits with ``repaired_sha256`` of each repaired conversation: its "role:text", joined by newlines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, head, repair, sha = (), None, None, None

        def put(role: bytes, text: bytes) -> None:
            sha.update((b"\n" if repair.place > 1 else b"") + role + b":")
            sha.update(text)

        def closed() -> tuple:
            for _, role in repair.inserted():
                put(role, b"")
            return (*now, *[head[c] for c in (*FIGURES, "audit")], sha.hexdigest())

        for batch in batches:
            out = []
            roles, texts, heads = (batch.column(c) for c in ("role", "text", "head"))
            is_head = heads.is_valid().to_pylist()
            for conv, i, j in groups(batch):
                for k in range(i, j):
                    if is_head[k]:
                        if now:
                            out.append(closed())
                        now, head, sha = (conv,), heads[k].as_py(), hashlib.sha256()
                        repair = Repair(head["audit"])
                        continue
                    for _, role in repair.inserted():
                        put(role, b"")
                    edit, role = repair.edited(roles[k].as_py())
                    if edit != "D":
                        put(role, texts[k].as_py())
            yield hash_rows(out)
        if now:
            yield hash_rows([closed()])

    def hash_rows(out: list[tuple]) -> pa.RecordBatch:
        batch = audit_rows([r[:-1] for r in out])
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array([r[-1] for r in out], pa.string())], [*batch.schema.names, "repaired_sha256"])

    return stream(rows, audited).mapInArrow(run, f"{AUDIT}, repaired_sha256 string")


def repaired(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """(conv_id, place, turn, role, text, edit): the repaired turns, counted from 0; inserted ones have no turn and an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, repair = None, None
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["conv_id", "place", "turn", "role", "text", "edit"])

        def fresh() -> list[tuple]:
            return [(now, repair.place - 1, None, role.decode(), "", edit) for edit, role in repair.inserted()] if repair else []

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                out += fresh()
                if row["head"] is not None:
                    now, repair = row["conv_id"], Repair(row["head"]["audit"])
                    continue
                edit, role = repair.edited(row["role"])
                if edit != "D":
                    out.append((now, repair.place - 1, row["turn"], role.decode(), row["text"].decode(), edit))
            yield batch_of(out)
        yield batch_of(fresh())

    return stream(rows, audited).mapInArrow(run, "conv_id bigint, place bigint, turn bigint, role string, text string, edit string")


def repair(spark: SparkSession, rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Figures, cost, audit and ``repaired_sha256`` for each conversation of ``rows`` and of ``ids``.

    Nulls: a role or text counts as one space, turns come first and leave no gap, a null conv_id is one conversation. Empty
    and blank texts are faults. Rows that repeat role and text are duplicates, whatever their turn; rows of one turn come
    in the order of role and digest. Very long texts are hashed as they come. Columns beyond the four are ignored.
    An empty table without ``ids`` gives no rows.
    """
    rows = turns(rows)
    steps = Steps(spark, "conversations")
    return hashed(rows, steps.save("audits", audits(rows, ids)))
