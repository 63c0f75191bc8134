"""Conversation repair against a version that tries every edit of every target."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from retailgrain.llm import alignment, conversations, queries

TURNS = "conv_id bigint, turn bigint, role string, text string, audit string, kind int, head string"


def plain_audit(codes: bytes) -> tuple[int, str]:
    n, found = len(codes), []
    for length in [0, *range(2, 2 * n + 4)]:
        wanted = "s" * (length % 2) + "ua" * (length // 2)

        @cache
        def best(i, j):
            if i == n and j == length:
                return 0, ""
            ways = []

            def way(cost, letter, rest):
                if rest is not None:
                    ways.append((cost + rest[0], letter + rest[1]))

            if i < n:
                kind, state = codes[i] & 3, codes[i] >> 2
                way(4, "D", best(i + 1, j))
                if state < 2 and j < length:
                    way(3 * state, "K", best(i + 1, j + 1) if "sua."[kind] == wanted[j] else None)
                    way(3 * state + 3, "R", best(i + 1, j + 1) if wanted[j] != "s" else None)
            if j < length and wanted[j] != "s":
                way(3, "I", best(i, j + 1))
            return min(ways, default=None)

        found.append(best(0, 0))
    return min(x for x in found if x is not None)


def plain(rows: list[tuple]) -> dict:
    """What the contract says, turn by turn; rows: (conv_id, turn, role, text)."""
    said = lambda x: " " if x is None else str(x)
    kept: dict = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        role, text = said(role), said(text)
        fault = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        kept[conv] += [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    out = {}
    for conv, turns in kept.items():
        order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).hexdigest())
        turns.sort(key=order)
        seen, codes, counts = set(), [], {1: 0, 2: 0, 3: 0}
        for _, role, text in turns:
            visible = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            state = 2 if not visible else 3 if (role, text) in seen else 1 if visible[-1] not in ".!?" else 0
            seen.add((role, text))
            codes.append({"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + 4 * state)
            counts[state] = counts.get(state, 0) + 1
        days = {t for t, *_ in turns if t is not None}
        gaps = max(days) - min(days) + 1 - len(days) if days else 0
        initials = [r[:1] for _, r, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = plain_audit(bytes(codes))
        wanted, at, lines = alignment.target(audit), iter(turns), []
        for letter in audit:
            if letter == "D":
                next(at)
                continue
            name = {"s": "system", "u": "user", "a": "assistant"}[wanted[len(lines)]]
            turn = next(at) if letter != "I" else None
            lines.append(f"{name}:" if letter == "I" else f"{turn[1] if letter == 'K' else name}:{turn[2]}")
        out[conv] = (gaps, counts[2], counts[3], counts[1], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def awkward(seed: int) -> list[tuple]:
    rng, rows = random.Random(seed), []
    texts = ["Yes.", "No", "What?\n", "", "  \t", "é!", "...", "x" * 3, None]
    for conv in range(120):
        for turn in range(rng.randint(1, 7)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            role = rng.choice(["system", "tool", "", None, "User"]) if rng.random() < 0.1 else role
            rows.append((conv, turn if rng.random() < 0.95 else None, role, rng.choice(texts) if rng.random() < 0.3 else f"{conv} says {turn}."))
    rows += [rows[5], rows[5], (None, None, None, None), (None, 3, "user", "Lost."), (500, 1, "user", "z" * 300_000 + "."), (-7, -3, "system", "One.")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_equals_the_plain_version(spark, seed):
    rows = awkward(seed)
    df = spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], TURNS)
    got = {r.conv_id: tuple(r)[1:] for r in conversations.repair(spark, conversations.damaged(df), df).collect()}
    assert got == plain(rows)


def test_query_equals_the_plain_version(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.QUERIES["op12_banded_turn_repair"](spark, sf_dir)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r.conv_id: tuple(r)[1:] for r in got.collect()} == plain(rows)


def test_repaired_turns_are_those_that_were_hashed(spark):
    df = spark.createDataFrame([(*r, "", 1, "") for r in awkward(3)], TURNS)
    rows = conversations.turns(conversations.damaged(df))
    texts: dict = {}
    for r in sorted(conversations.repaired(rows, conversations.audits(rows, df)).collect(), key=lambda r: r.place):
        texts.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        assert r.edit in "KRI" and (r.edit != "I" or r.text == "")
    for r in conversations.repair(spark, rows, df).collect():
        assert hashlib.sha256("\n".join(texts.get(r.conv_id, [])).encode()).hexdigest() == r.repaired_sha256


def test_blocks_and_bands_change_nothing():
    rng = random.Random(4)
    for _ in range(150):
        codes = bytes(rng.choices(range(4), rng.choice([[1, 1, 1, 1], [1, 4, 4, 0], [0, 6, 6, 1]]))[0] + 4 * rng.choices(range(4), [5, 2, 1, 1])[0] for _ in range(rng.randint(0, 9)))
        want = plain_audit(codes)
        assert all(alignment.cheapest(codes, size) == want for size in (128, 1, 2, 3, 5))


def test_a_long_conversation_is_aligned_in_blocks():
    rng = random.Random(5)
    codes = bytes((1 + k % 2 if rng.random() < 0.9 else rng.randrange(4)) + 4 * rng.choices(range(4), [14, 2, 1, 1])[0] for k in range(700))
    assert alignment.cheapest(codes, 128) == alignment.cheapest(codes, 700) == alignment.cheapest(codes, 37)


def test_empty_table(spark):
    empty = spark.createDataFrame([], TURNS)
    assert conversations.repair(spark, empty, empty).count() == 0
    assert conversations.repaired(empty, conversations.audits(empty)).count() == 0
