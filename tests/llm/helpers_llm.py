"""Small tables with every awkward case, and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, component_id string, score string, block int"


def prose(rng: random.Random, words: int) -> str:
    parts = ["the", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti"]
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(words))


def edited(rng: random.Random, text: str, changes: int) -> str:
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = prose(rng, 1) + "x"
    return " ".join(words)


def awkward_rows(seed: int = 5, families: int = 6, size: int = 8) -> list[tuple]:
    """Families of near copies, exact copies, nulls, empty, blank, one-word and very long texts, repeated rows and ids."""
    rng = random.Random(seed)
    rows, doc = [], 100
    for f in range(families):
        base = prose(rng, rng.randint(30, 120)).replace(" of ", "\nof ")
        for k in range(size):
            rows.append((doc, base if k % 3 == 0 else edited(rng, base, k), ["en", None, "de"][f % 3], "hot" if f % 2 else f"s{f}"))
            doc += 1
    rows += [(1, None, "en", "hot"), (2, "", None, None), (3, " \t\n ", "en", "hot"), (4, "one", "en", ""), (5, "ONE", "en", "hot"), (6, "a b c d", "fr", "hot")]
    rows += [(7, prose(rng, 30_000), "en", "long"), (8, "z" * 50_000, "en", "long"), (9, "é ñ ü " * 20, "es", "hot"), (9, "é ñ ü " * 20, "es", "hot")]
    rows += [(10, rows[0][1], "en", "hot"), (10, rows[8][1], "en", "hot"), (None, rows[0][1], "en", "hot"), (None, None, None, None), (0, "!!! ... ###", "en", "s0")]
    return [(i, t, lang, s, len(t or ""), 1, "clash", "clash", 7) for i, t, lang, s in rows]


def documents(spark, rows=None):
    return spark.createDataFrame(awkward_rows() if rows is None else rows, DOCS)


def shingles(text: str | None) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def smallest_reachable(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def vectors(seed: int = 3, size: int = 8) -> list[tuple]:
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(160):
        base = rng.standard_normal(size) if i % 4 == 0 else base + 0.05 * rng.standard_normal(size)
        rows.append((i, [float(np.float32(x)) for x in base], i // 8 % 3))
    rows += [(200, rows[0][1], 0), (201, rows[0][1], 0), (202, rows[0][1], None), (203, None, 0), (204, [0.0] * size, 0), (205, [1.0] * (size - 1), 0)]
    rows += [(206, [float("nan")] + [1.0] * (size - 1), 0), (207, [None] + [1.0] * (size - 1), 0), (208, [float("inf")] * size, 0), (None, rows[0][1], 0)]
    return [(*r, "clash", 1) for r in rows]


VECTORS = "vec_id bigint, embedding array<float>, label int, cell string, rank int"
