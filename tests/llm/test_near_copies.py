"""Jaccard join and line dedup against brute force."""

from __future__ import annotations

import random
import re

import pytest
from helpers_llm import DOCS, awkward_rows, documents, edited, prose, shingles, smallest_reachable

from retailgrain.llm import jaccard, lines, near, queries


def brute(rows):
    sets = {}
    for i, t, *_ in rows:
        if i is not None:
            sets.setdefault(i, set()).add(shingles(t))
    ids = sorted(sets)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b])
    ]
    return smallest_reachable(ids, links)


@pytest.mark.parametrize("seed", [5, 6])
def test_jaccard_join_equals_brute_force(spark, seed):
    rows = awkward_rows(seed, families=5, size=14)
    got = jaccard.join(spark, documents(spark, rows)).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles) for r in got) == sorted((r[0] is None, r[0] or 0, len(shingles(r[1]))) for r in rows)
    assert all(r.component_id == (None if r.doc_id is None else want[r.doc_id]) for r in got)


def test_chain_of_edits_is_one_group(spark):
    """Neighbours link, far ends do not; leader pairs alone would miss this."""
    rng = random.Random(2)
    text, rows = prose(rng, 200), []
    for i in range(60):
        rows.append((i, text, "en", "s", 0, 1, "", "", 1))
        text = edited(rng, text, 3)
    got = {r.doc_id: r.component_id for r in jaccard.join(spark, documents(spark, rows)).collect()}
    assert got == brute(rows)


def test_distinct_documents_keeps_one_of_each_group_and_all_columns(spark):
    docs = documents(spark)
    kept = jaccard.distinct_documents(spark, docs)
    want = brute(awkward_rows())
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, c in want.items() if i == c} | {None}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert jaccard.join(spark, empty).count() == 0
    assert lines.dedup(spark, empty).count() == 0


def normal_line(x):
    return lines.normal(x)


def test_exact_repeats_go_everywhere_but_first(spark):
    rows = awkward_rows()
    got = lines.dedup(spark, documents(spark, rows)).collect()
    assert len(got) == len(rows)
    seen = {}
    for i, t, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for k, line in enumerate((t or "").split("\n")):
            if lines.normal(line):
                seen.setdefault(lines.normal(line), (i, k))
    left = {}
    for r in got:
        for line in (r.text or "").split("\n"):
            if r.doc_id is not None and lines.normal(line):
                left.setdefault(lines.normal(line), []).append(r.doc_id)
    assert all(len(set(v)) == 1 and seen[k][0] == v[0] for k, v in left.items())
    assert {r.text for r in got if r.doc_id is None} == {None, rows[0][1]}  # rows without id are left alone
    assert [r.text for r in got if r.doc_id == 1] == [None]
    assert [r.text for r in got if r.doc_id == 0] == ["!!! ... ###"]


def test_fuzzy_lines_match_brute_force(spark):
    rng = random.Random(9)
    base = [prose(rng, 60) for _ in range(12)]
    rows = [(i, "\n".join([edited(rng, base[i % 12], i % 3), prose(rng, 25)]), "en", "s", 0, 1, "", "", 1) for i in range(120)]
    got = {r.doc_id: r.lines_dropped or [] for r in lines.dedup(spark, documents(spark, rows)).collect()}
    occurrences = [(i, k, lines.normal(x)) for i, t, *_ in rows for k, x in enumerate(t.split("\n"))]
    sims = {}
    for i, k, x in occurrences:
        import numpy as np

        data = np.frombuffer(x.encode(), np.uint8)
        sims[i, k] = int(lines.parts(data, np.array([0, len(data)]))[4][0])
    links = []
    for a, (i, k, x) in enumerate(occurrences):
        for j, m, y in occurrences[a + 1 :]:
            most = max(len(x), len(y)) * 20 // 100
            if (sims[i, k] ^ sims[j, m]).bit_count() <= 3 and lines.edit_distance(x, y, most) <= most:
                links.append(((i, k), (j, m)))
    first = smallest_reachable([(i, k) for i, k, _ in occurrences], links)
    want = {i: sorted(k for j, k, _ in occurrences if j == i and first[j, k] != (j, k)) for i in range(120)}
    assert got == want
    assert sum(map(len, want.values())) > 60


def test_query_finds_lines_similar_by_the_plain_definition(spark, tmp_path):
    """Edit similarity of 0.8 alone, without fingerprints; a replaced word in short and long lines."""
    rng = random.Random(12)
    rows = []
    for words in (6, 8, 12, 15, 20, 30, 40, 60) * 5:
        base = prose(rng, words)
        rows += [(len(rows) + k, "\n".join([prose(rng, 12), edited(rng, base, k)])) for k in range(3)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, k) for r in queries.op1_simhash_lines(spark, str(tmp_path)).collect() for k in r.lines_dropped or []}
    texts = [(i, k, lines.normal(x)) for i, t in rows for k, x in enumerate(t.split("\n"))]
    links = []
    for a, (i, k, x) in enumerate(texts):
        for j, m, y in texts[a + 1 :]:
            most = max(len(x), len(y)) * 20 // 100
            if lines.edit_distance(x, y, most) <= most:
                links.append(((i, k), (j, m)))
    first = smallest_reachable([(i, k) for i, k, _ in texts], links)
    want = {n for n, f in first.items() if n != f}
    assert got <= want
    assert len(want) >= 60 and len(got) >= 0.95 * len(want)


def test_any_cut_into_blocks_finds_the_same(spark):
    rng = random.Random(4)
    base = prose(rng, 80)
    docs = documents(spark, [(i, edited(rng, base, i % 4), "en", "s", 0, 1, "", "", 1) for i in range(80)])
    results = [
        sorted((r.doc_id, tuple(r.lines_dropped or [])) for r in lines.dedup(spark, docs, blocks=b, match=m, small=s).collect())
        for b, m, s in ((5, 2, 64), (4, 1, 2), (6, 3, 1000))
    ]
    assert results[0] == results[1] == results[2]


def test_edit_distance_equals_the_table_form():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ("".join(rng.choices("abé", k=rng.randint(0, 12))) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            above, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        most = rng.randint(0, 12)
        got = lines.edit_distance(a, b, most)
        assert got == row[-1] if row[-1] <= most else got > most


def test_pairs_compared_together_are_those_of_one_by_one():
    """Lengths around the words of 64 characters, characters beyond ASCII, more pairs than are taken at a time."""
    import numpy as np

    rng = random.Random(31)
    a = ["".join(rng.choices("abcé漢𝄞 ", k=rng.choice([0, 1, 5, 63, 64, 65, 128, 130]))) for _ in range(700)]
    b = []
    for x in a:
        y = list(x)
        for _ in range(rng.randint(0, len(x) // 3 + 1)):
            k = rng.randint(0, len(y))
            y[k : k + rng.choice([0, 1, 1])] = rng.choice(["", "d", "b"])
        b.append("".join(y))
    a, b = [*a, "a" * 1500, ""], [*b, "a" * 1400, "x"]
    most = np.array([max(len(x), len(y)) * 20 // 100 for x, y in zip(a, b, strict=True)])
    want = [lines.edit_distance(x, y, m) <= m for x, y, m in zip(a, b, most.tolist(), strict=True)]
    assert lines.close(a, b, most).tolist() == want and 100 < sum(want) < 600
    order = sorted(range(len(a)), key=lambda i: -max(len(a[i]), len(b[i])))
    short, long = ([f((a[i], b[i]), key=len) for i in order] for f in (min, lambda p, key: max(p[::-1], key=key)))
    assert lines.distances(short, long).tolist() == [lines.edit_distance(x, y, 2000) for x, y in zip(short, long, strict=True)]
    assert lines.close([], [], np.zeros(0, np.int64)).tolist() == []


def test_groups_meet_once_for_each_row_of_shared_keys(spark):
    """Every pair of different components meets; equal neighbours among its keys do not make it meet again."""
    from pyspark.sql import functions as F

    rng = random.Random(8)
    rows = []
    for g in range(40):
        keys = sorted(set(range(60)) - set(rng.sample(range(60), rng.choice([0, 3, 20, 55]))))
        rows += [(k, g, pos, rng.random() < 0.3 and g % 5 == 0, g // 2) for pos, k in enumerate(keys)]
    # Under each key one component at most is the main one.
    rows = [(k, g, pos, main and g // 10 == k % 4, part if part % 5 else 100 + g // 10) for k, g, pos, main, part in rows]
    table = spark.createDataFrame(rows, "key bigint, g bigint, pos int, in_main boolean, part bigint")
    main = table.where("in_main").groupBy("key").agg(F.min("part").alias("top"))
    table = table.join(main, "key", "left").withColumn("in_main", F.coalesce(F.col("part") == F.col("top"), F.lit(False))).drop("top")
    got = [(r.g, r.h) for r in near.meetings(near.chained(table, [F.col("pos")]), lambda a, b: F.lit(True)).collect()]
    keys, part = {}, {}
    for k, g, _, _, p in rows:
        keys.setdefault(g, set()).add(k)
        part[g] = p
    want = {(a, b) for a in keys for b in keys if a < b and part[a] != part[b] and keys[a] & keys[b]}
    assert set(got) == want
    assert len(got) * 3 < sum(len(keys[a] & keys[b]) for a, b in want)


def test_lines_go_by_short_numbers(spark, monkeypatch):
    """Links and components of lines hold numbers, not the place and hashes of each line."""
    seen = []
    plain = lines.connected
    monkeypatch.setattr(lines, "connected", lambda steps, shared, members, *rest: seen.append(members.schema["m"].dataType.simpleString()) or plain(steps, shared, members, *rest))
    rng = random.Random(3)
    base = prose(rng, 60)
    docs = documents(spark, [(i, edited(rng, base, i % 2), "en", "s", 0, 1, "", "", 1) for i in range(6)])
    got = {r.doc_id: r.lines_dropped or [] for r in lines.dedup(spark, docs, bands=lines.BANDS).collect()}
    assert seen == ["bigint"]
    assert got[0] == [] and sum(map(len, got.values())) == 5


def counted(monkeypatch, module, name):
    """Pairs that reach ``module.name``, which verifies them."""
    seen, plain = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda pairs, percent: seen.append(pairs.count()) or plain(pairs, percent))
    return seen


def test_documents_that_share_a_passage_are_not_all_verified(spark, monkeypatch):
    """Half of each text is the same, so all meet under many keys, but no two link; a few real copies are among them."""
    rng = random.Random(21)
    passage = prose(rng, 80)
    rows = [(i, f"{passage} {prose(rng, 70)}") for i in range(90)]
    rows += [(100 + i, edited(rng, t, 2)) for i, t in rows[:10]]
    rows.append((5, rows[40][1]))  # an id with two texts
    seen = counted(monkeypatch, jaccard, "linked")
    got = {r.doc_id: r.component_id for r in jaccard.join(spark, spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == brute(rows)
    assert sum(seen) < 1000  # of some 4,950


def test_lines_that_look_alike_are_not_all_verified(spark, monkeypatch):
    """Lines that begin alike and end in other words, so that most meet under some key; a few real copies are among them."""
    rng = random.Random(22)
    start = prose(rng, 9)
    rows = [(i, f"{start} {prose(rng, 2 + i % 12)}") for i in range(120)]
    rows += [(200 + i, edited(rng, t, 1)) for i, t in rows[40:60]]
    seen = counted(monkeypatch, lines, "similar")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id for r in lines.dedup(spark, docs, bands=lines.BANDS).collect() if r.lines_dropped}
    texts = [(i, lines.normal(t)) for i, t in rows]
    links = [
        (i, j) for k, (i, x) in enumerate(texts) for j, y in texts[k + 1 :]
        if lines.edit_distance(x, y, most := max(len(x), len(y)) * 20 // 100) <= most
    ]
    first = smallest_reachable([i for i, _ in texts], links)
    want = {i for i, f in first.items() if i != f}
    assert got <= want and len(got) >= 0.9 * len(want) >= 18
    assert sum(seen) < 2200


def test_traits_allow_every_pair_that_links(spark):
    """Letter counts bound the edit distance, bits the difference of two sets; both are plain sums here."""
    rng = random.Random(23)
    texts = [lines.normal(prose(rng, rng.randint(1, 12)) + rng.choice(["", " 42", " é", " ß7"])) for _ in range(60)]
    texts += [lines.normal(edited(rng, t, 1)) for t in texts] + ["", "a"]
    rows = spark.createDataFrame(list(enumerate(texts)), "m bigint, text string")
    counts = {r.m: r.traits for r in lines.letter_counts(rows).collect()}
    assert [sum(counts[i][:-1]) for i in range(len(texts))] == [counts[i][-1] for i in range(len(texts))] == [len(t) for t in texts]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts[:i]):
            apart = sum(abs(x - y) for x, y in zip(counts[i], counts[j], strict=True))
            assert apart <= 2 * lines.edit_distance(a, b, len(a) + len(b) + 1)
    sets = [sorted(rng.sample(range(1 << 56), rng.randint(1, 300))) for _ in range(30)]
    sets += [sorted({*rng.sample(s, len(s) - len(s) // 10), *rng.sample(range(1 << 56), 5)}) for s in sets]
    tokens = [(i, bytearray(b"".join(x.to_bytes(7, "little") for x in s))) for i, s in enumerate(sets)]
    bits = {r.m: r.traits for r in jaccard.parities(spark.createDataFrame(tokens, "m bigint, tokens binary")).collect()}
    for i, a in enumerate(sets):
        assert len(bits[i]) * 64 == jaccard.TRAIT_BITS
        for j, b in enumerate(sets[:i]):
            assert sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(bits[i], bits[j], strict=True)) <= len(set(a) ^ set(b))


def test_postings_of_lines_move_once(spark, monkeypatch):
    """Repeated postings go and keys are counted behind one exchange by key."""
    from retailgrain.llm.common import Steps

    plans, plain = {}, Steps.save

    def save(self, name, df):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return plain(self, name, df)

    monkeypatch.setattr(Steps, "save", save)
    rng = random.Random(24)
    docs = spark.createDataFrame([(i, prose(rng, 20)) for i in range(30)], "doc_id bigint, text string")
    lines.dedup(spark, docs, bands=lines.BANDS).count()
    assert plans["blocks"].count("Exchange hashpartitioning(key#") == 1
    assert not re.search(r"hashpartitioning\(g#\w+, key#", plans["blocks"])


def test_pairs_that_cannot_link_make_no_keys(spark, monkeypatch):
    """Lines that share most words meet, but where other letters keep them apart, they are no candidates."""
    from retailgrain.session import settings

    seen = []
    nothing = spark.createDataFrame([], "node bigint, component bigint")
    monkeypatch.setattr(lines, "connected", lambda steps, shared, *rest: seen.extend((r.key, r.g) for r in shared.collect()) or nothing)
    rng = random.Random(33)
    start = prose(rng, 30)
    texts = [f"{start} {rng.choice('zyxwvu') * 30} {rng.choice('zyxwvu') * 30}" for _ in range(30)]
    texts = sorted({*texts, *[edited(rng, t, 1) for t in texts[:4]]})
    docs, keys = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), []
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4"}):
        for _ in range(2):
            seen.clear()
            lines.repeated(spark, docs, bands=lines.BANDS)
            keys.append(len({k for k, _ in seen}))
            assert len(seen) == 2 * keys[-1]
            monkeypatch.setattr(lines, "possible", lambda pairs, looks, alike: pairs)
    plain = sorted({lines.normal(t) for t in texts})
    both = [(x, y, max(len(x), len(y)) * 20 // 100) for i, x in enumerate(plain) for y in plain[:i]]
    likely = [p for p in both if sum(abs(p[0].count(c) - p[1].count(c)) for c in {*p[0], *p[1]}) <= 2 * p[2]]
    assert sum(lines.edit_distance(*p) <= p[2] for p in both) >= 4
    assert 0 < keys[0] <= len(likely) < keys[1]
