"""Search and pair operators on embeddings against brute force."""

from __future__ import annotations

import numpy as np
from helpers_llm import VECTORS, smallest_reachable, vectors

from retailgrain.llm import ann, covertree


def usable(v):
    return v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def test_pairs_equal_brute_force(spark):
    rows = vectors()
    got = covertree.dedup(spark, spark.createDataFrame(rows, VECTORS), cell_rows=24, block_rows=16).collect()
    ok = [(k, r[0], r[2], np.array(r[1]) / np.linalg.norm(r[1])) for k, r in enumerate(rows) if usable(r[1]) and r[2] is not None and r[0] is not None]
    links = [(a[1], b[1]) for i, a in enumerate(ok) for b in ok[i + 1 :] if a[2] == b[2] and a[3] @ b[3] >= 0.98]
    first = smallest_reachable([r[0] for r in rows if r[0] is not None], links)
    degree = {i: sum(i in pair for pair in links) for i in first}
    assert len(got) == len(rows) and len(links) > 50
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id, r.kept) == (degree[r.vec_id], first[r.vec_id], first[r.vec_id] == r.vec_id)


def test_search_finds_the_nearest_of_a_small_table(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, VECTORS)
    got = {}
    for r in sorted(ann.search(spark, df, df.where("vec_id % 20 = 0"), k=7).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    ok = [(r[0], np.array(r[1])) for r in rows if usable(r[1]) and r[0] is not None]
    queries = [x for x in ok if x[0] % 20 == 0]
    assert set(got) == {i for i, _ in queries}
    for i, q in queries:
        want = sorted(((-float((v * q).sum()), j) for j, v in ok if j != i))[:7]
        assert [j for j, _ in got[i]] == [j for _, j in want]
        assert np.allclose([s for _, s in got[i]], [-s for s, _ in want], rtol=0, atol=1e-12)


def test_search_with_many_lists_reaches_the_recall(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(c) for c in v], 0, "", 0) for i, v in enumerate(x)], VECTORS)
    found = ann.search(spark, df, df.where("vec_id % 20 = 0"), list_rows=100, sample=1500, block_rows=64).collect()
    got = {}
    for r in found:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 3000, 20):
        score = x.astype(float) @ x[q].astype(float)
        score[q] = -np.inf
        assert len(got[q]) == 20
        hits += len(got[q] & set(np.argsort(-score)[:20].tolist()))
    assert hits / (150 * 20) >= 0.9


def test_few_and_no_vectors(spark):
    three = spark.createDataFrame([r for r in vectors() if r[0] in (0, 20, 41)], VECTORS)
    assert ann.search(spark, three, three).count() == 6
    empty = spark.createDataFrame([], VECTORS)
    assert ann.search(spark, empty, empty).count() == 0
    assert covertree.dedup(spark, empty).count() == 0
