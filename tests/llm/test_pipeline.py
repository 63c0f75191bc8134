"""The pipeline's stages on rows with every awkward case, each against a plain version."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from helpers_llm import DOCS, awkward_rows, documents, prose, shingles, smallest_reachable

import corpus_pipeline
from retailgrain.llm import lines, packing, toxicity

EXTRA = {"size": "lines_dropped", "component_id": "_gone", "score": "score", "block": "_copies"}


def given() -> list[tuple]:
    import random

    rng = random.Random(11)
    rows = [(i, prose(rng, 40) + (" zorgfrak kritsch" * 3 if i % 7 == 0 else ""), "en", f"s{i % 3}", 0, 1, "a", "own", 5) for i in range(1000, 1200)]
    return awkward_rows(families=3, size=6) + rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables as the pipeline finds them, with columns called as the helpers of its stages."""
    path = str(tmp_path_factory.mktemp("tables"))
    docs = documents(spark, given()).withColumnsRenamed(EXTRA)
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(i % 7 == 0)) for i in range(1000, 1200)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder):
    """What each stage gets and gives, stored in between as the pipeline does."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/stage{k}")
        after = spark.read.parquet(f"{folder}/stage{k}")
        out.append((name, docs.collect(), after.collect(), docs.columns, after.columns))
        docs = after
    return out


def test_all_but_the_last_stage_keep_the_columns(stages):
    assert [name for name, *_ in stages] == ["toxicity", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "best-fit packing"]
    assert all(before == after for *_, before, after in stages[:-1])


def test_toxic_documents_go_and_no_other(stages):
    _, before, after, *_ = stages[0]
    toxic = {r.doc_id for r in before if r.doc_id is not None and r.doc_id >= 1000 and r.doc_id % 7 == 0}
    assert Counter(map(tuple, after)) == Counter(tuple(r) for r in before if r.doc_id not in toxic) and toxic


def test_repeated_lines_go_and_every_line_stays_once(stages):
    _, before, after, *_ = stages[1]
    assert Counter(r.doc_id for r in before) == Counter(r.doc_id for r in after)
    words = lambda rows: {w for r in rows if r.text for line in r.text.split("\n") if (w := lines.normal(line))}
    kept = [w for r in after if r.doc_id is not None and r.text for line in r.text.split("\n") if (w := lines.normal(line))]
    unique = Counter(kept)
    gone = words(r for r in before if r.doc_id is not None) - set(unique)

    def near(a, b):
        most = max(len(a), len(b)) // 5
        return lines.edit_distance(a, b, most) <= most

    for line in gone:  # what is gone is like something that stayed, perhaps over others that are gone
        assert any(near(line, w) for w in {*unique, *gone} - {line})
    assert all(r.n_chars == len(r.text) for r in after if r.text is not None)


def test_one_document_of_each_group_stays(stages):
    _, before, after, *_ = stages[2]
    sets = defaultdict(set)
    for r in before:
        if r.doc_id is not None:
            sets[r.doc_id].add(shingles(r.text))
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b])]
    first = smallest_reachable(ids, links)
    assert Counter(map(tuple, after)) == Counter(tuple(r) for r in before if r.doc_id is None or first[r.doc_id] == r.doc_id)


def test_the_mix_keeps_every_document(stages):
    _, before, after, *_ = stages[3]
    had, has = Counter(map(tuple, before)), Counter(map(tuple, after))
    assert set(had) == set(has) and all(has[r] >= n for r, n in had.items())


def test_sequences_hold_every_piece(stages):
    _, before, after, *_ = stages[4]
    encode = packing.encoding(None)
    want = Counter((r.doc_id, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in [*encode(r.text or ""), 0]))) for r in before if len(encode(r.text or "")) < 2048)
    assert Counter((r.doc_id, r.ids_crc32) for r in after if r.piece == 0 and r.length < 2048 and (r.doc_id, r.ids_crc32) in want) == want
    places = defaultdict(list)
    for r in after:
        places[r.sequence_id].append((r.offset, r.length))
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_run_gives_the_rows_of_its_stages(spark, folder, stages):
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == stages[4][4]
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert Counter(map(key, got.collect())) == Counter(map(key, stages[4][2]))


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_lines_of_rows_that_share_an_id(spark):
    shared = "a line that both rows hold with enough words in it"
    rows = [(1, shared + "\nfirst document has more"), (2, "first row of two\n" + shared), (2, "other row of two\nprecious unique sentence of the other"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = Counter(r.text for r in lines.dedup(spark, docs).collect())
    assert got == Counter([rows[0][1], "first row of two", rows[2][1], None])


def test_toxicity_of_long_texts_is_that_of_their_ngrams(spark, monkeypatch):
    """Read in pieces or at once, a text holds the same n-grams."""
    import numpy as np

    text = np.frombuffer((prose(__import__("random").Random(3), 4000)).encode(), np.uint8)
    wanted = np.ones(1 << toxicity.BITS, bool)
    _, whole = toxicity.held(text, np.array([0, len(text)]), wanted)
    for piece in (64, 1000, 1 << 20):
        monkeypatch.setattr(toxicity, "PIECE", piece)
        assert (toxicity.held_by_long(text, wanted) == whole).all()
