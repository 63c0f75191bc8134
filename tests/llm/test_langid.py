"""Language ID: gradients, whole texts, awkward rows, held-out accuracy."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from helpers_llm import DOCS, awkward_rows, documents

from retailgrain.llm import langid, queries


@pytest.fixture(scope="module")
def corpus():
    """Invented languages of different syllables."""
    rng, rows = random.Random(1), []
    parts = {"xa": ["ka", "lo", "mi"], "xb": ["sch", "ung", "er"], "xc": ["éa", "ñu", "ço"]}
    for i in range(600):
        lang = ["xa", "xb", "xc"][i % 3] if i % 50 else "xc"
        text = " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(3, 200)))
        rows.append((i, text, lang, "s", len(text), 1, "clash", "clash", 7))
    return rows


@pytest.fixture(scope="module")
def net(spark, corpus):
    return langid.fit(spark, documents(spark, corpus))


def test_held_out_languages_are_found(spark, corpus, net):
    got = langid.predict(documents(spark, corpus).select("doc_id", "text", "score"), net).collect()
    lang = {r[0]: r[2] for r in corpus}
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(got) == len(corpus) and len(held) > 100
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_query_finds_most_held_out_languages(spark, sf_dir):
    got = queries.QUERIES["op13_byte_convolution_language"](spark, sf_dir)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()
    lang, rows = {r.doc_id: r.lang for r in truth}, got.collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and lang[r.doc_id] is not None and r.lang_pred != "und"]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) >= 0.9


def test_probabilities_and_gradients_equal_a_plain_network():
    rng = np.random.default_rng(0)
    net = langid.start(("a", "b"), 3)
    windows = rng.integers(1, 256, (3, langid.WINDOW)).astype(np.uint8)
    windows[1, 50:] = 0
    y = np.array([0, 1, 1])

    def plain(table, filters, shifts, out):
        rows = []
        for window in windows:
            x, hidden = np.vstack([table[window], np.zeros((4, langid.DEPTH))]), []
            for width, weights in zip(langid.WIDTHS, filters):
                seen = [x[t : t + width].ravel() @ weights for t in range(langid.WINDOW)]
                hidden.append(np.max(seen, axis=0))
            z = np.maximum(np.concatenate(hidden) + shifts, 0) @ out[:-1] + out[-1]
            rows.append(np.exp(z) / np.exp(z).sum())
        return np.array(rows)

    params = [p.astype(float) for p in langid.parameters(net)]
    unpacked = lambda p: (p[0], p[1:5], p[5], p[6])
    loss = lambda p: -np.log(plain(*unpacked(p))[np.arange(3), y]).mean()
    assert np.allclose(langid.probabilities(net, windows), plain(*unpacked(params)), atol=1e-5)
    for k, g in enumerate(langid.gradients(net, windows, y)):
        for at in [np.unravel_index(i, g.shape) for i in np.argsort(-np.abs(g), axis=None)[:3]]:
            up, down = [p.copy() for p in params], [p.copy() for p in params]
            up[k][at] += 1e-4
            down[k][at] -= 1e-4
            assert abs((loss(up) - loss(down)) / 2e-4 - g[at]) < 1e-3


def test_whole_texts_count(spark, corpus, net):
    """One window of another language in front does not decide; a long text is the average of its windows."""
    a, b = (next(r[1] for r in corpus if r[2] == lang and len(r[1].encode()) > 600) for lang in ("xa", "xb"))
    long = a[: langid.WINDOW] + (" " + b) * 400
    docs = spark.createDataFrame([(1, long), (2, " " * 5000 + b), (3, b + "\n" + "1234 " * 3000)], "doc_id bigint, text string")
    assert {r.lang_pred for r in langid.predict(docs, net).collect()} == {"xb"}


def test_awkward_rows(spark, net):
    rows = awkward_rows()
    extra = documents(spark, rows).withColumnsRenamed({"n_chars": "_lettered", "size": "lang_pred"})
    got = langid.predict(extra, net)
    assert got.columns == [c for c in extra.columns if c not in ("score", "lang_pred")] + ["lang_pred", "score"]
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in net.langs
    by_text = {}
    for r in found:
        by_text.setdefault(r.text, set()).add((r.lang_pred, round(r.score, 6)))
    assert all(len(v) == 1 for v in by_text.values())


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], DOCS)
    assert langid.fit(spark, empty) is None
    assert langid.predict(empty, None).count() == 0
    one = langid.predict(documents(spark), None)
    assert {r.lang_pred for r in one.collect()} == {"und"}
