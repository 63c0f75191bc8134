"""Mixing, packing, toxicity, quality, HTML text and sharding."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers_llm import DOCS, awkward_rows, documents, prose

from retailgrain.llm import htmltext, kneser, mixing, packing, sharding, toxicity

LABELS = "doc_id bigint, quality int, toxic int"


def test_shards_obey_the_key_law(spark):
    rows = awkward_rows()
    got = sharding.shard(documents(spark, rows), 40).collect()
    assert len(got) == len(rows)
    by_id = defaultdict(set)
    for r in got:
        by_id[r.doc_id].add(r.shard)
        assert 0 <= r.shard < 40 and r.law == "key" and r.grown_shard in (r.shard, 40)
    assert all(len(v) == 1 for v in by_id.values())
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(spark.createDataFrame([], DOCS), 40).count() == 0


def test_placement_equals_a_plain_walk_down_the_tree(spark):
    """Each level draws -ln(u) / weight for every child from an md5, and the smallest draw wins."""
    import hashlib

    def draw(key, child, weight):
        u = (int(hashlib.md5(f"{key}/{child}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
        return -math.log(u) / weight

    def walk(key, tree):
        region = min(tree, key=lambda r: draw(key, r.name, r.weight))
        rack = min(region.racks, key=lambda k: draw(key, k.name, k.weight))
        return min(rack.shards, key=lambda s: draw(key, f"{rack.name}.s{s[0]}", s[1]))[0]

    rows = [(i, "t") for i in range(-5, 400)] + [(None, "t")]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id bigint, text string"), 40).collect()
    for r in got:
        key = "null" if r.doc_id is None else str(r.doc_id)
        assert (r.shard, r.grown_shard) == (walk(key, sharding.plan_tree(40)), walk(key, sharding.plan_tree(41)))


def test_growth_moves_an_even_share_into_the_new_shard_only(spark):
    ids = spark.range(20_000).selectExpr("id as doc_id", "cast(id as string) as text")
    for n in (40, 41, 47):
        placed = sharding.shard(ids, n).collect()
        moved = [r for r in placed if r.shard != r.grown_shard]
        assert all(r.grown_shard == n for r in moved)
        assert abs(len(moved) - 20_000 / (n + 1)) < 5 * math.sqrt(20_000 / n)
        assert max(Counter(r.shard for r in placed).values()) < 1.3 * 20_000 / n


def test_a_change_of_weight_moves_rows_of_that_subtree_only(spark):
    rack = lambda name, *w: sharding.Rack(name, tuple((int(name[1]) * 100 + int(name[4]) * 10 + i, x) for i, x in enumerate(w)))
    before = (sharding.Region("r0", (rack("r0.k0", 1, 1), rack("r0.k1", 1, 1))), sharding.Region("r1", (rack("r1.k0", 1, 1),)))
    after = (before[0], sharding.Region("r1", (rack("r1.k0", 1, 3),)))
    from pyspark.sql import functions as F

    key = F.col("id").cast("string")
    for a, b in spark.range(5000).select(sharding.place(key, before), sharding.place(key, after)).collect():
        assert a == b or b >= 100  # whatever moved went into the region that grew


@pytest.mark.parametrize("limit", [1.5, 4.0])
def test_mix_meets_its_target(spark, limit):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randint(5, 60)), "en", "big" if i % 3 else f"s{i % 5}", 0, 1, "", "", 1) for i in range(600)]
    got = mixing.mix(spark, documents(spark, rows), entropy=1.0, max_repeats=limit, block_tokens=2000).collect()
    tokens = {r[0]: len(r[1].split()) for r in rows}
    own, mixed, uses = Counter(), Counter(), Counter()
    for r in rows:
        own[r[3]] += tokens[r[0]]
    weight = {}
    for r in got:
        mixed[r.source] += r.tokens
        uses[r.doc_id, r.epoch] += 1
        weight[r.source] = r.weight
    assert {i for i, _ in uses} == set(tokens) and set(uses.values()) == {1}  # all kept, once in an epoch
    repeats = {s: mixed[s] / own[s] for s in own}
    assert max(repeats.values()) <= limit + 0.1 and min(repeats.values()) == 1
    total = sum(mixed.values())
    assert all(abs(mixed[s] / total - weight[s]) < 0.01 for s in own) and abs(sum(weight.values()) - 1) < 1e-6
    # One exponent explains all weights.
    power = [math.log(weight[s] / weight["big"]) / math.log(own[s] / own["big"]) for s in own if s != "big"]
    assert max(power) - min(power) < 0.02 and -1e-6 <= min(power)
    blocks = defaultdict(Counter)
    for r in got:
        blocks[r.block][r.source] += r.tokens
    places = defaultdict(list)
    for r in got:
        places[r.block].append(r.position)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    n = len(blocks)
    assert abs(n - total / 2000) <= 1  # of the budget, which a source overruns by less than a document
    for b in blocks.values():
        assert all(abs(b[s] - mixed[s] / n) <= 2 * 60 for s in own)


def test_mix_of_awkward_documents(spark):
    rows = awkward_rows()
    docs = documents(spark, rows)
    got = mixing.mix(spark, docs).collect()
    assert {(r.doc_id, r.source) for r in got} == {(r[0], r[3]) for r in rows}
    assert sum(r.n_rows for r in got if r.epoch == 0) == len(rows)
    many = mixing.mixed_documents(spark, docs)
    assert many.columns == docs.columns
    want = Counter()
    for r in got:
        want[r.doc_id, r.source] += r.n_rows
    assert Counter((r.doc_id, r.source) for r in many.collect()) == want
    assert mixing.mix(spark, spark.createDataFrame([], DOCS)).count() == 0


def tokens_of(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return t.encode(text or "", add_special_tokens=False).ids + [0]


def test_packing_is_an_exact_round_trip(spark):
    rows = awkward_rows() + [(500, "a<|endoftext|>b 's'LL \u0085  x​y  \n\n z\t١٢٣ 👩‍🚀", "en", "s", 0, 1, "", "", 1)]
    got = packing.pack(spark, documents(spark, rows), capacity=64).collect()
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
    want = defaultdict(Counter)
    for i, t, *_ in rows:
        ids = np.array(tokens_of(t), "<u4")
        first = (len(ids) - 1) % 64 + 1
        cuts = [0, *range(first, len(ids) + 1, 64)]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            want[i][k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert {i: Counter((r.piece, r.start, r.length, r.ids_crc32) for r in p) for i, p in pieces.items()} == dict(want)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for s in sequences.values():
        end = 0
        for at, length in sorted(s):
            assert at == end
            end += length
        assert end <= 64
    least = math.ceil(sum(r.length for r in got) / 64)
    assert least <= len(sequences) <= least * 1.02 + 2
    assert packing.pack(spark, spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("n", [3, 400, 20_000])
def test_configurations_take_all_pieces_and_few_sequences(n):
    rng = np.random.default_rng(n)
    lengths, counts = np.unique(np.minimum(2048, rng.lognormal(6, 1.2, n).astype(int) + 1), return_counts=True)
    wanted = dict(zip(lengths.tolist(), counts.tolist(), strict=True))
    configs = packing.configurations(wanted, 2048)
    taken = Counter()
    for config, copies in configs:
        assert sum(a * b for a, b in config.items()) <= 2048 and copies > 0
        for a, b in config.items():
            taken[a] += b * copies
    assert taken == Counter(wanted)
    assert sum(k for _, k in configs) <= math.ceil(int((lengths * counts).sum()) / 2048) * 1.01 + 2
    assert packing.sequences(configs) <= packing.sequences(packing.best_fit(wanted, 2048))


@pytest.mark.parametrize("n", [60, 400, 20_000])
def test_the_program_places_pieces_at_every_size(n):
    rng = np.random.default_rng(n)
    lengths, counts = np.unique(np.minimum(2047, rng.lognormal(5.5, 1.0, n).astype(int) + 1), return_counts=True)
    rest = dict(zip(lengths.tolist(), counts.tolist(), strict=True))
    solution = packing.fractional(rest, 2048, 60, 48, 0.002, 0.05)
    whole = packing.rounded(solution, rest)
    placed = sum(copies * sum(config.values()) for config, copies in whole)
    assert placed >= 0.15 * n and placed + sum(rest.values()) == n and min(rest.values()) >= 0  # by the first of five solutions


def test_knapsack_against_all_fillings():
    rng = np.random.default_rng(2)
    lengths, price = np.array([3, 5, 7, 11]), rng.random(4)
    best, last = packing.knapsack(lengths, price, 30)
    top = max(a * price[0] + b * price[1] + c * price[2] + d * price[3] for a in range(11) for b in range(7) for c in range(5) for d in range(3) if 3 * a + 5 * b + 7 * c + 11 * d <= 30)
    config = packing.filling(int(last[30]), lengths, last, 30)
    assert math.isclose(best[30], top) and sum(k * v for k, v in config.items()) <= 30


def labelled(spark, bad: str, seed=1, n=400):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words, mark = prose(rng, rng.randint(10, 80)).split(" "), i % 5 == 0
        if mark:
            words.insert(rng.randrange(len(words)), bad)
        rows.append((i, " ".join(words), "en", "s", 0, 1, "", "", 1))
        labels.append((i, 1, int(mark)))
    return rows, labels


def test_toxicity_is_learned_and_held_out_labels_are_not_used(spark):
    rows, labels = labelled(spark, "zwkrvq")
    docs = documents(spark, rows + [(None, "zwkrvq", None, None, 0, 1, "", "", 1), (900, None, None, None, 0, 1, "", "", 1), (901, "", None, None, 0, 1, "", "", 1)])
    table = spark.createDataFrame(labels, LABELS)
    model = toxicity.fit(spark, docs, table)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    toxic = {i for i, _, t in labels if t}
    assert {i for i, r in got.items() if r.predicted and i is not None} == toxic
    assert got[900].score == got[901].score < 0.3 and all(0 <= r.score <= 1 for r in got.values())
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    turned = spark.createDataFrame([(i, q, 1 - t if i in set(held) else t) for i, q, t in labels], LABELS)
    other = toxicity.fit(spark, docs, turned)
    assert np.array_equal(model.weights, other.weights) and model.bias == other.bias
    kept = toxicity.clean(spark, docs, table)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {*range(400), 900, 901} - toxic


def plain_features(text) -> set:
    """Hashes of a text's 4- to 6-grams, one by one."""
    folded = bytes(toxicity.FOLD[b] for b in (text or "").encode())
    return {int(toxicity.grams(np.frombuffer(folded[i : i + n], np.uint8), n)[0]) for n in toxicity.ORDERS for i in range(len(folded) - n + 1)}


def test_weights_and_scores_equal_a_plain_fit(spark):
    rows, labels = labelled(spark, "zorgfrak", n=120)
    rows += [(900, None, "en", "s", 0, 1, "", "", 1), (901, "", "en", "s", 0, 1, "", "", 1), rows[3]]
    table = spark.createDataFrame([*labels, (3, 0, 1), (None, 1, 1)], LABELS)
    model = toxicity.fit(spark, documents(spark, rows), table, least=5.0)
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    toxic = {i: max(t for j, _, t in [*labels, (3, 0, 1)] if j == i) for i in range(120) if not held(i)}
    taught = [(plain_features(r[1]), toxic[r[0]]) for r in rows if r[0] in toxic]
    size = 1 << toxicity.BITS
    counts = np.zeros((2, size))
    for features, y in taught:
        counts[y][list(features)] += 1
    n_pos = sum(y for _, y in taught)
    r = toxicity.ratios(counts[1], counts[0], n_pos, len(taught) - n_pos, 5.0)
    assert ((model.weights != 0) <= (r != 0)).all()
    assert {i for i in np.flatnonzero(r) if any(i in f for f, _ in taught)} >= set(np.flatnonzero(model.weights))
    got = {x.doc_id: x for x in toxicity.score(documents(spark, rows), model).collect()}
    for i, text, *_ in rows:
        z = model.bias + sum(float(model.weights[f]) for f in plain_features(text))
        want = 1 / (1 + math.exp(-max(-60, min(60, z))))
        assert math.isclose(got[i].score, want, rel_tol=1e-5, abs_tol=1e-9) and got[i].predicted == int(got[i].score >= 0.3)
    # The learned weights are a minimum of the penalised loss, as far as the steps go: flipping their sign is worse.
    def loss(scale):
        total = 0.0
        for features, y in taught:
            z = model.bias + scale * sum(float(model.weights[f]) for f in features)
            total += math.log1p(math.exp(-z if y else z))
        return total
    assert loss(1.0) < loss(0.5) < loss(0.0) < loss(-1.0)


def test_scoring_an_empty_table_and_clashing_columns(spark):
    rows, labels = labelled(spark, "zorgfrak", n=60)
    docs, table = documents(spark, rows), spark.createDataFrame(labels, LABELS)
    model = toxicity.fit(spark, docs, table)
    assert toxicity.score(spark.createDataFrame([], DOCS), model).count() == 0
    named = docs.withColumnsRenamed({"size": "_rejected", "block": "predicted"})
    kept = toxicity.clean(spark, named, table)
    assert kept.columns == named.columns and {r.score for r in kept.collect()} == {""}  # the caller's own column


def test_toxicity_without_labels(spark):
    docs = documents(spark)
    model = toxicity.fit(spark, docs, spark.createDataFrame([(1, None, None)], LABELS))
    assert {r.predicted for r in toxicity.score(docs, model).collect()} == {0}


def brute_kneser(train: list[bytes], text: bytes) -> float:
    """Perplexity by the recursive definition."""
    order, counts = kneser.ORDER, {}
    counts[order] = Counter()
    for t in train:
        padded = bytes(order - 1) + t
        counts[order].update(padded[i : i + order] for i in range(len(t)))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cuts = {}
    for k, c in counts.items():
        n = [0, *(sum(v == i for v in c.values()) for i in range(1, 5))]
        y = n[1] / max(n[1] + 2 * n[2], 1)
        cuts[k] = [0] + [max(min(i - (i + 1) * y * (n[i + 1] / n[i] if n[i] else 0.5), i), 0.1) for i in (1, 2, 3)]

    def p(g: bytes) -> float:
        if not g:
            return 1 / 256
        k = len(g)
        same = [(x, c) for x, c in counts[k].items() if x[:-1] == g[:-1]]
        total = sum(c for _, c in same)
        if not total:
            return p(g[1:])
        c = counts[k].get(g, 0)
        left = sum(cuts[k][min(v, 3)] for _, v in same)
        return (c - cuts[k][min(c, 3)] if c else 0) / total + left / total * p(g[1:])

    padded = bytes(order - 1) + text
    return math.exp(-sum(math.log(p(padded[i : i + order])) for i in range(len(text))) / len(text))


@pytest.mark.parametrize("shard_rows", [2_000_000, 300])
def test_perplexity_equals_the_definition(spark, shard_rows):
    rng = random.Random(8)
    rows = [(i, prose(rng, 12), "en" if i % 2 else "de", "s", 0, 1, "", "", 1) for i in range(24)]
    rows += [(100, "QQ!! ZZ## ##", "en", "s", 0, 1, "", "", 1), (101, None, "en", "s", 0, 1, "", "", 1), (102, "the", "xx", "s", 0, 1, "", "", 1), (103, "the the", None, "s", 0, 1, "", "", 1)]
    rows += [rows[3], rows[3]]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(24)] + [(100, 0, 0), (None, 1, 0), (101, None, 0)], LABELS)
    got = kneser.perplexities(spark, documents(spark, rows), labels, shard_rows=shard_rows).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    train = {x: [r[1].encode() for r in rows[:24] if r[2] == x and zlib.crc32(str(r[0]).encode()) % 2 == 0] for x in ("en", "de")}
    texts = {r[0]: (r[1], r[2]) for r in rows}
    for r in got:
        text, lang = texts[r.doc_id]
        if text is None or lang not in train:
            assert r.perplexity is None and r.kept
        else:
            assert math.isclose(r.perplexity, brute_kneser(train[lang] + ([rows[3][1].encode()] * 2 if lang == "en" and zlib.crc32(b"3") % 2 == 0 else []), text.encode()), rel_tol=1e-4)
    assert not next(r for r in got if r.doc_id == 100).kept


def test_two_folds_judge_each_half_by_the_other(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, 12), "en", "s", 0, 1, "", "", 1) for i in range(24)]
    rows += [(100, "QQ!! ZZ## ##", "en", "s", 0, 1, "", "", 1), (101, "", "en", "s", 0, 1, "", "", 1), (102, "QQ!! ZZ## ##", "xx", "s", 0, 1, "", "", 1), (103, rows[0][1], None, "s", 0, 1, "", "", 1)]
    rows.append(rows[3])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(24)] + [(100, 0, 0)], LABELS)
    got = kneser.perplexities(spark, documents(spark, rows), labels, quantile=0.9, folds=2).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    half = lambda i: zlib.crc32(str(i).encode()) % 2
    train = [[r[1].encode() for r in rows if r[0] < 24 and half(r[0]) == x] for x in (0, 1)]
    by = {r.doc_id: r for r in got}
    for i, text, *_ in rows:
        if i == 101:
            assert by[i].perplexity is None and by[i].kept
            continue
        models = [1 - half(i)] if i < 24 else [0, 1]
        want = math.exp(sum(math.log(brute_kneser(train[x], text.encode())) for x in models) / len(models))
        assert math.isclose(by[i].perplexity, want, rel_tol=1e-4) and by[i].n_bytes == len(text.encode())
    assert {r.threshold for r in got} == {sorted(by[i].perplexity for i in range(24))[21]}
    assert not by[100].kept and not by[102].kept and by[103].kept


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>one<p>two <b>bold</b>  word<div>three</div>", "one\n\ntwo bold word\n\nthree"),
        ("a<br>b<br><br>c", "a\nb\n\nc"),
        ("<ul><li>x<li>y<ol start=4><li>n<li value=9>m</ol></ul>", "- x\n- y\n  4. n\n  9. m"),
        ("<table><tr><th>Name<th>Qty<tr><td>Apple pie<td>3<tr><td rowspan=2>Tea<td>1<tr><td>2</table>", "Name       Qty\nApple pie  3\nTea        1\n           2"),
        ("<head><title>t</title></head><body hidden>no</body>", ""),
        ("<div style='color:red;display:NONE'>no</div><span style='visibility: hidden'>no</span>yes<script>if(a<b)</script><!-- <p>no -->", "yes"),
        ("<pre>  a\n   b</pre>", "  a\n   b"),
        ("<details><summary>S</summary>no</details><details open><summary>T</summary>yes</details>", "S\nT\nyes"),
        ("a < b and <c", "a < b and"),
        ("</div></p>x</table>y", "xy"),
        ("<b>" * 3000 + "deep" + "<div>" * 3000 + "er", "deep\ner"),
        ("<p><b>text<br><p>more</b> end", "text\n\nmore end"),
        ("<select><option>1<option>2</select>", "1\n2"),
        ("<blockquote>q</blockquote><dl><dt>t<dd>d</dl>", "  q\n\nt\n  d"),
    ],
)
def test_html_text(html, text):
    assert htmltext.text_of(html) == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p title=it's>Hello</p><p>I don't know</p><p>end</p>", "Hello\n\nI don't know\n\nend"),
        ('<a href="x"">link</a>', "link"),
        ("<p title=5\">one</p><p>6\" two</p>", "one\n\n6\" two"),
        ("<p it's>a</p><p>b's</p>", "a\n\nb's"),
        ("<p title='a>b' id = \"c>d\">x</p y'>z", "x\n\nz"),
        ("<p title=>x</p><p = hidden>y</p><p class=a/b'c hidden>no</p>z'", "x\n\nz'"),
        ('<p title="never closed>x</p>', "x"),
        ("<b a=1'b=2>x</b><br/><input type=submit value='a\"b'>", "x\na\"b"),
    ],
)
def test_quotes_delimit_only_after_an_equals_sign(html, text):
    assert htmltext.text_of(html) == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<div>" * 200 + "<p hidden>no</p>yes", "yes"),
        ("<div>" * 200 + "<table><tr><td>a<td>b<tr><td>ccc<td>d</table>", "a    b\nccc  d"),
        ("<p style='visibility:hidden'>no<span style='visibility:visible'>yes</span> no</p>", "yes"),
        ("<ul style='visibility:hidden'><li>no<li style='visibility:visible'>yes</ul>", "- yes"),
        ("<svg><title>no</title><desc>no</desc><defs><text>no</text></defs><text>yes <tspan>two</tspan></text><rect/></svg>end", "yes two end"),
        ("<p hidden=1 hidden=2>no</p><span hidden/>no</span>yes", "yes"),
        ("<a title=x style='display:none' style='display:block'>no</a>yes", "yes"),
        ("<style>.x{display:none} #y{visibility:hidden} p.z{display:none}</style><p class='a x'>no<p id=y>no<p class=z>no</p><div class=z>yes</div>", "yes"),
        ("<style>/* .q{ */ .x,.w{display:none} .x{display:block} @media print{p{display:none}} ul li{display:none}</style><p class=x>yes<p class=w>no<ul><li>too</ul>", "yes\n\n- too"),
        ("<style>.x{display:none!important}</style><p class=x style='display:block'>no</p><p hidden style='display:block'>yes</p>", "yes"),
        ("text<p title='a' b", "text"),
        ("text <a", "text"),
        ("a <!doctype", "a"),
        ("1 < 2 <3 </ x", "1 < 2 <3 </ x"),
    ],
)
def test_what_is_hidden_and_what_is_cut_off(html, text):
    assert htmltext.text_of(html) == text


@pytest.mark.parametrize(
    "page",
    [
        "<a" * 200_000, "<div>" * 50_000 + "x", "<b>" * 30_000 + "</i>" * 30_000, '<a b="' * 50_000, "<ul><li>x" * 10_000, "<blockquote>y" * 10_000,
        "<table><tr><td>z" * 3_000, "<script>" + "</script" * 50_000, "<!" * 100_000, "<p><table>" + "<b>" * 20_000 + "<div>" * 20_000,
        "<style>" + "@media{" * 50_000, "<style>" + ".a{display:none}" * 3_000 + "</style>" + "<p class=a>" * 3_000,
    ],
)
def test_long_pages_take_linear_time(page):
    import time

    start = time.perf_counter()
    htmltext.text_of(page[: len(page) // 4])
    quarter = time.perf_counter() - start
    htmltext.text_of(page)
    assert time.perf_counter() - start - quarter < 12 * quarter + 1.0


def plain_blocks(rng: random.Random, depth: int = 0) -> tuple[str, list[str]]:
    """A random page of blocks and its lines, built together."""
    html, lines = "", []
    for _ in range(rng.randint(1, 4)):
        kind = rng.choice(["div", "hidden", "text", "none", "nest"])
        word = f"w{rng.randrange(1000)}"
        if kind == "div":
            html, lines = html + f"<div>{word} <b>b</b></div>", [*lines, f"{word} b"]
        elif kind == "hidden":
            html += f"<div hidden>{word}</div>"
        elif kind == "none":
            html += f"<script>{word}</script><div style='display: none'><p>{word}</div>"
        elif kind == "text":
            html, lines = html + f"<div>{word}<br>{word}</div>", [*lines, word, word]
        elif depth < 40:
            inside, own = plain_blocks(rng, depth + 1)
            html, lines = html + f"<section>{inside}</section>", [*lines, *own]
    return html, lines


@pytest.mark.parametrize("seed", range(20))
def test_random_blocks_against_their_lines(seed):
    html, lines = plain_blocks(random.Random(seed))
    assert htmltext.text_of(html) == "\n".join(lines)


def test_html_of_an_empty_table_and_clashing_columns(spark):
    kind = "page_id bigint, url string, html string, text string, n_chars string"
    assert htmltext.extract(spark.createDataFrame([], kind)).count() == 0
    rows = htmltext.extract(spark.createDataFrame([(1, "u", "<p>a", "own", "own")], kind))
    assert [tuple(r) for r in rows.collect()] == [(1, "a", 1)]


def test_html_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a", "x"), (2, "u", None, "x"), (None, "u", "", "x"), (1, "u", "<p>a", "x")], "page_id bigint, url string, html string, text string")
    assert sorted(map(tuple, htmltext.extract(pages).collect()), key=str) == sorted([(1, "a", 1), (2, "", 0), (None, "", 0), (1, "a", 1)], key=str)
