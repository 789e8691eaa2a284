"""Operators that compare rows with each other or with corpus statistics, and the pipeline."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tripwell.llm import components, lattice, mixing, neighbours, quality, queries, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---------------------------------------------------------------- components

def test_components_of_paths_stars_and_repeats(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 200), (200, 201), (300, 300)]
    edges += [(rng.randint(400, 500), rng.randint(400, 500)) for _ in range(60)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    df = spark.createDataFrame(edges + [(None, 5)], "x long, y long")
    got = dict(rows_of(components.connected_components(df, "x", "y")))
    assert got == {n: root(n) for n in parent}
    assert rows_of(components.connected_components(df.limit(0), "x", "y")) == []


# ---------------------------------------------------------------- fingerprints

def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, linked):
    label = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i in range(len(values)):
            for j in range(i):
                if label[i] != label[j] and linked(values[i], values[j]):
                    low, high = sorted((label[i], label[j]))
                    label = [low if x == high else x for x in label]
                    changed = True
    return label


def test_fingerprints_and_components(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    prints = [plain_fingerprint(t) for _, t in docs]
    label = plain_components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {k: min(d for (d, _), x in zip(docs, label) if x == k) for k in set(label)}
    want = sorted((d, f"{p:016x}", least[x]) for (d, _), p, x in zip(docs, prints, label))
    assert sorted(rows_of(queries.op2_simhash(spark, small))) == want


def test_split_tiles_lose_no_link(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40)
    prints = np.unique(np.concatenate([base, *[base ^ (1 << int(b)) for b in range(0, 40, 3)]]))
    df = spark.createDataFrame([(int(p), b"") for p in prints], "fp long, sketch binary")
    values = [int(p) for p in prints]
    edges = rows_of(simhash.link_forest(df, radius=4, block=7))
    assert all((a ^ b).bit_count() <= 64 for a, b in edges)
    got = dict(rows_of(components.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b")))
    label = plain_components(values, lambda a, b: (a ^ b).bit_count() <= 4)
    first = {x: min(v for v, y in zip(values, label) if y == x) for x in set(label)}
    assert [got.get(v, v) for v in values] == [first[x] for x in label]


def test_fingerprints_of_odd_rows(spark, empty):
    rows = [(4, None), (3, ""), (9, " \n"), (5, "one two"), (5, "one two"), (None, "one two"), (None, "ONE\ttwo"), (7, "x " * 400_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(rows_of(simhash.near_duplicates(df)), key=str)
    assert sorted((d, c) for d, f, c in got if f == 0) == [(3, 3), (4, 3), (9, 3)]
    assert Counter((d, c) for d, f, c in got if f and d != 7) == {(5, 5): 2, (None, 5): 2}
    assert rows_of(simhash.near_duplicates(empty)) == []
    kept = simhash.deduplicate(df.selectExpr("*", "1 as fp", "2 as root", "3 as _fp", "4 as component_id"))
    assert sorted(kept.select("doc_id").toPandas().doc_id.tolist()) == [3, 5, 7]


def test_near_copies_of_a_text_go_and_others_stay(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    texts = {i: [rng.choice(words) for _ in range(300)] for i in range(60)}
    rows = [(i, " ".join(t)) for i, t in texts.items()]
    for i in range(20):
        copy = list(texts[i])
        copy[rng.randrange(300)] = "changed"
        copy[rng.randrange(300)] = "again"
        rows.append((1000 + i, " ".join(copy)))
    kept = simhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(60))


def test_every_bit_of_the_sketch_varies():
    rng = np.random.default_rng(10)
    seen = np.array([np.frombuffer(simhash.sketch(rng.integers(0, 1 << 63, 9, dtype=np.uint64)), np.uint8) for _ in range(200)])
    share = np.unpackbits(seen, axis=1).mean(axis=0)
    assert 0.25 < share.min() and share.max() < 0.75


def planted_pair(rng, tag, similarity):
    """Two texts whose sets of five-word shingles have just that similarity: one is the start of the other."""
    words = [f"{tag}x{rng.randrange(10**9)}" for _ in range(404)]
    return " ".join(words), " ".join(words[:round(400 * similarity) + 4])


def test_similarity_decides_at_the_threshold(spark):
    rng = random.Random(8)
    texts = [planted_pair(rng, f"{s}n{k}", s) for s in (0.7, 0.75, 0.79, 0.8, 0.85) for k in range(120)]
    rows = [(2 * i + side, t) for i, pair in enumerate(texts) for side, t in enumerate(pair)]
    kept = {r.doc_id for r in simhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == set(range(0, 1200, 2)) | set(range(1, 720, 2))


def test_parts_of_a_component_lose_no_link(spark):
    rng = random.Random(9)
    words = [f"w{rng.randrange(10**9)}" for _ in range(240)]
    rows = [(i, " ".join(words[i * 3:i * 3 + 104])) for i in range(40)]  # each overlaps the next in 97 of 103 shingles
    rows += [(100 + i, " ".join(words[:20 + i] + [f"v{i}"] * 5)) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    distinct = simhash.set_prints(docs, "text", "doc_id", 5).withColumnRenamed("doc_id", "first_id").cache()
    candidates = distinct.selectExpr("node", "0L as root")
    sets = {r.node: simhash.shingle_set(dict(rows)[r.first_id], 5)[0] for r in distinct.collect()}
    nodes = sorted(sets)
    alike = lambda a, b: (n := len(np.intersect1d(sets[a], sets[b]))) >= 0.8 * (len(sets[a]) + len(sets[b]) - n)
    label = plain_components(nodes, alike)
    for block in (300, 1 << 20):
        edges = rows_of(simhash.verified_links(docs, distinct, candidates, "text", "doc_id", 5, 0.8, 64, 256, block))
        assert all(alike(a, b) for a, b in edges)
        got = plain_components(nodes, lambda a, b, e=set(edges): (a, b) in e or (b, a) in e)
        assert [got.index(x) for x in got] == [label.index(x) for x in label]


# ---------------------------------------------------------------- quality

def plain_model(texts, order):
    """Straightforward interpolated modified Kneser-Ney over padded units; returns p(gram)."""
    counts = [Counter() for _ in range(order + 1)]
    for t in texts:
        padded = "￿" * (order - 1) + t + "￿"
        for i in range(order - 1, len(padded)):
            counts[order][padded[i - order + 1:i + 1]] += 1
    for k in range(order - 1, 0, -1):
        for g in counts[k + 1]:
            counts[k][g[1:]] += 1
    discounts, contexts = [None] * (order + 1), [None] * (order + 1)
    for k in range(1, order + 1):
        n = [sum(c == i for c in counts[k].values()) for i in range(5)]
        if all(n[1:]):
            y = n[1] / (n[1] + 2 * n[2])
            discounts[k] = [0] + [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0), i) for i in (1, 2, 3)]
        else:
            discounts[k] = [0, 0.5, 1, 1.5]
        contexts[k] = defaultdict(lambda: [0, 0.0])
        for g, c in counts[k].items():
            contexts[k][g[:-1]][0] += c
            contexts[k][g[:-1]][1] += discounts[k][min(c, 3)]

    def p(gram):
        k = len(gram)
        if k == 0:
            return 1 / (len(counts[1]) + 1)
        if gram[:-1] not in contexts[k]:
            return p(gram[1:])
        total, left = contexts[k][gram[:-1]]
        c = counts[k].get(gram, 0)
        return (c - discounts[k][min(c, 3)] if c else 0) / total + left / total * p(gram[1:])

    return p


def test_perplexity_equals_plain_model(spark, monkeypatch):
    rng = random.Random(7)
    text = lambda: " ".join("".join(rng.choice("abcdé😀") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(0, 30)))
    rows = [(i, rng.choice(["x", "y"]), text()) for i in range(120)] + [(900, "z", "no model"), (901, None, "none"), (902, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    trusted = spark.createDataFrame([(i,) for i in range(60)], "doc_id long")
    model = quality.train(quality.trusted_documents(docs, trusted), 700)
    got = {r.doc_id: r.perplexity for r in quality.perplexities(docs, model, 900).collect()}
    units = lambda t: "".join(chr(u) for u in np.frombuffer((t or "").encode("utf-16-le"), np.uint16))
    order = quality.ORDER
    for lang in "xy":
        p = plain_model([units(t) for i, l, t in rows if l == lang and i < 60], order)
        for i, l, t in rows:
            if l == lang:
                padded = "￿" * (order - 1) + units(t) + "￿"
                logs = [math.log(p(padded[k - order + 1:k + 1])) for k in range(order - 1, len(padded))]
                assert got[i] == pytest.approx(math.exp(-sum(logs) / len(logs)), rel=1e-4)
    assert got[900] is None and got[901] is None and len(got) == len(rows)


def test_classifier_rejects_junk_and_keeps_trusted(spark, empty):
    sf = "/root/testdata/sf0.01"
    got = queries.op1_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good, bad = [r.keep for r in got if r.quality == 1], [r.keep for r in got if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.4
    ids = spark.createDataFrame([(1,), (None,)], "doc_id long")
    assert rows_of(quality.classify(empty, ids)) == []
    odd = spark.createDataFrame([(1, "abc", "x"), (1, "abc", "x"), (None, "q" * 2_000_000, "x"), (2, None, None), (3, "", "x")],
                                "doc_id long, text string, lang string").selectExpr("*", "1 as keep", "2 as part")
    assert quality.classify(odd, ids).count() == 5
    kept = quality.keep_good(odd, ids)
    assert kept.columns == odd.columns and {1, None, 2} <= {r.doc_id for r in kept.collect()}


# ---------------------------------------------------------------- mixing

def test_water_fill_and_flow():
    assert mixing.water_fill([10, 100, 50], [5, 2, 1], 160, 3) == pytest.approx([30, 260 / 3, 130 / 3])
    assert mixing.water_fill([0, 0], [5, 2], 0, 3) == [0, 0]
    capacity, members, quotas = [100, 50, 80], [[0], [0, 1], [1, 2]], [120.0, 100.0, 50.0]
    flow = mixing.cheapest_flow(capacity, members, quotas, 3)
    filled = [sum(f.get(s, 0) for f in flow) for s in range(3)]
    assert filled == pytest.approx(quotas)
    used = [sum(f.values()) for f in flow]
    cost = sum(max(0, u - c) + max(0, u - 2 * c) for u, c in zip(used, capacity))
    assert cost == pytest.approx(sum(quotas) - sum(capacity))  # no token a third time, none twice before all once


def test_flow_is_cheapest_on_small_networks():
    from itertools import product

    rng = random.Random(8)
    for _ in range(20):
        capacity = [rng.randint(1, 3) for _ in range(3)]
        members = [sorted(rng.sample(range(2), rng.randint(1, 2))) for _ in range(3)]
        quotas = [rng.randint(0, 5) for _ in range(2)]
        best = {}
        for sent in product(*[[(a, b) for a in range(3 * c + 1) for b in range(3 * c + 1 - a)
                               if (0 in m or not a) and (1 in m or not b)] for c, m in zip(capacity, members)]):
            if all(sum(x[s] for x in sent) <= quotas[s] for s in (0, 1)):
                cost = sum(sum(max(0, sum(x) - k * c) for k in (1, 2)) for x, c in zip(sent, capacity))
                total = sum(map(sum, sent))
                best[total] = min(cost, best.get(total, 99))
        flow = mixing.cheapest_flow(capacity, members, [float(q) for q in quotas], 3)
        used = [sum(f.values()) for f in flow]
        assert sum(used) == max(best)
        assert sum(sum(max(0, u - k * c) for k in (1, 2)) for u, c in zip(used, capacity)) == pytest.approx(best[max(best)])


def test_mix_meets_targets_and_repeats(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op3_mixing(spark, sf).collect()
    again = queries.op3_mixing(spark, sf).collect()
    assert sorted(rows) == sorted(again)
    sources = {r.doc_id: r.source for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source").collect()}
    taken, target = Counter(), {}
    for r in rows:
        assert r.taken <= 3 * r.size
        taken[sources[r.doc_id]] += r.taken
        target[sources[r.doc_id]] = r.target
    assert all(abs(taken[s] - t) < 0.05 * t for s, t in target.items())
    assert sum(target.values()) == pytest.approx(sum(r.size for r in rows))


def test_mix_of_odd_rows(spark, empty):
    rows = [(1, None, None), (2, "a b", "s"), (2, "a b", "s"), (None, "c " * 100_000, "t"), (3, "", "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as copies", "2 as _mix_size", "3 as row")
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and all(n <= 6 for n in Counter(r.doc_id for r in mixed.collect()).values())
    assert rows_of(mixing.mix_documents(empty)) == []
    many = spark.createDataFrame([(i, "w " * (i % 7 + 1), [["a"], ["b"], ["a", "b"], [None]][i % 4]) for i in range(400)],
                                 "doc_id long, text string, source array<string>")
    assert mixing.mix_documents(many, weights={"a": 3, "b": 1, None: 1}).count() > 100


# ---------------------------------------------------------------- vectors

def test_nearest_equals_brute_force(spark):
    rng = np.random.default_rng(9)
    vectors = rng.standard_normal((700, 16)).astype(np.float32) * rng.choice([0.1, 1, 10], (700, 1)).astype(np.float32)
    vectors[50:120] = vectors[40]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(5000, None), (5020, [0.0] * 16), (5040, [float("nan")] * 16), (5060, [1.0] * 3), (5080, []), (None, [1.0] * 16),
             (5100, [None] * 16), (20, vectors[20].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as dim", "2 as block")
    from pyspark.sql import functions as F

    rows += [(7, (vectors[20] * 3).tolist()), (7, (vectors[20] * 2).tolist()), (20, (-vectors[20]).tolist())]  # ids repeat
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as dim", "2 as block", "3 as `row`")
    found = [tuple(r) for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=20).collect()]
    fit = [(i, np.array(v, float)) for i, v in rows
           if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    want = []
    for q, (query, x) in enumerate(fit):
        if query % 20 == 0:
            scores = sorted((-float(x @ v), i) for c, (i, v) in enumerate(fit) if c != q and len(v) == len(x))
            want += [(query, rank, i, -s) for rank, (s, i) in enumerate(scores[:20], 1)]
    assert len(found) == len(want)
    for f, w in zip(sorted(found), sorted(want)):
        assert f[:2] == w[:2] and np.isclose(f[3], w[3], rtol=1e-9)
    # Where several rows tie in double precision the smaller id comes first.
    first = [f[2] for f in sorted(found) if f[0] == 40][:20]
    assert first == [w[2] for w in sorted(want) if w[0] == 40]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_lattice_decoding_is_nearest():
    x = np.random.default_rng(10).standard_normal((500, 8)) * 2
    home = lattice.decode(x)
    off = ((x - home) ** 2).sum(axis=1)
    others = ((x[:, None] - home[:, None] - lattice.STEPS[None]) ** 2).sum(axis=2).min(axis=1)
    assert (off <= others + 1e-9).all() and off.max() <= 1 + 1e-9 and len(lattice.STEPS) == 240


def test_links_against_brute_force(spark):
    rng = np.random.default_rng(11)
    vectors = []
    for x in rng.standard_normal((120, 64)):
        x /= np.linalg.norm(x)
        for _ in range(rng.integers(1, 9)):
            g = rng.standard_normal(64)
            vectors.append(x + rng.choice([0, 0.1, 0.2, 0.3, 0.4]) * g / np.linalg.norm(g))
    for _ in range(250):
        g = rng.standard_normal(64)
        vectors.append(vectors[0] + 0.25 * g / np.linalg.norm(g))
    vectors = np.array(vectors, np.float32)
    n = len(vectors)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(9000, None), (9001, [0.0] * 64), (9002, [float("inf")] * 64), (9003, [1.0] * 8), (9004, [1.0] * 8), (9005, []),
             (None, vectors[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as id", "2 as cell")
    got = {r.vec_id: r for r in lattice.near_duplicates(df, block=100).collect()}
    unit = vectors.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    links = unit @ unit.T >= 0.9
    np.fill_diagonal(links, False)
    found = np.array([got[i].n_links for i in range(n)])
    assert (found <= links.sum(axis=1)).all() and found.sum() > 0.95 * links.sum()
    assert (got[9003].n_links, got[9004].component_id) == (1, 9003)
    assert all(got[i].n_links == 0 and got[i].kept for i in (9000, 9001, 9002, 9005, None))
    assert all(got[i].kept == (got[i].component_id == i) for i in range(n))
    assert lattice.near_duplicates(df.limit(0)).collect() == []


def test_links_of_different_vectors_under_one_id(spark):
    a, b = [1.0] * 16 + [0.0] * 16, [0.0] * 16 + [1.0] * 16
    near_a = [1.01] * 16 + [0.0] * 16
    df = spark.createDataFrame([(5, a), (5, b), (9, near_a), (5, near_a), (7, b)], "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in lattice.near_duplicates(df).collect())
    # a, and near_a twice, are one class; b twice another: both hold the id 5
    assert got == [(5, 1, 5, True), (5, 2, 5, True), (5, 2, 5, True), (7, 1, 5, False), (9, 2, 5, False)]


def test_recall_at_the_threshold():
    rng = np.random.default_rng(12)
    x = rng.standard_normal((1500, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    g = rng.standard_normal((1500, 64))
    g -= (g * x).sum(axis=1)[:, None] * x
    g /= np.linalg.norm(g, axis=1)[:, None]
    a, b = lattice.cells(x), lattice.cells(0.9 * x + math.sqrt(0.19) * g)
    met = (a == b[:, :, :1]).any(axis=2) | (b == a[:, :, :1]).any(axis=2)
    assert met.any(axis=1).mean() > 0.95


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages(spark, small):
    import corpus_pipeline
    from tripwell.sources.storage import store

    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "personal_data", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, store(stage(spark, docs, small), name)
        if name != "packing":
            assert docs.columns == columns
        if name in ("quality", "near_duplicates"):
            assert docs.subtract(before).count() == 0 and 0 < docs.count() < before.count()
    assert docs.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0
    assert corpus_pipeline.run(spark, small).count() == docs.count()


def test_licence_and_other_sql(spark, small):
    from check_oracles import compare, connect

    for name, sql in queries.oracle_sql().items():
        df = queries.queries()[name](spark, small)
        cursor = connect(small).execute(sql)
        assert compare(rows_of(df), df.columns, cursor.fetchall(), [d[0] for d in cursor.description]) is None, name


@pytest.mark.parametrize("letters,n", [(5, 3000), (3000, 60_000)])
def test_grams_of_small_and_large_alphabets(letters, n):
    """Tables and sorting number the same grams; sorting needs memory by units only."""
    import tracemalloc

    rng = np.random.default_rng(letters)
    texts = ["".join(chr(0x4E00 + int(x)) for x in rng.integers(0, letters, n)), None, "一"]
    tracemalloc.start()
    grams = quality.Grams(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 * n + 8_000_000
    want = Counter()
    for t in texts:
        padded = quality._PAD * 3 + (t or "") + quality._PAD
        want.update(padded[i - 3:i + 1] for i in range(3, len(padded)))
    keys, counts = grams.counts()
    assert {bytes(np.array([k], np.uint64).view(np.uint16)[::-1]).decode("utf-16-le"): c
            for k, c in zip(keys.tolist(), counts.tolist())} == dict(want)
    for level in range(2, 5):
        some = grams.wanted[level]  # those that only cross from one document into the next have no suffix
        keys, suffix, context = grams.keys[level][some], grams.suffix[level][some], grams.context[level][some]
        assert (grams.keys[level - 1][suffix] == keys & np.uint64((1 << 16 * (level - 1)) - 1)).all()
        assert (grams.keys[level - 1][context] == keys >> np.uint64(16)).all()


def test_piece_cache_keeps_two_generations(monkeypatch):
    from tripwell.llm import packing

    monkeypatch.setattr(packing, "CACHED_WORDS", 30)
    monkeypatch.setattr(packing, "CACHED_CHARS", 8)
    path = queries.vocabulary()
    own = packing.WordTokenizer(path)
    rng = random.Random(3)
    words = ["often"] + ["".join(rng.choice("abcdeß1'-é漢") for _ in range(rng.randint(1, 14))) for _ in range(400)]
    for i in range(60):
        texts = [" ".join(["often", *rng.sample(words, 12)]) for _ in range(3)] + ["", " "]
        for t, ids in zip(texts, own.encode(texts)):
            assert ids.tolist() == own.model.encode(t, add_special_tokens=False).ids
        assert len(own.now) + len(own.before) < 200 and not any(len(p) > 8 for p in own.now)
