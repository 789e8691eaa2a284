"""Piece encoding, hard negatives and ranked search against the library, brute force and SQL."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from tripwell.llm import hard_negatives, lexical, pieces, queries

MODEL = queries.vocabulary("piece_bpe_32k.model")


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# ---------------------------------------------------------------- pieces

def mixed_texts(n, seed):
    rng = random.Random(seed)
    letters = list("abcdeThe    ..,12\n\t") + ["▁", "é", "ﬁ", "Ａ", "漢", "ह", "ि", "😀", " ", "　", "é", "​", "½", "\x00", "ﷺ", "the x", "ab1"]
    odd = ["", " ", "  ", "a", " a", "a ", "▁", "▁a ▁", "\x00a\x00", "<s> </s> <unk> <0x41>", "ﬁ ﬂ", "１２３ ＡＢＣ", "a" * 500, " " * 300]
    return odd + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(n)]


def models():
    """The given model, and variants of its settings; none is trained."""
    from sentencepiece import SentencePieceNormalizer, sentencepiece_model_pb2

    def proto(data=None):
        made = sentencepiece_model_pb2.ModelProto()
        made.ParseFromString(data or open(MODEL, "rb").read())
        return made

    yield "as it is", proto().SerializeToString()
    for rule in ("nmt_nfkc", "nfkc", "nmt_nfkc_cf"):
        rules = proto(SentencePieceNormalizer(rule_name=rule).serialized_model_proto()).normalizer_spec.precompiled_charsmap
        for trim in (False, True):
            made = proto()
            made.normalizer_spec.precompiled_charsmap, made.normalizer_spec.remove_extra_whitespaces = rules, trim
            yield f"{rule} {trim}", made.SerializeToString()
    made = proto()
    made.trainer_spec.byte_fallback = False
    for p in made.pieces:
        if p.type == p.BYTE:
            p.type = p.CONTROL
    yield "unknown pieces", made.SerializeToString()
    made = proto()
    made.trainer_spec.treat_whitespace_as_suffix = True
    yield "space as suffix", made.SerializeToString()
    made = proto()
    for word in ("the▁x", "ab1"):
        made.pieces.add(piece=word, score=0, type=4)
    yield "user pieces", made.SerializeToString()


@pytest.mark.parametrize("name,model", list(models()), ids=lambda x: x if isinstance(x, str) else "")
def test_pieces_spans_and_decoding_equal_the_library(name, model):
    from sentencepiece import SentencePieceProcessor

    library, own = SentencePieceProcessor(model_proto=model), pieces.PieceEncoder(model)
    texts = mixed_texts(500, 1)
    for text, (ids, begins, ends) in zip(texts, own.encode(texts)):
        want = library.encode(text, return_type="proto").pieces
        assert ids.tolist() == [p.id for p in want] + [2], text
        assert list(zip(begins[:-1].tolist(), ends[:-1].tolist())) == [(p.begin, p.end) for p in want], text
        assert begins[-1] == ends[-1] == len(text.encode())
        assert own.decode(ids) == library.decode(ids.tolist()), text
    rng = random.Random(2)
    for _ in range(500):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(32000), 0, 2, 259, 28705]) for _ in range(rng.randint(0, 12))]
        assert own.decode(np.array(ids, int)) == library.decode(ids), ids


def test_encoding_query_and_forgetting(spark, small, monkeypatch):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=MODEL)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for doc_id, text in docs:
        ids = library.encode(text or "") + [2]
        want[doc_id] = (len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids)), len((text or "").encode()))
    assert {r[0]: r[1:] for r in rows_of(queries.op11_pieces(spark, small))} == want
    monkeypatch.setattr(pieces, "KEPT", 50)
    own = pieces.PieceEncoder(MODEL)
    for _, text in docs[:40] * 2:
        assert own.encode([text])[0][0].tolist() == library.encode(text) + [2]


def test_encoding_of_odd_rows(spark):
    rows = [(1, None, "x"), (1, "", "x"), (None, "two words", "x"), (None, "two words", "x"), (7, "q" * 300_000 + " é" * 300_000, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumns({"begins": __import__("pyspark").sql.functions.lit(1)})
    got = rows_of(pieces.encode(df, MODEL))
    assert sorted((r[1], r[2], r[3], r[4]) for r in got if r[0] == 1) == [([2], [0], [0], "")] * 2
    assert [r[4] for r in got if r[0] is None] == ["two words"] * 2
    long = next(r for r in got if r[0] == 7)
    assert long[4] == rows[-1][1] and long[3][-1] == 300_000 + 900_000 and long[2][1:] == long[3][:-2] + [long[3][-1]]
    assert rows_of(pieces.encode(df.limit(0), MODEL)) == []


# ---------------------------------------------------------------- hard negatives

def plain_negatives(rows, scale=256):
    usable = [(i, l, [math.floor(scale * x) for x in v]) for i, l, v in rows
              if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    last = lambda i: (i is None, i or 0)
    found = []
    for a, (anchor, label, va) in enumerate(usable):
        if anchor is None or anchor % 100:
            continue
        scored = [(sum(x * y for x, y in zip(va, v)), i, l) for b, (i, l, v) in enumerate(usable) if b != a and len(v) == len(va)]
        for score, positive, _ in sorted((s for s in scored if s[2] == label), key=lambda s: (-s[0], last(s[1])))[:5]:
            fitting = [s for s in scored if s[2] != label and 30 * score <= 100 * s[0] <= 90 * score]
            for rank, (s, i, _) in enumerate(sorted(fitting, key=lambda s: (-s[0], last(s[1])))[:10], 1):
                found.append((anchor, positive, rank, i, score, s))
    return sorted(found, key=str)


def mined(spark, rows, **options):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns(
        {c: F.lit("clash") for c in ("id", "lane", "place", "rank", "dim", "score", "vector", "anchor")})
    return sorted(rows_of(hard_negatives.mine(df, F.col("vec_id") % 100 == 0, F.col("label"), **options)), key=str)


@pytest.mark.parametrize("lane_bytes", [1 << 24, 3000])
def test_hard_negatives_equal_brute_force(spark, lane_bytes):
    rng = np.random.default_rng(8)
    centers = rng.standard_normal((6, 12))
    vectors = [(i * 10 if i % 3 else i, int(rng.integers(3)), (centers[i % 6] + rng.standard_normal(12) * 0.5).tolist()) for i in range(700)]
    vectors += [(100, 1, vectors[5][2]), (100, 1, vectors[9][2]), (7, None, vectors[0][2]), (8, 1, None), (200, 1, [1.0, None] * 6),
                (300, 1, [float("nan")] * 12), (400, 1, [float("inf")] * 12), (None, 2, vectors[0][2]), (None, 2, vectors[0][2]),
                (500, 0, [0.0] * 12), (600, 2, [1.0] * 5), (601, 2, [2.0] * 5), (602, 1, [1.0] * 5), (603, 1, [0.4] * 5), (700, 1, [])]
    vectors += [vectors[3]] * 40  # ties
    assert mined(spark, vectors, lane_bytes=lane_bytes) == plain_negatives(vectors)


def test_hard_negatives_of_large_numbers_and_none(spark):
    rng = np.random.default_rng(9)
    rows = [(i, i % 2, (rng.standard_normal(4) * 1e6).tolist()) for i in range(0, 400, 4)]
    assert mined(spark, rows) == plain_negatives(rows)
    huge = [(100, 1, [3.4e13] * 9), (1, 1, [3.4e13] * 9), (2, 0, [2e13] * 9)]
    assert mined(spark, huge) == []  # scores beyond 64 bits
    assert mined(spark, [(100, 1, [1.0])]) == [] and mined(spark, []) == []


def test_score_bounds_hold():
    rng = np.random.default_rng(10)
    for dim in (1, 2, 3, 16):
        vectors = np.floor(rng.standard_normal((200, dim)) * 50)
        vectors[0] = 0
        references = hard_negatives.directions(vectors[:20], 8)
        assert np.allclose(np.linalg.norm(references, axis=1), 1)
        norms = np.linalg.norm(vectors, axis=1)
        angles = hard_negatives.angles_to(references, vectors, norms)
        exact = vectors @ vectors.T
        for i in range(0, 200, 7):
            low, high = hard_negatives.score_bounds(angles, angles, norms, norms, angles[i], norms[i])
            assert (low <= exact[i]).all() and (exact[i] <= high).all()
            for a in range(0, 200, 40):
                part = slice(a, a + 40)
                low, high = hard_negatives.score_bounds(angles[part].min(0)[None], angles[part].max(0)[None],
                                                        norms[part].min()[None], norms[part].max()[None], angles[i], norms[i])
                assert low[0] <= exact[i, part].min() and exact[i, part].max() <= high[0]


# ---------------------------------------------------------------- ranked search

def plain_ranking(docs, items, k=10):
    import re

    find = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+").findall
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    held = [(i, Counter(find((t or "").translate(lower)))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, n_words = len(held), sum(n for *_, n in held)
    frequency = Counter(t for _, c, _ in held for t in c)
    found = []
    for item, text in items:
        scored = []
        for doc_id, c, n in held:
            m = 100 - 90 + (90 * n * n_docs) // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(find((text or "").translate(lower))) if t in c)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        found += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(found, key=str)


def ranked(spark, docs, items, **options):
    from pyspark.sql import functions as F

    clash = {c: F.lit("x") for c in ("terms", "n", "score", "lane", "item", "times", "rank", "deal", "block")}
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns(clash)
    i = spark.createDataFrame(items, "item_id long, text string").withColumns(clash)
    return sorted(rows_of(lexical.search(d, i, **options)), key=str)


@pytest.mark.parametrize("chunk,block_terms", [(1_000_000, 200_000), (900, 60)])
def test_ranking_equals_brute_force(spark, monkeypatch, chunk, block_terms):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(60)] + ["Ünï", "É", "漢字", "X9", "ẞ"]
    marks = [" ", "-", "\x00", "\x7f", "\n", "_", "  "]

    def text(n):
        return "".join(rng.choice(words[:1 + int(len(words) * rng.random() ** 2)]) + rng.choice(marks) for _ in range(n))

    docs = [(i, text(rng.randint(0, 40))) for i in range(900)]
    docs += [(1000 + i, docs[5][1]) for i in range(300)] + [(None, docs[5][1]), (None, None), (5, docs[6][1]), (2000, "x " * 200_000), (2001, "-- \n")]
    items = [(i, text(rng.randint(1, 12))) for i in range(40)] + [(100, None), (101, ""), (102, "unseen"), (103, "W1 w1 w1"), (None, "w2")]
    monkeypatch.setattr(lexical, "CHUNK_ENTRIES", chunk)
    assert ranked(spark, docs, items, block_terms=block_terms) == plain_ranking(docs, items)


def test_ranking_of_nothing(spark):
    assert ranked(spark, [], [(1, "a")]) == [] == ranked(spark, [(1, "a")], []) == ranked(spark, [(1, None)], [(1, "a")])


def test_ball_tree_bounds_hold_and_prune():
    rng = np.random.default_rng(12)
    rows, vocabulary = 2000, 400
    topics = [rng.choice(vocabulary, 30, replace=False) for _ in range(20)]
    held = [np.sort(topics[i % 20][rng.integers(2):][:12]) for i in range(rows)]
    weights = rng.integers(900_000, 1_000_000, rows * 12)
    tree = lexical.BallTree(np.arange(rows + 1) * 12, np.concatenate(held), weights)
    dense = np.zeros(vocabulary, np.int64)
    for i in range(20):
        terms = np.sort(topics[i][:8])
        values = rng.integers(1, 30_000, 8)
        bounds = tree.bounds(terms, values)
        dense[terms] = values
        for bound, (first, last, *_) in zip(bounds, tree.nodes):
            assert tree.scores(first, last, dense).max() <= bound
        dense[terms] = 0
        ranking = lexical.Ranking(terms, values, 10)
        ranking.search(tree, list(range(rows)), dense)
        assert ranking.opened < sum(left < 0 for *_, left, _ in tree.nodes)


@pytest.mark.parametrize("name", ["op12_hard_negatives", "op13_lexical"])
def test_sql_of_search_queries(spark, small, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    assert sorted(con.sql(queries.oracle_sql()[name]).fetchall()) == sorted(rows_of(queries.queries()[name](spark, small)))
