"""Operators 1 and 2, connected components and the pipeline, against plain code."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from genenet_spark.llm import ann, attention, bpe, decontaminate, jaccard, language, lines, lm_scoring, queries
from genenet_spark.llm.common import freeze
from genenet_spark.llm.components import components
from genenet_spark.llm.graph_index import GraphIndex

BYTE = public_tokenizers.path("byte_bpe_50k.json")


# -- 2: nearest neighbours ---------------------------------------------------------


def test_graph_recall():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1500, 24)) + 3 * rng.standard_normal((12, 24))[rng.integers(0, 12, 1500)]
    index = GraphIndex(x)
    assert (index.edges >= -1).all() and (index.edges < len(x)).all()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    true = np.argsort(-(unit[::10] @ unit.T), axis=1)[:, :5]
    found, _ = index.search(unit[::10], 64)
    assert np.mean([len(set(a[:5]) & set(b)) / 5 for a, b in zip(found, true)]) > 0.95


def test_neighbours_recall_and_scores(spark, sf0001):
    out = queries.op2_neighbours(spark, sf0001).toPandas()
    rows = spark.read.parquet(f"{sf0001}/embeddings.parquet").collect()
    x = {r.vec_id: np.array(r.embedding, float) for r in rows}
    hits = total = 0
    for q, g in out.groupby("query_id"):
        cos = {v: x[q] @ y / (np.linalg.norm(x[q]) * np.linalg.norm(y)) for v, y in x.items() if v != q}
        true = sorted(cos, key=lambda v: (-cos[v], v))[:5]
        g = g.sort_values("rank")
        assert list(g["rank"]) == [1, 2, 3, 4, 5] and list(g["score"]) == sorted(g["score"], reverse=True)
        assert all(abs(cos[v] - s) < 1e-12 for v, s in zip(g.vec_id, g.score))
        hits, total = hits + len(set(true) & set(g.vec_id)), total + 5
    assert total == 5 * sum(v % 50 == 0 for v in x) and hits / total >= 0.9


def test_neighbours_of_one_direction_are_the_smallest_ids(spark):
    """Two hundred multiples of one vector: all cosines are equal, so ties alone decide."""
    rng = np.random.default_rng(6)
    base = rng.standard_normal(16)
    rows = [(i, (base * 2.0 ** (i % 60 - 30)).tolist()) for i in range(200)]
    out = {}
    for r in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), shard_vectors=64).collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    for q in (0, 50, 100, 150):
        assert [v for _, v in sorted(out[q])] == [v for v in range(6) if v != q][:5]


def test_neighbours_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [1.0, None]), (6, [1.0, 1.0]), (7, [inf, 1.0]),
            (8, []), (50, [1.0, 0.0]), (50, [1.0, 0.0]), (None, [1.0, 0.0]), (100, [1.0]), (101, [-2.0]), (150, [1e300, 1e300, 0.0]), (151, [1e-300, 0.0, 0.0])]
    rows += [(200 + i, [1.0, 0.0]) for i in range(9)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, shard string, rank int")
    out = {}
    for r in ann.search(frame).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 12)))
    assert out[0] == [(1, 1), (50, 1), (200, 1), (201, 1), (202, 1)]
    assert out[50] == [(0, 1), (1, 1), (200, 1), (201, 1), (202, 1)]
    assert out[200] == [(0, 1), (1, 1), (50, 1), (201, 1), (202, 1)]
    assert out[100] == [(101, -1)]
    assert out[150] == [(151, round(math.sqrt(0.5), 12))]
    assert ann.search(frame.limit(0)).count() == 0


def test_neighbours_over_many_shards(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 8))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(frame, shard_vectors=60).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in range(0, 400, 50):
        cos = unit @ unit[q]
        cos[q] = -2
        assert got[q] == set(np.argsort(-cos)[:5].tolist())


# -- components ----------------------------------------------------------------------


def test_components_of_chains_and_stars(spark):
    random.seed(5)
    links = [(i, i + 1) for i in range(120)] + [(1000, 1000 + i) for i in range(1, 60)] + [(2001, 2000), (2000, 2001), (3000, 3000)]
    names = {v: random.random() for e in links for v in e}  # node order unlike chain order
    frame = spark.createDataFrame([(str(names[a]), str(names[b])) for a, b in links], "a string, b string")
    back = {str(v): k for k, v in names.items()}
    groups = {}
    for r in components(frame).collect():
        groups.setdefault(r.comp, set()).add(back[r.node])
    assert sorted(map(sorted, groups.values())) == [list(range(121)), list(range(1000, 1060)), [2000, 2001]]
    assert components(frame.limit(0)).count() == 0


# -- 1: language model -----------------------------------------------------------------


def _words(text):
    return (text or "").encode().lower().split() + [b""]


def _model(n_ids=60, seed=0):
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, 40, (attention.COMPONENTS, n_ids)).astype(float)
    clusters = rng.integers(0, attention.COMPONENTS, n_ids).astype(np.int32)
    starts = rng.random(n_ids) < 0.4
    ctx = rng.integers(0, 2**63, 50).astype(np.uint64)
    keys = np.concatenate([attention.pair_key(ctx, rng.integers(0, n_ids, 50)), attention.own_key(ctx)])
    table = attention.ShareTable(keys, np.full(100, 0.3, np.float32))
    return attention.AttentionModel(clusters, attention.input_classes(counts), attention.component_table(counts), starts, table)


def test_share_table_finds_what_was_stored():
    keys = attention._mix(np.arange(1, 5000, dtype=np.uint64))
    table = attention.ShareTable(keys[:3000], np.arange(1, 3001, dtype=np.float32))
    assert (table.get(keys[:3000]) == np.arange(1, 3001)).all() and (table.get(keys[3000:]) == 0).mean() > 0.999


def test_windows_score_every_place_once():
    for places in range(0, 150):
        seen = Counter()
        for at in attention.window_starts(places):
            seen.update(p for p in range(at + (attention.CONTEXT if at else 0), min(places, at + attention.WINDOW)))
        assert seen == Counter(range(places))


def test_score_is_batch_independent_and_causal():
    m = _model()
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 60, n) for n in (2, 3, 24, 25, 26, 45, 200, 1)]
    together = m.score(texts)
    alone = np.array([m.score([t])[0] if len(t) > 1 else 0.0 for t in texts])
    assert np.allclose(together, alone, rtol=1e-5) and together[-1] == 0
    longer = m.score([texts[3], np.concatenate([texts[3], [5]])])
    assert longer[1] < longer[0]  # one more id costs something, nothing before it changes by it
    short, ext = texts[2], np.concatenate([texts[2], [7, 8]])
    parts = [m.score([ext[: k + 1]])[0] - m.score([ext[:k]])[0] for k in range(2, len(ext) + 1) if k < len(ext)]
    assert np.isclose(sum(parts) + m.score([ext[:2]])[0], m.score([ext])[0], rtol=1e-4) and len(short) == 24


def test_next_id_probabilities_add_up_to_one():
    """For stored shares that are shares of one context's followers, each component is a distribution."""
    m = _model()
    n = len(m.clusters)
    context, last = np.uint64(12345), 7
    follow = np.array([3, 5, attention.END_OF_WORD])
    m.starts_word[[3, 5]] = False
    m.word_start = m.table[m.starts_word].sum(axis=0)
    keys = np.concatenate([attention.pair_key(np.full(3, context), follow), attention.own_key(np.array([context]))])
    m.shares = attention.ShareTable(keys, np.array([0.2, 0.3, 0.1, 0.6], np.float32))
    m.last_left = np.ones(n, np.float32)
    every = np.arange(n)
    share, left = m.lookups(np.full(n, last), np.full(n, context), every)
    assert np.allclose(m._parts(np.full(n, last), every, share, left).sum(axis=0), 1, atol=1e-4)


def test_training_lowers_the_loss():
    m = _model()
    rng = np.random.default_rng(9)
    ids = rng.integers(0, 60, (6, attention.WINDOW + 1))
    ids[0, 10:] = -1
    contexts = np.zeros(ids.shape, np.uint64)
    before = m.train(ids, contexts, steps=60)
    assert np.mean(before[-5:]) < before[0]


def test_lm_scoring_base_and_learning(spark, sf0001):
    docs = spark.read.parquet(f"{sf0001}/documents.parquet").select("doc_id", "text")
    odd = [(9001, None), (9002, ""), (9003, "UNSEENWORD" * 30), (9003, "UNSEENWORD" * 30), (None, "the"), (9004, "a\x0bb\x1cc the THE é É")]
    docs = docs.union(spark.createDataFrame(odd, "doc_id long, text string")).selectExpr("doc_id", "text", "1 AS row", "'x' AS ids", "0 AS n")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    count = Counter(w for d, t in rows if not held(d) for w in _words(t))
    total, kinds = sum(count.values()), len(count)
    small, lm_scoring.COMMON_WORDS = lm_scoring.COMMON_WORDS, 500  # most words take the join
    try:
        out = lm_scoring.score_documents(docs, BYTE).collect()
    finally:
        lm_scoring.COMMON_WORDS = small
    key = lambda r: (-1 if r[0] is None else r[0], r[2])
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in out), key=key)
    expected = []
    for d, t in rows:
        w = _words(t)
        expected.append((d, held(d), len(w), sum(count[x] > 0 for x in w), total, sum(math.log10((count[x] + 1) / (total + kinds + 1)) for x in w)))
    expected.sort(key=key)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert np.allclose([g[5] for g in got], [e[5] for e in expected], rtol=1e-9)
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)
    # The model has learned: it beats the vocabulary's uniform distribution by far on rows that it never saw.
    ids = {r.doc_id: r.n_tokens for r in bpe.encode_documents(docs, BYTE).collect()}
    unseen = [r for r in out if r.held_out and r.doc_id is not None]
    assert sum(r.score for r in unseen) > 0.75 * -math.log10(50257) * sum(ids[r.doc_id] + 1 for r in unseen)


def test_lm_scores_do_not_depend_on_the_shares_at_hand(spark, sf0001, monkeypatch):
    docs = spark.read.parquet(f"{sf0001}/documents.parquet").select("doc_id", "text")
    scores = []
    for most in (lm_scoring.STORED_SHARES, 300):  # the rest takes the join
        monkeypatch.setattr(lm_scoring, "STORED_SHARES", most)
        scores.append({r.doc_id: r.score for r in lm_scoring.score_documents(docs, BYTE).collect()})
    assert scores[0].keys() == scores[1].keys()
    assert np.allclose([scores[0][d] for d in scores[0]], [scores[1][d] for d in scores[0]], rtol=1e-3)


def test_network_learns_all_windows(spark, monkeypatch):
    assert 2 * attention.CONTEXT >= attention.WINDOW  # windows overlap by half: no place but the first is scored with little before it
    m, rng = _model(), np.random.default_rng(5)
    lengths = rng.integers(0, 90, 300).tolist()
    rows = [(rng.integers(0, 60, n).astype("<u2").tobytes(), [], [], i) for i, n in enumerate(lengths)]
    frame = spark.createDataFrame(rows, "ids binary, keys array<bigint>, shares array<float>, row long")
    windows = sum(len(attention.window_starts(n + 1)) for n in lengths)
    before = {c: x.copy() for c, x in m.weights.items()}
    monkeypatch.setattr(lm_scoring, "SHARD_WINDOWS", windows // 9)
    assert lm_scoring.train_network(frame, m, spark.sparkContext.broadcast(m), "<u2", 59) == windows
    assert all(m.weights[c].shape == x.shape and np.isfinite(m.weights[c]).all() for c, x in before.items())
    assert {c for c, x in before.items() if (m.weights[c] == x).all()} <= {"trust"}  # no share was given


def test_lm_scoring_empty_and_without_training(spark):
    docs = spark.createDataFrame([(d, "some text") for d in range(60) if zlib.crc32(str(d).encode()) % 7 == 2], "doc_id long, text string")
    out = lm_scoring.score_documents(docs, BYTE).collect()
    assert len(out) == docs.count() and all(r.held_out and r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in out)
    assert lm_scoring.score_documents(docs.limit(0), BYTE).count() == 0


# -- pipeline ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def stages(spark, sf0001):
    docs = spark.read.parquet(f"{sf0001}/documents.parquet")
    made = [docs]
    for name, stage in corpus_pipeline.STAGES:
        made.append(freeze(stage(spark, made[-1], sf0001), "test-stage"))
    return made


def test_pipeline_stages(spark, sf0001, stages):
    docs, known, cut, single, clean, coded = stages
    assert all(x.columns == docs.columns for x in stages[:-1])
    texts = [{r.doc_id: r.text for r in x.collect()} for x in stages[:-1]]
    model = language.train(docs)
    predicted = {r.doc_id: r for r in language.predict(docs, model, {"doc_id": "long"}).collect()}
    assert set(texts[1]) == {d for d in texts[0] if predicted[d].score >= 0.5 and predicted[d].lang_pred != "und"}
    assert set(texts[2]) == set(texts[1])
    pages = known.collect()
    sites = Counter(r.source for r in pages)
    held = Counter((r.source, x) for r in pages for x in {y.strip(" \t\r") for y in r.text.split("\n")} if x)
    for r in pages:
        left = [x for x in r.text.split("\n") if not x.strip(" \t\r") or not (held[r.source, x.strip(" \t\r")] > 1 and held[r.source, x.strip(" \t\r")] > lines.MAX_RATIO * sites[r.source])]
        assert texts[2][r.doc_id] == "\n".join(left)
    groups = {r.component_id for r in jaccard.link_components(cut, 5, 80).collect()}
    assert set(texts[3]) == groups and len(groups) < len(texts[2])
    leaked = {r.doc_id for r in decontaminate.leaks(single, spark.read.parquet(f"{sf0001}/benchmark.parquet")).collect()}
    assert set(texts[4]) == set(texts[3]) - leaked and leaked
    out = {r.doc_id: r for r in coded.collect()}
    assert set(out) == set(texts[4]) and all(r.round_trip and len(r.ids) == 4 * r.n_tokens for r in out.values())


def test_pipeline_run_and_edges(spark, sf0001, stages):
    run = corpus_pipeline.run(spark, sf0001)
    assert sorted((r.doc_id, r.ids_sha256) for r in run.collect()) == sorted((r.doc_id, r.ids_sha256) for r in stages[-1].collect())
    docs = stages[0]
    odd = spark.createDataFrame([(None, None, None, None, None), (7001, "", "en", "src0", 0), (7002, "...", "en", None, 3)], docs.schema)
    for table in (docs.limit(0), docs.limit(30).union(odd).union(odd)):
        at = table
        for name, stage in corpus_pipeline.STAGES:
            at = freeze(stage(spark, at, sf0001), "test-stage")
        assert at.where("doc_id > 7000").count() == 0
