"""Operator 13 against plain code: sorted suffixes with common prefixes, and removed bytes."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from genenet_spark.llm import queries, repeats, suffixes


def plain_suffixes(data):
    """Sorted suffixes of segments that end with 0 (the 0 left out), and common prefixes of neighbours."""
    out, end = [], len(data)
    for i in range(len(data) - 1, -1, -1):
        end = i if data[i] == 0 else end
        if data[i]:
            out.append(tuple(data[i:end]))
    out.sort()
    shared = [0] * len(out)
    for i in range(1, len(out)):
        k = 0
        while k < min(len(out[i]), len(out[i - 1])) and out[i][k] == out[i - 1][k]:
            k += 1
        shared[i] = k
    return out, shared


def random_segments(rng, alphabet):
    base = rng.integers(1, alphabet + 1, rng.integers(0, 40)).tolist()
    data = []
    for _ in range(rng.integers(1, 6)):
        own = rng.integers(1, alphabet + 1, rng.integers(0, 40)).tolist()
        data += (own[:9] + base[rng.integers(0, len(base) + 1):] if rng.random() < 0.5 else own) + [0]
    return data


@pytest.mark.parametrize("memory", [1, 16, 1000])
@pytest.mark.parametrize("alphabet", [1, 2, 3, 6, 200])
def test_induced_order_and_common_prefixes(memory, alphabet, monkeypatch):
    rng = np.random.default_rng(memory * 1000 + alphabet)
    for turn in range(40):
        monkeypatch.setattr(suffixes, "CHUNK", [3, 7, 1 << 18][turn % 3])
        monkeypatch.setattr(suffixes, "SAMPLE", [2, 8, 1 << 14][turn % 3])
        data = random_segments(rng, alphabet)
        pos, shared = suffixes.sort_suffixes(np.array(data, np.int64), memory)
        true, lcp = plain_suffixes(data)
        text = [tuple(data[p : p + data[p:].index(0)]) for p in pos.tolist()]
        assert text == true and shared.tolist() == lcp and len(set(pos.tolist())) == len(true)


def test_queue_and_arrays_on_disk(monkeypatch):
    """A shard whose tuples and arrays leave memory many times over sorts as one that stays in it."""
    rng = np.random.default_rng(3)
    words = [rng.integers(1, 27, rng.integers(2, 9)) for _ in range(400)]
    data = np.concatenate([np.concatenate([*(words[i] for i in rng.integers(0, 400, 30)), [0]]) for _ in range(300)])
    near = suffixes.sort_suffixes(data, 1 << 20)
    monkeypatch.setattr(suffixes, "IN_MEMORY", 0)
    spilled = []
    spill = suffixes.SuffixQueue._spill
    monkeypatch.setattr(suffixes.SuffixQueue, "_spill", lambda q: (spilled.append(q.size), spill(q))[1])
    far = suffixes.sort_suffixes(data, 500)
    assert sum(spilled) > 20 * 500
    assert (near[0] == far[0]).all() and (near[1] == far[1]).all()


def test_groups_share_a_prefix():
    rng = np.random.default_rng(8)
    data = np.concatenate([np.append(rng.integers(1, 4, 60), 0) for _ in range(12)])
    found = {}
    for pos, starts in suffixes.repeated_groups(data, 6, 50):
        for part in np.split(pos, starts[1:]):
            found[tuple(data[part[0] : part[0] + 6])] = sorted(p for p in part.tolist() if (data[p : p + 6] > 0).all() and len(data[p : p + 6]) == 6)
    true = {}
    for p in range(len(data) - 6):
        if (data[p : p + 6] > 0).all():
            true.setdefault(tuple(data[p : p + 6]), []).append(p)
    assert {k: v for k, v in found.items() if len(v) > 1} == {k: v for k, v in true.items() if len(v) > 1}


def plain_dedup(rows, length=100):
    """``(doc_id, n_bytes, n_removed, n_spans, sha256)`` by a table of all strings."""
    order = sorted({((i if i is not None else -(2**63)), t) for i, t in rows if t is not None}, key=lambda r: r[0])
    first, gone = {}, {}
    for i, t in order:
        mask = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first.setdefault(t[p : p + length], (i, p)) != (i, p):
                mask[p : p + length] = b"\x01" * length
        gone[i, t] = mask
    out = []
    for i, t in rows:
        mask = gone.get((i if i is not None else -(2**63), t), b"")
        kept = bytes(b for b, m in zip(t or b"", mask) if not m)
        spans = sum(m and not (k and mask[k - 1]) for k, m in enumerate(mask))
        out.append((i, len(t or b""), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **more):
    frame = spark.createDataFrame([(i, bytearray(t) if t is not None else None, 1, "x") for i, t in rows],
                                  "doc_id long, text binary, start long, hash string").repartition(5)
    out = repeats.drop_repeats(frame, **more)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in out.collect()), key=str)


@pytest.mark.parametrize("length", [1, 3, 7, 12])
def test_groups_of_any_length(length):
    rng = np.random.default_rng(length)
    data = np.concatenate([np.append(rng.integers(1, 4, 90), 0) for _ in range(8)])
    true = {}
    for p in range(len(data) - length + 1):
        if (data[p : p + length] > 0).all():
            true.setdefault(tuple(data[p : p + length].tolist()), set()).add(p)
    found = {}
    for pos, starts in suffixes.repeated_groups(data, length, 50):
        for part in np.split(pos, starts[1:]):
            whole = {p for p in part.tolist() if tuple(data[p : p + length].tolist()) in true}
            if len(whole) > 1:
                found.setdefault(tuple(data[min(whole) : min(whole) + length].tolist()), set()).update(whole)
    assert found == {k: v for k, v in true.items() if len(v) > 1}


def test_segments_that_cannot_share_a_passage_are_not_sorted():
    rng = random.Random(4)
    anchor, side = rng.randbytes(repeats.GRAM), repeats.LENGTH - repeats.GRAM
    parts, twins = [], set()
    for shared in range(side + 1):  # bytes after the anchor that two segments share, and as many as needed before it or a few less
        for lacking in (0, 12):
            before, after = rng.randbytes(max(0, side - shared - lacking)), rng.randbytes(shared)
            if not lacking:
                twins |= {len(parts), len(parts) + 1}
            for _ in range(2):
                front = rng.randbytes(side - len(before)) + before
                parts.append((front + anchor + after + rng.randbytes(side - shared), len(front)))
    kept = repeats._may_share([7 * (i // 2) for i in range(len(parts))], [p for p, _ in parts], [a for _, a in parts], repeats.LENGTH)
    kept = set(np.flatnonzero(kept).tolist())
    assert twins <= kept  # none that shares a passage is left out
    assert len(kept - twins) <= len(parts) // 8  # most of the others are, too


def test_repeats_of_the_table(spark, sf0001):
    rows = [(r.doc_id, r.text.encode() if r.text is not None else None) for r in spark.read.parquet(f"{sf0001}/documents.parquet").collect()]
    out = sorted(map(tuple, queries.op13_repeats(spark, sf0001).collect()), key=str)
    assert out == plain_dedup(rows) and sum(r[2] for r in out) > 0


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocab) for _ in range(n)).encode()
    passages = [prose(n) for n in (14, 20, 25, 60)]  # below, about and above 100 bytes
    rows = []
    for i in range(70):
        parts = [prose(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            cut = rng.choice(passages)
            parts += [cut[rng.randint(0, 6) :], prose(rng.randint(0, 9))]
        rows.append((i * 3 % 71, b" ".join(parts)))
    return rows + [(900 + i, rows[i][1]) for i in range(12)]


@pytest.mark.parametrize("more", [{}, {"shard_bytes": 300, "queue_rows": 40}])
def test_repeats_of_planted_passages(spark, more):
    rows = corpus(5)
    assert run(spark, rows, **more) == plain_dedup(rows)


def test_repeats_edges(spark, monkeypatch):
    rng = random.Random(1)
    noise = lambda n: bytes(rng.randrange(256) for _ in range(n))
    a, b = noise(150), noise(100)
    rows = [(1, None), (2, b""), (3, b"x" * 99), (4, b"x" * 99), (5, b"y" * 400), (6, b"y" * 250), (7, b"ab" * 300), (8, a), (8, a), (9, a + b),
            (10, b), (None, b), (None, None), (11, a[:100]), (12, a[50:]), (13, b"z" + a), (14, b + b), (-5, noise(30) + a[20:140])]
    assert run(spark, rows) == plain_dedup(rows)
    monkeypatch.setattr(repeats, "PIECE", 256)  # long texts come in overlapping pieces
    long = noise(900)
    more = [(20, long), (21, noise(70) + long[100:700] + noise(70)), (22, long[:450] + long[:450]), (23, b"q" * 2000)]
    assert run(spark, rows + more) == plain_dedup(rows + more)
    assert run(spark, []) == [] and run(spark, [(1, None)]) == plain_dedup([(1, None)])


@pytest.mark.parametrize("piece", [130, 256, 1 << 20])
def test_every_passage_has_one_segment(piece, monkeypatch):
    """Long texts come in overlapping pieces: each passage lies in one run, and equal passages have one anchor hash."""
    monkeypatch.setattr(repeats, "PIECE", piece)
    rng = random.Random(piece)
    passage = bytes(rng.randrange(256) for _ in range(180))
    texts = [b"", passage, b"k" * 700, passage[:99], bytes(rng.randrange(3) for _ in range(800)) + passage, passage[20:170] * 3]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6), pa.int64()), pa.array(range(6), pa.int64()), pa.array(texts, pa.binary())], names=["doc", "tk", "text"])
    hashes = {}
    seen = set()
    for out in repeats._find_anchors(100)(iter([batch])):
        for r in out.to_pylist():
            start, count = r["run"] // repeats.RUN, r["run"] % repeats.AT
            for p in range(start, start + count):
                assert (r["doc"], p) not in seen
                seen.add((r["doc"], p))
                assert hashes.setdefault(texts[r["doc"]][p : p + 100], r["hash"]) == r["hash"]
    assert seen == {(i, p) for i, t in enumerate(texts) for p in range(len(t) - 99)}


def test_same_id_with_different_texts(spark):
    """Documents of one id stand in a fixed order: one of them keeps the shared passage."""
    rng = random.Random(2)
    shared = bytes(rng.randrange(256) for _ in range(200))
    rows = [(1, b"first" + shared), (1, b"second" + shared), (1, b"second" + shared)]
    out = run(spark, rows)
    assert sorted((r[1], r[2]) for r in out) in ([(205, 0), (206, 200), (206, 200)], [(205, 200), (206, 0), (206, 0)])
