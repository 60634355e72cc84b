"""Suffix-array dedup (operator 13): bytes of passages that stand earlier in the corpus go.

Texts are cut into shards by content, so that equal passages of ``length`` bytes always meet: the
anchor of a passage is its ``GRAM``-byte stretch of least hash, and neighbouring passages of one
anchor travel as one segment. Anchors that occur once are settled by counting. Equal segments
are settled by their digests. What is left, different segments around the same anchor, goes to
shards, where their suffixes are sorted by external induction with common prefixes
(``suffixes``), and passages that share ``length`` bytes are neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genenet_spark.llm.common import discard, free_shuffles, freeze, map_batches
from genenet_spark.llm.suffixes import repeated_groups

LENGTH = 100
#: Bytes hashed to choose anchors: long enough that chance repeats are rare, short enough that anchors are sparse.
GRAM = 32
#: Bytes worked on at once when anchors are chosen.
PIECE = 1 << 17
#: Bytes of texts handed back at once.
OUT_BYTES = 1 << 20
#: Segments handed back at once.
CUT_ROWS = 4096
#: Bytes of segments in a shard on average; a shard may be many times larger.
SHARD_BYTES = 1 << 19
#: Ranges of the number of bytes before an anchor that segments are compared by before the sort.
SIDES = 16
#: Suffix tuples a shard's queue holds in memory.
QUEUE_ROWS = 1 << 16

#: Odd multipliers of the hashes (fixed values).
POLYNOMIAL = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
SEED_BITS = (1 << 64) - 1

#: A run of ``n`` neighbouring passages from ``start`` on, with its anchor ``at`` bytes further, is one number:
#: ``start * RUN + at * AT + n``. Passages may have up to 65,535 bytes.
RUN, AT = 1 << 32, 1 << 16
ANCHORS = "hash long, doc long, tk long, run long, digest long"


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from every place on, by doubling; the last places hash what is there."""
    now, power, width = data.astype(np.uint64) + np.uint64(1), POLYNOMIAL, 1
    while width < GRAM:
        now[:-width] = now[:-width] * np.uint64(power) + now[width:]
        power, width = power * power % (1 << 64), width * 2
    for shift, factor in zip((30, 27), MIX):
        now ^= now >> np.uint64(shift)
        now *= np.uint64(factor)
    now ^= now >> np.uint64(31)
    return now


def _least_at(hashes: np.ndarray, window: int) -> np.ndarray:
    """Place of the least hash (the first of equal ones) in the ``window`` places from each place on."""
    # Their upper halves are enough to choose by.
    at, least, width = np.arange(len(hashes), dtype=np.int32), (hashes >> np.uint64(32)).astype(np.uint32), 1
    while width < window:
        step = min(width, window - width)
        after = least[step:] < least[:-step]
        at = np.where(after, at[step:], at[:-step])
        least = np.where(after, least[step:], least[:-step])
        width += step
    return at


def segments(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """``start, count, hash, anchor place`` of runs of passages with one anchor in ``data``, whose texts end at ``ends``."""
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none, none, none, none
    hashes = _gram_hashes(data)
    anchor = _least_at(hashes[: len(data) - GRAM + 1], length - GRAM + 1)[: len(data) - length + 1]
    inside = np.zeros(len(anchor), bool)
    begin = 0
    for end in ends:
        if end - begin >= length:
            inside[begin : end - length + 1] = True
        begin = end
    new = np.append(True, anchor[1:] != anchor[:-1]) & inside
    # A text's first passage begins a run whatever the place before it was.
    new[1:] |= inside[1:] & ~inside[:-1]
    start = np.flatnonzero(new)
    stop = np.append(start[1:], len(anchor))
    stopped = np.append(0, np.cumsum(inside))
    return start, stopped[stop] - stopped[start], hashes[anchor[start]].view(np.int64), anchor[start]


def _pieces(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """Rows ``a`` to ``b`` worked on together and the bytes of them; a long row comes in overlapping pieces."""
    a, n = 0, len(offsets) - 1
    while a < n:
        if offsets[a + 1] - offsets[a] > PIECE:
            for at in range(offsets[a], offsets[a + 1] - length + 1, PIECE):
                yield a, a + 1, at, min(at + PIECE + length - 1, offsets[a + 1])
            a += 1
            continue
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + PIECE, side="right")) - 1)
        yield a, b, int(offsets[a]), int(offsets[b])
        a = b


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column and the offsets of its rows in them."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), offsets


def _find_anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = _bytes_of(batch.column(2))
            docs, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for a, b, low, high in _pieces(offsets, length):
                here = data[low:high]
                ends = (np.minimum(offsets[a + 1 : b + 1], high) - low).tolist()
                start, count, hashes, anchor = segments(here, ends, length)
                if not len(start):
                    continue
                view = memoryview(here)
                digests = [xxhash.xxh3_64_intdigest(view[s : s + c + length - 1]) for s, c in zip(start.tolist(), count.tolist())]
                row = a + np.searchsorted(offsets[a + 1 : b + 1], low + start, side="right")
                yield pa.RecordBatch.from_arrays([
                    pa.array(hashes), pa.array(docs[row]), pa.array(keys[row]), pa.array((low + start - offsets[row]) * RUN + (anchor - start) * AT + count),
                    pa.array(np.array(digests, np.uint64).view(np.int64)),
                ], names=[f.split()[0] for f in ANCHORS.split(", ")])

    return run


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as zstd frames, for shuffles."""
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = pa.array([None if t is None else pack.compress(t) for t in (v.as_py() for v in batch.column(2))], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], names=["doc", "tk", "z"])


def _cut(length: int):
    """Rows of a document's text and runs in it to a row a run with its bytes."""
    names = ["hash", "doc", "tk", "run", "segment"]
    types = [pa.int64()] * 4 + [pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        rows: list[tuple] = []
        for batch in batches:
            for i in range(batch.num_rows):
                doc, key, z, hashes, runs = (batch.column(k)[i].as_py() for k in range(5))
                text = unpack.decompress(z)
                for h, r in zip(hashes, runs):
                    start, n = r // RUN, r % AT
                    rows.append((h, doc, key, r, text[start : start + n + length - 1]))
                    if len(rows) == CUT_ROWS:
                        yield _batch(rows, types, names)
        if rows:
            yield _batch(rows, types, names)

    return run


def _may_share(hashes: list[int], parts: list[bytes], at: list[int], length: int) -> np.ndarray:
    """Marks segments that can share a passage with another one of their anchor.

    A passage holds its anchor and ``length - GRAM`` other bytes, some of them before it. Equal ones agree in what a passage
    has there at least, whichever of ``SIDES`` ranges that number of bytes is in.
    """
    around = length - GRAM
    edges = [around * i // SIDES for i in range(SIDES + 1)]
    kept = np.zeros(len(parts), bool)
    for least, most in zip(edges, edges[1:]):
        before, after = least, GRAM + around - most
        # A segment that is too short on one side keeps a key of its own there: it has no such passage.
        key = np.fromiter((
            xxhash.xxh3_64_intdigest(part[a - before : a + after], h & SEED_BITS) if a >= before and len(part) - a >= after else i
            for i, (h, part, a) in enumerate(zip(hashes, parts, at))), np.uint64, len(parts))
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        kept |= count[which] > 1
    return kept


def _sort_shard(length: int, memory: int):
    """Segments of one shard, in the order of documents, to runs of passages that stand earlier in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[pa.RecordBatch] = list(batches)
        if not sum(b.num_rows for b in seen):
            return
        everything = pa.Table.from_batches(seen).combine_chunks()
        seen.clear()
        hashes, runs = (everything.column(i).to_numpy() for i in (0, 3))
        parts = everything.column(4).to_pylist()
        kept = _may_share(hashes.tolist(), parts, (runs // AT % AT).tolist(), length)
        docs, keys, starts = (c[kept] for c in (everything.column(1).to_numpy(), everything.column(2).to_numpy(), runs // RUN))
        codes = [p for p, k in zip(parts, kept) if k]
        del everything, parts
        if not codes:
            return
        # Byte + 1, and a sentinel behind each segment.
        sentinel = np.cumsum([len(c) + 1 for c in codes]) - 1
        data = np.frombuffer(b"\0".join([*codes, b""]), np.uint8).astype(np.uint16) + 1
        codes.clear()
        data[sentinel] = 0
        begin = np.append(0, sentinel[:-1] + 1)
        changed = (docs[1:] != docs[:-1]) | (keys[1:] != keys[:-1])
        number = np.append(0, np.cumsum(changed))
        for pos, groups in repeated_groups(data, length, memory):
            segment = np.searchsorted(sentinel, pos)
            whole = pos + length <= sentinel[segment]
            place = starts[segment] + pos - begin[segment]
            size = np.diff(np.append(groups, len(pos)))
            group = np.repeat(np.arange(len(groups)), size)
            order = np.lexsort((place, number[segment], group))  # the earliest of each group first
            head = order[groups][group]
            later = whole & ((number[segment] != number[segment[head]]) | (place != place[head]))
            at = np.sort(pos[later])
            if len(at):
                segment = np.searchsorted(sentinel, at)
                first = np.flatnonzero(np.append(True, (np.diff(at) != 1) | (np.diff(segment) != 0)))
                owner = segment[first]
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs[owner]), pa.array(keys[owner]),
                    pa.array((starts[owner] + at[first] - begin[owner]) * RUN + np.diff(np.append(first, len(at)))),
                ], names=["doc", "tk", "run"])

    return run


DEDUPED = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,length:long>>, kept binary"


def _remove(length: int):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"]
    types = [pa.int64()] * 4 + [pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for i in range(batch.num_rows):
                doc_id, z, runs = (batch.column(k)[i].as_py() for k in range(3))
                text = b"" if z is None else unpack.decompress(z)
                spans, kept, last = [], [], 0
                for s, e in _spans(runs or [], length):
                    spans.append({"start": s, "length": e - s})
                    kept.append(text[last:s])
                    last = e
                kept.append(text[last:])
                rows.append((doc_id, len(text), sum(s["length"] for s in spans), len(spans), spans, b"".join(kept)))
                size += len(rows[-1][-1]) + 32 * len(spans)
                if size >= OUT_BYTES:
                    yield _batch(rows, types, names)
                    size = 0
        if rows:
            yield _batch(rows, types, names)

    return run


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    """The rows as a batch; the list is emptied."""
    out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
    rows.clear()
    return out


def _spans(runs: list[int], length: int) -> list[tuple[int, int]]:
    """Bytes covered by runs of passages, as maximal spans."""
    out: list[tuple[int, int]] = []
    for s, n in ((r // RUN, r % AT) for r in sorted(runs)):
        e = s + n + length - 1
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _with_runs(docs: DataFrame, runs: DataFrame, how: str, *columns: str) -> DataFrame:
    """``doc, tk, z`` (the text as a zstd frame) and arrays of ``columns`` of the runs in each document."""
    lists = runs.groupBy("doc", "tk").agg(F.collect_list(F.struct(*columns)).alias("a"))
    texts = map_batches(docs, _squeeze, "doc long, tk long, z binary")
    return texts.join(lists, ["doc", "tk"], how).select("doc", "tk", "z", *(F.col(f"a.{c}").alias(c) for c in columns))


def _segment_classes(docs: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Stored tables of runs around anchors that stand more than once: all of them with their digests, and the different ones.

    A class has its ``first`` run, its number of ``rows``, and whether its anchor is ``contested`` by another class.
    """
    anchors = freeze(map_batches(docs, _find_anchors(length), ANCHORS), "anchors")
    again = anchors.groupBy("hash").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("hash")
    runs = freeze(anchors.join(again, "hash"), "met-anchors")
    discard(anchors)
    del anchors, again
    free_shuffles(docs.sparkSession)
    several = runs.groupBy("hash").agg((F.min("digest") != F.max("digest")).alias("contested"))
    classes = runs.groupBy("hash", "digest").agg(F.min(F.struct("doc", "tk", "run")).alias("first"), F.count(F.lit(1)).alias("rows"))
    classes = freeze(classes.join(several, "hash"), "segment-classes")
    del several
    free_shuffles(docs.sparkSession)
    return runs, classes


def repeated_runs(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """``doc, tk, run``: runs of passage starts of ``docs(doc, tk, text binary)`` that also stand earlier, as a stored table."""
    docs = docs.where(F.length("text") >= length)
    runs, classes = _segment_classes(docs, length)
    first = F.struct("doc", "tk", "run") != F.col("first")
    copies = runs.join(classes.where("rows > 1").select("hash", "digest", "first"), ["hash", "digest"]).where(first).select("doc", "tk", "run")
    contested = classes.where("contested").select("hash", "first.*")
    size = contested.agg(F.sum(F.col("run") % AT + length - 1).alias("b")).first()["b"]
    if size:
        cut = map_batches(_with_runs(docs, contested, "inner", "hash", "run"), _cut(length),
                          "hash long, doc long, tk long, run long, segment binary")
        dealt = cut.repartition(max(1, -(-int(size) // shard_bytes)), "hash").sortWithinPartitions("doc", "tk", "run")
        copies = copies.unionByName(map_batches(dealt, _sort_shard(length, queue_rows), "doc long, tk long, run long"))
    out = freeze(copies, "repeated-runs")
    discard(runs, classes)
    del runs, classes, copies
    free_shuffles(docs.sparkSession)
    return out


def drop_repeats(documents: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, queue_rows: int = QUEUE_ROWS,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, spans, kept``: every document without the bytes that any ``length``-byte
    string covers which also starts earlier, in a document of smaller id or further to the front; judged on the input.

    ``kept`` is binary, as a cut may fall inside a character; ``spans`` are the maximal removed runs.

    Cases: a null text has no bytes; a text of fewer than ``length`` bytes stays whole. A null id stands before all
    others and stays null. Rows of the same id with different texts are documents of their own, in a fixed order by a hash
    of their texts; rows that are equal in both count as one document, so they are not copies of each other, and each
    comes back. Extra columns are ignored. An empty table gives no rows.
    """
    least = F.lit(-(1 << 63))
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    docs = docs.select(F.coalesce("doc_id", least).alias("doc"), "text")
    # Only where an id stands twice do texts need a key of their own beside it.
    twice = not docs.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    docs = docs.select("doc", (F.xxhash64("text") if twice else F.lit(0).cast("long")).alias("tk"), "text")
    runs = repeated_runs(docs, length, shard_bytes, queue_rows)
    doc_id = F.when(F.col("doc") != least, F.col("doc")).alias("doc_id")
    return map_batches(_with_runs(docs, runs, "left", "run").select(doc_id, "z", "run"), _remove(length), DEDUPED)
