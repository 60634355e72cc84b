"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding (operator 3).

Ids are replaced by their rank by corpus frequency, so that the 256 most common
take one byte. A block holds the ranks of many whole documents: two bits an id
in the control bytes say how many data bytes it has (1 to 4, little-endian), and
control and data bytes lie apart. Readers get lengths from a 256-entry table and
take all values of a block at once with numpy.

On disk a token file is a folder: ``ranks`` has the id of every rank, ``blocks``
one row a block with ``part, block, in_part, n_ids, doc_ids, lengths, control,
data``; ``in_part`` counts the ids of the part before the block.
Blocks in the order of (part, block) hold the documents in ascending id order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genenet_spark.llm.common import discard, freeze, map_batches
from genenet_spark.llm.library import library

#: A block is closed once it has so many ids; a document is never split.
BLOCK_IDS = 1 << 19
BLOCK_SCHEMA = ("part int, block int, in_part long, n_ids long, doc_ids array<bigint>, lengths array<bigint>, "
                "control binary, data binary")
#: Data bytes of the four ids of each control byte, and the bits that those leave of four bytes.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + np.uint8(1)
KEPT_BITS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit integers."""
    values = np.ascontiguousarray(values, "<u4")
    if not len(values):
        return b"", b""
    size = (1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)).astype(np.uint8)
    two = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    two[: len(values)] = size - 1
    two = two.reshape(-1, 4)
    control = two[:, 0] | two[:, 1] << 2 | two[:, 2] << 4 | two[:, 3] << 6
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8) < size[:, None]]
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` integers of one block."""
    if not n:
        return np.empty(0, np.uint32)
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    end = np.cumsum(size, dtype=np.int64)
    padded = np.frombuffer(data + b"\0\0\0", np.uint8)
    four = np.lib.stride_tricks.as_strided(padded.view(), (len(data), 4), (1, 1))[end - size]
    return four.copy().view("<u4").ravel() & KEPT_BITS[size]


def _encoded(tokenizer: str, end_id: int, kind: str):
    """``doc_id, h, ids`` of whole texts, end id included, as little-endian integers of ``kind``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = library(tokenizer)
        end = np.array([end_id], kind).tobytes()
        for batch in batches:
            ids = [np.frombuffer(raw, "<u4").astype(kind).tobytes() + end for raw in lib.ids([x or "" for x in batch.column(2).to_pylist()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary())], names=["doc_id", "h", "ids"])

    return run


def _id_counts(n_ids: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(n_ids, np.int64)
        for batch in batches:
            seen += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind), minlength=n_ids)
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(seen[used])], names=["id", "n"])

    return run


def _blocks(ranks, kind: str, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank_of = ranks.value
        part, block = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        docs: list[int | None] = []
        n = in_part = 0

        def close() -> pa.RecordBatch:
            control, data = pack(rank_of[np.concatenate(held)])
            lengths = [len(x) for x in held]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([in_part], pa.int64()),
                 pa.array([n], pa.int64()), pa.array([docs], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
                 pa.array([control], pa.binary()), pa.array([data], pa.binary())],
                names=["part", "block", "in_part", "n_ids", "doc_ids", "lengths", "control", "data"])

        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(raw, kind)
                held.append(ids)
                docs.append(doc)
                n += len(ids)
                if n >= block_ids:
                    yield close()
                    held, docs, n, block, in_part = [], [], 0, block + 1, in_part + n
        if held:
            yield close()

    return run


def write_token_file(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, partitions: int | None = None,
                     block_ids: int = BLOCK_IDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id`` to each and write a token file in ascending id order.

    Every text is encoded once and its ids are stored, in two bytes each where the vocabulary allows; ids are counted from
    there (a table no larger than the vocabulary goes to the driver), sorted by range of doc id and written as blocks, and
    the stored ids are deleted. Cases: null text is the empty text (only ``end_id``);
    null ids come first; rows of one id are in order of their text's hash; repeated rows are all written;
    other columns are ignored; an empty table writes a file with no blocks.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n_ids = max(library(tokenizer).n_ids, end_id + 1)
    kind = "<u2" if n_ids <= 1 << 16 else "<u4"
    rows = rows.select("doc_id", F.xxhash64("text").alias("h"), "text")
    encoded = freeze(map_batches(rows, _encoded(tokenizer, end_id, kind), "doc_id long, h long, ids binary"), "encoded")
    counted = map_batches(encoded.select("ids"), _id_counts(n_ids, kind), "id long, n long")
    seen = counted.groupBy("id").agg(F.sum("n").alias("n")).toPandas()  # at most a row an id of the vocabulary
    counts = np.zeros(n_ids, np.int64)
    counts[seen["id"].to_numpy(int)] = seen["n"].to_numpy(int)
    by_rank = np.lexsort((np.arange(n_ids), -counts))
    rank_of = np.empty(n_ids, np.uint32)
    rank_of[by_rank] = np.arange(n_ids, dtype=np.uint32)
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(by_rank)], "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")

    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = encoded.repartitionByRange(partitions, "doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "ids")
    blocks = map_batches(ordered, _blocks(spark.sparkContext.broadcast(rank_of), kind, block_ids), BLOCK_SCHEMA)
    blocks.write.option("compression", "zstd").parquet(f"{path}/blocks")
    discard(encoded)


def _documents(table, parts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_of = table.value
        for batch in batches:
            for row in batch.to_pylist():
                ids = id_of[unpack(row["control"], row["data"], row["n_ids"])]
                ends = np.cumsum(np.array(row["lengths"], np.int64))
                starts = np.concatenate([[0], ends[:-1]])
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["in_part"] + parts.value[row["part"]], pa.int64()),
                     pa.array(row["lengths"], pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """Decode a token file: a row for each document with ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it in the file; ``ids_crc32`` is the unsigned crc32 of its
    ids, end id included, as little-endian unsigned 32-bit integers. An empty file gives no rows.
    """
    table = spark.read.schema("rank long, id long").parquet(f"{path}/ranks").orderBy("rank").toPandas()
    ids = spark.sparkContext.broadcast(table["id"].to_numpy().astype("<u4"))
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    # Ids before each part: one row a part, that is a task that wrote, goes to the driver.
    parts = sorted((r["part"], r["n"]) for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    before, total = {}, 0
    for part, n in parts:
        before[part] = total
        total += n
    return map_batches(blocks, _documents(ids, spark.sparkContext.broadcast(before)),
                       "doc_id long, start long, n_tokens long, ids_crc32 long")
