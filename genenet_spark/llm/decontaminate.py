"""Benchmark decontamination by containment search (operator 5). DataFrame functions only.

A test item leaks into a document when the document holds at least ``threshold``
of the item's distinct word shingles, wherever they stand in it.

Search. Items are partitioned by size (powers of two of their shingle count). Each
item is sketched by its smallest shingle hashes under one fixed hash function, the
bottom-k form of MinHash. k belongs to the size partition: the most shingles that a
leaked item of the partition may lack, and one more. So every document above the
threshold holds a sketch value of the item, however long it is: unlike banded
signatures of whole documents, which lose a short item among the many minima of a
long text, no leak is lost. Documents are probed by all their shingle hashes.

Verification. Candidate pairs are compared by the shingles themselves, as text: the
item's distinct shingles in the document are counted exactly.

The benchmark side is stored first, so the planner knows its size: it broadcasts it
below its threshold and shuffles by shingle hash above, where hot shingles are
split. Documents are known by a digest of their text, so copies share a verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from genenet_spark.llm.common import discard, freeze

WORDS = 5
THRESHOLD = 0.8


def _words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _shingles(rows: DataFrame, key: list[str], n: int) -> DataFrame:
    """``key`` and the ``n`` words of each shingle as an array ``w`` at ``pos``, from a column ``words``."""
    return rows.select(*key, "words", F.posexplode("words").alias("pos", "__w")).where(F.col("pos") <= F.size("words") - n)


def _spelled(n: int) -> Column:
    return F.concat_ws(" ", *[F.get("words", F.col("pos") + i) for i in range(n)])


def _hashed(n: int) -> Column:
    return F.xxhash64(*[F.get("words", F.col("pos") + i) for i in range(n)])


def leaks(docs: DataFrame, items: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, shared, item_shingles, containment`` for each document and each item that leaked into it.

    Cases: null texts and texts of fewer than ``words`` words have no shingle, such items are found nowhere and
    such documents hold nothing; repeated document rows give repeated pairs; several item rows of one id are
    one item with the shingles of all; rows of null item id are items of null id; a containment equal to the
    threshold counts; extra columns are ignored; an empty table on either side gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    rows = rows.select("doc_id", "text", F.unhex(F.md5("text")).alias("doc"))
    item_words = items.select(F.col(item_id_col).alias("item_id"), _words(F.col(item_text_col).cast("string")).alias("words"))
    spelled = _shingles(item_words, ["item_id"], words).select("item_id", _spelled(words).alias("shingle"), _hashed(words).alias("h")).distinct()
    sizes = spelled.groupBy("item_id").agg(F.count(F.lit(1)).alias("size"))
    need = F.ceil(F.col("size") * F.lit(threshold) - F.lit(1e-9)).cast("long")
    index = freeze(spelled.join(sizes.withColumnRenamed("item_id", "__i"), F.col("item_id").eqNullSafe(F.col("__i"))).drop("__i")
                   .withColumn("need", need), "items")

    # The largest size of the partition sets the sketch depth of every item in it.
    top = F.pow(F.lit(2.0), F.floor(F.log2("size")) + 1) - 1
    depth = F.least(F.col("size"), F.floor(top * F.lit(1 - threshold) + F.lit(1e-9)) + 1)
    order = Window.partitionBy("item_id").orderBy("h", "shingle")  # one item's shingles
    sketch = index.withColumn("r", F.row_number().over(order)).where(F.col("r") <= depth)
    # Without the items of a value: they are looked up for the values that occur, not for every shingle.
    probes = freeze(sketch.select("h", "item_id").distinct(), "sketches")

    tokens = rows.select("doc", _words(F.col("text")).alias("words"))
    hits = _shingles(tokens, ["doc"], words).select("doc", _hashed(words).alias("h")).join(probes, "h")
    candidates = freeze(hits.select("doc", "item_id").distinct(), "candidates")

    wanted = candidates.select("doc").distinct()
    again = rows.select("doc", "text").join(wanted, "doc", "left_semi").select("doc", _words(F.col("text")).alias("words"))
    held = _shingles(again, ["doc"], words).select("doc", _spelled(words).alias("shingle")).join(
        index.select("shingle", "item_id", "size", "need"), "shingle")
    pairs = held.groupBy("doc", "item_id", "size", "need").agg(F.count_distinct("shingle").alias("shared")).where("shared >= need")
    same = (F.col("doc") == F.col("__d")) & F.col("item_id").eqNullSafe(F.col("__i"))
    pairs = pairs.join(candidates.select(F.col("doc").alias("__d"), F.col("item_id").alias("__i")), same, "left_semi")
    found = freeze(pairs.select("doc", "item_id", "shared", F.col("size").alias("item_shingles")), "leaks")
    discard(index, probes, candidates)
    return rows.select("doc_id", "doc").join(found, "doc").select(
        "doc_id", "item_id", "shared", "item_shingles", (F.col("shared") / F.col("item_shingles")).alias("containment"))


def clean(docs: DataFrame, items: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` into which no item leaked; null ids are kept unless their text leaks too."""
    leaked = leaks(docs.select(id_col, text_col).withColumn("__key", F.md5(F.col(text_col).cast("string"))), items, words,
                   threshold, "__key", text_col).select(F.col("doc_id").alias("__leaked")).distinct()
    leaked = freeze(leaked, "leaked")
    return docs.join(leaked, F.md5(F.col(text_col).cast("string")) == F.col("__leaked"), "left_anti")
