"""Exact Jaccard join over word n-grams by grouped prefixes (operator 6).

A document is the set of its distinct word shingles, each a 64-bit hash. All
sets are sorted by one global order; two sets above the threshold share a value
among the first ``size - ceil(threshold * size) + 1`` of each, the prefix.

1. Documents of equal sets are one class.
2. Classes with identical prefix and size are one group; the prefix index holds
   groups, not documents.
3. Star round: per prefix value one pivot group is paired with the others by their
   first classes, and per group its first class with the other members. Pairs whose
   sizes can't fit are filtered; the rest is filtered by parity bitmaps and verified,
   each class's best pair first. Links join components.
4. Full round: prefix values (and groups) whose members are still in several
   components are worked in full: all members of a list are compared by bitmap, in
   blocks, across components. What passes is expanded to pairs and verified. Pairs
   inside a component need no check: they can't change the result.

5. For the number of links (or the pairs), the classes of each component are compared
   with one another in blocks: every link lies inside a component, so none is lost, and a
   pair is in one block pair only. A task verifies what bitmaps allow with the texts at hand
   and gives a row a class, not a pair.

Steps 3 and 4 alone give the components (``keep_one``).

Each linked pair shares a prefix value or a group, so it is verified or already
joined: no link is lost. A row is a candidate pair only if it passes the bitmap, which
is nearly exact for common sizes, so lists of unlike documents make no rows and a
large group of near copies makes about as many rows as it has members. Filters are
sound: the symmetric difference of two sets is at least the number of differing bits
of their parity bitmaps.

The global order puts frequent shingles last, so that a passage shared by many
documents is hardly ever in a prefix. The order only changes the cost: it is
taken from the most frequent values of all documents, a table of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genenet_spark.llm.common import discard, free_shuffles, freeze, map_batches, small_batches
from genenet_spark.llm.components import components

#: Frequent values that the global order knows; a task reports at most as many.
FREQUENT = 50_000
#: The full round compares lists in blocks of so many classes.
BLOCK = 4096
#: All links of a component are verified in blocks of so many classes.
LINK_BLOCK = 512
#: Rounds of verification: best pairs, best pairs of what is left, all that are left.
VERIFY_ROUNDS = 3
#: Keys of candidate texts that are broadcast at most: 16 MB.
BROADCAST_KEYS = 2_000_000
#: Bits of the parity bitmap of a set: a power of two, least and most.
BITMAP, WIDEST = 1024, 1 << 20
#: Bytes of bitmaps that are compared at once.
COMPARED = 4 << 20
#: Words whose hashes a Python worker keeps: some 10 MB. Hashing a word again costs no more than finding it in a large table.
HASHED_WORDS = 1 << 16


class _WordHashes(dict):
    """Hash of each word, kept for the common ones."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < HASHED_WORDS:
            self[word] = value
        return value


_HASHES = _WordHashes()


def shingle_set(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles of a text; fewer words make one shingle of all.

    Words are runs without ASCII white space, with A-Z in lower case.
    """
    words = text.lower().split()  # of bytes: both know ASCII only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(n, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        out ^= h[i : len(h) - width + 1 + i]
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def bitmap(s: np.ndarray, percent: int) -> bytes:
    """Parity bitmap of a set, wide enough to tell it from an unlike one of its size.

    Half the bits of two unlike sets differ at most, whatever their size, so sets of more shingles than bits
    need wider bitmaps for the bound on the symmetric difference to bite.
    """
    width, unlike = BITMAP, 5 * (100 - percent) * len(s) // (100 + percent)
    while width < min(unlike, WIDEST):
        width *= 2
    bits = np.bincount((s >> np.uint64(17)).astype(np.int64) & (width - 1), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


class Bitmaps:
    """The bitmaps of many sets. Those of two widths are compared at the lesser: the wider one folds to it by exclusive or."""

    def __init__(self, raw: list[bytes]):
        self.raw, self.width = raw, np.array(list(map(len, raw)), np.int64)
        self.folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _of_width(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """A row of ``width`` bytes for each bitmap at least as wide, and the row's place by the bitmap's."""
        if width not in self.folded:
            place = np.cumsum(self.width >= width) - 1
            rows = np.empty((int(place[-1]) + 1, width // 8), np.uint64)
            for w in np.unique(self.width[self.width >= width]).tolist():
                at = np.flatnonzero(self.width == w)
                own = np.frombuffer(b"".join([self.raw[i] for i in at.tolist()]), np.uint64).reshape(len(at), w // width, width // 8)
                rows[place[at]] = np.bitwise_xor.reduce(own, axis=1)
            self.folded[width] = rows, place
        return self.folded[width]

    def differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of differing bits of the sets ``a`` and ``b``, place by place: no more than their symmetric difference."""
        width = np.minimum(self.width[a], self.width[b])
        out = np.empty(len(a), np.int64)
        for w in np.unique(width).tolist():
            rows, place = self._of_width(w)
            at = np.flatnonzero(width == w)
            for i in range(0, len(at), max(1, COMPARED // w)):
                some = at[i : i + max(1, COMPARED // w)]
                out[some] = np.bitwise_count(rows[place[a[some]]] ^ rows[place[b[some]]]).sum(axis=-1, dtype=np.int64)
        return out


def _frequent(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        held: list[np.ndarray] = []
        size = 0

        def merge() -> tuple[np.ndarray, np.ndarray]:
            new, seen = np.unique(np.concatenate(held), return_counts=True) if held else (values, counts)
            if held and len(values):
                new, at = np.unique(np.concatenate([values, new]), return_inverse=True)
                seen = np.bincount(at, np.concatenate([counts, seen])).astype(np.int64)
            if len(new) > FREQUENT:
                top = np.argpartition(-seen, FREQUENT)[:FREQUENT]
                new, seen = new[top], seen[top]
            often = seen > 1
            return new[often], seen[often]

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(shingle_set(text or b"", n))
                size += len(held[-1])
                if size > 1_500_000:
                    values, counts = merge()
                    held, size = [], 0
        values, counts = merge()
        yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], names=["value", "n"])

    return run


def _signatures(n: int, percent: int, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, place = frequent.value
        for batch in batches:
            size, digest, prefix, group, bits = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text or b"", n)
                size.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                p = len(s) - -(-percent * len(s) // 100) + 1 if len(s) else 0
                if len(common) and len(s):
                    at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                    rank = np.where(common[at] == s, place[at], 0)
                    s_ordered = s[np.argsort(rank, kind="stable")[:p]]
                else:
                    s_ordered = s[:p]
                prefix.append(s_ordered.view(np.int64))
                group.append(xxhash.xxh3_64_intdigest(s_ordered.tobytes(), seed=len(s)) - (1 << 63) if len(s) else None)
                bits.append(bitmap(s, percent))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(size, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(prefix, pa.list_(pa.int64())), pa.array(group, pa.int64()), pa.array(bits, pa.binary())],
                names=["doc_id", "text_key", "n", "set", "prefix", "grp", "bits"])

    return run


def _may_link(percent: int):
    """Keep pairs whose bitmaps allow the threshold: |A xor B| >= differing parity bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            if not batch.num_rows:
                continue
            at = np.arange(batch.num_rows)
            differ = Bitmaps(col["bits_a"].to_pylist() + col["bits_b"].to_pylist()).differ(at, at + batch.num_rows)
            total = col["n_a"].to_numpy().astype(np.int64) + col["n_b"].to_numpy()
            # J >= t  iff  |A xor B| <= (1 - t) / (1 + t) * (|A| + |B|)
            keep = pa.array(differ * (100 + percent) <= (100 - percent) * total)
            share = pa.array(differ / total)
            yield pa.RecordBatch.from_arrays([*(col[c].filter(keep) for c in ("a", "b", "key_a", "key_b")), share.filter(keep)],
                                             names=["a", "b", "key_a", "key_b", "share"])

    return run


def _compare(percent: int, best: bool):
    """Pairs of different components inside each list ``(value, i, j)`` that sizes and bitmaps allow.

    Rows come sorted by list, then size. A list with i = j is compared within itself, else its block i with block j.
    With ``best``, only the most promising pair of each class of a list: no more rows than the list has, and none only
    where no pair of the list is allowed. Rows are ``a, b, value``.
    """

    def chosen(a: np.ndarray, b: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Places of the pairs that are the best of either end."""
        end, place = np.concatenate([a, b]), np.tile(np.arange(len(a)), 2)
        order = np.lexsort((place, share[place], end))
        first = np.ones(len(order), bool)
        first[1:] = end[order][1:] != end[order][:-1]
        return np.unique(place[order][first])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def worked(table: pa.Table) -> Iterator[pa.RecordBatch]:
            table = table.combine_chunks()
            key = np.stack([table.column(i).to_numpy().astype(np.int64) for i in range(3)], axis=1)
            sets, n = table.column(3), table.column(4).to_numpy()
            comp = table.column(5).combine_chunks().dictionary_encode().indices.to_numpy()
            block = table.column(6).to_numpy()
            mask = Bitmaps(table.column(7).to_pylist())
            start = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
            size = np.diff(np.append(start, len(key)))
            for m in np.unique(size[(size > 1) & (size <= 64)]).tolist():  # short lists of one length together
                heads = start[size == m]
                one, two = np.triu_indices(m, 1)
                step = max(1, 200_000 // len(one))
                for at in range(0, len(heads), step):
                    h = heads[at : at + step, None]
                    yield from passed(sets, n, comp, block, mask, key, (h + one).ravel(), (h + two).ravel())
            for head, m in zip(start[size > 64].tolist(), size[size > 64].tolist()):
                last = head + np.searchsorted(n[head : head + m], n[head : head + m] * 100 // percent, side="right")  # sizes that fit
                for row in range(head, head + m):
                    two = np.arange(row + 1, int(last[row - head]))
                    yield from passed(sets, n, comp, block, mask, key, np.full(len(two), row), two)

        def passed(sets, n, comp, block, mask, key, a, b) -> Iterator[pa.RecordBatch]:
            ok = (comp[a] != comp[b]) & (n[b] * percent <= n[a] * 100) & ((key[a, 1] == key[a, 2]) | (block[a] != block[b]))
            a, b = a[ok], b[ok]
            differ = mask.differ(a, b)
            ok = differ * (100 + percent) <= (100 - percent) * (n[a] + n[b])
            if ok.any():
                a, b, differ = a[ok], b[ok], differ[ok]
                if best:
                    share = differ / (n[a] + n[b])
                    # Of a long list one row comes at a time: its best pair alone, or every partner's only pair would count.
                    pick = chosen(a, b, share) if a[0] != a[-1] else np.array([np.argmin(share)])
                    a, b = a[pick], b[pick]
                left, right = (sets.take(pa.array(x)).combine_chunks() for x in (a, b))
                yield pa.RecordBatch.from_arrays([left, right, pa.array(key[a, 0])], names=["a", "b", "value"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            if not table.num_rows:
                continue
            # The last list of a batch may go on in the next one.
            last = [table.column(i)[-1].as_py() for i in range(3)]
            same = np.ones(table.num_rows, bool)
            for i in range(3):
                same &= table.column(i).to_numpy() == last[i]
            cut = int(np.argmax(same))
            if cut:
                yield from worked(table.slice(0, cut))
            rest = table.slice(cut)
        if rest is not None and rest.num_rows:
            yield from worked(rest)

    return run


def _all_links(n: int, percent: int, pairs: bool):
    """All links between the classes of each block pair ``(comp, i, j)``, as pairs or as numbers of links by class.

    Rows ``comp, i, j, block, set, n, bits, text`` come sorted by block pair. Each pair of classes meets in one of them.
    """

    def worked(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        block, own, size = (np.array([r[c] for r in rows]) for c in (3, 5, 6))
        names = [r[4] for r in rows]
        mask = Bitmaps([r[7] for r in rows])
        sets = [shingle_set(r[8], n) for r in rows]
        values, place = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.cumsum(size)
        sets = np.split(place, ends[:-1])
        held, links = np.zeros(len(values), bool), np.zeros(len(rows), np.int64)
        left, right = [], []
        for a in range(len(rows) - 1):
            b = np.arange(a + 1, len(rows))
            b = b[(np.minimum(size[b], size[a]) * 100 >= np.maximum(size[b], size[a]) * percent) & (own[a] | (block[b] != block[a]))]
            differ = mask.differ(np.full(len(b), a), b)
            b = b[differ * (100 + percent) <= (100 - percent) * (size[a] + size[b])]
            if not len(b):
                continue
            held[sets[a]] = True
            first = np.cumsum(size[b]) - size[b]
            both = np.add.reduceat(held[np.concatenate([sets[x] for x in b.tolist()])].astype(np.int64), first)
            held[sets[a]] = False
            b = b[100 * both >= percent * (size[a] + size[b] - both)]
            links[a] += len(b)
            links[b] += 1
            if pairs and len(b):
                left += [min(names[a], names[x]) for x in b.tolist()]
                right += [max(names[a], names[x]) for x in b.tolist()]
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])
        else:
            some = np.flatnonzero(links).tolist()
            yield pa.RecordBatch.from_arrays([pa.array([names[x] for x in some], pa.binary()), pa.array(links[some])], names=["set", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for comp, i, j, block, name, size, bits, text in zip(*(batch.column(c).to_pylist() for c in range(8))):
                if (comp, i, j) != now:
                    if len(rows) > 1:
                        yield from worked(rows)
                    now, rows = (comp, i, j), []
                rows.append((comp, i, j, block, name, i == j, size, bits, text))
        if len(rows) > 1:
            yield from worked(rows)

    return run


def _verify(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bytes, np.ndarray] = (b"", np.empty(0, np.uint64))
        for batch in batches:
            keep = []
            for ta, tb in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if ta != last[0]:
                    last = ta, shingle_set(ta, n)
                a, b = last[1], shingle_set(tb, n)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return run


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent)


def link_components(docs: DataFrame, n: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, verified_links`` for each input row.

    ``component_id`` is the smallest id reachable by links (100 * intersection >= ``percent`` * union), the
    row's own included; ``verified_links`` counts the links of the row's class to classes of other sets, all of them.

    Cases: null texts and texts without words have an empty set, no link and their own id as component; a text
    of fewer than ``n`` words is one shingle; rows of equal sets link whatever their ids; repeated rows are
    repeated; null ids never are the smallest (null only where all ids of a component are null); other columns
    are ignored; an empty table gives an empty result.
    """
    with small_batches(docs.sparkSession):
        signed, label, classes, rows = _labelled(docs, n, percent, id_col, text_col)
        links = _linked(rows, classes, label, n, percent, pairs=False)
    links = links.groupBy("set").agg(F.sum("links").alias("links"))
    discard(classes)
    label = label.join(links, "set", "left")
    return signed.select("doc_id", F.col("n").alias("n_shingles"), "set").join(label, "set", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("verified_links"))


def linked_classes(docs: DataFrame, n: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(``a, b`` of every linked pair of classes, ``doc_id, set`` of each input row: its class). Rows of one class are all linked."""
    with small_batches(docs.sparkSession):
        signed, label, classes, rows = _labelled(docs, n, percent, id_col, text_col)
        links = _linked(rows, classes, label, n, percent, pairs=True)
    discard(classes, label)
    return links, signed.where("n > 0").select("doc_id", "set")


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows without near duplicates: one row of each component stays.

    It is the row of the smallest id (a null id only where all are null), of rows of that id the one of the
    least text hash, of those the first by its other columns (as JSON). Rows without words are linked with nothing and stay.
    """
    with small_batches(docs.sparkSession):
        signed, label, classes, _ = _labelled(docs, n, percent, id_col, text_col)
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    rows = signed.where("n > 0").join(label.select("set", "comp"), "set").select("comp", row.alias("row"))
    first = rows.groupBy("comp").agg(F.min("row").alias("row"))
    gone = rows.join(first.withColumnRenamed("row", "stays"), "comp").where(~F.col("row").eqNullSafe(F.col("stays"))).select("row").distinct()
    gone = freeze(gone.select(F.col("row.doc_id").alias("__id"), F.col("row.text_key").alias("__key")), "dropped")
    repeated = signed.where("n > 0").groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    repeated = freeze(repeated.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")), "repeated")
    discard(signed, label, classes)
    key = F.xxhash64(F.col(text_col).cast("string").cast("binary"))
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (key == F.col("__key"))
    kept = docs.join(gone, same, "left_anti")
    alone = kept.join(repeated, same, "left_anti")
    others = F.to_json(F.struct(*[F.col(c) for c in docs.columns if c not in (id_col, text_col)], F.lit(0).alias("__none")))
    order = Window.partitionBy(id_col, "__key").orderBy("__others")
    one = kept.join(repeated, same, "left_semi").withColumns({"__key": key, "__others": others})
    one = one.withColumn("__place", F.row_number().over(order)).where("__place = 1").select(docs.columns)
    return alone.unionByName(one)


def _labelled(docs: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(a signature row for each input row, ``set, comp, component_id`` for each distinct set, the classes, the input rows)."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string").cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    often = map_batches(rows.select("text"), _frequent(n), "value long, n long").groupBy("value").agg(F.sum("n").alias("n"))
    often = often.orderBy(F.desc("n"), "value").limit(FREQUENT).toPandas()  # bounded: places in the order, not rows of the result
    common = often["value"].to_numpy(np.int64).view(np.uint64)
    place = np.arange(len(common), 0, -1, dtype=np.int64)  # the most frequent value comes last
    by_value = np.argsort(common)
    frequent = spark.sparkContext.broadcast((common[by_value], place[by_value]))

    signed = freeze(map_batches(rows, _signatures(n, percent, frequent), "doc_id long, text_key long, n long, set binary, "
                                "prefix array<bigint>, grp long, bits binary"), "signatures")
    classes = signed.where("n > 0").groupBy("set").agg(
        F.first("n").alias("n"), F.min("doc_id").alias("least"), F.min("text_key").alias("key"), F.first("grp").alias("grp"),
        F.first("bits").alias("bits"))
    classes = freeze(classes, "classes")
    groups = freeze(classes.groupBy("grp", "n").agg(F.min("set").alias("head"), F.count(F.lit(1)).alias("members")), "groups")

    # The prefix index: values that two groups or more of fitting sizes have.
    prefixes = freeze(signed.where("n > 0").select("grp", "n", "prefix").dropDuplicates(["grp", "n"]), "prefixes")
    index = freeze(_index(prefixes, percent), "index")
    discard(prefixes)
    free_shuffles(spark)

    head = groups.select("grp", "n", "head")
    star = index.where((F.col("grp") != F.col("pivot.grp")) | (F.col("n") != F.col("pivot.n"))).where(
        _sizes_fit(F.col("n"), F.col("pivot.n"), percent)).select("grp", "n", "pivot").distinct()
    star = star.join(head, ["grp", "n"]).select("pivot", F.col("head").alias("b")).join(
        head.select(F.struct("grp", "n").alias("pivot"), F.col("head").alias("a")), "pivot").select("a", "b")
    inside = classes.join(groups.where("members > 1").select("grp", "n", "head"), ["grp", "n"]).where(
        F.col("set") != F.col("head")).select(F.col("head").alias("a"), F.col("set").alias("b"))
    found: list[DataFrame] = []
    _joined(rows, classes, star.unionByName(inside), found, n, percent)
    comp = components(_union(found)) if found else classes.select(F.col("set").alias("node"), F.col("set").alias("comp")).limit(0)

    # Lists of classes by prefix value, and by group where a group has several; a class without links is its own component.
    member = classes.select("set", "grp", "n").join(comp.withColumnRenamed("node", "set"), "set", "left").select(
        "set", "grp", "n", F.coalesce("comp", "set").alias("comp"))
    placed = index.select("value", "grp", "n").join(member, ["grp", "n"]).unionByName(
        member.join(groups.where("members > 1").select("grp", "n"), ["grp", "n"], "left_semi").select(
            F.xxhash64("grp", "n", F.lit("group")).alias("value"), "grp", "n", "set", "comp"))
    placed = freeze(_open(placed.select("value", "set", "n", "comp")), "open")
    discard(index, groups, *([comp] if found else []))
    free_shuffles(spark)
    for best in (True, False):  # the first pass joins most of a group of near copies, the second one is complete
        blocks = F.ceil(F.col("members") / BLOCK).cast("int")
        own = F.pmod(F.xxhash64("set", F.lit("block")), F.col("blocks")).cast("int")
        worked = placed.withColumn("blocks", blocks).withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        worked = worked.select("value", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "set", "n", "comp", "block")
        worked = worked.join(classes.select("set", "bits"), "set").select("value", "i", "j", "set", "n", "comp", "block", "bits")
        worked = worked.repartition("value", "i", "j").sortWithinPartitions("value", "i", "j", "n")
        compared = freeze(map_batches(worked, _compare(percent, best), "a binary, b binary, value long"), "compared")
        free_shuffles(spark)
        before = len(found)
        _joined(rows, classes, compared.select("a", "b"), found, n, percent)
        if best and len(found) > before:
            comp = components(_union(found))
            new = comp.select(F.col("node").alias("set"), F.col("comp").alias("joined"))
            # A list without a pair that passes has none later on either.
            moved = placed.join(compared.select("value").distinct(), "value", "left_semi").join(new, "set", "left")
            moved = moved.select("value", "set", "n", F.coalesce("joined", "comp").alias("comp"))
            old, placed = placed, freeze(_open(moved), "open")
            discard(old, comp)
            free_shuffles(spark)
        discard(compared)
        if len(found) == before:
            break  # no pair at all passes the bitmaps
    discard(placed)
    every = _union(found) if found else classes.select(F.col("set").alias("a"), F.col("set").alias("b")).limit(0)
    comp = components(every)
    known = classes.select("set", "least").join(comp.withColumnRenamed("node", "set"), "set", "left").withColumn("comp", F.coalesce("comp", "set"))
    lowest = known.groupBy("comp").agg(F.min("least").alias("component_id"))
    label = known.join(lowest, "comp")
    label = freeze(label.select("set", "comp", "component_id"), "labels")
    discard(comp, *found)
    free_shuffles(spark)
    return signed, label, classes, rows


def _linked(rows: DataFrame, classes: DataFrame, label: DataFrame, n: int, percent: int, pairs: bool) -> DataFrame:
    """``a, b`` of all linked pairs of classes, or ``set, links`` with the links of a class in each block pair."""
    sizes = label.groupBy("comp").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    member = label.join(sizes, "comp").join(classes.select("set", "n", "bits", "key"), "set").withColumn("blocks", F.ceil(F.col("m") / LINK_BLOCK).cast("int"))
    member = member.withColumn("block", F.pmod(F.xxhash64("set", F.lit("links")), F.col("blocks")).cast("int"))
    member = freeze(member.select("comp", "set", "n", "bits", "key", "blocks", "block"), "members")
    texts = rows.select("text_key", "text").join(member.select(F.col("key").alias("text_key")).distinct(), "text_key", "left_semi")
    texts = texts.groupBy("text_key").agg(F.first("text").alias("text"))
    with_text = member.join(texts.withColumnRenamed("text_key", "key"), "key")
    worked = with_text.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    worked = worked.select("comp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "set", "n", "bits", "text")
    worked = worked.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j", "block", "set")
    links = freeze(map_batches(worked, _all_links(n, percent, pairs), "a binary, b binary" if pairs else "set binary, links long"), "all-links")
    discard(member)
    free_shuffles(rows.sparkSession)
    return links


def _union(links: list[DataFrame]) -> DataFrame:
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out.distinct()


def _open(placed: DataFrame) -> DataFrame:
    """The lists that are in several components, with their number of members."""
    several = placed.groupBy("value").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("members"))
    return placed.join(several.where("lo <> hi").select("value", "members"), "value")


def _index(prefixes: DataFrame, percent: int) -> DataFrame:
    """``value, grp, n, pivot``: the prefix values of each group that another group may be found by, and one group of each value.

    A pair is found by the first value that both sets have. All they share stands from there on, so a set of ``n`` whose
    value stands at ``pos`` meets sizes from ``percent`` of ``n`` to ``(n - pos) * (100 + percent) / percent - n`` there.
    Rows whose list, in the order of sizes, has no such neighbour find nothing and are left out.
    """
    posts = prefixes.select("grp", "n", F.posexplode("prefix").alias("pos", "value"))
    by_size = Window.partitionBy("value").orderBy("n")
    less, more = F.lag("n").over(by_size), F.lead("n").over(by_size)
    met = (less * 100 >= F.col("n") * percent) | ((more + F.col("n")) * percent <= (F.col("n") - F.col("pos")) * (100 + percent))
    kept = posts.withColumn("met", met).where("met").select("value", "grp", "n")
    every = Window.partitionBy("value")
    kept = kept.withColumns({"k": F.count(F.lit(1)).over(every), "pivot": F.min(F.struct("grp", "n")).over(every)})
    return kept.where("k > 1").select("value", "grp", "n", "pivot")


def _joined(rows: DataFrame, classes: DataFrame, pairs: DataFrame, found: list[DataFrame], n: int, percent: int) -> None:
    """Verify pairs of classes until every one is a link, no link, or inside a component; add the links to ``found``.

    First every class's most promising pair is verified, as in Boruvka's spanning trees: that joins most of a
    group of near copies with as many checks as it has members. Pairs that are then still between components
    are treated the same way once more; the last round verifies all that are left.
    """
    spark = rows.sparkSession
    side = classes.select("set", "n", "bits", "key")
    known = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for c in ("a", "b"):
        known = known.join(side.select(F.col("set").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"),
                                       F.col("key").alias(f"key_{c}")), c)
    todo = freeze(map_batches(known.select("a", "b", "n_a", "n_b", "bits_a", "bits_b", "key_a", "key_b"), _may_link(percent),
                              "a binary, b binary, key_a long, key_b long, share double"), "candidates")
    free_shuffles(spark)
    for turn in range(VERIFY_ROUNDS):
        if todo.isEmpty():
            discard(todo)
            break
        now = todo
        if turn < VERIFY_ROUNDS - 1:
            pair = F.struct("share", "a", "b", "key_a", "key_b").alias("p")
            best = todo.select(F.col("a").alias("v"), pair).unionAll(todo.select(F.col("b").alias("v"), pair)).groupBy("v").agg(F.min("p").alias("p"))
            now = freeze(best.select("p.a", "p.b", "p.key_a", "p.key_b").distinct(), "chosen")
        links = _verified(rows, now, n, percent)
        found.append(links)
        if turn == VERIFY_ROUNDS - 1:
            discard(todo)
            break
        comp = components(_union(found))
        left = todo.join(now.select("a", "b"), ["a", "b"], "left_anti")
        for c in ("a", "b"):
            left = left.join(comp.select(F.col("node").alias(c), F.col("comp").alias(f"comp_{c}")), c, "left")
        left = left.where(F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b")).select(*todo.columns)
        old, todo = todo, freeze(left, "candidates")
        discard(old, now, comp)
        free_shuffles(spark)


def _verified(rows: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose texts are links."""
    spark = rows.sparkSession
    wanted = freeze(pairs.select(F.col("key_a").alias("text_key")).union(pairs.select("key_b")).distinct(), "wanted")
    # 8 bytes each; beyond the bound it is a shuffled join
    keys = F.broadcast(wanted) if wanted.count() <= BROADCAST_KEYS else wanted
    texts = rows.select("text_key", "text").join(keys, "text_key", "left_semi").groupBy("text_key").agg(F.first("text").alias("text"))
    texts = freeze(texts, "texts")
    free_shuffles(spark)
    both = pairs.join(texts.withColumnRenamed("text_key", "key_b").withColumnRenamed("text", "text_b"), "key_b")
    both = both.join(texts.withColumnRenamed("text_key", "key_a").withColumnRenamed("text", "text_a"), "key_a")
    links = freeze(map_batches(both.select("a", "b", "text_a", "text_b"), _verify(n, percent), "a binary, b binary"), "links")
    discard(texts, wanted)
    free_shuffles(spark)
    return links
