"""Language identification with error-correcting output codes (operator 10).

Every language gets a codeword; a bit splits the languages in two halves. For each
bit a binary classifier over hashed character n-grams (1 to 3) tells the halves
apart: naive Bayes with the n-gram counts of the two sides, whose weight for an
n-gram is the difference of its smoothed log probabilities. A text's margin for a
bit is the mean weight of its n-grams. Decoding adds up, for each codeword, the
logistic loss of every bit's margin against the codeword's bit, weighted by how
well that bit separates the training counts, and takes the codeword of least loss.
A text whose two best codewords are close in loss is flagged as ambiguous.

Training counts come from all labelled rows: each task adds up a table of
languages x buckets, so what is shuffled and collected is bounded by that table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genenet_spark.llm.common import map_batches, ship_package

BUCKETS = 1 << 14
#: Additive smoothing of n-gram counts, as a share of the mean bucket.
SMOOTHING = 0.5
#: Two best codewords closer than this share of the probability are ambiguous.
AMBIGUOUS = 0.6
#: Languages that one table may hold; 1000 x 16384 counts are 130 MB.
MAX_LANGUAGES = 1000
#: Code points of a text whose n-grams are hashed at once; a longer text is taken in pieces.
PIECE = 1 << 20


def bucket_counts(text: str, buckets: int = BUCKETS) -> np.ndarray | None:
    """Hashed counts of the 1- to 3-grams of lower-cased letters, other runs as one space; None without a letter.

    A text longer than ``PIECE`` is hashed piece by piece: the last two codes of one are carried to the next, so that
    every n-gram counts once, also across a seam.
    """
    counts = np.zeros(buckets, np.float32)
    shift = np.uint32(32 - buckets.bit_length() + 1)
    text = text.lower()
    letters, after_letter, carried = False, True, np.empty(0, np.uint32)
    for at in range(0, len(text), PIECE):
        code = np.frombuffer(text[at : at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        is_letter = _letter(code)
        letters |= bool(is_letter.any())
        keep = is_letter | np.concatenate([[after_letter], is_letter[:-1]])  # letters, and the first of each other run
        after_letter = bool(is_letter[-1])
        old = len(carried)
        code = np.concatenate([carried, np.where(is_letter, code, np.uint32(32))[keep]])
        h = code * np.uint32(0x9E3779B1)
        two = (h[:-1] ^ (h[1:] >> np.uint32(15))) * np.uint32(0x85EBCA77) + code[1:]
        three = (two[:-1] ^ (h[2:] >> np.uint32(13))) * np.uint32(0xC2B2AE3D) + code[2:]
        new = h[old:], two[max(old - 1, 0) :] * np.uint32(0x27D4EB2F), three * np.uint32(0x165667B1)
        for x in new:
            counts += np.bincount(x >> shift, minlength=buckets)
        carried = code[-2:]
    return counts if letters else None


_LETTERS = np.zeros(0x110000, bool)


def _letter(code: np.ndarray) -> np.ndarray:
    """Which code points are letters, from Python's Unicode table (built on first use)."""
    if not _LETTERS[97]:
        for c in range(0x110000):
            if chr(c).isalpha():
                _LETTERS[c] = True
    return _LETTERS[code]


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A row of -1 / +1 bits for each of ``n`` languages.

    Up to 7 languages: the exhaustive code, every split of them in two (2^(n-1) - 1 bits). More: about
    10 log2 n random balanced splits, the best of several draws by its least distance between rows.
    """
    if n < 2:
        return np.ones((n, 1), np.int8)
    if n <= 7:
        splits = np.arange(1, 1 << (n - 1))
        return np.where(splits[None, :] >> np.arange(n)[:, None] & 1, 1, -1).astype(np.int8)
    bits, rng, best, best_far = int(np.ceil(10 * np.log2(n))), np.random.default_rng(seed), None, -1
    for _ in range(50):
        code = np.stack([np.where(rng.permutation(n) < n // 2, 1, -1) for _ in range(bits)], axis=1).astype(np.int8)
        far = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i)) if n <= 60 else 0
        if far > best_far:
            best, best_far = code, far
        if n > 60:
            break
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray  # languages x bits, -1 / +1
    weights: np.ndarray  # buckets x bits
    bit_weight: np.ndarray  # bits, adding up to 1
    scale: float

    def decode(self, counts: np.ndarray) -> tuple[int, float, bool]:
        """(language, its probability, ambiguous) from the n-gram counts of one text."""
        used = np.flatnonzero(counts)
        margin = self.scale * (counts[used] @ self.weights[used]) / counts[used].sum()
        loss = np.logaddexp(0, -margin[None, :] * self.code) @ self.bit_weight
        z = -len(self.bit_weight) * (loss - loss.min())
        p = np.exp(z) / np.exp(z).sum()
        order = np.argsort(loss, kind="stable")
        best = int(order[0])
        gap = p[best] - p[order[1]] if len(order) > 1 else 1.0
        return best, float(min(1.0, max(0.0, p[best]))), bool(gap < 2 * AMBIGUOUS - 1)


def _gather(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if (counts := bucket_counts(text, buckets)) is not None:
                    if lang not in tables:
                        tables[lang] = np.zeros(buckets, np.float64)
                    tables[lang] += counts
        for lang, counts in tables.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(counts[used].astype(np.int64))],
                names=["lang", "bucket", "n"])

    return run


def train(rows: DataFrame, lang_col: str = "lang", text_col: str = "text", buckets: int = BUCKETS) -> LanguageModel:
    """Learn from all rows whose text and language are not null; with no such row, a model of no language."""
    known = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    known = known.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    gathered = map_batches(known, _gather(buckets), "lang string, bucket int, n long")
    table = gathered.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()  # languages x buckets at most
    languages = sorted(table["lang"].unique())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; the code is built for {MAX_LANGUAGES} at most")
    counts = np.zeros((len(languages), buckets))
    where = {x: i for i, x in enumerate(languages)}
    counts[table["lang"].map(where).to_numpy(int), table["bucket"].to_numpy(int)] = table["n"].to_numpy()
    # Every language weighs the same in its half, however many rows it has.
    shares = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    code = codewords(len(languages))
    n_bits = code.shape[1]
    weights = np.zeros((buckets, n_bits), np.float32)
    worth = np.ones(n_bits)
    spread = []
    for b in range(n_bits if len(languages) > 1 else 0):
        up, down = shares[code[:, b] > 0].mean(axis=0), shares[code[:, b] < 0].mean(axis=0)
        w = np.log(up + SMOOTHING / buckets) - np.log(down + SMOOTHING / buckets)
        weights[:, b] = w
        margins = shares @ w  # of each language's whole text
        worth[b] = max(1e-6, (margins * code[:, b]).min())
        spread.append(np.abs(margins).min())
    scale = 4.0 / max(1e-6, float(np.median(spread))) if spread else 1.0
    return LanguageModel(languages, code, weights, worth / worth.sum(), scale)



def _predictor(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: LanguageModel = model.value
        for batch in batches:
            langs, scores, unsure = [], [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                counts = bucket_counts(text, len(m.weights)) if text and m.languages else None
                best, p, ambiguous = m.decode(counts) if counts is not None else (-1, 0.0, True)
                langs.append(m.languages[best] if best >= 0 else "und")
                scores.append(p)
                unsure.append(ambiguous)
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(unsure, pa.bool_())],
                names=[*batch.schema.names[:-1], "lang_pred", "score", "ambiguous"])

    return run


def predict(docs: DataFrame, model: LanguageModel, keep: dict[str, str], text_col: str = "text") -> DataFrame:
    """``lang_pred, score, ambiguous`` of every whole text, beside the columns of ``keep`` (name to SQL type).

    ``lang_pred`` is a learned language, or ``und`` (score 0, ambiguous) where the text is null or has no
    letter or nothing was learned. Cases: empty text is ``und``; equal losses go to the first language by
    name; repeated rows are repeated; a very long text is hashed in pieces but judged as a whole; an empty
    table gives an empty result. The prediction looks at the text alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    picked = docs.select(*[F.col(c).cast(t).alias(c) for c, t in keep.items()], F.col(text_col).cast("string").alias("__text"))
    schema = ", ".join(f"`{c}` {t}" for c, t in keep.items())
    return map_batches(picked, _predictor(shared), f"{schema}, lang_pred string, score double, ambiguous boolean")


def _keeper(model, text_at: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: LanguageModel = model.value
        for batch in batches:
            keep = []
            for text in batch.column(text_at).to_pylist():
                counts = bucket_counts(text, len(m.weights)) if text and m.languages else None
                keep.append(counts is not None and m.decode(counts)[1] >= least)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def keep_identified(docs: DataFrame, model: LanguageModel, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The input rows, all columns as they are, whose language is told with a probability of ``least`` or more.

    Rows with null text or without a letter go.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    ship_package(docs.sparkSession)
    return docs.mapInArrow(_keeper(shared, docs.columns.index(text_col), least), docs.schema)
