"""BPE encoding and decoding with a contiguous rank array (operator 8).

Each piece is held as an array of parts beside an array with the merge rank of
every adjacent pair. Again and again the smallest rank is found, the boundary it
names is deleted, and the ranks of the two neighbouring pairs are looked up
anew. Pieces of one byte length are handled together: every row of the matrix
loses one boundary a round, so both arrays stay contiguous. Pieces longer than
``LONG_PIECE`` bytes use a heap of ranks over linked parts instead, as scanning
them would take quadratic time.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genenet_spark.llm.chunks import ChunkMemo
from genenet_spark.llm.common import in_slices, map_batches

LONG_PIECE = 96
_NONE = np.int32(2**31 - 1)

#: The published pre-token pattern of byte-level BPE (fixed value), white space spelled out.
PRETOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
            r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


class RankTable:
    """Merge ranks of pairs of ids, looked up for whole arrays."""

    def __init__(self, pairs: np.ndarray, merged: np.ndarray):
        keys = pairs[:, 0].astype(np.int64) << 32 | pairs[:, 1]
        bits = max(8, int(np.ceil(np.log2(len(keys) + 1))) + 3)
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int64)
        self.rank = np.full(1 << bits, _NONE, np.int32)
        self.mask = (1 << bits) - 1
        todo = np.arange(len(keys))
        at = self._home(keys)
        self.probes = 0
        while len(todo):  # linear probing: the first of each free slot's claimants settles there
            self.probes += 1
            free = self.slots[at] == -1
            _, first = np.unique(at[free], return_index=True)
            settled = np.flatnonzero(free)[first]
            self.slots[at[settled]], self.rank[at[settled]] = keys[todo[settled]], todo[settled]
            left = np.ones(len(todo), bool)
            left[settled] = False
            todo, at = todo[left], (at[left] + 1) & self.mask
        self.merged = merged.astype(np.int32)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = self._home(keys)
        out = np.where(self.slots[at] == keys, self.rank[at], _NONE)
        open_ = np.flatnonzero((self.slots[at] != keys) & (self.slots[at] != -1))
        for _ in range(self.probes):
            if not len(open_):
                break
            at_open = (at.flat[open_] + 1) & self.mask
            at.flat[open_] = at_open
            hit = self.slots[at_open] == keys.flat[open_]
            out.flat[open_[hit]] = self.rank[at_open[hit]]
            open_ = open_[~hit & (self.slots[at_open] != -1)]
        return out


class RankBPE:
    """Byte-level BPE of a public tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        alphabet = byte_alphabet()
        back = {c: b for b, c in enumerate(alphabet)}
        self.byte_ids = np.array([vocab[c] for c in alphabet], np.int32)
        pairs = np.array([(vocab[a], vocab[b]) for a, b in merges], np.int64).reshape(-1, 2)
        self.table = RankTable(pairs, np.array([vocab[a + b] for a, b in merges]))
        self.pair_rank = {(int(a), int(b)): r for r, (a, b) in enumerate(pairs)}
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = specials
        self.special_at = regex.compile("(" + "|".join(map(regex.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else None
        self.piece_at = regex.compile(PRETOKEN)
        self.token_bytes = [b""] * (1 + max([*vocab.values(), *specials.values()]))
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(back[c] for c in token)
        for token, i in specials.items():
            self.token_bytes[i] = token.encode()

    # -- encoding ---------------------------------------------------------------
    def _rows(self, pieces: np.ndarray) -> list[bytes]:
        """Ids (little-endian unsigned 32 bit) of pieces of one byte length, one a row of bytes."""
        out: list[bytes] = [b""] * len(pieces)
        ids = self.byte_ids[pieces]
        ranks = self.table.ranks(ids[:, :-1], ids[:, 1:])
        row = np.arange(len(pieces))
        while ids.shape[1] > 1:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(row)), at]
            done = best == _NONE
            if done.any():
                for r, x in zip(row[done].tolist(), ids[done].astype("<u4")):
                    out[r] = x.tobytes()
                going = ~done
                row, ids, ranks, at, best = row[going], ids[going], ranks[going], at[going], best[going]
                if not len(row):
                    return out
            n, width = ids.shape
            line = np.arange(n)
            ids[line, at] = self.table.merged[best]
            keep = np.ones((n, width), bool)
            keep[line, at + 1] = False
            ids = ids[keep].reshape(n, width - 1)
            keep = np.ones((n, width - 1), bool)
            keep[line, at] = False
            ranks = ranks[keep].reshape(n, width - 2)
            if width > 2:
                for side in (at - 1, at):  # the pairs before and after the merged part
                    has = np.flatnonzero((side >= 0) & (side < width - 2))
                    p = side[has]
                    ranks[has, p] = self.table.ranks(ids[has, p], ids[has, p + 1])
        for r, x in zip(row.tolist(), ids.astype("<u4")):
            out[r] = x.tobytes()
        return out

    def _long(self, piece: bytes) -> bytes:
        """The same merges for a long piece: a heap of (rank, place) over linked parts."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        after, before = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        rank, merged = self.pair_rank, self.table.merged
        heap = [(r, i) for i in range(len(ids) - 1) if (r := rank.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or rank.get((ids[i], ids[j])) != r:
                continue  # one of the two parts has changed since
            ids[i], ids[j], after[i] = int(merged[r]), -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
                if (q := rank.get((ids[i], ids[after[i]]))) is not None:
                    heapq.heappush(heap, (q, i))
            if (h := before[i]) >= 0 and (q := rank.get((ids[h], ids[i]))) is not None:
                heapq.heappush(heap, (q, h))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        by_length: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            by_length.setdefault(len(p), []).append(i)
        out = [b""] * len(pieces)
        for length, places in by_length.items():
            if length > LONG_PIECE:
                for i in places:
                    out[i] = self._long(pieces[i])
                continue
            for at in range(0, len(places), 8192):
                part = places[at : at + 8192]
                rows = np.frombuffer(b"".join(pieces[i] for i in part), np.uint8).reshape(len(part), length)
                for i, ids in zip(part, self._rows(rows)):
                    out[i] = ids
        return out

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk: special strings first, then the pre-tokens of what lies between them."""
        plan: list[list[object]] = []
        seen: dict[str, int] = {}
        for chunk in chunks:
            if not any(s in chunk for s in self.specials):
                plan.append([seen.setdefault(p, len(seen)) for p in self.piece_at.findall(chunk)])
                continue
            steps: list[object] = []
            for part in self.special_at.split(chunk):
                if part in self.specials:
                    steps.append(np.array([self.specials[part]], "<u4").tobytes())
                else:
                    steps += [seen.setdefault(p, len(seen)) for p in self.piece_at.findall(part)]
            plan.append(steps)
        coded = self.encode_pieces([p.encode() for p in seen])
        return [b"".join(s if isinstance(s, bytes) else coded[s] for s in steps) for steps in plan]

    # -- decoding ---------------------------------------------------------------
    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; bytes that are no UTF-8 become replacement characters, unknown ids nothing."""
        known, size = self.token_bytes, len(self.token_bytes)
        return b"".join(known[i] for i in ids.tolist() if i < size).decode("utf-8", "replace")


_MODELS: dict[str, tuple[RankBPE, ChunkMemo]] = {}


def model(path: str) -> tuple[RankBPE, ChunkMemo]:
    """The tokenizer of a file and its memo, kept in the Python worker."""
    if path not in _MODELS:
        bpe = RankBPE(path)
        _MODELS[path] = bpe, ChunkMemo(bpe.encode_chunks)
    return _MODELS[path]


def _encoder(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, memo = model(path)
        for batch in in_slices(batches):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            n, ids_sha, text_sha, all_ids, same = [], [], [], [], []
            for text, found in zip(texts, memo.values(texts)):
                raw = b"".join(found)
                ids = np.frombuffer(raw, "<u4")
                decoded = bpe.decode(ids)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(raw).hexdigest())
                text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
                same.append(decoded == text)
                if with_ids:
                    all_ids.append(raw)
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                    pa.array(text_sha, pa.string()), pa.array(same, pa.bool_())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"]
            if with_ids:
                cols.append(pa.array(all_ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = True) -> DataFrame:
    """Ids of every whole text, decoded again.

    Returns a row for each input row: ``doc_id``, ``n_tokens``, ``ids_sha256`` (over the ids as
    little-endian unsigned 32-bit integers), ``decoded_sha256``, ``round_trip`` (the decoded text is the
    text) and, unless ``with_ids`` is off, ``ids`` (those integers as binary). Special strings inside a
    text become their special ids, as the library does by default; none are added.

    Cases: null text is the empty text (no ids); a null id stays null; repeated rows give repeated results;
    other columns are ignored; an empty table gives an empty result. No shuffle: one pass over the rows.
    """
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean"
    return map_batches(picked, _encoder(tokenizer, with_ids), schema + (", ids binary" if with_ids else ""))
