"""Ids and counts of whole texts as a public tokenizer library gives them."""

from __future__ import annotations

import hashlib
import json
import os
import re
from importlib.metadata import version
from itertools import chain

import numpy as np

from genenet_spark.llm.chunks import MEMO_CHARS, MEMO_ENTRIES, ChunkMemo


#: Words that go to the library in one text.
RUN_WORDS = 512


#: A pre-tokenizer that takes letters and marks apart.
LETTER_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters of ASCII and Latin-1, which no normal form changes and whose lower case is one letter, then marks (none of an apostrophe or of < | >).
PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:;=?@\[-`{}~]*)")


def tokenizer_version(path: str) -> str:
    """Digest that names a tokenizer: its file's content and the version of the library that reads it."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + f"{library}-{version(library)}".encode()).hexdigest()


def _cut_rule(spec: dict) -> str:
    """Where texts may be cut without changing ids: 'space', 'bare' or 'none' (whole texts only)."""
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or any(map(str.isspace, t["content"]))
           for t in spec["added_tokens"]):
        return "none"
    pre, norm = spec["pre_tokenizer"] or {}, spec["normalizer"]
    if pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and norm is None:
        return "space"
    steps = pre.get("pretokenizers", [])
    split_off = len(steps) == 2 and steps[0]["type"] == "Split" and steps[0]["invert"] and steps[0]["behavior"] == "Removed"
    if (split_off and steps[1]["type"] == "ByteLevel" and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]
            and {n["type"] for n in (norm or {}).get("normalizers", [])} <= {"NFC", "Replace", "Lowercase"}
            and r"\s\p{L}\p{N}" in steps[0]["pattern"].get("Regex", "")):
        return "bare"
    return "none"


def _takes_stems(spec: dict) -> bool:
    """Whether the ids of a plain word are those of its letters in lower case, then those of its marks.

    For a tokenizer whose texts may be cut at white space ('bare').
    """
    norm, split = spec["normalizer"]["normalizers"], spec["pre_tokenizer"]["pretokenizers"][0]
    spaces = all(n["pattern"].get("Regex") == r"\s+" for n in norm if n["type"] == "Replace")
    return (spaces and "Lowercase" in [n["type"] for n in norm] and split["pattern"]["Regex"] == LETTER_RUNS
            and all(re.search(r"[^A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff!-&(-/:;=?@\[-`{}~]", t["content"]) for t in spec["added_tokens"]))


class Library:
    """One tokenizer of one worker. ``ids`` and ``counts`` take whole texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark owns the cores
        self._mark = None
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._encode = lambda texts: model.encode(texts, num_threads=1)
            rule, self.n_ids = "none", model.vocab_size()
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self._encode = lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]
            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            rule = _cut_rule(spec)
            if rule == "bare":
                self._learn_mark(spec["added_tokens"])
            stems = rule == "bare" and bool(spec["normalizer"]) and _takes_stems(spec)
            self.n_ids = max(model.get_vocab(with_added_tokens=True).values()) + 1
        self._id_memo = self._count_memo = None
        if rule != "none":
            if stems:
                self._learn_stems(model)
            self._id_memo = ChunkMemo(self._stem_bytes if stems else self._word_bytes, rule == "space")
            self._count_memo = ChunkMemo(lambda texts: map(len, self._encode(texts)), rule == "space")

    def _bytes(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, "<u4").tobytes() for ids in self._encode(texts)]

    def _learn_mark(self, added: list[dict]) -> None:
        """An added token to set between words: the library takes texts apart at it before anything else."""
        if added:
            self._mark = (added[0]["content"], added[0]["id"])
            # A word without these can't be part of an added token that reaches over its end.
            self._ends = re.compile("[" + re.escape("".join(sorted({t["content"][i] for t in added for i in (0, -1)}))) + "]")

    def _word_bytes(self, words: list[str]) -> list[bytes]:
        """Ids of words, many of them encoded in one call with a mark between."""
        if self._mark is None or len(words) < 2 or self._ends.search("".join(words)):
            plain = [] if self._mark is None else [i for i, w in enumerate(words) if not self._ends.search(w)]
            if len(plain) < 2:
                return self._bytes(words)
            other = sorted(set(range(len(words))) - set(plain))
            out = dict(zip(plain, self._word_bytes([words[i] for i in plain])))
            out |= dict(zip(other, self._bytes([words[i] for i in other])))
            return [out[i] for i in range(len(words))]
        mark, mark_id = self._mark
        runs = [words[i : i + RUN_WORDS] for i in range(0, len(words), RUN_WORDS)]
        out: list[bytes] = []
        for run, ids in zip(runs, self._encode([mark.join(run) for run in runs])):
            ids = np.array(ids, "<u4")
            cuts = (np.flatnonzero(ids == mark_id) * 4).tolist()
            if len(cuts) != len(run) - 1:
                raise RuntimeError("the tokenizer doesn't keep the mark between words apart")
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *(c + 4 for c in cuts)], [*cuts, len(raw)])]
        return out

    def _learn_stems(self, model) -> None:
        """The library's model of one pre-token, and plain letters as its byte level spells them."""
        from tokenizers.pre_tokenizers import ByteLevel

        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self._spelling = {c: spell(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self._tokenize = model.model.tokenize
        self._stems: dict[str, bytes] = {"": b""}

    def _stem_bytes(self, words: list[str]) -> list[bytes]:
        """Ids of words; those that differ in case or in the marks at their end only are encoded once."""
        known, plain = self._stems, PLAIN.fullmatch
        matched = list(map(plain, words))
        cut = [(m[1].lower(), m[2]) if m else (w, "") for w, m in zip(words, matched)]
        other = [w for w, m in zip(words, matched) if not m]
        found = dict(zip(other, self._word_bytes(other)))
        new = [part for part in dict.fromkeys(chain.from_iterable(cut)) if part not in known and part not in found]
        tokenize, spelling = self._tokenize, self._spelling
        of_part = [[t.id for t in tokenize(part if part.isascii() else part.translate(spelling))] for part in new]
        raw, at = np.array(list(chain.from_iterable(of_part)), "<u4").tobytes(), 0
        for part, ids in zip(new, of_part):
            found[part] = raw[at : (at := at + 4 * len(ids))]
        out = [(known[a] if a in known else found[a]) + (known[b] if b in known else found[b]) for a, b in cut]
        room = MEMO_ENTRIES - len(known)
        if room > 0:
            known.update((part, found[part]) for part in new[:room] if len(part) <= MEMO_CHARS)
        return out

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if self._id_memo is None:
            return self._bytes(texts)
        return [b"".join(found) for found in self._id_memo.values(texts)]

    def word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of words that white space separates, without the memo."""
        return self._word_bytes(words)

    def counts(self, texts: list[str]) -> list[int]:
        if self._count_memo is None:
            return list(map(len, self._encode(texts)))
        return list(map(sum, self._count_memo.values(texts)))


_LOADED: dict[str, Library] = {}


def library(path: str) -> Library:
    """The tokenizer of a file, loaded once a Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Library(path)
    return _LOADED[path]
