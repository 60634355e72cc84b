"""Memoised use of a tokenizer.

A text is cut at places where the tokenizer provably starts a new pre-token, so
that the ids of a text are the ids of its chunks in a row. Natural text repeats
its chunks, hence a worker computes most of them only once. The memo is bounded;
what does not fit is computed again when it comes back.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

#: Memo entries kept in one Python worker, and the longest chunk that is kept.
MEMO_ENTRIES = 400_000
MEMO_CHARS = 48
#: Characters of text that are looked up before the misses among them are computed.
BLOCK_CHARS = 300_000

#: A cut before a single space between two other characters. Python's ``\s`` covers
#: every Unicode white space, so no white-space run of a tokenizer is cut.
_CUT = re.compile(r"(?<=\S)(?= \S)")
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")


def _regular(part: str) -> bool:
    """Neither empty nor with white space at an end: a plain cut beside it is safe."""
    return bool(part) and len(part.strip()) == len(part)


def bare_chunks(text: str) -> list[str]:
    """The words between white space.

    The four information separators are white space for Python but not for a tokenizer; a text that holds one
    is a single chunk.
    """
    return [text] if any(s in text for s in _SEPARATORS) else text.split()


#: White space at an end of a text or beside one of its spaces: a plain split at spaces is no safe cut there.
_UNEVEN = re.compile(r"\A\s|\s\Z| \s|\s ")


def space_parts(text: str) -> list[str]:
    """The chunks of a text for a byte-level tokenizer, all but the first without their leading space."""
    if not text:
        return []
    if not _UNEVEN.search(text):
        return text.split(" ")
    head, *rest = _CUT.split(text)
    return [head, *(c[1:] for c in rest)]


class ChunkMemo:
    """``compute`` of every chunk of many texts, called once a batch for the distinct misses.

    ``leading_space=True`` is for byte-level tokenizers that bind one space to the
    next word: ``a b`` gives the chunks ``a`` and `` b``; joined, chunks are the text.
    ``leading_space=False`` is for tokenizers that drop white space: chunks are words.
    """

    def __init__(self, compute: Callable[[list[str]], Iterable[object]], leading_space: bool = True,
                 entries: int = MEMO_ENTRIES):
        self.compute, self.leading_space, self.entries = compute, leading_space, entries
        self.inner: dict[str, object] = {}  # value of " " + part (of part itself without leading spaces)
        self.first: dict[str, object] = {}  # value of a part that begins its text
        self.seeded = 0

    def seed(self, values: dict[str, object]) -> None:
        """Values of frequent parts, known beforehand; they don't count against ``entries``."""
        before = len(self.inner)
        self.inner.update((k, v) for k, v in values.items() if not self.leading_space or _regular(k))
        self.seeded += len(self.inner) - before

    def _parts(self, text: str) -> tuple[list[str], list[object]]:
        if not self.leading_space:
            parts = bare_chunks(text)
            return parts, list(map(self.inner.get, parts))
        if not text:
            return [], []
        parts = text.split(" ")
        found = list(map(self.inner.get, parts))
        found[0] = self.first.get(parts[0])
        if None in found and not all(_regular(parts[i]) for i, v in enumerate(found) if v is None):
            head, *rest = _CUT.split(text)
            parts = [head, *(c[1:] for c in rest)]
            found = [self.first.get(head), *map(self.inner.get, parts[1:])]
        return parts, found

    def values(self, texts: list[str]) -> list[list[object]]:
        """The values of the chunks of each text, in order."""
        out: list[list[object]] = []
        at = 0
        while at < len(texts):  # a few texts at a time, so that the memo is warm for the next ones
            end, chars = at, 0
            while end < len(texts) and chars < BLOCK_CHARS:
                chars += len(texts[end])
                end += 1
            out += self._block(texts[at:end])
            at = end
        return out

    def _block(self, texts: list[str]) -> list[list[object]]:
        out: list[list[object]] = []
        waiting: list[tuple[list[str], list[object], list[int]]] = []
        inner: dict[str, object] = {}
        first: dict[str, object] = {} if self.leading_space else inner
        for text in texts:
            parts, found = self._parts(text)
            if None in found:
                gaps = [i for i, v in enumerate(found) if v is None]
                waiting.append((parts, found, gaps))
                inner.update((parts[i], None) for i in gaps if i)
                if not gaps[0]:
                    first[parts[0]] = None
            out.append(found)
        if waiting:
            self._compute(inner, " " if self.leading_space else "", self.inner, self.entries + self.seeded)
            if self.leading_space:
                self._compute(first, "", self.first, self.entries // 8)
            for parts, found, gaps in waiting:
                for i in gaps:
                    found[i] = inner[parts[i]] if i else first[parts[0]]
        return out

    def _compute(self, wanted: dict[str, object], lead: str, kept: dict[str, object], entries: int) -> None:
        """Fill in the values of ``wanted`` and keep those that another text may look up."""
        keys = list(wanted)
        wanted.update(zip(keys, self.compute([lead + k for k in keys] if lead else keys)))
        room = entries - len(kept)
        if room > 0:
            kept.update((k, wanted[k]) for k in keys[:room]
                        if len(k) <= MEMO_CHARS and (not self.leading_space or _regular(k)))
