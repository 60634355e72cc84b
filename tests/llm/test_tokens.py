"""Operators 3, 7 and 8 against the tokenizers library, and their parts against plain code."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from genenet_spark.llm import bpe, token_counts, token_file
from genenet_spark.llm.chunks import ChunkMemo
from genenet_spark.llm.common import scratch_path
from genenet_spark.llm.library import Library, tokenizer_version

BYTE, WORD, PIECE = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
ODD = ["a", "b", "'s", "'ll", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "12", "é", "é", "ß", "İ", "漢字", "😀",
       "<|endoftext|>", "<|startoftext|>", "!?", ".", ",", "THE"]
odd_texts = st.lists(st.sampled_from(ODD), max_size=25).map("".join)


@pytest.fixture(scope="module")
def byte_tokenizer():
    return Tokenizer.from_file(BYTE)


def _edge_rows():
    long = "word " * 4000 + "x" * 9000
    return [(1, "the cat sat"), (2, ""), (3, None), (None, "no id"), (4, "the cat sat"), (4, "the cat sat"), (5, "\n\n a  b \t"),
            (6, "<|endoftext|> mid<|endoftext|>"), (7, long), (8, "Ωmega naïve 漢字 😀")]


def _edge_docs(spark):
    return spark.createDataFrame([(t, i, "clash", 1) for i, t in _edge_rows()], "text string, doc_id long, ids string, content int")


@settings(max_examples=300, deadline=None)
@given(odd_texts)
def test_own_bpe_is_the_librarys(text):
    own, memo = bpe.model(BYTE)
    library = test_own_bpe_is_the_librarys.tokenizer
    ids = np.frombuffer(b"".join(memo.values([text])[0]), "<u4")
    expected = library.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == expected
    assert own.decode(ids) == library.decode(expected, skip_special_tokens=False)


test_own_bpe_is_the_librarys.tokenizer = Tokenizer.from_file(BYTE)


def test_long_pieces_take_the_heap(byte_tokenizer):
    own, _ = bpe.model(BYTE)
    random.seed(4)
    pieces = ["".join(random.choice("abcthesion") for _ in range(n)) for n in (95, 96, 97, 500, 5000)] + ["a" * 3000]
    for piece, ids in zip(pieces, own.encode_pieces([p.encode() for p in pieces])):
        assert np.frombuffer(ids, "<u4").tolist() == byte_tokenizer.encode(piece, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(odd_texts, max_size=4))
def test_memoised_library_is_the_library(texts):
    for path in (BYTE, WORD):
        lib, t = test_memoised_library_is_the_library.libs[path]
        expected = [t.encode(x, add_special_tokens=False).ids for x in texts]
        assert [np.frombuffer(x, "<u4").tolist() for x in lib.ids(texts)] == expected
        assert lib.counts(texts) == list(map(len, expected))


test_memoised_library_is_the_library.libs = {p: (Library(p), Tokenizer.from_file(p)) for p in (BYTE, WORD)}


def test_memo_is_bounded_and_right_when_full():
    calls = []
    memo = ChunkMemo(lambda chunks: calls.append(len(chunks)) or [c.upper() for c in chunks], entries=2)
    for _ in range(2):
        assert "".join(memo.values(["a b c d e\n f"])[0]) == "A B C D E\n F"
    assert len(memo.inner) <= 2 and len(calls) >= 2


def test_op8_edges(spark, byte_tokenizer):
    out = bpe.encode_documents(_edge_docs(spark), BYTE).collect()
    assert len(out) == len(_edge_rows())
    seen = sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.ids_sha256, r.decoded_sha256, bytes(r.ids)) for r in out)
    expected = []
    for i, t in _edge_rows():
        ids = byte_tokenizer.encode(t or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        text = byte_tokenizer.decode(ids, skip_special_tokens=False)
        expected.append((i if i is not None else -1, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), raw))
    assert seen == sorted(expected)
    assert all(r.round_trip for r in out)
    assert bpe.encode_documents(_edge_docs(spark).limit(0), BYTE).count() == 0


def test_op8_unknown_ids_and_broken_bytes():
    own, _ = bpe.model(BYTE)
    assert own.decode(np.array([10**6], "<u4")) == ""
    lone = int(own.byte_ids[0xE6])
    assert own.decode(np.array([lone], "<u4")) == "�"


def test_op7_edges_and_cache(spark, byte_tokenizer):
    cache = scratch_path(spark, "test-cache")
    docs = _edge_docs(spark)
    out = token_counts.count_tokens(docs, BYTE, cache, limit=3).collect()
    expected = sorted((i if i is not None else -1, len((t or "").encode()), n := len(byte_tokenizer.encode(t or "", add_special_tokens=False).ids), n > 3)
                      for i, t in _edge_rows())
    key = lambda r: (r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens, r.over_limit)
    assert sorted(map(key, out)) == expected
    stored = token_counts.open_cache(spark, cache)
    contents = len({t or "" for _, t in _edge_rows()})
    assert stored.count() == contents == spark.read.parquet(cache).count()
    # A second run encodes only what is new; counts come from the cache.
    more = docs.select("doc_id", "text").union(spark.createDataFrame([(99, "quite new")], "doc_id long, text string"))
    assert token_counts.count_tokens(more, BYTE, cache).count() == len(expected) + 1
    assert spark.read.parquet(cache).count() == contents + 1
    # Another tokenizer never takes these counts.
    word = Tokenizer.from_file(WORD)
    other = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs.where("doc_id = 8"), WORD, cache).collect()}
    assert other == {8: len(word.encode(_edge_rows()[-1][1], add_special_tokens=False).ids)}
    assert tokenizer_version(BYTE) != tokenizer_version(WORD)
    assert token_counts.count_tokens(docs.limit(0), BYTE, scratch_path(spark, "test-cache")).count() == 0


def test_op7_sentencepiece(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    docs = _edge_docs(spark).where("doc_id <> 4")
    out = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, PIECE, scratch_path(spark, "test-cache")).collect()}
    assert out == {i: len(model.encode(t or "")) for i, t in _edge_rows() if i not in (None, 4)}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 70000), st.integers(0, 2**32 - 1)), max_size=40))
def test_token_coding_round_trip(values):
    values = np.array(values, np.uint32)
    control, data = token_file.pack(values)
    assert len(control) == -(-len(values) // 4)
    assert token_file.unpack(control, data, len(values)).tolist() == values.tolist()


def test_op3_edges(spark):
    word = Tokenizer.from_file(WORD)
    path = scratch_path(spark, "test-file")
    token_file.write_token_file(_edge_docs(spark), path, WORD, partitions=3, block_ids=50)
    out = token_file.read_token_file(spark, path).orderBy("start").collect()
    rows = _edge_rows()
    assert [r.doc_id for r in out] == [None, 1, 2, 3, 4, 4, 5, 6, 7, 8]
    text = {i: t for i, t in rows}
    at = 0
    for r in out:
        ids = word.encode(text[r.doc_id] or "", add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").limit(1).collect()[0]
    assert ranks["id"] == word.encode("word", add_special_tokens=False).ids[0]  # 4000 times in one text
    empty = scratch_path(spark, "test-file")
    token_file.write_token_file(_edge_docs(spark).limit(0), empty, WORD)
    assert token_file.read_token_file(spark, empty).count() == 0


def test_op3_whole_text_tokenizer(spark):
    """Without a rule to cut texts, ids are counted text by text."""
    path = scratch_path(spark, "test-file")
    token_file.write_token_file(_edge_docs(spark), path, BYTE, end_id=50256)
    byte = Tokenizer.from_file(BYTE)
    total = sum(len(byte.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in _edge_rows())
    assert token_file.read_token_file(spark, path).groupBy().sum("n_tokens").collect()[0][0] == total


def test_words_in_one_call_have_the_ids_of_words_alone():
    """Words joined by a mark, among them the mark itself, its parts, empty-looking and very long ones."""
    lib, plain = Library(WORD), Tokenizer.from_file(WORD)
    rng = random.Random(3)
    words = ["<|endoftext|>", "<|startoftext|>", "a<|endoftext|>b", "<", "|>", "<|", "endoftext", "x" * 5000, "\u0301", "\ufb01n", "\u0130I", "it's"]
    words += ["".join(rng.choice("abcdeé中'.-<|>09\u0301") for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    want = [np.array(plain.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words]
    assert lib.word_ids(words) == want
    clean = [i for i, w in enumerate(words) if not set(w) & set("<>")]
    assert lib.word_ids([words[i] for i in clean]) == [want[i] for i in clean]
    assert lib.word_ids([]) == [] and lib.word_ids(["<|endoftext|>"]) == want[:1]


def test_words_of_one_stem_are_encoded_once():
    lib, t = Library(WORD), Tokenizer.from_file(WORD)
    rng = random.Random(3)
    letters = "abcXYZéÈßÿþÐµ×÷ªĳİſKé"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) + rng.choice(["", ",", "...", "'s", "'", "<|", "|>", "&*%", "7", "!?x", "$'d"])
             for _ in range(3000)]
    words += ["<|startoftext|>", "Word<|endoftext|>", "word", "Word", "WORD,", "word!!", "É", "é", "'s", "s", "é", "É,"]
    assert lib.ids(words) == [np.array(t.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words]
    calls, encode = [], lib._encode
    lib._encode = lambda texts: calls.extend(texts) or encode(texts)
    assert lib.ids(["Stemming stemming, STEMMING! Éclair éclair."])[0] == np.array(
        t.encode("Stemming stemming, STEMMING! Éclair éclair.", add_special_tokens=False).ids, "<u4").tobytes()
    assert not calls and {"stemming", "éclair"} <= set(lib._stems)  # before: all five words went to the library as they stand
