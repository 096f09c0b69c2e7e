from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadtide.llm import bpe_automaton
from loadtide.llm.queries import LLM_QUERIES

PATH = f"{bpe_automaton.TOKENIZER_DIR}/{bpe_automaton.MODEL}"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    held = Tokenizer.from_file(PATH)
    held.no_truncation()
    held.no_padding()
    return held


@pytest.fixture(scope="module")
def encoder():
    return bpe_automaton.Encoder(bpe_automaton.load_automaton(PATH))


def same(encoder, library, texts):
    flat, offsets = encoder.encode_many(texts)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [flat[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == want
    read = encoder.decode_many(flat, offsets).to_pylist()
    assert read == [library.decode(ids, skip_special_tokens=False) for ids in want]


def test_every_character_is_encoded_as_by_the_library(encoder, library):
    for first in range(0, 0x110000, 1 << 14):
        chars = [chr(c) for c in range(first, first + (1 << 14)) if not 0xD800 <= c < 0xE000]
        if chars:
            same(encoder, library, [f"a{c}b1" for c in chars] + [f"!{c}!" for c in chars])


def test_words_of_any_length_and_added_tokens(encoder, library):
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abcehtisn"), rng.integers(1, 60))) for _ in range(3000)]
    long = ["x" * 5000, "ab" * 3000, "!" * 70_001, "é" * 700, "thethethe" * 500, "".join(rng.choice(list("aeiou"), 40_000))]
    odd = ["", " ", "'s'S don't", "ΑΣ Σ", "İI", "é", "\x1c\x1d a\x85b　c", "<|endoftext|>A b<|startoftext|><|endoftext|", "<|EndOfText|>"]
    same(encoder, library, words + long + odd)


def test_gadgets_equal_merging_for_every_short_word():
    """A small vocabulary whose merges overlap themselves, against merging by rank, over all words of up to seven letters."""
    letters = bpe_automaton.byte_characters()
    vocab = {c: i for i, c in enumerate(letters)} | {c + "</w>": 256 + i for i, c in enumerate(letters)}
    merges = [("a", "a"), ("a", "b"), ("aa", "a</w>"), ("b", "aa"), ("ab", "ab"), ("b", "b</w>"), ("aa", "aa"), ("b", "a")]
    for one, other in merges:
        vocab[one + other] = len(vocab)
    encoder = bpe_automaton.Encoder(bpe_automaton.compile_automaton(vocab, merges, {}))
    words = [np.base_repr(i, 2).replace("0", "a").replace("1", "b")[1:] for i in range(2, 256)]

    def merged(word):
        parts = [*word[:-1], word[-1] + "</w>"]
        while True:
            ranks = [merges.index(p) if p in merges else 99 for p in zip(parts, parts[1:])]
            if not ranks or min(ranks) == 99:
                return [vocab[p] for p in parts]
            k = ranks.index(min(ranks))
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    ids, offsets = encoder.encode_words(words)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [merged(w) for w in words]
    assert [encoder._walk(w.encode()).tolist() for w in words] == [merged(w) for w in words]


def test_odd_tables(spark, library):
    rows = [(1, "Hello World", "x"), (None, "twice", "x"), (None, "twice", "x"), (2, None, None), (3, "", "x"), (4, "long " * 30_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumn("decoded", F.lit(1)).repartition(3)
    got = bpe_automaton.decode(bpe_automaton.encode(docs))
    assert sorted(got.columns) == ["decoded", "doc_id", "ids", "ids_le", "n_tokens", "text"]
    for r in got.collect():
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert (r.ids, r.n_tokens) == (want, len(want))
        assert bytes(r.ids_le) == np.array(want, "<u4").tobytes()
        assert r.decoded == library.decode(want, skip_special_tokens=False)
    assert got.count() == 6
    assert bpe_automaton.decode(bpe_automaton.encode(docs.where("false"))).count() == 0
    lists = spark.createDataFrame([(1, None), (2, [320, 999_999, -5]), (3, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe_automaton.decode(lists).collect()} == {1: None, 2: library.decode([320]), 3: ""}


def test_query_over_whole_table(spark, sf, library):
    got = {r.doc_id: r for r in LLM_QUERIES["op13_bpe_automaton"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(docs) == len(got)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
