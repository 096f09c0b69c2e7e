from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loadtide.llm import collocations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def pieces(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", low)]


def brute(rows):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        for words in pieces(text):
            totals[lang or "und"] += len(words)
            for m in range(1, 5):
                counts[lang or "und"].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= 30}
        inside = Counter()
        for p, a in candidates.items():
            for s in range(2, len(p)):
                for i in range(len(p) - s + 1):
                    inside[p[i : i + s]] = max(inside[p[i : i + s]], a)
        found = []
        for p, a in candidates.items():
            if 100 * inside[p] >= 80 * a:
                continue
            score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:2000], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(30)] + ["Été", "日本", "don't", "UPPER"]
    weights = np.r_[[0.3, 0.1], np.full(32, 0.6 / 32)]
    out = []
    for i in range(160):
        text = "".join(w + rng.choice([" ", "\t", ". ", ",", "\n", " \x0b"], p=[0.8, 0.05, 0.05, 0.04, 0.03, 0.03]) for w in rng.choice(words, 120, p=weights))
        out.append((i, text, [None, "en", "de"][i % 3], "a", 1))
    out += [(200 + i, "same opening words here again and again. " * 20, "en", "a", 1) for i in range(4)]
    out += [(300, None, "en", "a", 0), (301, "", "en", "a", 0), (302, " ..!", "fr", "a", 0), (None, "und und und und", "und", None, None)]
    out += [(400, "a " * 500 + "ab " * 20_000, "es", "a", 1), (400, "a " * 500 + "ab " * 20_000, "es", "a", 1)]
    return out


@pytest.mark.parametrize("budget", [collocations.BUDGET, 300])
def test_phrases(spark, rows, budget):
    """A small budget lengthens prefixes to two and three words and makes many groups."""
    taken = ("h", "n", "a", "w1", "phrase", "score", "k", "grp")
    docs = spark.createDataFrame(rows, DOCS).select("*", *(F.lit("own").alias(c) for c in taken)).repartition(3)
    got = collocations.phrases(docs, budget)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_empty_tables(spark):
    assert collocations.phrases(spark.createDataFrame([], DOCS)).count() == 0
    assert collocations.phrases(spark.createDataFrame([(1, None, None, None, None)], DOCS)).count() == 0


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "PIECE", 40)
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("Ab c.\té"), 700)), "nobreak" * 40, None, "", "x. " * 100, "." * 90]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": texts})
    got = []
    for words, data, *_ in collocations.chunks(iter([batch]), 0):
        cut = [0, *(np.flatnonzero(np.diff(words.pieces)) + 1).tolist(), len(words.starts)]
        for a, b in zip(cut, cut[1:]):
            got.append([data[words.starts[i] : words.ends[i]].tobytes().decode().lower() for i in range(a, b)])
    assert [p for p in got if p] == [p for t in texts for p in pieces(t) if p]


def test_word_hashes_tell_languages_apart():
    data = np.frombuffer(b"ab ba ab", np.uint8)
    keys = np.array([1, 2], np.uint64)
    found = collocations.find_words(data, np.array([0, 5, 8]), keys, 0, checked=True)
    assert len(set(found.hashes.tolist())) == len(set(found.checks.tolist())) == 3
    assert found.pieces.tolist() == [0, 0, 1]
