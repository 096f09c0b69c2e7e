from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from loadtide.llm import ngram_lm
from test_llm_operators import brute_scores


def test_a_batch_reports_few_pairs_of_frequent_contexts():
    """All pairs of every frequent context were rows before; now those with a fixed share of the batch alone."""
    rng = np.random.default_rng(3)
    text = " ".join(f"w{k}" for k in rng.integers(0, 50, 20_000)) + " often same" * 5_000
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([False]), pa.array([text])], ["doc_id", "held_out", "text"])
    hot = np.unique(np.concatenate([next(ngram_lm.pieces(batch.column("text"))).hashes, [ngram_lm.START, ngram_lm.END]]))
    rows = pa.Table.from_batches(ngram_lm._hot_pairs(hot, 8)([batch]))
    assert sorted(rows.column("m").to_pylist()) == [4_999, 5_000]
    wanted = np.sort(rows.column("pair").to_numpy())
    again = pa.Table.from_batches(ngram_lm._hot_pairs(hot, wanted=wanted)([batch, batch]))
    assert sorted(again.column("n").to_pylist()) == [4_999, 4_999, 5_000, 5_000]


@pytest.mark.parametrize("shard", [12 << 20, 1_000])
def test_frequent_pair_that_only_held_out_texts_have(spark, shard, monkeypatch):
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", shard)
    rows = []
    for k in range(60):
        held = zlib.crc32(str(k).encode()) % 10 == 0
        rows.append((k, " ".join(["left right"] * 400 + [f"own{k}"]) if held else f"left other{k % 7} then right left other right end{k}"))
    got = {r.doc_id: r for r in ngram_lm.score_corpus(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    for (i, _), (held, n, known, total, base, score) in zip(rows, brute_scores(rows)):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.held_out, r.train_tokens) == (n, known, held, total)
        assert abs(r.base_score - base) < 1e-6 and abs(r.score - score) <= 0.0005 * n
