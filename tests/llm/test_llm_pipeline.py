from __future__ import annotations

import importlib

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline

from test_llm_operators import DOCS, brute_components, brute_contained, brute_repeats, prose, toxic_corpus


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Clean documents, toxic ones, exact and near copies, a shared passage and benchmark passages."""
    folder = tmp_path_factory.mktemp("planted")
    rows, labels = toxic_corpus()
    clean = [(1000 + k, " ".join(prose(5000 + k, 120)), "en", "a", 1) for k in range(20)]
    copies = [(2000 + k, clean[k][1], "en", "b", 1) for k in range(5)]
    near = [(2100 + k, clean[k][1].replace(" ", " new ", 1), "en", "b", 1) for k in range(5, 8)]
    passage = " ".join(prose(77, 70))
    shared = [(2200 + k, f"{' '.join(prose(6000 + k, 60))} {passage} {' '.join(prose(7000 + k, 60))}", "en", "c", 1) for k in range(4)]
    items = [(k, " ".join(prose(8000 + k, 30))) for k in range(3)]
    leaks = [(2300 + k, f"{' '.join(prose(9000 + k, 200))} {items[k][1]} {' '.join(prose(9500 + k, 200))}", "en", "d", 1) for k in range(3)]
    empty = [(2400, None, None, None, None), (2401, "", "en", "a", 0)]
    docs = rows + clean + copies + near + shared + leaks + empty
    spark.createDataFrame(docs, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), docs, items


def test_stages_against_brute_force(spark, planted):
    folder, rows, items = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "minhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "sentencepiece"]

    kept = corpus_pipeline.staged(stages["toxicity"](spark, docs, folder), "t")
    assert kept.columns == docs.columns
    gone = {r[0] for r in rows} - {r.doc_id for r in kept.collect()}
    toxic = {k for k in range(200) if k % 4 == 0}
    assert len(gone & toxic) >= 0.95 * len(toxic) and len(gone - toxic) <= 3

    before = [tuple(r) for r in kept.collect()]
    single = corpus_pipeline.staged(stages["minhash_near_dedup"](spark, kept, folder), "m")
    stay = {i for i, _, c in brute_components(before, 80) if i == c}
    assert single.columns == docs.columns and sorted(r.doc_id for r in single.collect()) == sorted(stay)

    before = single.collect()
    cut = corpus_pipeline.staged(stages["suffix_array_dedup"](spark, single, folder), "s")
    want = brute_repeats(before)
    texts = {r.doc_id: r.text for r in before}
    assert cut.columns == docs.columns
    for r in cut.collect():
        old = texts[r.doc_id]
        assert (r.text is None) == (old is None)
        removed = want[r.doc_id, old or ""][1]
        assert len((old or "").encode()) - len((r.text or "").encode()) == removed and (not removed or r.n_chars == len(r.text))
    assert sum(want[r.doc_id, r.text or ""][1] > 300 for r in before) >= 3

    before = [tuple(r) for r in cut.collect()]
    open_ = corpus_pipeline.staged(stages["benchmark_decontamination"](spark, cut, folder), "b")
    leaked = {i for i, *_ in brute_contained(before, items)}
    assert leaked == {2300, 2301, 2302}
    assert {r.doc_id for r in open_.collect()} == {r[0] for r in before} - leaked

    out = stages["sentencepiece"](spark, open_, folder).collect()
    assert len(out) == open_.count() and all(r.round_trip and r.n_pieces == len(r.ids) for r in out)


def test_run_is_the_stages_in_order(spark, planted):
    folder, rows, _ = planted
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert all(1000 + k in out for k in range(20))  # clean ones stay whole
    assert not {2000 + k for k in range(5)} & set(out) and not {2105, 2106, 2107} & set(out)
    assert not {2300, 2301, 2302} & set(out) and {2400, 2401} <= set(out)
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run


def test_stages_take_empty_tables(spark, planted):
    folder, *_ = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_the_entry_works_without_the_operators(monkeypatch):
    import sys

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        again = importlib.reload(__spark_entry__)
        assert "duck_curve" in again.queries() and not any(q.startswith("op") and q[2].isdigit() for q in again.queries())
        assert set(again.oracle_sql()) <= set(again.queries())
    finally:
        monkeypatch.undo()
        importlib.reload(__spark_entry__)
    assert np.all([q in __spark_entry__.queries() for q in ("pipeline", "op1_minhash_near_dedup")])
