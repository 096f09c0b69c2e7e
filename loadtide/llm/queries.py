"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadtide.llm import bpe_automaton, chain_dedup, chat_template, collocations, contamination, line_quality, merkle, minhash_dedup, ngram_lm, piece_fst, suffix_dedup, token_rollup, toxicity
from loadtide.sources.stages import new_path, staged

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85).drop("digest", "class_id")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads all documents with an estimate, revises it to exact counts, deletes later exact copies, replays two batches."""
    counted = staged(token_rollup.count_tokens(table(spark, sf_dir, "documents")), "token_counts")
    rollup = token_rollup.Rollup(spark, new_path(spark, "token_rollup"))
    guess = "(n_bytes + 3) div 4"
    batches = {
        "load": token_rollup.unpivot(counted, "insert", None, guess),
        "exact": token_rollup.unpivot(counted, "revise", guess, "{v}"),
        "copies": token_rollup.unpivot(token_rollup.later_copies(counted), "delete", "{v}", None),
    }
    for name in ("load", "exact", "load", "copies", "exact"):
        rollup.apply(name, batches[name])
    return rollup.totals()


def op3_benchmark_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_sentencepiece_fst(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = piece_fst.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), read_back=True)
    plain = F.translate(F.coalesce("text", F.lit("")), piece_fst.MARK, " ")  # the mark itself reads back as a space
    return read.select(
        "doc_id",
        "n_pieces",
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == plain).alias("round_trip"),
    )


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    return chat_template.read_back(chat_template.format_conversations(turns.unionByName(probe)))


def op6_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.quality(table(spark, sf_dir, "documents")).drop("source", "clean_text")


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), held_out=5)
    scored = toxicity.score(docs.select("doc_id", "text", "lang"), model)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted", "rejected")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score_corpus(table(spark, sf_dir, "documents"))


def op10_fuzzy_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain_dedup.fuzzy_passages(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.phrases(table(spark, sf_dir, "documents"))


def op13_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    automaton = bpe_automaton.load_automaton()
    tokens = bpe_automaton.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), automaton).drop("text")
    return bpe_automaton.decode(tokens, automaton).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids_le", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


LLM_QUERIES: dict[str, Query] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_benchmark_contamination": op3_benchmark_contamination,
    "op4_sentencepiece_fst": op4_sentencepiece_fst,
    "op5_chat_format": op5_chat_format,
    "op6_line_quality": op6_line_quality,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_fuzzy_substring_dedup": op10_fuzzy_substring_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_bpe_automaton": op13_bpe_automaton,
}
LLM_ORACLES: dict[str, str] = {
    "op1_minhash_near_dedup": minhash_dedup.ORACLE_SQL,
    "op3_benchmark_contamination": contamination.ORACLE_SQL,
    "op5_chat_format": chat_template.ORACLE_SQL,
    "op6_line_quality": line_quality.ORACLE_SQL,
    "op11_merkle_manifest": merkle.ORACLE_SQL,
    "op12_phrase_collocations": collocations.ORACLE_SQL,
}
