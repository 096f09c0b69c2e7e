"""Cleaning of a training corpus: five stages over ``documents``, each on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``. ``run`` writes
each result as Parquet to the folder that all executors share and reads it again for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadtide.llm import contamination, minhash_dedup, piece_fst, suffix_dedup, toxicity
from loadtide.sources.stages import staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, does not reject."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), held_out=None)
    return toxicity.score(docs, model).where("not rejected").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return minhash_dedup.deduplicate(docs, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without 100-byte strings that start earlier in the corpus; ``n_chars`` follows, a null text stays null."""
    cut = suffix_dedup.remove_repeats(docs)
    text = F.when(F.col("text").isNotNull(), F.col("kept_text"))
    changed = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.length(text).cast("long")).otherwise(F.col("n_chars"))}
    return cut.select(*(changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return contamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their piece ids, the number of pieces, and whether the ids read back as the text."""
    read = piece_fst.encode(docs, read_back=True)
    plain = F.translate(F.coalesce("text", F.lit("")), piece_fst.MARK, " ")
    return read.select(*docs.columns, "ids", "n_pieces", (F.col("decoded") == plain).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_benchmark),
    ("sentencepiece", encode_pieces),
]

#: Classifier, suffix arrays and piece transducer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
