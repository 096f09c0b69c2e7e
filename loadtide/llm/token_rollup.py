"""Token counts: additive totals by source, language and tokenizer version, maintained from signed changes.

A change inserts, deletes or revises the count of one document under one tokenizer version. A batch of changes is summed to signed
deltas and committed as one folder by a rename; a batch that is committed already is skipped, so replays and retries change nothing, and an
attempt that dies leaves nothing visible. Totals are the sums over committed folders; documents are never read again.
"""

from __future__ import annotations

import base64
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZER_DIR = "/opt/tokenizers"
#: Tokenizer versions and their rank files.
VERSIONS = {"byte_bpe_50k": "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k": "byte_bpe_multi_50k.tiktoken"}
#: Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

KEYS = ["source", "lang", "tokenizer"]
DELTAS = "source string, lang string, tokenizer string, docs long, tokens long"
CHANGES = "op string, source string, lang string, tokenizer string, old_tokens long, new_tokens long"

_encodings: dict[str, object] = {}


def _encoding(version: str, ranks: dict[bytes, int]):
    import tiktoken

    if version not in _encodings:
        _encodings[version] = tiktoken.Encoding(version, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[version]


def load_ranks(tokenizer_dir: str = TOKENIZER_DIR) -> dict[str, dict[bytes, int]]:
    out = {}
    for version, name in VERSIONS.items():
        with open(os.path.join(tokenizer_dir, name), "rb") as lines:
            out[version] = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return out


def count_tokens(docs: DataFrame, tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """doc_id, source, lang, digest (of the text), n_bytes and one count per tokenizer version for each row.

    A null text counts as empty; special tokens are not recognised in texts. Other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(load_ranks(tokenizer_dir))  # 50,000 ranks per version
    versions = list(VERSIONS)
    rest = "doc_id long, source string, lang string, digest string, n_bytes long"
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    slim = slim.withColumns({"digest": F.md5("text"), "n_bytes": F.octet_length("text").cast("long")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encodings = [_encoding(v, held.value[v]) for v in versions]
        for batch in batches:
            counts = np.array(
                [[len(e.encode_ordinary(t.as_py())) for e in encodings] for t in batch.column("text")], np.int64
            ).reshape(-1, len(encodings))
            kept = [batch.column(c) for c in ("doc_id", "source", "lang", "digest", "n_bytes")]
            yield pa.RecordBatch.from_arrays(
                [*kept, *(pa.array(counts[:, k]) for k in range(len(encodings)))],
                ["doc_id", "source", "lang", "digest", "n_bytes", *versions],
            )

    return slim.mapInArrow(run, rest + "".join(f", {v} long" for v in versions))


class Rollup:
    """Totals kept in a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._at = jvm.org.apache.hadoop.fs.Path
        self._files = self._at(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def committed(self, batch: str) -> bool:
        return self._files.exists(self._at(f"{self.path}/committed/{batch}"))

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Adds a batch of changes once; False if it was there.

        ``changes`` has op, source, lang, tokenizer, old_tokens, new_tokens: an insert adds a document and its new tokens, a delete takes
        away a document and its old tokens, a revise replaces old by new tokens. Missing counts are 0, other ops are an error, missing
        source or lang are groups of their own. One writer per batch name is assumed.
        """
        if self.committed(batch):
            return False
        op, old, new = F.col("op"), F.coalesce("old_tokens", F.lit(0)), F.coalesce("new_tokens", F.lit(0))
        wrong = F.raise_error(F.concat(F.lit("unknown op "), F.coalesce(op, F.lit("null")))).cast("long")
        docs = F.when(op == "insert", 1).when(op == "delete", -1).when(op == "revise", 0).otherwise(wrong)
        tokens = F.when(op == "insert", new).when(op == "delete", -old).otherwise(new - old)
        sums = changes.groupBy(*KEYS).agg(F.sum(docs).cast("long").alias("docs"), F.sum(tokens).cast("long").alias("tokens"))
        attempt = f"{self.path}/attempts/{batch}-{uuid.uuid4().hex}"
        sums.write.parquet(attempt)
        self._files.mkdirs(self._at(f"{self.path}/committed"))
        if self.committed(batch) or not self._files.rename(self._at(attempt), self._at(f"{self.path}/committed/{batch}")):
            self._files.delete(self._at(attempt), True)
            return False
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens; groups without documents and tokens are left out."""
        if not self._files.exists(self._at(f"{self.path}/committed")):
            deltas = self.spark.createDataFrame([], DELTAS)
        else:
            deltas = self.spark.read.schema(DELTAS).parquet(f"{self.path}/committed/*")
        sums = deltas.groupBy(*KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
        return sums.where("n_docs != 0 or n_tokens != 0")


def unpivot(counted: DataFrame, op: str, old: str | None, new: str | None) -> DataFrame:
    """Changes for every tokenizer version; ``old`` and ``new`` are expressions in which {v} stands for its column."""
    each = [
        F.struct(
            F.lit(v).alias("tokenizer"),
            F.expr(old.format(v=v) if old else "cast(null as long)").alias("old_tokens"),
            F.expr(new.format(v=v) if new else "cast(null as long)").alias("new_tokens"),
        )
        for v in VERSIONS
    ]
    return counted.select(F.lit(op).alias("op"), "source", "lang", F.inline(F.array(*each)))


def later_copies(counted: DataFrame) -> DataFrame:
    """Rows whose text also has a smaller doc_id."""
    first = counted.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first != last")
    return counted.join(first.select("digest", "first"), "digest").where("doc_id > first")
