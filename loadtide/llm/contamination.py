"""Benchmark decontamination: containment search by MinHash over size classes, verified by exact shingle containment.

A short item inside a long document has a tiny Jaccard similarity to it, so documents are cut to windows that fit the
items. Items are partitioned by the size of their shingle set into classes up to 2, 4, 8, ... shingles. For a class
of up to u shingles a window is two neighbouring blocks of u positions: any run that holds an item lies in one window,
whose similarity to the item is then at least 0.8 / (2 + 1 - 0.8) = 0.36. Block minima of larger classes are minima of smaller ones, so all classes cost
one hash pass. An item is a candidate for a document when one of 64 minima agrees with a window's; with the item's
shingles spread over the document, 64 * 0.8 / 2.2 agreements are expected. Candidates are counted exactly on whole documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtide.llm import groups
from loadtide.llm.minhash_dedup import class_ids, distinct_shingles
from loadtide.llm.words import pieces, shingles, sql_sets
from loadtide.sources.stages import staged

PERCENT = 80
PERMUTATIONS = 64
#: Items are searched in blocks of about so many shingles: the broadcast's bound, 8 bytes each plus signatures.
BLOCK_SHINGLES = 1_000_000

_random = np.random.default_rng(20240502)
_FACTORS = _random.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32) | np.uint32(1)
_FLIPS = _random.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)


def _minima(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    out = np.empty((len(starts), PERMUTATIONS), np.uint32)
    low = values.astype(np.uint32)
    for k in range(PERMUTATIONS):
        out[:, k] = np.minimum.reduceat((low ^ _FLIPS[k]) * _FACTORS[k], starts)
    return out


def _item_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch.column("text")):
            values, offsets = distinct_shingles(*shingles(piece.hashes, piece.words))
            n = len(offsets) - 1
            out = [
                batch.column("item_id").slice(piece.first, n),
                pa.array(np.diff(offsets)),
                class_ids(values, offsets),
                groups.binaries(values, offsets),
            ]
            yield pa.RecordBatch.from_arrays(out, ["item_id", "size", "cid", "members"])


class Index:
    """A block of items, by size class: sets, and for each permutation the sorted minima."""

    def __init__(self, ids: list[int], sets: list[np.ndarray]):
        sizes = np.array([len(x) for x in sets])
        self.ids, self.sets = np.array(ids, np.int64), sets
        self.classes: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        upper = np.maximum(1, np.ceil(np.log2(np.maximum(sizes, 1) + 1))).astype(int)
        for level in np.unique(upper):
            members = np.flatnonzero(upper == level)
            starts = np.concatenate([[0], np.cumsum(sizes[members])[:-1]])
            minima = _minima(np.concatenate([sets[i] for i in members]), starts)
            order = np.argsort(minima, axis=0, kind="stable")
            self.classes.append((1 << level, members, order, np.take_along_axis(minima, order, axis=0)))

    def candidates(self, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Pairs of a document's number and an item's number, distinct."""
        found = []
        sizes = np.diff(offsets)
        docs = np.flatnonzero(sizes)
        if not len(docs):
            return np.zeros((0, 2), np.int64)
        unit = self.classes[0][0]
        counts = -(-sizes[docs] // unit)  # blocks of each document
        owner = np.repeat(docs, counts)
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        minima = _minima(values, offsets[owner] + inside * unit)
        for width, members, order, known in self.classes:
            while unit < width:  # merge neighbouring blocks
                starts = np.flatnonzero(inside % 2 == 0)
                minima = np.minimum.reduceat(minima, starts, axis=0)
                owner, inside, unit = owner[starts], inside[starts] // 2, unit * 2
            window = minima.copy()
            same = owner[1:] == owner[:-1]
            window[:-1][same] = np.minimum(window[:-1][same], minima[1:][same])
            for k in range(PERMUTATIONS):
                column = known[:, k]
                low = np.searchsorted(column, window[:, k], "left")
                hit = np.flatnonzero((low < len(column)) & (column[np.minimum(low, len(column) - 1)] == window[:, k]))
                if len(hit):
                    high = np.searchsorted(column, window[hit, k], "right")
                    many = high - low[hit]
                    at = np.repeat(low[hit], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    found.append(np.stack([np.repeat(owner[hit], many), members[order[at, k]]], axis=1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)

    def matches(self, values: np.ndarray, offsets: np.ndarray, percent: int) -> list[tuple[int, int, int, int]]:
        """Document's number, item_id, size of the item's set, shingles shared with the whole document."""
        out, last, own = [], -1, values[:0]
        for d, i in self.candidates(values, offsets).tolist():
            if d != last:
                last, own = d, np.sort(values[offsets[d] : offsets[d + 1]])
            item = self.sets[i]
            at = np.searchsorted(own, item)
            shared = int(np.count_nonzero(own[np.minimum(at, len(own) - 1)] == item))
            if 100 * shared >= percent * len(item):
                out.append((d, int(self.ids[i]), len(item), shared))
        return out


def indexes(items: DataFrame) -> Iterator[Index]:
    """The items in blocks of bounded size. Items without id or words match nothing; repeated ones count once."""
    slim = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    sets = staged(
        slim.where("item_id is not null")
        .mapInArrow(_item_sets, "item_id long, size long, cid binary, members binary")
        .where("size > 0")
        .dropDuplicates(["item_id", "cid"]),
        "benchmark_sets",
    )
    total = sets.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_SHINGLES))
    for block in range(blocks if total else 0):
        rows = sets.where(F.pmod(F.xxhash64("cid", "item_id"), F.lit(blocks)) == block).orderBy("item_id", "cid").collect()
        if rows:
            yield Index([r.item_id for r in rows], [np.frombuffer(r.members, np.uint64) for r in rows])


def _each(batch: pa.RecordBatch, index: Index, percent: int) -> Iterator[tuple[int, int, int, int]]:
    for piece in pieces(batch.column("text")):
        for d, *rest in index.matches(*shingles(piece.hashes, piece.words), percent):
            yield piece.first + d, *rest


def search(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs of documents and the items that they contain: 100 * shared >= percent * shingles of the item.

    Returns doc_id, item_id, item_shingles, shared_shingles; documents without a match have no row. Shingles are five words; an item with fewer
    is one shingle, which only an equally short document can hold. Null and empty texts match nothing; rows without
    doc_id are searched and return null; repeated rows each return theirs. Other columns are not read. Either table may
    be empty.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, item_shingles long, shared_shingles long"
    out = spark.createDataFrame([], schema)

    def job(held) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = np.array(list(_each(batch, held.value, percent)), np.int64).reshape(-1, 4)
                ids = batch.column("doc_id").take(pa.array(found[:, 0]))
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(found[:, k]) for k in (1, 2, 3))],
                    ["doc_id", "item_id", "item_shingles", "shared_shingles"],
                )

        return run

    for index in indexes(items):
        out = out.unionByName(slim.mapInArrow(job(spark.sparkContext.broadcast(index)), schema))
    return out


def decontaminate(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, without those that contain an item (as :func:`search` finds them)."""
    spark = docs.sparkSession

    def job(held) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[d for d, *_ in _each(batch, held.value, percent)]] = False
                yield batch.filter(pa.array(clean))

        return run

    for index in indexes(items):
        docs = docs.mapInArrow(job(spark.sparkContext.broadcast(index)), docs.schema)
    return docs


ORACLE_SQL = f"""
with doc_sets as ({sql_sets("documents", "doc_id")}),
item_sets as ({sql_sets("benchmark", "item_id")}),
sizes as (select item_id, count(*) as item_shingles from item_sets group by item_id),
shared as (
  select doc_id, item_id, count(*) as shared_shingles from doc_sets join item_sets using (shingle) group by doc_id, item_id
)
select doc_id, item_id, item_shingles, shared_shingles
from shared join sizes using (item_id) where 100 * shared_shingles >= {PERCENT} * item_shingles
"""
