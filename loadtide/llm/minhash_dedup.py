"""Near-duplicate documents by b-bit MinHash.

Every distinct shingle set (a class) gets 128 minima. Runs of five minima are band keys; four low bits of every minimum are packed
into eight longs. Classes that share a band key form coarse clusters. Inside a cluster, in blocks of bounded size, bit counts of
the packed signatures give the similarity, corrected for chance collisions of the kept bits; pairs that may reach the threshold are
confirmed on their full shingle sets. Confirmed links give the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtide.llm import groups
from loadtide.llm.words import mix, pieces, shingles, sql_sets
from loadtide.sources.stages import staged

PERMUTATIONS = 128
ROWS = 5
BANDS = PERMUTATIONS // ROWS
BITS = 4
LANES = 64 // BITS
#: A pair at the threshold is estimated below ``threshold - SLACK`` with a probability under 1e-5 (deviation 0.033).
SLACK = 0.15
BLOCK_CLASSES = 1000
BLOCK_SHINGLES = 2_000_000

_random = np.random.default_rng(20240501)
_FACTORS = _random.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32) | np.uint32(1)
_FLIPS = _random.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_LOW_LANES = np.uint64(sum(1 << (BITS * k) for k in range(LANES)))

SKETCH = "doc_id long, digest long, n_shingles long, cid binary, bands array<long>, sig array<long>"
SETS = "cid binary, members binary"
LINKS = "u binary, v binary"


def distinct_shingles(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each document, and the offsets of the documents."""
    values = hashes.copy()
    for first, end in zip(offsets[:-1], offsets[1:]):
        values[first:end].sort()
    fresh = np.ones(len(values), bool)
    fresh[1:] = values[1:] != values[:-1]
    starts = offsets[:-1][np.diff(offsets) > 0]
    fresh[starts] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])
    return values[fresh], kept[offsets]


def minima(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash values, one row for each document that has a shingle."""
    starts = offsets[:-1][np.diff(offsets) > 0]
    out = np.empty((len(starts), PERMUTATIONS), np.uint32)
    low = values.astype(np.uint32)
    for k in range(PERMUTATIONS):
        out[:, k] = np.minimum.reduceat((low ^ _FLIPS[k]) * _FACTORS[k], starts)
    return out


def band_keys(mins: np.ndarray) -> np.ndarray:
    wide = mins.astype(np.uint64)
    keys = np.empty((len(mins), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(mins), band + 1, np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            key = mix(key * _SPREAD + wide[:, k])
        keys[:, band] = key
    return keys.view(np.int64)


def pack(mins: np.ndarray) -> np.ndarray:
    """The low bits of the minima, packed into longs."""
    low = (mins & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(len(mins), -1, LANES)
    shifts = np.arange(LANES, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(low << shifts, axis=2).view(np.int64)


def estimate(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Similarity of one packed signature to many: share of equal lanes, less the lanes that agree by chance."""
    differ = (one ^ many).view(np.uint64)
    for step in (1, 2):
        differ = differ | (differ >> np.uint64(step))
    unequal = np.bitwise_count(differ & _LOW_LANES).sum(axis=1, dtype=np.int64)
    chance = 1.0 / (1 << BITS)
    return (1 - unequal / PERMUTATIONS - chance) / (1 - chance)


def class_ids(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A 128-bit name for each shingle set: two sums of scrambled members."""
    sizes = np.diff(offsets)
    name = np.zeros((len(sizes), 2), np.uint64)
    full = sizes > 0
    if full.any():
        starts = offsets[:-1][full]
        for k, salt in enumerate((np.uint64(0x51ED270B27C11F5D), np.uint64(0xA24BAED4963EE407))):
            name[full, k] = mix(np.add.reduceat(mix(values ^ salt), starts) + sizes[full].astype(np.uint64))
    return groups.binaries(name.reshape(-1), np.arange(0, 2 * len(sizes) + 1, 2))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch.column("text")):
            values, offsets = distinct_shingles(*shingles(piece.hashes, piece.words))
            sizes = np.diff(offsets)
            n, full = len(sizes), sizes > 0
            bands = np.zeros((n, BANDS), np.int64)
            sig = np.zeros((n, PERMUTATIONS // LANES), np.int64)
            if full.any():
                mins = minima(values, offsets)
                bands[full], sig[full] = band_keys(mins), pack(mins)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(piece.first, n),
                    batch.column("digest").slice(piece.first, n),
                    pa.array(sizes.astype(np.int64)),
                    class_ids(values, offsets),
                    groups.lists(bands.reshape(-1), BANDS),
                    groups.lists(sig.reshape(-1), PERMUTATIONS // LANES),
                ],
                ["doc_id", "digest", "n_shingles", "cid", "bands", "sig"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Full shingle sets; a row whose text is not of the wanted class gives none."""
    for batch in batches:
        for piece in pieces(batch.column("text")):
            values, offsets = distinct_shingles(*shingles(piece.hashes, piece.words))
            n = len(offsets) - 1
            ids = class_ids(values, offsets)
            wanted = batch.column("cid").slice(piece.first, n)
            out = pa.RecordBatch.from_arrays([ids, groups.binaries(values, offsets)], ["cid", "members"])
            yield out.filter(pa.compute.equal(ids, wanted))


def confirmed(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, on sorted distinct values."""
    both = np.concatenate([one, other])
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= percent * (len(both) - shared)


def block_links(sets: list[np.ndarray], sigs: np.ndarray, blocks: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join the classes of a pair of blocks (or of one block), as far as they are not joined already."""
    sizes = np.array([len(x) for x in sets])
    across = len(np.unique(blocks)) > 1
    firsts, seconds, scores = [], [], []
    for i in range(len(sets) - 1):
        score = estimate(sigs[i], sigs[i + 1 :])
        rest = sizes[i + 1 :]
        good = (score >= percent / 100 - SLACK) & (100 * np.minimum(rest, sizes[i]) >= percent * np.maximum(rest, sizes[i]))
        if across:
            good &= blocks[i + 1 :] != blocks[i]
        at = np.flatnonzero(good)
        firsts.append(np.full(len(at), i))
        seconds.append(at + i + 1)
        scores.append(score[at])
    if not firsts:
        return []
    first, second, score = (np.concatenate(x) for x in (firsts, seconds, scores))
    parent = list(range(len(sets)))
    out = []
    for k in np.argsort(-score, kind="stable"):
        a, b = int(first[k]), int(second[k])
        x, y = groups.find(parent, a), groups.find(parent, b)
        if x != y and confirmed(sets[a], sets[b], percent):
            parent[x] = y
            out.append((a, b))
    return out


def _links(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups.runs(batches, "task"):
            group = group.combine_chunks()
            ids = group.column("cid").to_pylist()
            sets = [np.frombuffer(x, np.uint64) for x in group.column("members").to_pylist()]
            sigs = np.array(group.column("sig").to_pylist(), np.int64)
            found = block_links(sets, sigs, group.column("block").to_numpy(), percent)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[a] for a, _ in found], pa.binary()), pa.array([ids[b] for _, b in found], pa.binary())],
                    ["u", "v"],
                )

    return run


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """Components of documents whose sets of distinct five-word shingles overlap: 100 * intersection >= percent * union.

    Returns doc_id, n_shingles, component_id, kept, class_id and digest (a hash of the text). One row for each input row. A document with fewer than five words has its whole
    sequence as only shingle; one without words (or with a null text) has none and is linked with nothing. Rows of equal sets
    form one class and count as one text. ``component_id`` is the smallest doc_id reachable, itself included; repeated
    rows each get the same. A row without doc_id is linked with nothing: its component_id is null and it is kept.
    Other columns of ``docs`` are not read; an empty table gives no rows.

    No pair of a group is emitted: only confirmed links that connect something new leave a block.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = staged(slim.withColumn("digest", F.xxhash64("text")).mapInArrow(_sketches, SKETCH), "sketches")
    classes = staged(
        rows.where("n_shingles > 0 and doc_id is not null")
        .groupBy("cid")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("size"), F.first("bands").alias("bands"), F.first("sig").alias("sig")),
        "classes",
    )
    keyed = classes.select("cid", F.explode("bands").alias("band"), F.pmod(F.xxhash64("cid"), F.lit(8).cast("long")).alias("salt"))
    buckets = keyed.groupBy("band").agg(F.min("cid").alias("low"), F.max("cid").alias("high")).where("low != high").drop("high")
    buckets = buckets.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))))
    meets = keyed.join(buckets, ["band", "salt"]).where("cid != low").select(F.col("cid").alias("u"), F.col("low").alias("v"))
    clusters = groups.components(meets, "near_clusters").withColumnsRenamed({"node": "cid", "root": "cluster"})
    members = staged(clusters.join(classes.drop("bands"), "cid"), "near_members")
    weights = members.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_CLASSES), F.ceil(F.sum("size") / BLOCK_SHINGLES)).alias("blocks")
    )
    texts = members.select("cid", F.col("rep").alias("doc_id")).join(slim, "doc_id").select("cid", "text")
    sets = texts.mapInArrow(_sets, SETS).dropDuplicates(["cid"])
    placed = (
        members.join(weights, "cluster")
        .join(sets, "cid")
        .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            F.xxhash64("cluster", F.least("block", "other"), F.greatest("block", "other")).alias("task"),
            "cid",
            "block",
            "sig",
            "members",
        )
    )
    tasks = placed.repartition("task").sortWithinPartitions("task", "cid")
    links = tasks.mapInArrow(_links(percent), LINKS)
    joined = groups.components(links, "near_links").withColumnsRenamed({"node": "cid"})
    lowest = joined.join(classes.select("cid", "rep"), "cid").groupBy("root").agg(F.min("rep").alias("lowest"))
    labels = classes.select("cid", "rep").join(joined.join(lowest, "root").select("cid", "lowest"), "cid", "left")
    labels = labels.select("cid", F.coalesce("lowest", "rep").alias("component"))
    empty = F.col("n_shingles") == 0
    component = F.when(empty, F.col("doc_id")).otherwise(F.when(F.col("doc_id").isNotNull(), F.col("component")))
    return (
        rows.select("doc_id", "digest", "n_shingles", "cid")
        .join(labels, "cid", "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
            F.when(empty, None).otherwise(F.lower(F.hex("cid"))).alias("class_id"),
            "digest",
        )
    )


def deduplicate(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One document of each component of :func:`near_duplicates`, that of the smallest doc_id, with all columns of ``docs``.

    Rows that are equal in doc_id and text are one document, of which one row stays. Of several texts under the kept doc_id the one
    with the smallest digest stays. Documents without words are kept, and so are rows without doc_id.
    """
    verdicts = near_duplicates(docs, percent).select("doc_id", "n_shingles", "kept", "digest").where("kept")
    linked = verdicts.where("doc_id is not null and n_shingles > 0").groupBy("doc_id").agg(F.min("digest").alias("digest"))
    alone = verdicts.where("doc_id is null or n_shingles = 0").select("doc_id", "digest").distinct()
    stay = linked.unionByName(alone).select(F.xxhash64("doc_id", "digest").alias("_stays"))
    name = F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")))
    return docs.withColumn("_stays", name).join(stay, "_stays", "left_semi").dropDuplicates(["_stays"]).drop("_stays")


ORACLE_SQL = f"""
with recursive sets as ({sql_sets("documents", "doc_id")}),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
links as (
  select x, y from (
    select a.doc_id as x, b.doc_id as y, count(*) as common
    from sets a join sets b on a.shingle = b.shingle and a.doc_id != b.doc_id group by a.doc_id, b.doc_id
  ) join sizes s on s.doc_id = x join sizes t on t.doc_id = y
  where 100 * common >= 85 * (s.n + t.n - common)
),
reach(doc, root) as (
  select doc_id, doc_id from documents
  union
  select y, root from reach join links on x = doc
)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, d.doc_id = component_id as kept
from documents d left join sizes using (doc_id)
  join (select doc as doc_id, min(root) as component_id from reach group by doc) using (doc_id)
"""
