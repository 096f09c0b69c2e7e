"""Toxicity: a convolutional text classifier on hashed words, trained here in numpy.

Words are hashed to rows of an embedding table; filters of several widths run over the word sequence, the largest response of each
filter over the whole text feeds a logistic output. The only input of a score is the text. The embedding's first column
starts at the smoothed log odds of the word in the training texts; everything is then trained by Adam. Verdicts use one threshold per language, set
on training rows that the fit has not seen.

All labelled rows are learned from. They are dealt to shards of bounded size; a round trains every shard from the common weights, and Spark
averages what the shards changed. Only weights, which do not grow with the table, and one cut per language reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtide.llm import groups
from loadtide.llm.words import Piece, buffers, mix, pieces
from loadtide.sources.stages import staged

WORD_BUCKETS = 1 << 16
BUCKETS = WORD_BUCKETS + (1 << 14)
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 5
#: Up to so many labelled rows are fitted in one piece; more are dealt to shards.
LOCAL_ROWS = 4000
#: Labelled rows, and bytes of all texts, per shard.
SHARD_ROWS, SHARD_BYTES = 16_384, 128 << 20
#: Passes over the shards before the cuts are set; one more pass over all rows follows.
ROUNDS = 3
#: One in so many labelled rows sets the thresholds and the output's scale before it is fitted.
CALIBRATION = 5
#: Steps between 0 and 1 on which the cuts of sharded rows lie.
CUT_STEPS = 1 << 16
#: Buckets of the embedding that are averaged together.
BLOCK = 1024

#: Bits per labelled document of the map that lets few other texts be hashed, and its largest size.
MAP_SHARE, MAP_BITS = 16, 1 << 27

KEYS = "doc_id long, lang string, key binary"
ROWS = "part int, key binary, ids binary"
BLOCKS = "block int, part int, n_rows long, delta binary, touched binary"
MARKS = "lang string, step int, toxic int"

#: Documents that a word's first log odds count as seen beforehand.
PRIOR = 8

PIECE_WORDS = 50_000
#: Bytes of text hashed together.
PIECE_BYTES = 1 << 20


@dataclass
class Model:
    table: np.ndarray  # buckets x dimensions
    filters: list[np.ndarray]  # per width: width x dimensions x filters
    biases: list[np.ndarray]
    out: np.ndarray
    offset: float
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    default: float = 0.5

    def taps(self) -> np.ndarray:
        return taps(self.table, self.filters)


def taps(table: np.ndarray, filters: list[np.ndarray]) -> np.ndarray:
    """Response of each bucket at each place of each filter, side by side: inference is lookups and sums."""
    return np.concatenate([table @ step for w in filters for step in w], axis=1).astype(np.float32)


_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[ord(c) for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = True


def bare(column: pa.Array) -> pa.Array:
    """Texts with ASCII punctuation blanked, so that a word and the same word before a comma are one."""
    data, bounds = buffers(column)
    data = data.copy()
    data[_PUNCTUATION[data]] = 0x20
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)])


def bucket_ids(piece: Piece) -> np.ndarray:
    """Two buckets per word: one for the word, one for its first four bytes (inflected forms share it)."""
    out = np.empty((len(piece.hashes), 2), np.int32)
    out[:, 0] = (mix(piece.hashes) >> np.uint64(40)) % np.uint64(WORD_BUCKETS)
    head = np.zeros(len(piece.hashes), np.uint64)
    for k in range(4):
        at = piece.starts + k
        inside = at < piece.ends
        byte = piece.data[np.where(inside, at, 0)].astype(np.uint64)
        byte += np.uint64(32) * ((byte >= 65) & (byte <= 90))
        head |= np.where(inside, byte + np.uint64(1), np.uint64(0)) << np.uint64(9 * k)
    out[:, 1] = WORD_BUCKETS + (mix(head) >> np.uint64(40)) % np.uint64(BUCKETS - WORD_BUCKETS)
    return out


def responses(lookup: np.ndarray, ids: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Response of every filter at every word, one array per width; a window sees nothing beyond its document."""
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(ids))
    each = lookup[ids[:, 0]]
    each += lookup[ids[:, 1]]
    first = 0
    for width in WIDTHS:
        total = each[:, first : first + FILTERS].copy()
        for k in range(1, width):
            cols = slice(first + k * FILTERS, first + (k + 1) * FILTERS)
            total[: len(ids) - k] += each[k:, cols] * (left[: len(ids) - k] > k)[:, None]
        first += width * FILTERS
        yield total


def pooled(
    lookup: np.ndarray, biases: list[np.ndarray], ids: np.ndarray, offsets: np.ndarray, places: bool = False
) -> tuple[np.ndarray, np.ndarray | None]:
    """Largest response of every filter per document, at zero at least, and the place of its (first) window.

    Documents without words have zeros, and place -1.
    """
    sizes = np.diff(offsets)
    width = sum(len(b) for b in biases)
    values, where = np.zeros((len(sizes), width), np.float32), np.full((len(sizes), width), -1, np.int64)
    full = np.flatnonzero(sizes > 0)
    if len(full):
        starts, first = offsets[:-1][full], 0
        for found, bias in zip(responses(lookup, ids, offsets), biases):
            cols = slice(first, first + len(bias))
            first += len(bias)
            top = np.maximum.reduceat(found, starts)
            values[full, cols] = np.maximum(top + bias, 0)
            if places:
                at = np.where(found == np.repeat(top, sizes[full], axis=0), np.arange(len(ids))[:, None], len(ids))
                where[full, cols] = np.minimum.reduceat(at, starts)
    return values, where if places else None


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _holders(ids: np.ndarray, offsets: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Numbers of clean and of toxic documents that hold a bucket's word."""
    out = np.zeros((2, BUCKETS))
    for label, first, last in zip(labels, offsets, offsets[1:]):
        out[int(label > 0)][np.unique(ids[first:last])] += 1
    return out


def _log_odds(holders: np.ndarray, toxic: float, n: int) -> np.ndarray:
    """Smoothed log odds of the label in documents that hold a bucket's word, of ``n`` documents."""
    share = (toxic + 1) / (n + 2)
    return np.log((holders[1] + PRIOR * share) / (holders[0] + PRIOR * (1 - share))) - np.log(share / (1 - share))


def gradients(
    table: np.ndarray, filters: list[np.ndarray], biases: list[np.ndarray], out: np.ndarray, offset: float,
    ids: np.ndarray, offsets: np.ndarray, labels: np.ndarray,
) -> tuple[list[np.ndarray], float]:
    """Slopes of the mean logistic loss, plus 5e-5 times the squared output weights, by table, filters, biases and output; by the offset."""
    features, places = pooled(taps(table, filters), biases, ids, offsets, places=True)
    error = (_logistic(features @ out + offset) - labels) / len(labels)
    flow = error[:, None] * out * (features > 0)
    by_table = np.zeros_like(table)
    by_filters, by_biases = [], []
    for k, w in enumerate(filters):
        cols = slice(k * FILTERS, (k + 1) * FILTERS)
        f, p = flow[:, cols], places[:, cols]
        g = np.zeros_like(w)
        for step in range(len(w)):
            spot = p + step
            rows, which = np.nonzero((p >= 0) & (spot < offsets[1:, None]) & (f != 0))
            if not len(rows):
                continue
            word, pull = ids[spot[rows, which]], f[rows, which]
            np.add.at(g[step].T, which, pull[:, None] * table[word].sum(axis=1))
            for half in (0, 1):
                np.add.at(by_table, word[:, half], pull[:, None] * w[step].T[which])
        by_filters.append(g)
        by_biases.append(f.sum(axis=0))
    return [by_table, *by_filters, *by_biases, features.T @ error + 1e-4 * out], float(error.sum())


def _start(rng: np.random.Generator, toxic: float, n: int) -> Model:
    """Weights before training on ``n`` documents, and the answer of a model that knows one label only."""
    table = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    filters = [rng.normal(0, 0.3 / w, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS]
    for w in filters:
        w[0, 0, :] = np.abs(w[0, 0, :]) + 0.3
    biases = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    out = np.full(len(WIDTHS) * FILTERS, 0.1, np.float32)
    share = (toxic + 1) / (n + 2)
    if not 0 < toxic < n:
        return Model(np.zeros_like(table), filters, biases, np.zeros_like(out), float(np.log(share / (1 - share))))
    return Model(table, filters, biases, out, -2.0)


def _descend(model: Model, ids: np.ndarray, offsets: np.ndarray, labels: np.ndarray, rng: np.random.Generator, epochs: int) -> None:
    """Trains the weights in place."""
    table, filters, biases, out = model.table, model.filters, model.biases, model.out
    labels = labels.astype(np.float64)
    state = [np.zeros_like(x) for x in (*filters, *biases, out)], [np.zeros_like(x) for x in (*filters, *biases, out)]
    steps, offset = 0, model.offset
    slow = [np.zeros(BUCKETS)]
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for batch in np.array_split(order, max(1, len(order) // 32)):
            sizes = (offsets[1:] - offsets[:-1])[batch]
            local = np.zeros(len(batch) + 1, np.int64)
            np.cumsum(sizes, out=local[1:])
            at = np.repeat(offsets[batch] - local[:-1], sizes) + np.arange(local[-1])
            seen, back = np.unique(ids[at], return_inverse=True)
            back = back.reshape(-1, 2)
            part = table[seen]
            grads, error = gradients(part, filters, biases, out, offset, back, local, labels[batch])
            grad_table, *grads = grads
            offset -= 0.05 * error
            steps += 1
            for k, (x, g) in enumerate(zip((*filters, *biases, out), grads)):
                state[0][k] = 0.9 * state[0][k] + 0.1 * g
                state[1][k] = 0.99 * state[1][k] + 0.01 * g * g
                x -= 0.01 * (state[0][k] / (1 - 0.9**steps)) / (np.sqrt(state[1][k] / (1 - 0.99**steps)) + 1e-8)
            slow[0][seen] += (grad_table**2).mean(axis=1)
            table[seen] -= 0.02 * grad_table / (np.sqrt(slow[0][seen])[:, None] + 1e-8)
    model.offset = offset


def fit(ids: np.ndarray, offsets: np.ndarray, labels: np.ndarray, seed: int = 7, epochs: int = EPOCHS) -> Model:
    """Trains on documents given as bucket ids. Without both labels the model answers with the share of label 1."""
    rng = np.random.default_rng(seed)
    model = _start(rng, labels.sum(), len(labels))
    if 0 < labels.sum() < len(labels):
        model.table[:, 0] += np.clip(_log_odds(_holders(ids, offsets, labels), labels.sum(), len(labels)), -3, 6)
        _descend(model, ids, offsets, labels, rng, epochs)
    return model


def raw(model: Model, lookup: np.ndarray, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Scores between 0 and 1; a text without words gets the score of its empty features."""
    features = np.zeros((len(offsets) - 1, len(model.out)))
    first = 0
    while first < len(offsets) - 1:  # bounded memory for the responses
        last = int(np.searchsorted(offsets, offsets[first] + PIECE_WORDS, "right")) - 1
        last = max(last, first + 1)
        part = offsets[first : last + 1]
        features[first:last], _ = pooled(lookup, model.biases, ids[part[0] : part[-1]], part - part[0])
        first = last
    return _logistic(model.scale * (features @ model.out + model.offset) + model.shift)


def _f1_cut(scores: np.ndarray, labels: np.ndarray, counts: np.ndarray | None = None) -> float | None:
    """The cut between scores with the best F1; the middle of the widest gap among equals.

    With ``counts`` a score stands for so many rows, and its label is the number of toxic ones.
    """
    counts = np.ones(len(labels)) if counts is None else counts
    if not 0 < labels.sum() < counts.sum():
        return None
    order = np.argsort(-scores, kind="stable")
    s, y = scores[order], labels[order]
    hit = np.cumsum(y)
    f1 = 2 * hit / (np.cumsum(counts[order]) + y.sum())
    usable = np.append(s[:-1] > s[1:], True)
    f1 = np.where(usable, f1, -1)
    below = np.append(s[1:], 0.0)
    top = np.flatnonzero(f1 >= f1.max() - 1e-12)
    best = top[np.argmax(s[top] - below[top])]
    return float((s[best] + below[best]) / 2)


def _hashed(held, parts: int | None = None):
    """Digest of the bucket ids of each text whose doc_id is in the bitmap; with ``parts`` the shard, and the ids, two bytes each and compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = zstandard.ZstdCompressor(level=1)
        words = held.value
        for batch in batches:
            spot = batch.column("spot").to_numpy()
            batch = batch.filter(pa.array((words[spot >> 6] >> (spot & 63)) & 1 == 1))
            for piece in pieces(bare(batch.column("text")), PIECE_BYTES):
                n = piece.last - piece.first
                ids = bucket_ids(piece)
                ids[:, 1] -= WORD_BUCKETS
                ids = ids.astype(np.uint16)
                texts = [ids[a:b].tobytes() for a, b in zip(piece.words, piece.words[1:])]
                keys = [hashlib.md5(x).digest() for x in texts]
                if parts is None:
                    kept = (batch.column(c).slice(piece.first, n) for c in ("doc_id", "lang"))
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(keys, pa.binary())], ["doc_id", "lang", "key"])
                else:
                    part = pa.array([int.from_bytes(k[:8], "big") % parts for k in keys], pa.int32())
                    packed = pa.array([engine.compress(x) for x in texts], pa.binary())
                    yield pa.RecordBatch.from_arrays([part, pa.array(keys, pa.binary()), packed], ["part", "key", "ids"])

    return run


def _bitmap(ids: DataFrame, bits: int) -> np.ndarray:
    """Bits at the hashes of doc_id, as longs: ``MAP_BITS`` at most, whatever the input."""
    spots = ids.select(_spot(bits).alias("spot"))
    words = spots.groupBy(F.shiftright("spot", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(spot & 63 as int)))").alias("word")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words.column("at").to_numpy()] = words.column("word").to_numpy()
    return out


def _spot(bits: int):
    return F.pmod(F.xxhash64("doc_id"), F.lit(bits).cast("long"))


def _unpacked(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket ids of the rows, and their offsets."""
    engine = zstandard.ZstdDecompressor()
    texts = [np.frombuffer(engine.decompress(x), np.uint16) for x in column.to_pylist()]
    offsets = np.concatenate([[0], np.cumsum([len(x) // 2 for x in texts])]).astype(np.int64)
    ids = (np.concatenate(texts) if texts else np.zeros(0, np.uint16)).reshape(-1, 2).astype(np.int32)
    ids[:, 1] += WORD_BUCKETS
    return ids, offsets


def _aside(doc_ids: np.ndarray) -> np.ndarray:
    """Which rows set the thresholds."""
    return (mix(doc_ids.astype(np.uint64)) % np.uint64(CALIBRATION)) == 0


def _labelled(docs: DataFrame, labels: DataFrame, held_out: int | None, parts: int) -> DataFrame:
    """Every labelled text once, dealt to shards: part, key, doc_id (the smallest), toxic (if one label says so), lang, ids.

    Labels meet digests of the texts; only the texts that stay are sent, once.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang")
    ).where("doc_id is not null")
    if held_out:
        marks, texts = (x.where(F.crc32(F.col("doc_id").cast("string")) % held_out != 0) for x in (marks, texts))
    bits = min(MAP_BITS, max(64, 1 << (MAP_SHARE * labels.count()).bit_length()))
    texts = texts.withColumn("spot", _spot(bits))
    context = docs.sparkSession.sparkContext
    held = context.broadcast(_bitmap(marks, bits))
    found = texts.mapInArrow(_hashed(held), KEYS).join(marks, "doc_id")
    chosen = staged(found.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"), F.min("lang").alias("lang")), "toxic_labels")
    held.unpersist()
    sent = texts.mapInArrow(_hashed(context.broadcast(_bitmap(chosen, bits)), parts), ROWS)
    number = F.conv(F.hex(F.substring("key", 1, 8)), 16, 10).cast("decimal(20,0)") % F.lit(parts)
    both = chosen.withColumn("part", number.cast("int")).unionByName(sent, allowMissingColumns=True).repartition(parts, "part")
    met = both.groupBy("part", "key").agg(
        F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"), F.min("lang").alias("lang"), F.first("ids", ignorenulls=True).alias("ids")
    )
    return met.where("toxic is not null and ids is not null")


def train(docs: DataFrame, labels: DataFrame, held_out: int | None = 5, local_rows: int = LOCAL_ROWS, shard_rows: int = SHARD_ROWS) -> Model:
    """Fits on all labelled documents.

    Labels other than 0 and 1, and rows without doc_id or label, are left out; a doc_id or a text that is labelled twice counts as
    toxic if one label says so. With ``held_out`` the rows whose crc32(doc_id) modulo it is 0 are never seen. Up to ``local_rows`` rows
    are fitted in one piece, more in shards of about ``shard_rows``.
    """
    n, size = labels.count(), docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    local = n <= local_rows
    rows = _labelled(docs, labels, held_out, 1 if local else max(-(-n // shard_rows), -(-size // SHARD_BYTES)))
    if not local:
        return _train_shards(rows)
    got = rows.select("doc_id", "toxic", "lang", "ids").toArrow().combine_chunks().sort_by("doc_id")
    ids, offsets = _unpacked(got.column("ids"))
    toxic, langs = got.column("toxic").to_numpy(), np.array(got.column("lang").to_pylist())
    return _calibrated(ids, offsets, toxic, langs, _aside(got.column("doc_id").to_numpy()))


# ---------------------------------------------------------------- shards


def _shards(batches: Iterator[pa.RecordBatch], known_only: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Number, ids, offsets and labels of each shard; with ``known_only`` without the rows set aside."""
    for group in groups.runs(batches, "part"):
        if known_only:
            group = group.filter(pa.array(~_aside(group.column("doc_id").to_numpy())))
        if group.num_rows:
            yield group.column("part")[0].as_py(), *_unpacked(group.column("ids")), group.column("toxic").to_numpy()


def _block_rows(part: int, n_rows: int, table: np.ndarray, touched: np.ndarray, rest: np.ndarray) -> pa.RecordBatch:
    """Changes by blocks of buckets, those of blocks nobody touched left out; block -1 has the other weights."""
    engine = zstandard.ZstdCompressor(level=1)
    rows = [(-1, rest.tobytes(), b"\1")]
    for block, first in enumerate(range(0, BUCKETS, BLOCK)):
        own = touched[first : first + BLOCK]
        if own.any():
            rows.append((block, table[first : first + BLOCK].tobytes(), own.astype(np.uint8).tobytes()))
    blocks, deltas, marks = zip(*rows)
    fixed = [pa.array(np.full(len(rows), x), t) for x, t in ((part, pa.int32()), (n_rows, pa.int64()))]
    packed = [pa.array([engine.compress(x) for x in c], pa.binary()) for c in (deltas, marks)]
    return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), *fixed, *packed], ["block", "part", "n_rows", "delta", "touched"])


def _merged(kind, mean: bool):
    """Adds up the changes of each block; with ``mean`` each bucket's over the rows of the shards that touched it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = zstandard.ZstdDecompressor()
        for group in groups.runs(batches, "block"):
            total, weight = 0.0, 0.0
            for batch in group.to_batches():
                for n, delta, touched in zip(*(batch.column(c).to_pylist() for c in ("n_rows", "delta", "touched"))):
                    own = np.frombuffer(engine.decompress(touched), np.uint8).astype(np.float64)[:, None] * (n if mean else 1)
                    total = total + np.frombuffer(engine.decompress(delta), kind).reshape(len(own), -1) * own
                    weight = weight + own
            value = (total / np.maximum(weight, 1) if mean else total).astype(np.float64)
            yield pa.RecordBatch.from_arrays([group.column("block")[:1].combine_chunks(), pa.array([value.tobytes()], pa.binary())], ["block", "value"])

    return run


def _gathered(made: DataFrame, kind, mean: bool, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The merged blocks as one table of ``width`` columns, and the other values: as long as the weights, whatever the input."""
    merged = made.repartition("block").sortWithinPartitions("block", "part").mapInArrow(_merged(kind, mean), "block int, value binary")
    table, rest = np.zeros((BUCKETS, width)), np.zeros(0)
    for r in merged.collect():
        value = np.frombuffer(r.value, np.float64)
        if r.block < 0:
            rest = value
        else:
            table[r.block * BLOCK : (r.block + 1) * BLOCK] = value.reshape(-1, width)
    return table, rest


def _count_shards(rows: DataFrame, known_only: bool) -> tuple[np.ndarray, float, int]:
    """Clean and toxic holders of each bucket, toxic documents, documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, offsets, toxic in _shards(batches, known_only):
            holders = _holders(ids, offsets, toxic).T.copy()
            yield _block_rows(part, len(toxic), holders, holders.any(axis=1), np.array([toxic.sum(), len(toxic)], np.float64))

    holders, rest = _gathered(rows.mapInArrow(run, BLOCKS), np.float64, False, 2)
    return holders.T, *((float(rest[0]), int(rest[1])) if len(rest) else (0.0, 0))


def _round(rows: DataFrame, model: Model, known_only: bool, seed: int) -> None:
    """One pass: every shard trains from the common weights, which then change by the mean of what the shards changed."""
    held = rows.sparkSession.sparkContext.broadcast(model)

    def flat(m: Model) -> np.ndarray:
        return np.concatenate([*(x.reshape(-1) for x in (*m.filters, *m.biases, m.out)), [m.offset]]).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, offsets, toxic in _shards(batches, known_only):
            begun = held.value
            own = Model(begun.table.copy(), [x.copy() for x in begun.filters], [x.copy() for x in begun.biases], begun.out.copy(), begun.offset)
            _descend(own, ids, offsets, toxic, np.random.default_rng([seed, part]), 1)
            touched = np.zeros(BUCKETS, bool)
            touched[ids.reshape(-1)] = True
            yield _block_rows(part, len(toxic), own.table - begun.table, touched, flat(own) - flat(begun))

    table, rest = _gathered(rows.mapInArrow(run, BLOCKS), np.float32, True, DIMENSIONS)
    held.unpersist()
    model.table += table.astype(np.float32)
    for x in (*model.filters, *model.biases, model.out):
        x += rest[: x.size].reshape(x.shape).astype(np.float32)
        rest = rest[x.size :]
    model.offset += float(rest[0])


def _cuts(rows: DataFrame, model: Model) -> dict[str, tuple[float, int, int]]:
    """Best cut, rows and toxic rows of those set aside: of all under "0", of each language under "1" and its name."""
    held = rows.sparkSession.sparkContext.broadcast((model.taps(), model))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, net = held.value
        for batch in batches:
            batch = batch.filter(pa.array(_aside(batch.column("doc_id").to_numpy())))
            steps = np.round(raw(net, lookup, *_unpacked(batch.column("ids"))) * CUT_STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(steps), batch.column("toxic")], ["lang", "step", "toxic"])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups.runs(batches, "name"):
            steps, n, toxic = (group.column(c).to_numpy() for c in ("step", "n", "toxic"))
            cut = _f1_cut(steps / CUT_STEPS, toxic, n)
            values = (group.column("name")[0].as_py(), cut, int(n.sum()), int(toxic.sum()))
            types = (pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], ["name", "cut", "n", "toxic"])

    names = F.explode(F.array(F.lit("0"), F.concat(F.lit("1"), "lang"))).alias("name")
    steps = rows.mapInArrow(scored, MARKS).select(names, "step", "toxic").groupBy("name", "step").agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic"))
    # at most CUT_STEPS + 1 rows of a name
    found = steps.repartition("name").sortWithinPartitions("name", "step").mapInArrow(best, "name string, cut double, n long, toxic long").collect()
    held.unpersist()
    return {r.name: (r.cut, r.n, r.toxic) for r in found}


def _train_shards(rows: DataFrame) -> Model:
    """As :func:`_calibrated`, over shards: rounds without the rows set aside, scale and thresholds on these, a last round on all rows."""
    rows = staged(rows.sortWithinPartitions("part", "key"), "toxic_rows")
    whole, toxic, n = _count_shards(rows, False)
    model = _start(np.random.default_rng(7), toxic, n)
    if not 0 < toxic < n:
        return model
    every = np.clip(_log_odds(whole, toxic, n), -3, 6).astype(np.float32)
    known, known_toxic, known_n = _count_shards(rows, True)
    apart = 0 < known_toxic < known_n
    begun = np.clip(_log_odds(known, known_toxic, known_n), -3, 6).astype(np.float32) if apart else every
    model.table[:, 0] += begun
    for k in range(ROUNDS):
        _round(rows, model, apart, k)
    cuts = _cuts(rows, model) if apart else {}
    model.table[:, 0] += every - begun
    _round(rows, model, False, ROUNDS)
    if cuts.get("0", (None,))[0] is not None:
        bounded = min(max(cuts["0"][0], 0.02), 0.98)
        model.shift = float(-np.log(bounded / (1 - bounded)))  # the best common cut becomes 0.5
        for name, (cut, own, hits) in cuts.items():
            if name != "0" and own >= 50 and 10 <= hits < own:
                cut = min(max(cut, 1e-9), 1 - 1e-9)
                moved = float(_logistic(np.log(cut / (1 - cut)) + model.shift))
                model.thresholds[name[1:]] = min(max(moved, 0.2), 0.8)
    return model


def _pick(ids: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(offsets)[rows]
    local = np.concatenate([[0], np.cumsum(sizes)])
    return ids[np.repeat(offsets[:-1][rows] - local[:-1], sizes) + np.arange(local[-1])], local


def _calibrated(ids: np.ndarray, offsets: np.ndarray, toxic: np.ndarray, langs: np.ndarray, aside: np.ndarray) -> Model:
    """Fits without the rows set aside, sets the scale and the thresholds on them, then fits on all rows."""
    known, spare = np.flatnonzero(~aside), np.flatnonzero(aside)
    model = fit(ids, offsets, toxic)
    if len(known) and 0 < toxic[known].sum() < len(known) and 0 < toxic[spare].sum() < len(spare):
        trial = fit(*_pick(ids, offsets, known), toxic[known])
        scores = raw(trial, trial.taps(), *_pick(ids, offsets, spare))
        cut = _f1_cut(scores, toxic[spare])
        bounded = min(max(cut, 0.02), 0.98)
        model.shift = float(-np.log(bounded / (1 - bounded)))  # the best common cut becomes 0.5
        moved = _logistic(np.log(np.clip(scores, 1e-9, 1 - 1e-9) / np.clip(1 - scores, 1e-9, 1)) + model.shift)
        for lang in sorted(set(langs[spare].tolist())):
            own = langs[spare] == lang
            if own.sum() >= 50 and 10 <= toxic[spare][own].sum() < own.sum():
                model.thresholds[lang] = min(max(_f1_cut(moved[own], toxic[spare][own]), 0.2), 0.8)
    return model


SCORES = "doc_id long, lang string, score double"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Scores every row of ``docs``: its columns, then score, predicted (score >= 0.5) and rejected (score >= its language's threshold).

    ``lang`` only picks the threshold. Null and empty texts get the score of a text without words. Clashing columns of these names
    are replaced; rows without doc_id and repeated rows are scored like others; an empty table gives no rows.
    """
    # the model is some megabytes, whatever the input
    held = docs.sparkSession.sparkContext.broadcast((model.taps(), model))
    kept = [c for c in docs.columns if c not in ("score", "predicted", "rejected")]
    schema = docs.select(*kept).schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, net = held.value
        for batch in batches:
            column = batch.column("text")
            values = [
                raw(net, lookup, bucket_ids(piece), piece.words) for piece in pieces(bare(column), PIECE_BYTES)
            ]
            values = np.concatenate(values) if values else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], [*batch.schema.names, "score"])

    cut = F.lit(model.default)
    for lang, value in sorted(model.thresholds.items()):
        cut = F.when(F.col("lang") == lang, F.lit(value)).otherwise(cut)
    scored = docs.select(*kept).mapInArrow(run, schema)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).withColumn("rejected", F.col("score") >= cut)
