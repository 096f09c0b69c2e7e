"""Removal of repeated byte strings with suffix arrays built by two-stage sorting.

Equal windows of ``LENGTH`` bytes must meet in one suffix array. Every window has one anchor, the smallest of its hashed 24-byte grams;
equal windows have equal anchors at equal places. So the corpus is cut at its anchors: the windows of one anchor
form a context (one string of 100 to 176 bytes), contexts are shuffled by their anchor's hash, and only 128 bits and
an address travel. Equal contexts need no sorting: all but the first are repeats. Where one anchor has different
contexts, their texts are fetched and a suffix array over blocks of contexts decides each window.

Two-stage sorting: only suffixes smaller than their successors are sorted directly (by words of eight bytes, to the
depth that matters); all others are induced by one scan over the character buckets. Adjacent common prefixes of 100 bytes or more
chain equal windows; the first in document order stays, the others are covered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtide.llm import groups
from loadtide.llm.words import _tables, buffers, cuts, mix
from loadtide.sources.stages import staged

LENGTH = 100
GRAM = 24
PIECE = 1 << 20
BLOCK = 1 << 19
#: An anchor with more different contexts is cut finer, to runs of ``STEP`` windows that also share the bytes common to the run.
MANY = 1000
STEP = 8
_DIGEST = 18  # bits
_SPAN = 7  # bits
_PLACE = 22  # bits, for places in a part of ``PIECE`` windows

ANCHORS = "k long, c long, doc long, at long, lone boolean"
FOUND = "h long, doc long, at long, fetch boolean, many boolean"
CONTEXTS = "h long, doc long, digest long, start int, n int, context binary"
SPANS = "doc long, digest long, start int, stop int"


# ---------------------------------------------------------------- suffix array


def suffix_types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; the last one counts as smaller."""
    n = len(text)
    up = np.zeros(n, bool)
    up[-1] = True
    turns = np.flatnonzero(text[1:] != text[:-1])
    if len(turns):
        up[turns] = text[turns] < text[turns + 1]
    # in a run of one character all have the type of its end
    ends = np.append(turns, n - 1)
    return up[ends[np.searchsorted(ends, np.arange(n))]]


def _words(text: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes at each place as one number, most significant first; zeros follow the end."""
    padded = np.zeros(len(text) + depth + 16, np.uint64)
    padded[: len(text)] = text
    out = padded[: len(padded) - 8].copy()
    for k in range(1, 8):
        out <<= np.uint64(8)
        out |= padded[k : len(padded) - 8 + k]
    return out


def _sort_direct(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of their next ``depth`` bytes, ties by place."""
    order = places[np.argsort(words[places], kind="stable")]
    fresh = np.ones(len(order), bool)
    keys = words[order]
    fresh[1:] = keys[1:] != keys[:-1]
    for k in range(8, depth, 8):
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        group = np.cumsum(fresh)[at]
        keys = words[order[at] + k]
        turn = np.lexsort((keys, group))
        order[at] = order[at][turn]
        keys, group = keys[turn], group[turn]
        fresh[at[1:]] = (group[1:] != group[:-1]) | (keys[1:] != keys[:-1])
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes at least."""
    n = len(text)
    smaller = suffix_types(text)
    words = _words(text, depth)
    direct = _sort_direct(np.flatnonzero(smaller), words, depth)
    sizes = np.bincount(text, minlength=256)
    heads = np.cumsum(sizes) - sizes
    induced = np.bincount(text[~smaller], minlength=256)
    out = np.empty(n, np.int64)
    firsts = np.bincount(text[direct], minlength=256)
    bounds = np.cumsum(firsts) - firsts
    for c in np.flatnonzero(firsts):
        out[heads[c] + induced[c] : heads[c] + sizes[c]] = direct[bounds[c] : bounds[c] + firsts[c]]
    fill = heads.copy()

    def induce(scanned: np.ndarray) -> None:
        before = scanned[scanned > 0] - 1
        before = before[~smaller[before]]
        if len(before):
            chars = text[before]
            turn = np.argsort(chars, kind="stable")
            before, chars = before[turn], chars[turn]
            counts = np.bincount(chars, minlength=256)
            offset = np.cumsum(counts) - counts
            out[fill[chars] + np.arange(len(before)) - offset[chars]] = before
            fill[:] += counts

    for c in np.flatnonzero(sizes):
        done = heads[c]
        while done < fill[c]:  # suffixes of this bucket can induce more of it
            end = fill[c]
            induce(out[done:end].copy())
            done = end
        induce(out[heads[c] + induced[c] : heads[c] + sizes[c]])
    return out


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it in ``order``, up to ``depth``."""
    words = _words(text, depth)
    out = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for k in range(0, depth, 8):
        differ = words[order[live] + k] ^ words[order[live - 1] + k]
        same = differ == 0
        part = differ[~same]
        equal = np.zeros(len(part), np.int64)
        for shift in range(56, 0, -8):
            equal += (part >> np.uint64(shift)) == 0
        out[live[~same]] = k + equal
        live = live[same]
    out[live] = depth
    return np.minimum(out, depth)


def covered_windows(contexts: list[np.ndarray], length: int = LENGTH) -> list[np.ndarray]:
    """For each context, which of its windows also start earlier: in a context before it, or further left in it."""
    sizes = np.array([len(x) + 1 for x in contexts])
    starts = np.cumsum(sizes) - sizes
    text = np.zeros(sizes.sum(), np.uint8)  # a zero ends each context
    for at, x in zip(starts, contexts):
        text[at : at + len(x)] = x
    left = np.repeat(starts + sizes - 1, sizes) - np.arange(len(text))
    window = left >= length
    depth = -(-length // 8) * 8
    order = suffix_array(text, depth)
    linked = common_prefixes(text, order, depth) >= length
    run = np.cumsum(~linked)
    valid = window[order]
    places, run = order[valid], run[valid]
    covered = np.zeros(len(text), bool)
    if len(places):
        bounds = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
        first = np.minimum.reduceat(places, bounds)
        covered[places] = True
        covered[first] = False
    return [covered[a : a + s - length] for a, s in zip(starts, sizes)]


# ---------------------------------------------------------------- anchors


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor hash, context hash, document, first window, number of windows and the anchor's place in the first, of each context."""
    n, reach = len(data), LENGTH - GRAM + 1
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none, none
    power, inverse = _tables(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * inverse[: n - GRAM + 1])
    bits = np.uint64((1 << _PLACE) - 1)
    assert len(grams) <= 1 << _PLACE
    keys = (grams & ~bits) | np.arange(len(grams), dtype=np.uint64)
    # smallest key of each run of ``reach`` grams, from running minima of blocks in both directions
    blocks = -(-len(keys) // reach)
    padded = np.full(blocks * reach, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    grid = padded.reshape(blocks, reach)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    count = n - LENGTH + 1
    least = (np.minimum(back[:count], ahead[reach - 1 : reach - 1 + count]) & bits).astype(np.int64)
    doc = np.searchsorted(bounds, np.arange(count), "right") - 1
    inside = np.flatnonzero(np.arange(count) + LENGTH <= bounds[doc + 1])
    if not len(inside):
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none, none
    place, owner = least[inside], doc[inside]
    fresh = np.ones(len(inside), bool)
    fresh[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(fresh)
    first, owner, place = inside[at], owner[at], place[at]
    windows = np.diff(np.append(at, len(inside)))
    context = (sums[first + windows + LENGTH - 1] - sums[first]) * inverse[first]
    shape = (windows.astype(np.uint64) << np.uint64(32)) | (place - first).astype(np.uint64)
    return mix(grams[place] ^ np.uint64(0x5BF0_3635_AE3D_1C6B)), mix(context + mix(shape)), owner, first - bounds[owner], windows, place - first


def parts_of(begin: int, end: int) -> Iterator[tuple[int, int]]:
    """Bounds of the parts of a run of bytes: more than one if a document is longer than ``PIECE``; every window lies whole in one part only."""
    for first in range(begin, max(begin + 1, end - LENGTH + 1), PIECE):
        yield first, min(end, first + PIECE + LENGTH - 1)


def digests(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A short digest that tells rows with one doc_id and different texts apart."""
    out = [int.from_bytes(hashlib.md5(data[a:b]).digest()[:4], "big") >> (32 - _DIGEST) for a, b in zip(bounds, bounds[1:])]
    return np.array(out, np.int64)


def after_first(keys: tuple[np.ndarray, ...], doc: np.ndarray, address: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted rows: which follow the first of their key, and which of them are that very place again (a repeated row)."""
    fresh = np.ones(len(doc), bool)
    fresh[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in keys])
    lead = np.maximum.accumulate(np.where(fresh, np.arange(len(doc)), 0))
    return ~fresh, ~fresh & (doc == doc[lead]) & (address == address[lead])


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, bounds = buffers(batch.column("text"))
        ids = batch.column("doc").to_numpy()
        parts = []
        for first, last in cuts(bounds, PIECE):
            tags = digests(data, bounds[first : last + 1])
            for begin, end in parts_of(int(bounds[first]), int(bounds[last])):
                at = np.clip(bounds[first : last + 1], begin, end) - begin
                h, c, owner, start, n, inside = anchors(data[begin:end], at)
                start = start + max(0, begin - int(bounds[first]))  # only a lone document has several parts
                tag = tags[owner]
                address = (start << 32) | (n << (_DIGEST + _SPAN)) | (inside << _DIGEST) | tag
                parts.append((h, c, ids[first:last][owner], tag, address))
        if not parts:
            continue
        h, c, doc, tag, address = (np.concatenate(x) for x in zip(*parts))
        # repeats of a context inside the batch are settled here: they are dealt out evenly, not by their anchor
        order = np.lexsort((address >> 32, tag, doc, c, h))
        h, c, doc, address = (x[order] for x in (h, c, doc, address))
        repeat, again = after_first((h, c), doc, address)
        h, c, doc, address, repeat = (x[~again] for x in (h, c, doc, address, repeat))
        key = np.where(repeat, mix(address.view(np.uint64) + doc.view(np.uint64)), h)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)), pa.array(c.view(np.int64)), pa.array(doc), pa.array(address), pa.array(repeat)],
            ["k", "c", "doc", "at", "lone"],
        )


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts that repeat (to be removed) and first ones of an anchor that has several (to be fetched)."""
    held: list[np.ndarray] = []

    def settle(k, c, doc, at, lone):
        order = np.lexsort((at >> 32, at & ((1 << _DIGEST) - 1), doc, c, k, lone))
        k, c, doc, at, lone = (x[order] for x in (k, c, doc, at, lone))
        later, again = after_first((k, lone, c), doc, at)
        fresh = ~later
        group = np.cumsum(~after_first((k, lone), doc, at)[0]) - 1
        different = np.bincount(group, fresh)[group]
        keep = lone | (later & ~again) | (fresh & (different > 1))
        columns = (k, doc, at, fresh & ~lone, different > MANY)
        return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in columns], ["h", "doc", "at", "fetch", "many"])

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(name).to_numpy(zero_copy_only=False) for name in ("k", "c", "doc", "at", "lone")]
        if held:
            columns = [np.concatenate([a, b]) for a, b in zip(held, columns)]
        cut = int(np.searchsorted(columns[0], columns[0][-1]))  # the last key may go on
        if cut:
            yield settle(*(x[:cut] for x in columns))
        held = [x[cut:] for x in columns]
    if held:
        yield settle(*held)


def finer(h: int, data: np.ndarray, start: int, n: int, inside: int) -> Iterator[tuple[int, int, int]]:
    """Key, first window and number of windows of the runs that a context of a common anchor is cut to."""
    for q in range(max(0, inside - n + 1) // STEP, inside // STEP + 1):
        first, last = max(0, inside - STEP * q - STEP + 1), min(n - 1, inside - STEP * q)
        shared = start + inside - STEP * q
        key = xxhash.xxh3_64_intdigest(data[shared : shared + LENGTH - STEP + 1].tobytes(), (h + q) & 0xFFFF_FFFF_FFFF_FFFF)
        yield key - (1 << 63), first, last - first + 1


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, bounds = buffers(batch.column("text"))
        rows = batch.column("places").flatten()
        sizes = np.diff(batch.column("places").offsets.to_numpy())
        owner = np.repeat(np.arange(batch.num_rows), sizes)
        h, start, n, inside = (rows.field(name).to_numpy() for name in ("h", "start", "n", "inside"))
        common = np.flatnonzero(rows.field("many").to_numpy(zero_copy_only=False))
        if len(common):
            cut = [
                (key, r, start[r] + first, windows)
                for r in common
                for key, first, windows in finer(int(h[r]), data[bounds[owner[r]] : bounds[owner[r] + 1]], int(start[r]), int(n[r]), int(inside[r]))
            ]
            rest = np.delete(np.arange(len(h)), common)
            keys, at, starts, windows = (np.array(x, np.int64) for x in zip(*cut))
            h, owner = np.concatenate([h[rest], keys]), np.concatenate([owner[rest], owner[at]])
            start, n = np.concatenate([start[rest], starts]).astype(np.int32), np.concatenate([n[rest], windows]).astype(np.int32)
        for first in range(0, len(h), 5_000):
            part = slice(first, first + 5_000)
            begin = bounds[owner[part]] + start[part]
            width = n[part].astype(np.int64) + LENGTH - 1
            at = np.concatenate([[0], np.cumsum(width)])
            flat = data[np.repeat(begin - at[:-1], width) + np.arange(at[-1])]
            take = pa.array(owner[part])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h[part]),
                    batch.column("doc").take(take),
                    batch.column("digest").take(take),
                    pa.array(start[part]),
                    pa.array(n[part]),
                    groups.binaries(flat, at),
                ],
                ["h", "doc", "digest", "start", "n", "context"],
            )


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of covered windows, from suffix arrays over runs of whole anchors of about ``BLOCK`` bytes."""

    def solve(parts: list[pa.Table]) -> pa.RecordBatch:
        rows = pa.concat_tables(parts).combine_chunks().sort_by([("doc", "ascending"), ("digest", "ascending"), ("start", "ascending")])
        start = rows.column("start").to_numpy()
        # equal contexts of an anchor: all but the first are covered
        first: dict[tuple[int, bytes], int] = {}
        out, own = [], []
        docs, tags = rows.column("doc").to_numpy(), rows.column("digest").to_numpy()
        for row, (key, context) in enumerate(zip(rows.column("h").to_pylist(), rows.column("context").to_pylist())):
            lead = first.setdefault((key, context), row)
            if lead == row:
                own.append(row)
            elif (docs[lead], tags[lead], start[lead]) != (docs[row], tags[row], start[row]):
                out.append((row, start[row], start[row] + len(context)))
        texts = [np.frombuffer(context, np.uint8) for _, context in first]
        for row, covered in zip(own, covered_windows(texts)):
            edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
            out += [(row, start[row] + a, start[row] + b - 1 + LENGTH) for a, b in zip(edges[::2], edges[1::2])]
        out = np.array(out, np.int64).reshape(-1, 3)
        take = pa.array(out[:, 0])
        return pa.RecordBatch.from_arrays(
            [
                rows.column("doc").combine_chunks().take(take) if rows.num_rows else pa.array([], pa.int64()),
                rows.column("digest").combine_chunks().take(take) if rows.num_rows else pa.array([], pa.int64()),
                pa.array(out[:, 1].astype(np.int32)),
                pa.array(out[:, 2].astype(np.int32)),
            ],
            ["doc", "digest", "start", "stop"],
        )

    held, size = [], 0
    for group in groups.runs(batches, "h"):
        held.append(group)
        size += int(group.column("n").to_numpy().sum()) + LENGTH * group.num_rows
        if size >= BLOCK:
            yield solve(held)
            held, size = [], 0
    if held:
        yield solve(held)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, bounds = buffers(batch.column("text"))
        spans = batch.column("spans")
        flat, at = spans.flatten(), spans.offsets.to_numpy() - spans.offsets[0].as_py()
        starts, stops = flat.field("start").to_numpy(), flat.field("stop").to_numpy()
        valid = spans.is_valid().to_numpy(zero_copy_only=False)
        removed, runs, hashes, texts = [], [], [], []
        for row in range(batch.num_rows):
            raw = data[bounds[row] : bounds[row + 1]]
            depth = np.zeros(len(raw) + 1, np.int64)
            if valid[row]:
                np.add.at(depth, starts[at[row] : at[row + 1]], 1)
                np.add.at(depth, stops[at[row] : at[row + 1]], -1)
            gone = np.cumsum(depth)[:-1] > 0
            left = raw[~gone].tobytes()
            removed.append(int(gone.sum()))
            runs.append(int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1)))
            hashes.append(hashlib.sha256(left).hexdigest())
            texts.append(left)
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(i) for i, name in enumerate(batch.schema.names) if name not in ("text", "spans")),
                batch.column("text"),
                pa.array(np.diff(bounds)),
                pa.array(removed, pa.int64()),
                pa.array(runs, pa.int64()),
                pa.array(hashes, pa.string()),
                pa.array(texts, pa.binary()),
                pa.array([x.decode("utf-8", "ignore") for x in texts], pa.string()),
            ],
            [*(n for n in batch.schema.names if n not in ("text", "spans")), "text", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes", "kept_text"],
        )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Byte spans (start, stop) of each document, overlapping or not, that cover what :func:`remove_repeats` removes.

    ``docs`` has doc, digest and text. Returns doc, digest, start, stop.
    """
    dealt = docs.select("doc", "text").mapInArrow(_anchor_rows, ANCHORS).repartition("k").sortWithinPartitions("k")
    found = staged(dealt.mapInArrow(_found, FOUND), "repeated_contexts")

    def bits(shift: int, width: int):
        return F.shiftright("at", shift).bitwiseAND(F.lit((1 << width) - 1))

    found = found.select(
        "h",
        "doc",
        bits(0, _DIGEST).cast("long").alias("digest"),
        bits(32, 31).cast("int").alias("start"),
        bits(_DIGEST + _SPAN, _SPAN).cast("int").alias("n"),
        bits(_DIGEST, _SPAN).cast("int").alias("inside"),
        "fetch",
        "many",
    )
    places = F.collect_list(F.struct("h", "start", "n", "inside", "many")).alias("places")
    wanted = found.where("fetch").groupBy("doc", "digest").agg(places)
    contexts = docs.join(wanted, ["doc", "digest"]).select("doc", "digest", "text", "places").mapInArrow(_contexts, CONTEXTS)
    decided = contexts.repartition("h").sortWithinPartitions("h").mapInArrow(_decided, SPANS)
    whole = found.where("not fetch").select("doc", "digest", "start", (F.col("start") + F.col("n") + F.lit(LENGTH - 1)).cast("int").alias("stop"))
    return whole.unionByName(decided)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Removes each byte that a 100-byte string covers which also starts earlier in the corpus.

    Earlier means a smaller doc_id, or the same document and an earlier start; strings never cross documents, may overlap, and
    are judged on the input. Returns all columns of ``docs`` and n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, kept_bytes
    (binary: a cut can fall inside a character), kept_text (without the bytes of cut characters); clashing columns of these names are replaced. A null text is empty. Rows
    without doc_id come after all others. Rows that share a doc_id are ordered by a digest of their text; rows equal in both are one
    document and get the same result. An empty table gives no rows.
    """
    made = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes", "kept_text")
    rest = [c for c in docs.columns if c not in made and c != "text"]
    text = F.col("text").cast("string")
    body = F.coalesce(text, F.lit(""))
    digest = F.conv(F.substring(F.md5(body), 1, 8), 16, 10).cast("long")
    own = docs.select(
        F.struct(*rest).alias("_row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"),
        F.shiftright(digest, 32 - _DIGEST).alias("digest"),
        text.alias("text"),
    )
    spans = repeated_spans(own.select("doc", "digest", F.coalesce("text", F.lit("")).alias("text")))
    gathered = spans.groupBy("doc", "digest").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    joined = own.join(gathered, ["doc", "digest"], "left").select("_row", "text", "spans")
    kinds = joined.select("_row", "text").schema
    for name, kind in (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string"), ("kept_bytes", "binary"), ("kept_text", "string")):
        kinds = kinds.add(name, kind)
    return joined.mapInArrow(_cut, kinds).select("_row.*", "text", *made)
