"""Arrow helpers: stream the groups of a sorted partition, build list columns, walk connected components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtide.sources.stages import staged


def runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each run of equal ``key``; a run may span batches. Only one run is held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(key)
        change = np.flatnonzero(pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)) + 1
        bounds = [0, *change.tolist(), batch.num_rows]
        for first, end in zip(bounds, bounds[1:]):
            value = column[first].as_py()
            if held and value != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(first, end - first))
            last = value
    if held:
        yield pa.Table.from_batches(held)


def whole_runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows in tables of about a batch that cut no run of equal ``key``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(key).to_numpy()
        if held and held[-1].column(key)[-1].as_py() != column[0]:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        other = np.flatnonzero(column != column[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def lists(flat: np.ndarray, width: int) -> pa.ListArray:
    """Rows of ``width`` values each."""
    offsets = np.arange(0, len(flat) + 1, width, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def ragged(flat: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))


def binaries(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary values from one buffer; ``offsets`` count items of ``flat``."""
    flat = np.ascontiguousarray(flat)
    at = (offsets * flat.itemsize).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(flat)]
    ).cast(pa.binary())


def find(parent: np.ndarray | list, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _stars(small: bool):
    """One step over rows (u, v, up) sorted by u and v, ``up`` where v is above u: nodes move to the lowest neighbour, or to u if that is lower.

    The large step moves the neighbours above u, the small one u and its other neighbours. Nothing but two rows is held between batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # of the last node: the row of its lowest neighbour, and the row before
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([*(held.to_batches() if held else []), batch]).combine_chunks()
            skip = rows.num_rows - batch.num_rows
            u, v, up = (rows.column(c).combine_chunks() for c in ("u", "v", "up"))
            fresh = np.append(True, pc.not_equal(u[1:], u[:-1]).to_numpy(zero_copy_only=False))
            again = np.append(False, pc.equal(v[1:], v[:-1]).to_numpy(zero_copy_only=False)) & ~fresh
            lead = np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))
            low = pc.if_else(up.take(pa.array(lead)), u, v.take(pa.array(lead)))
            keep = ~again & (np.arange(len(fresh)) >= skip)
            keep &= True if small else up.to_numpy(zero_copy_only=False)
            a = pc.if_else(pa.array(fresh), u, v) if small else v
            yield pa.RecordBatch.from_arrays([x.filter(pa.array(keep)) for x in (a, low)], ["a", "b"])
            held = rows.take(pa.array([lead[-1], len(lead) - 1]))

    return run


def components(edges: DataFrame, name: str) -> DataFrame:
    """Smallest reachable node of every node of an undirected graph: columns ``node``, ``root``.

    ``edges`` has the comparable columns ``u`` and ``v``. Alternating large-star and small-star steps shrink the graph to
    stars in a logarithmic number of rounds; a step is one shuffle whose sorted rows are streamed, a round's result a table in the shared
    folder. Nothing but two sums of each round reaches the driver. A graph without edges gives no rows.
    """
    kind = edges.schema["u"].dataType.simpleString()

    def step(rows: DataFrame, small: bool) -> DataFrame:
        return rows.repartition("u").sortWithinPartitions("u", "v").mapInArrow(_stars(small), f"a {kind}, b {kind}")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    pairs = edges.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).where("a != b")
    current = staged(pairs.distinct(), name)
    seen = mark(current)
    while seen[0]:
        down = current.select(F.col("a").alias("u"), F.col("b").alias("v"), F.lit(False).alias("up"))
        both = down.unionByName(current.select(F.col("b").alias("u"), F.col("a").alias("v"), F.lit(True).alias("up")))
        large = step(both, small=False)
        after = staged(step(large.select(F.col("a").alias("u"), F.col("b").alias("v"), F.lit(False).alias("up")), small=True).distinct(), name)
        now = mark(after)
        current = after
        if now == seen:
            break
        seen = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
