"""A Merkle manifest of a data set: leaf digests, subroots, one root, and an inclusion proof for every row.

The trees are evaluated by time-forward processing. Nodes are labelled in an order in which children come before parents; a node
sends its digest to its parent through a priority queue ordered by label, and a parent pops what its children sent. A reversed
sweep pops from the other end: a node hands the proof suffix above it to its children, until the leaves have whole proofs.

The labels go by the last leaf below a node, then by level, so inside a run of leaves the queue never holds more than a few digests a
level. A tree is cut into blocks of ``FANOUT ** LEVELS`` leaves, one sweep each; messages that leave a block are the rows of a table,
which Spark's sort brings to their block in label order: this is the external part of the queue. The tops of the blocks are the
leaves of the next round, so the number of rounds is the logarithm of the rows to the base of a block.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from loadtide.llm.groups import runs
from loadtide.sources.stages import staged

FANOUT = 8
#: Levels of a block: 4,096 leaves, about half a megabyte.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = ArrayType(StructType([StructField("l", StringType()), StructField("r", StringType())]))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(values: dict[str, Column]) -> Column:
    """SHA-256 over the fields in order, each with its byte count, ``-`` for a null."""
    texts = [values[name].cast("string") for name in FIELDS]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """One row per document: tree ``key``, ``doc_id``, ``digest`` and ``changed``, the digest of the tampered row.

    A third of the rows, picked by a checksum of the id, is tampered with: their text is lower-cased.
    """
    plain = {name: F.col(name) for name in FIELDS}
    picked = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    lowered = F.translate("text", UPPER, LOWER)
    tampered = picked & (lowered != F.col("text"))
    # the key sorts as the language does: null first, then bytewise
    rows = docs.select(
        F.coalesce(F.concat(F.lit("1"), F.col("lang").cast("string")), F.lit("0")).alias("key"),
        "doc_id",
        leaf_digest(plain).alias("digest"),
        F.when(tampered, leaf_digest(plain | {"text": lowered})).alias("changed"),
        F.pmod(F.monotonically_increasing_id(), F.lit(4096)).alias("spread"),  # parts equal rows among tasks
    )
    return rows.withColumn("changed", F.coalesce("changed", "digest"))


def ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos``, the place in their ``key`` from 0, and ``total``, the number of rows of the key.

    One range shuffle sorts all rows; a key may span any number of partitions. Places inside a partition come from the running row
    number, and the small table of (key, partition) counts gives what comes before.
    """
    held = staged(
        rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order).withColumn("row", F.monotonically_increasing_id()), name
    ).withColumn("part", F.shiftright("row", 33))
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = held.groupBy("key", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    parts = parts.select(
        "key", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(Window.partitionBy("key")).alias("total"),
    )
    return held.join(parts, ["key", "part"]).withColumn("pos", F.col("row") + F.col("shift")).drop("part", "row", "shift", "spread")


def widths(total: int) -> list[int]:
    """Nodes of the whole tree on the levels of a block, from the leaves to the block's top."""
    out = [total]
    while out[-1] > 1 and len(out) <= LEVELS:
        out.append(-(-out[-1] // FANOUT))
    return out


def forward(first: int, digests: list[str], total: int) -> list[dict[int, str]]:
    """Sweep over the leaves ``first``, ``first + 1``, ...: the nodes of each level by their index, the last level being the top.

    A message is (label, level and index of the receiver, digest); labels are (last leaf below, level).
    """
    width = widths(total)
    levels: list[dict[int, str]] = [{} for _ in width]
    queue: list[tuple[int, int, int, int, str]] = []

    def send(level: int, index: int, value: str) -> None:
        levels[level][index] = value
        if level + 1 < len(width):
            parent = index // FANOUT
            last = min((parent + 1) * FANOUT ** (level + 1), total) - 1
            heapq.heappush(queue, (last, level + 1, parent, index, value))

    for at, value in enumerate(digests, first):
        send(0, at, value)
        while queue and queue[0][0] <= at:
            last, level, index, _, value = heapq.heappop(queue)
            children = [value]
            while queue and queue[0][:3] == (last, level, index):
                children.append(heapq.heappop(queue)[4])
            send(level, index, digest(*children))
    return levels


def backward(levels: list[dict[int, str]], path: list[dict[str, str]]) -> Iterator[tuple[int, list[dict[str, str]]]]:
    """Reversed sweep from the top, whose proof is ``path``: (leaf, proof), a proof being the left and right siblings level by level."""
    top = len(levels) - 1
    queue: list[tuple[int, int, int, list[dict[str, str]]]] = []  # the greatest label first, so its negative; level and index of the receiver

    def send(level: int, index: int, proof: list[dict[str, str]]) -> None:
        heapq.heappush(queue, (-(index + 1) * FANOUT**level, -level, index, proof))

    (index,) = levels[top]  # a block ends in one node
    send(top, index, path)
    while queue:
        _, level, index, above = heapq.heappop(queue)
        if not level:
            yield index, above
            continue
        below = levels[-level - 1]
        children = [c for c in range(index * FANOUT, (index + 1) * FANOUT) if c in below]
        for child in children:
            own = {"l": "".join(below[c] for c in children if c < child), "r": "".join(below[c] for c in children if c > child)}
            send(-level - 1, child, [own, *above])


def _grouped(rows: DataFrame, *order: str) -> DataFrame:
    """Rows of a block next to each other, dealt by block."""
    block = F.col("block") if "block" in rows.columns else F.floor(F.col("pos") / FANOUT**LEVELS)
    grouped = rows.withColumn("group", F.concat(block.cast("string"), F.lit(":"), F.col("key")))
    return grouped.repartition("group").sortWithinPartitions("group", *order)


def tops(nodes: DataFrame) -> DataFrame:
    """The top of every block as a node of the next round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs(batches, "group"):
            first, total = block.column("pos")[0].as_py(), block.column("total")[0].as_py()
            ((index, value),) = forward(first, block.column("digest").to_pylist(), total)[-1].items()
            size = FANOUT**LEVELS
            yield pa.RecordBatch.from_pylist(
                [{"key": block.column("key")[0].as_py(), "pos": index, "total": -(-total // size), "digest": value}], schema
            )

    schema = pa.schema([("key", pa.string()), ("pos", pa.int64()), ("total", pa.int64()), ("digest", pa.string())])
    return _grouped(nodes.select("key", "pos", "total", "digest"), "pos").mapInArrow(run, "key string, pos long, total long, digest string")


def grow(nodes: DataFrame) -> list[DataFrame]:
    """The nodes of every round, until each key has one."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("total")).first()[0] or 0) > 1:
        rounds.append(staged(tops(rounds[-1]), "merkle_tops"))
    return rounds


def descend(nodes: DataFrame, above: DataFrame, whole: bool) -> DataFrame:
    """Proofs of ``nodes`` from those of the tops of their blocks (key, pos, path, subroot, root).

    With ``whole`` the proofs end here: ``proof_sha256`` and ``folded_root`` of every node, folded from its ``changed`` digest.
    Else the ``path`` of every node.
    """
    kept = [f for f in nodes.schema.fields if f.name not in ("key", "pos", "total")]
    named = {f.name for f in kept}
    suffixes = above.select(F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), "key", "path", "subroot", "root")
    mine = nodes.withColumn("block", F.floor(F.col("pos") / FANOUT**LEVELS)).unionByName(suffixes, allowMissingColumns=True)
    made = [StructField("proof_sha256", StringType()), StructField("folded_root", StringType())] if whole else [StructField("path", PATH)]
    place = [f for f in nodes.schema.fields if f.name in ("key", "pos")]
    roots = [StructField("subroot", StringType()), StructField("root", StringType())]
    out = StructType([*place, *(f for f in kept if f.name not in ("subroot", "root")), *roots, *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs(batches, "group"):
            head, block = block.slice(0, 1).to_pylist()[0], block.slice(1)
            first, total = block.column("pos")[0].as_py(), block.column("total")[0].as_py()
            proofs = dict(backward(forward(first, block.column("digest").to_pylist(), total), head["path"]))
            places = block.column("pos").to_pylist()
            columns = {f.name: block.column(f.name) for f in out.fields if f.name in block.column_names}
            columns |= {name: pa.array([head[name]] * len(places), pa.string()) for name in ("subroot", "root")}
            if whole:
                folded = []
                for at, value in zip(places, block.column("changed").to_pylist()):
                    for step in proofs[at]:
                        value = digest(step["l"], value, step["r"])
                    folded.append(value)
                columns["folded_root"] = pa.array(folded, pa.string())
                columns["proof_sha256"] = pa.array([digest(*(s[x] for s in proofs[at] for x in "lr")) for at in places], pa.string())
            else:
                kind = pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))
                columns["path"] = pa.array([proofs[at] for at in places], kind)
            yield from pa.table([columns[f.name] for f in out.fields], names=out.fieldNames()).combine_chunks().to_batches()

    wanted = sorted({"key", "pos", "total", "block", "path", "subroot", "root"} | named)
    return _grouped(mine.select(*wanted), "pos").mapInArrow(run, out)


def manifest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256 (of the untampered trees), folded_root, verified.

    ``folded_root`` is recomputed from the leaf, tampered with where :func:`leaves` says so, and the original siblings; ``verified``
    tells whether it equals the root. Null fields count as ``-``, a null language is a tree of its own and comes first, missing
    doc_ids come first in their tree and are never tampered with, ties and repeated rows are ordered by their leaves, and an empty
    table gives no rows. Columns beyond ``FIELDS`` are ignored.
    """
    own = ranked(leaves(docs), ["doc_id", "digest", "spread"], "merkle_leaves")
    rounds = grow(own)
    subroots = rounds[-1].select(F.lit("").alias("key"), F.col("key").alias("tree"), "digest")
    upper = grow(ranked(subroots, ["tree"], "merkle_subroots"))
    none = F.lit(None).cast("string")
    paths = upper[-1].select("key", "pos", F.array().cast(PATH).alias("path"), none.alias("subroot"), F.col("digest").alias("root"))
    for nodes in reversed(upper):
        paths = descend(nodes, paths, whole=False)
    paths = paths.select(F.col("tree").alias("key"), F.lit(0).cast("long").alias("pos"), "path", F.col("digest").alias("subroot"), "root")
    for nodes in reversed(rounds[1:]):
        paths = descend(nodes, staged(paths, "merkle_paths"), whole=False)
    done = descend(own, staged(paths, "merkle_paths"), whole=True)
    return done.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


ORACLE_SQL = r"""
with recursive picked as (
  select *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low,
    -- CRC-32, bit by bit
    doc_id is not null and xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::ubigint)),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), list_transform(range(8), lambda k: 0::ubigint)),
        lambda x, k: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 3 = 0 as tampers
  from documents
),
hashed as (
  select doc_id, lang,
    sha256(concat(coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-'),
      coalesce(strlen(text) || ':' || text, '-'))) as leaf,
    sha256(concat(coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-'),
      coalesce(strlen(case when tampers then low else text end) || ':' || case when tampers then low else text end, '-'))) as changed
  from picked
),
leaf_rows as (
  select *, coalesce('1' || lang, '0') as tree,
    row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos,
    row_number() over () as id
  from hashed
),
nodes as (
  select tree, 0 as level, pos, leaf as digest, count(*) over (partition by tree) as width from leaf_rows
  union all
  select tree, level + 1, pos // 8, sha256(string_agg(digest, '' order by pos)), (any_value(width) + 7) // 8
  from nodes where width > 1 group by tree, level, pos // 8
),
subroots as (
  select tree, level as height, digest, row_number() over (order by tree) - 1 as place from nodes where width = 1
),
crown as (
  select 0 as level, place as pos, digest, count(*) over () as width from subroots
  union all
  select level + 1, pos // 8, sha256(string_agg(digest, '' order by pos)), (any_value(width) + 7) // 8
  from crown where width > 1 group by level, pos // 8
),
roots as (select digest as root, level as crown_height from crown where width = 1),
-- the siblings of every node on its level, left and right
sided as (
  select a.tree, a.level, a.pos, coalesce(string_agg(b.digest, '' order by b.pos) filter (where b.pos < a.pos), '') as l,
    coalesce(string_agg(b.digest, '' order by b.pos) filter (where b.pos > a.pos), '') as r
  from nodes a join nodes b on a.tree = b.tree and a.level = b.level and a.pos // 8 = b.pos // 8 where a.width > 1 group by all
),
crown_sided as (
  select a.level, a.pos, coalesce(string_agg(b.digest, '' order by b.pos) filter (where b.pos < a.pos), '') as l,
    coalesce(string_agg(b.digest, '' order by b.pos) filter (where b.pos > a.pos), '') as r
  from crown a join crown b on a.level = b.level and a.pos // 8 = b.pos // 8 where a.width > 1 group by all
),
steps as (
  select d.id, s.level as step, s.l, s.r from leaf_rows d join sided s on s.tree = d.tree and s.pos = d.pos // (8 ** s.level)::bigint
  union all
  select d.id, t.height + s.level, s.l, s.r from leaf_rows d join subroots t using (tree)
    join crown_sided s on s.pos = t.place // (8 ** s.level)::bigint
),
proofs as (
  select id, list({l: l, r: r} order by step) as path, string_agg(l || r, '' order by step) as proof from steps group by id
),
folds as (
  select id, 0 as step, changed as value from leaf_rows
  union all
  select f.id, f.step + 1, sha256(p.path[f.step + 1].l || f.value || p.path[f.step + 1].r)
  from folds f join proofs p using (id) where f.step < len(p.path)
),
folded as (select id, arg_max(value, step) as folded_root from folds group by id)
select d.doc_id, d.leaf, t.digest as subroot, root, sha256(coalesce(p.proof, '')) as proof_sha256, f.folded_root, f.folded_root = root as verified
from leaf_rows d join subroots t using (tree) cross join roots left join proofs p using (id) join folded f using (id)
"""
