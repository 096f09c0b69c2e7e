"""Phrases of two to four words that occur more often than their parts suggest, by vertically partitioned suffix trees.

1. **Prefixes.** All words are counted per language. Only phrases of frequent words can be frequent, and only suffixes that start
   with a frequent pair matter, so words, then pairs, are counted first; what is frequent goes to a bitmap of bounded size, whose
   false hits only let more through. A prefix of one word with more suffixes than the memory budget is lengthened to two, then three.
2. **Groups.** Prefixes fall into ``LANES`` lanes by their hash; lanes are packed into groups whose counted suffixes fit the budget.
3. **Subtrees.** Every suffix, cut after four words, at the end of its piece and at the first infrequent pair, goes to the group of
   its prefix; equal suffixes travel as one with a count. A group sorts its suffixes: the runs of equal first words are the nodes
   of its depth-truncated subtree, and the count of a node is the sum of its leaf totals.
4. **Scores** are joins of the frequent nodes with their parts.

Words travel as 64-bit hashes of language and word. A second hash tells whether two words share one; the counting starts anew with
another seed then, so results are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadtide.llm.groups import runs
from loadtide.llm.words import buffers, cuts, mix
from loadtide.sources.stages import staged

DEPTH = 4
MIN_COUNT = 30
TOP = 2000
PERCENT = 80
NO_LANGUAGE = "und"
#: Suffixes that a group may hold, and records that a task combines before it passes them on.
BUDGET = 1 << 20
COMBINE = 1 << 18
LANES = 1 << 20
MAP_BITS = (16, 29)
PIECE = 1 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)
_KIND = np.zeros(256, np.uint8)  # 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256)
_LOWER[65:91] += 32


@dataclass
class Words:
    """The words of a run of texts: hash with the language, second hash, piece, text, place of the first and behind the last byte."""

    hashes: np.ndarray
    checks: np.ndarray
    pieces: np.ndarray
    texts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def _hash(values: np.ndarray, places: np.ndarray, starts: np.ndarray, seed: int) -> np.ndarray:
    step = np.full(int(places.max()) + 1, 2 * seed + 1, np.uint64) * _STEP
    step[0] = 1
    codes = mix(np.arange(256, dtype=np.uint64) + np.uint64(1) + np.uint64(seed) * np.uint64(256))[_LOWER]
    codes[_KIND > 0] = 0
    return mix(np.add.reduceat(codes[values] * np.cumprod(step)[places], starts))


def find_words(data: np.ndarray, bounds: np.ndarray, languages: np.ndarray, seed: int, checked: bool = False) -> Words:
    """``languages`` holds one hash per text; words never cross ``bounds``."""
    kind = _KIND[data]
    solid = kind == 0
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    first[edges] = solid[edges]
    starts = np.flatnonzero(first)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Words(none.astype(np.uint64), none.astype(np.uint64), none, none, none, none)
    behind = np.append(~solid, True)
    behind[edges] = True
    stops = np.flatnonzero(behind)
    ends = stops[np.searchsorted(stops, starts, "right")]
    texts = np.searchsorted(bounds, starts, "right") - 1
    # places inside the own word; bytes between words count nothing
    at = np.zeros(len(data), np.int64)
    at[starts] = starts
    places = np.where(solid, np.arange(len(data)) - np.maximum.accumulate(at), 0)
    hashes = mix(_hash(data, places, starts, seed) ^ languages[texts])
    hashes[hashes == 0] = 1
    checks = mix(_hash(data, places, starts, seed + 1) ^ (languages[texts] * _STEP)) if checked else hashes
    return Words(hashes, checks, np.cumsum(kind == 2)[starts] + texts, texts, starts, ends)


def chunks(batches: Iterator[pa.RecordBatch], seed: int, checked: bool = False) -> Iterator[tuple[Words, np.ndarray, list[str], np.ndarray]]:
    """Words, bytes, and the languages with their number per text, of runs of texts; long texts are cut between pieces."""
    for batch in batches:
        names = batch.column("lang").dictionary_encode()
        languages = names.dictionary.to_pylist()
        keys = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in languages], np.uint64)
        numbers = names.indices.to_numpy()
        data, bounds = buffers(batch.column("text"))
        for low, high in cuts(bounds, PIECE):
            view, inner, number = data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low], numbers[low:high]
            if high == low + 1 and len(view) > 2 * PIECE:
                gaps = np.flatnonzero(_KIND[view] == 2) + 1
                near = np.searchsorted(gaps, np.arange(PIECE, len(view), PIECE))
                for a, b in pairwise([0, *np.unique(gaps[near[near < len(gaps)]]).tolist(), len(view)]):
                    if b > a:
                        yield find_words(view[a:b], np.array([0, b - a]), keys[number], seed, checked), view[a:b], languages, number
            elif len(view):
                yield find_words(view, inner, keys[number], seed, checked), view, languages, number


def combined(key: np.ndarray, columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows as one, their counts added. Rows are brought together by ``key``; unequal rows of one key stay apart."""
    order = np.argsort(key)
    columns = [c[order] for c in columns]
    fresh = np.ones(len(order), bool)
    fresh[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    first = np.flatnonzero(fresh)
    return [c[first] for c in columns], np.add.reduceat(counts[order], first) if len(first) else counts


def combining(parts: Iterator[tuple[np.ndarray, list[np.ndarray], np.ndarray]], whole: Callable) -> Iterator[pa.RecordBatch]:
    """Combines the (key, columns, counts) of a task as long as ``COMBINE`` records hold them; ``whole`` makes a batch of the rest."""
    held: tuple[list[np.ndarray], np.ndarray] | None = None
    keys = np.zeros(0, np.uint64)
    for key, columns, counts in parts:
        if not len(key):
            continue
        if held is not None:
            key = np.concatenate([keys, key])
            columns = [np.concatenate(c) for c in zip(held[0], columns)]
            counts = np.concatenate([held[1], counts])
        (keys, *columns), counts = combined(key, [key, *columns], counts)
        held = columns, counts
        if len(keys) > COMBINE:
            yield whole(*held)
            held = None
    if held is not None:
        yield whole(*held)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), "text")


def count_words(docs: DataFrame, seed: int) -> DataFrame:
    """lang, h, n of the words found ``MIN_COUNT`` times, and h = 0 with the number of all words of a language; ``clash`` if two share h."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}

        def parts() -> Iterator:
            for words, _, languages, number in chunks(batches, seed, checked=True):
                own = np.array([names.setdefault(x, len(names)) for x in languages])[number[words.texts]]
                yield words.hashes, [words.hashes, words.checks, own], np.ones(len(own), np.int64)
                total = np.bincount(own, minlength=1)
                seen = np.flatnonzero(total)
                none = np.zeros(len(seen), np.uint64)
                yield none, [none, none, seen], total[seen]

        def whole(columns: list[np.ndarray], counts: np.ndarray) -> pa.RecordBatch:
            h, check, own = columns
            lang = pa.DictionaryArray.from_arrays(pa.array(own.astype(np.int32)), pa.array(list(names))).cast(pa.string())
            return pa.RecordBatch.from_arrays([lang, pa.array(h.view(np.int64)), pa.array(check.view(np.int64)), pa.array(counts)], ["lang", "h", "c", "n"])

        yield from combining(parts(), whole)

    found = _texts(docs).mapInArrow(run, "lang string, h long, c long, n long").groupBy("lang", "h")
    return found.agg(F.sum("n").alias("n"), (F.min("c") != F.max("c")).alias("clash")).where((F.col("n") >= MIN_COUNT) | (F.col("h") == 0))


class Bitmap:
    """Which 64-bit hashes may be in a set, by their upper bits."""

    def __init__(self, hashes: DataFrame, column: str = "h"):
        """Built by an aggregation; what reaches the driver is at most the map, 64 MB, whatever the set."""
        size = hashes.count()
        self.bits = int(np.clip(int(size * 16).bit_length(), *MAP_BITS))
        at = F.shiftrightunsigned(column, 64 - self.bits)
        one = F.expr("1L")
        rows = hashes.select(F.shiftright(at, 6).alias("slot"), F.call_function("shiftleft", one, at.bitwiseAND(63).cast("int")).alias("bit"))
        table = rows.groupBy("slot").agg(F.bit_or("bit").alias("bit")).toArrow()
        self.slots = np.zeros(1 << (self.bits - 6), np.uint64)
        self.slots[table["slot"].to_numpy()] = table["bit"].to_numpy().astype(np.int64).view(np.uint64)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.bits)
        return (self.slots[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * _STEP + right)


def count_pairs(docs: DataFrame, seed: int, frequent: Bitmap, hot: Bitmap) -> DataFrame:
    """h (of the pair), first (whether its first word is a hot prefix), n: pairs of frequent words found ``MIN_COUNT`` times."""
    shared = docs.sparkSession.sparkContext.broadcast((frequent, hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, many = shared.value

        def parts() -> Iterator:
            for words, *_ in chunks(batches, seed):
                h = words.hashes
                ok = known(h)
                at = np.flatnonzero((words.pieces[1:] == words.pieces[:-1]) & ok[1:] & ok[:-1])
                pair = joined(h[at], h[at + 1])
                yield pair, [pair, many(h[at])], np.ones(len(at), np.int64)

        def whole(columns: list[np.ndarray], counts: np.ndarray) -> pa.RecordBatch:
            pair, first = columns
            return pa.RecordBatch.from_arrays([pa.array(pair.view(np.int64)), pa.array(first), pa.array(counts)], ["h", "first", "n"])

        yield from combining(parts(), whole)

    found = _texts(docs).mapInArrow(run, "h long, first boolean, n long").groupBy("h", "first").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= MIN_COUNT)


def lane(prefix: np.ndarray) -> np.ndarray:
    return (prefix >> np.uint64(64 - (LANES.bit_length() - 1))).astype(np.int64)


def pack(words: DataFrame, pairs: DataFrame, budget: int) -> np.ndarray:
    """The group of every lane: consecutive lanes share one while their counted suffixes fit the budget."""
    counted = words.select("h", "n").unionByName(pairs.where("first").select("h", "n")).where(F.col("n") <= budget)
    at = F.shiftrightunsigned("h", 64 - (LANES.bit_length() - 1)).alias("lane")
    table = counted.groupBy(at).agg(F.sum("n").alias("n")).toArrow()  # at most ``LANES`` rows
    weights = np.zeros(LANES, np.int64)
    weights[table["lane"].to_numpy()] = table["n"].to_numpy()
    return ((np.cumsum(weights) - weights) // budget).astype(np.int32)


@dataclass
class Plan:
    seed: int
    pairs: Bitmap
    hot_words: Bitmap
    hot_pairs: Bitmap
    groups: np.ndarray


def suffixes(docs: DataFrame, plan: Plan) -> DataFrame:
    """Truncated suffixes of two or more words with their group and count."""
    shared = docs.sparkSession.sparkContext.broadcast(plan)
    names = ["grp", *(f"w{k + 1}" for k in range(DEPTH)), "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value

        def parts() -> Iterator:
            for words, *_ in chunks(batches, plan.seed):
                h = np.concatenate([words.hashes, np.zeros(DEPTH, np.uint64)])
                piece = np.concatenate([words.pieces, np.full(DEPTH, -1)])
                pair = joined(h[:-1], h[1:])
                follows = np.append((piece[1:] == piece[:-1]) & plan.pairs(pair), False)
                at = np.flatnonzero(follows[: len(words.hashes)])
                on = np.ones(len(at), bool)
                columns = [h[at]]
                for k in range(1, DEPTH):
                    on = on & follows[at + k - 1]
                    columns.append(np.where(on, h[at + k], np.uint64(0)))
                prefix, first = columns[0], pair[at]
                hot = plan.hot_words(prefix)
                prefix = np.where(hot, first, prefix)
                prefix = np.where(hot & plan.hot_pairs(first), joined(first, columns[2]), prefix)
                key = columns[0]
                for c in columns[1:]:
                    key = joined(key, c)
                yield key, [plan.groups[lane(prefix)], *columns], np.ones(len(at), np.int64)

        def whole(columns: list[np.ndarray], counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(columns[0]), *(pa.array(c.view(np.int64)) for c in columns[1:]), pa.array(counts)], names)

        yield from combining(parts(), whole)

    return _texts(docs).mapInArrow(run, "grp int, w1 long, w2 long, w3 long, w4 long, n long")


def subtree(columns: list[np.ndarray], counts: np.ndarray) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Nodes of the truncated tree over the suffixes given, from the second level on: words (0: none) and summed leaf totals."""
    order = np.lexsort(columns[::-1])
    columns, counts = [c[order] for c in columns], counts[order]
    fresh = np.zeros(len(order), bool)
    fresh[0] = True
    for depth, column in enumerate(columns):
        fresh[1:] |= column[1:] != column[:-1]
        if not depth:
            continue
        first = np.flatnonzero(fresh)
        total = np.add.reduceat(counts, first)
        node = column[first] != 0
        first = first[node]
        yield [c[first] if k <= depth else np.zeros(len(first), np.int64) for k, c in enumerate(columns)], total[node]


def grow(found: DataFrame, hot_pairs: Bitmap) -> DataFrame:
    """Frequent phrases: w1 to w4 (0 behind the last word) and a, from the subtrees of all groups.

    A pair whose suffixes are spread over several groups has its totals added up.
    """
    shared = found.sparkSession.sparkContext.broadcast(hot_pairs)
    names = [f"w{k + 1}" for k in range(DEPTH)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "grp"):
            columns = [group.column(n).to_numpy() for n in names]
            for depth, (node, total) in enumerate(subtree(columns, group.column("n").to_numpy())):
                keep = total >= MIN_COUNT
                if depth == 0:
                    keep |= shared.value(joined(node[0].view(np.uint64), node[1].view(np.uint64)))
                yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (*node, total)], [*names, "a"])

    dealt = found.repartition("grp").sortWithinPartitions("grp")
    nodes = dealt.mapInArrow(run, "w1 long, w2 long, w3 long, w4 long, a long")
    return nodes.groupBy(*names).agg(F.sum("a").alias("a")).where(F.col("a") >= MIN_COUNT)


def look_up(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` joined with ``table`` on ``keys``, which are unique there.

    Keys with more than a 500th of the rows, 500 at most, are joined by broadcast, so no task gets all rows of a hot key.
    """
    total = rows.count()
    hot = rows.groupBy(*keys).count().where(F.col("count") * 500 > total).select(*keys)
    known = F.broadcast(table.join(F.broadcast(hot), keys, "leftsemi"))
    spread = rows.join(known, keys)
    return spread.unionByName(rows.join(known, keys, "leftanti").join(table, keys))


def phrase_scores(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """``phrases`` that no longer one makes superfluous, with l, r and score of the lowest cut (the smallest k among equals)."""
    names = [f"w{k + 1}" for k in range(DEPTH)]
    zero = F.lit(0).cast("long")
    size = sum((F.col(n) != 0).cast("int") for n in names)
    phrases = phrases.withColumn("m", size)

    def part(start: int, stop: int) -> list:
        return [F.col(names[k]) if k < stop else zero for k in range(start, stop)] + [zero] * (DEPTH - 1 - (stop - start))

    def struct(columns: list, *more) -> F.Column:
        return F.struct(*(c.alias(f"p{k + 1}") for k, c in enumerate(columns)), *more)

    spans = [(i, j) for i in range(DEPTH) for j in range(i + 2, DEPTH + 1) if j - i < DEPTH]
    inner = F.array(*(F.when((F.col("m") >= j) & (F.col("m") > j - i), struct(part(i, j))) for i, j in spans))
    longer = phrases.where("m > 2").select(F.explode(F.array_compact(inner)).alias("p"), "a").select("p.*", F.col("a").alias("longer"))
    longer = longer.groupBy("p1", "p2", "p3").agg(F.max("longer").alias("longer"))
    longer = longer.select(*(F.col(f"p{k + 1}").alias(names[k]) for k in range(DEPTH - 1)), zero.alias(names[-1]), "longer")
    kept = phrases.join(longer, names, "left").where(F.coalesce(100 * F.col("longer") < PERCENT * F.col("a"), F.lit(True))).drop("longer")
    kept = staged(kept, "phrases_kept")

    cuts_of = []
    for m in range(2, DEPTH + 1):
        for k in range(1, m):
            right = [F.col(names[i]) for i in range(k, m)] + [zero] * (DEPTH - 1 - (m - k))
            cuts_of.append(
                F.when(F.col("m") == m, F.struct(F.lit(k).alias("k"), struct(part(0, k)).alias("left"), struct(right).alias("right")))
            )
    cut = kept.select(*names, "a", F.explode(F.array_compact(F.array(*cuts_of))).alias("cut"))
    left, right = [f"l{k + 1}" for k in range(DEPTH - 1)], [f"r{k + 1}" for k in range(DEPTH - 1)]
    cut = cut.select(
        *names, "a", "cut.k", *(F.col(f"cut.left.p{k + 1}").alias(c) for k, c in enumerate(left)),
        *(F.col(f"cut.right.p{k + 1}").alias(c) for k, c in enumerate(right)),
    )
    counts = words.where("h != 0").select(F.col("h").alias("w1"), zero.alias("w2"), zero.alias("w3"), F.col("n").alias("f"))
    counts = staged(counts.unionByName(phrases.where("m < 4").select("w1", "w2", "w3", F.col("a").alias("f"))), "phrase_counts")

    def side(columns: list[str], name: str) -> DataFrame:
        return counts.select(*(F.col(names[k]).alias(c) for k, c in enumerate(columns)), F.col("f").alias(name))

    cut = staged(look_up(cut, side(left, "l"), left).drop(*left), "phrase_cuts")
    cut = look_up(cut, side(right, "r"), right).drop(*right)
    score = "(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"
    best = cut.groupBy(*names, "a").agg(F.min(F.struct(F.expr(score).alias("score"), "k", "l", "r")).alias("best"))
    return staged(best.select(*names, "a", "best.score", "best.l", "best.r"), "phrase_scores")


def spell(docs: DataFrame, seed: int, hashes: DataFrame) -> DataFrame:
    """h, word of the words in ``hashes``, by one more pass over the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(Bitmap(hashes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[int] = set()
        for words, data, *_ in chunks(batches, seed):
            at = np.flatnonzero(shared.value(words.hashes))
            h, first = np.unique(words.hashes[at], return_index=True)
            new = [(x, i) for x, i in zip(h.tolist(), at[first].tolist()) if x not in told]
            if len(told) > COMBINE:
                told.clear()
            told.update(x for x, _ in new)
            low = [_LOWER[data[words.starts[i] : words.ends[i]]].astype(np.uint8).tobytes().decode() for _, i in new]
            yield pa.RecordBatch.from_arrays([pa.array(np.array([x for x, _ in new], np.uint64).view(np.int64)), pa.array(low, pa.string())], ["h", "word"])

    return _texts(docs).mapInArrow(run, "h long, word string").join(hashes, "h", "leftsemi").groupBy("h").agg(F.min("word").alias("word"))


def phrases(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """The first ``TOP`` phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Null texts have no words, a null language is ``und``; ties are settled by a and phrase, repeated rows count each time, ids are not
    read, other columns are ignored, an empty table gives no rows.
    """
    names = [f"w{k + 1}" for k in range(DEPTH)]
    for seed in range(0, 64, 2):
        words = staged(count_words(docs, seed), "phrase_words")
        if words.where("clash and h != 0").isEmpty():
            break
    frequent = words.where("h != 0")
    hot_words = Bitmap(frequent.where(F.col("n") > budget))
    pairs = staged(count_pairs(docs, seed, Bitmap(frequent), hot_words), "phrase_pairs")
    hot_pairs = Bitmap(pairs.where(F.col("n") > budget))
    plan = Plan(seed, Bitmap(pairs), hot_words, hot_pairs, pack(frequent, pairs, budget))
    found = staged(grow(suffixes(docs, plan), hot_pairs), "phrase_nodes")
    scored = phrase_scores(found, words)
    scored = look_up(scored, frequent.select(F.col("h").alias("w1"), "lang"), ["w1"])
    order = [F.desc("score"), F.desc("a")]
    # all ties of the last place stay until the words are spelled
    best = staged(scored.withColumn("at", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("at") <= TOP), "phrase_best")
    used = best.select(F.explode(F.array(*names)).alias("h")).where("h != 0").distinct()
    spelled = best.withColumn("id", F.struct(*names)).select("*", F.posexplode(F.array(*names)).alias("place", "h")).where("h != 0")
    spelled = spelled.join(spell(docs, seed, staged(used, "phrase_used")), "h").groupBy("lang", "id", "a", "l", "r", "score")
    spelled = spelled.agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("words"))
    spelled = spelled.withColumn("phrase", F.array_join("words.word", " "))
    spelled = spelled.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long"))
    totals = words.where("h = 0").select("lang", "n")
    return spelled.where(F.col("rank") <= TOP).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
),
cut as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces),
grams as (
  select lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: ws[i:i + m - 1])) as ph
  from cut, (select unnest([1, 2, 3, 4]) as m) where len(ws) >= m
),
f as (select lang, m, ph, count(*) as a from grams group by all),
totals as (select lang, sum(a)::bigint as n from f where m = 1 group by lang),
candidates as (select * from f where m >= 2 and a >= 30),
cuts as (
  select lang, m, ph, a, k, ph[1:k] as lp, ph[k + 1:m] as rp from candidates, (select unnest([1, 2, 3]) as k) where k < m
),
scored as (
  select c.lang, c.m, c.ph, c.a, k, x.a as l, y.a as r, ((2000000::hugeint * c.a) // (x.a::hugeint + y.a::hugeint))::bigint as score
  from cuts c join f x on x.lang = c.lang and x.ph = c.lp join f y on y.lang = c.lang and y.ph = c.rp
),
lowest as (
  select * from scored qualify row_number() over (partition by lang, ph order by score, k) = 1
),
inside as (
  select lang, ph[i:i + s - 1] as ph, max(a) as longer
  from candidates, (select unnest([1, 2, 3]) as i), (select unnest([2, 3]) as s) where s < m and i + s - 1 <= m group by all
)
select lang, rank, phrase, a, l, r, n, score from (
  select w.lang, row_number() over (partition by w.lang order by score desc, w.a desc, array_to_string(w.ph, ' ')) as rank,
    array_to_string(w.ph, ' ') as phrase, w.a, l, r, n, score
  from lowest w join totals using (lang) left join inside i on i.lang = w.lang and i.ph = w.ph
  where longer is null or 100 * longer < 80 * w.a
) where rank <= 2000
"""
