"""Subword encoding and decoding with a weighted finite-state transducer.

Compiled once from a public vocabulary: a normaliser (characters to characters), a trie that reads piece texts and writes
piece ids, byte arcs for characters without a piece, and a filter over neighbouring pieces. A text is composed with
them lazily, all distinct segments of a slice of the table place by place together, and the path of least weight in the tropical semiring (weights add along a path, the least path wins)
gives the ids. For a merge-ranked vocabulary the filter is what makes the path the merge result: two pieces may follow each
other exactly if merging their joined text gives them back (weight 0, else infinite), so one finite path is left to
every place of the input and one state per place is enough. Decoding runs the inverse transducer.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from loadtide.llm.bpe_automaton import kept_offsets, row_bytes, slices

TOKENIZER_DIR = "/opt/tokenizers"
MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Characters of distinct segments that walk together.
TOGETHER = 1 << 16


@dataclass(frozen=True)
class Normaliser:
    """Character transducer: ``rules`` rewrite single characters, all others pass; ``prefix`` is put before a text that is not empty."""

    rules: tuple[tuple[str, str], ...] = ((" ", MARK),)
    prefix: str = MARK

    def apply(self, text: str) -> str:
        if not text:
            return ""
        if len(self.rules) == 1:
            return self.prefix + text.replace(*self.rules[0])
        return self.prefix + text.translate(str.maketrans(dict(self.rules)))

    def invert(self, text: str) -> str:
        text = text.removeprefix(self.prefix)
        for plain, written in self.rules:
            text = text.replace(written, plain)
        return text


@dataclass
class Vocabulary:
    """Pieces that text may use (text, id, score) and the ids of the 256 byte pieces."""

    pieces: list[tuple[str, int, float]]
    byte_ids: list[int]
    normaliser: Normaliser = field(default_factory=Normaliser)


@functools.lru_cache(2)
def load_vocabulary(tokenizer_dir: str = TOKENIZER_DIR, model: str = MODEL) -> Vocabulary:
    """Reads pieces and scores from a model file; nothing else of its library is used."""
    import sentencepiece

    held = sentencepiece.SentencePieceProcessor(model_file=os.path.join(tokenizer_dir, model))
    ids = range(held.get_piece_size())
    byte_ids = {held.id_to_piece(i): i for i in ids if held.is_byte(i)}
    pieces = [
        (held.id_to_piece(i), i, held.get_score(i))
        for i in ids
        if not (held.is_byte(i) or held.is_control(i) or held.is_unknown(i) or held.is_unused(i))
    ]
    return Vocabulary(pieces, [byte_ids[f"<0x{b:02X}>"] for b in range(256)])


class Transducer:
    """Normaliser, pieces, byte fallback and neighbour filter, composed with one input at a time."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.ids = {text: i for text, i, _ in vocabulary.pieces}
        self.weights = {text: -score for text, _, score in vocabulary.pieces}
        self.byte_ids = vocabulary.byte_ids
        # the merge that made each piece: its two parts and its weight; single characters were always there
        self.made: dict[str, tuple[str, str, float]] = {}
        # trie over reversed texts: the arcs into a place, read backwards from it
        self.trie: dict = {}
        for text in self.ids:
            steps = [[*text]]
            if len(text) > 1 and self.merged(text, steps) != [text]:
                continue  # merging never makes this piece
            if len(text) > 1:
                self.made[text] = (*steps[-1], self.weights[text])
            else:
                self.made[text] = ("", "", -1.0)
            node = self.trie
            for char in reversed(text):
                node = node.setdefault(char, {})
            node[""] = text

    def merged(self, text: str, steps: list | None = None) -> list[str]:
        """Merge result of a short text: the lightest neighbouring pair first, the leftmost among equals.

        The parts before the last merge are added to ``steps``.
        """
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                weight = self.weights.get(parts[k] + parts[k + 1])
                if weight is not None and (best is None or weight < best):
                    best, at = weight, k
            if best is None:
                return parts
            if steps is not None and len(parts) == 2:
                steps.append(tuple(parts))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def allowed(self, left: str, right: str) -> bool:
        """The neighbour filter: whether merging ``left + right`` gives the two back.

        The merges that made both are undone from the latest on. At every stage the symbols at the seam must not have had
        a merge of their own before the one undone last; an equal weight goes to the left pair.
        """
        made, weights = self.made, self.weights
        limit, inclusive = float("inf"), False
        while True:
            weight = weights.get(left + right)
            if weight is not None and (weight < limit or (inclusive and weight == limit)):
                return False
            one, other = made[left], made[right]
            if one[2] > other[2]:
                left, limit, inclusive = one[1], one[2], False
            elif other[2] >= 0:
                right, limit, inclusive = other[0], other[2], True
            else:
                return True

    def shortest_path(self, text: str) -> list[int]:
        """Ids of the least path over a normalised segment.

        ``best[i]`` is the last piece (None: start or byte arcs), the place before it and the weight of the path to place i.
        """
        best: list[tuple[str | None, int, int] | None] = [(None, -1, 0)]
        for end in range(1, len(text) + 1):
            node, found = self.trie, None
            place = end
            while place > 0 and (node := node.get(text[place - 1])) is not None:
                place -= 1
                piece = node.get("")
                state = best[place]
                if piece is None or state is None or (state[0] is not None and not self.allowed(state[0], piece)):
                    continue
                weight = state[2] + 1
                if found is None or weight < found[2]:
                    found = (piece, place, weight)
            if found is None and text[end - 1] not in self.ids and best[end - 1] is not None:
                found = (None, end - 1, best[end - 1][2] + len(text[end - 1].encode("utf-8", "surrogatepass")))
            best.append(found)
        if best[-1] is None:  # no path under the filter: a vocabulary that is not closed under merging
            return [i for part in self.merged(text) for i in self._arcs(part)]
        out: list[list[int]] = []
        place = len(text)
        while place:
            piece, before, _ = best[place]
            out.append(self._arcs(text[before:place]))
            place = before
        return [i for ids in reversed(out) for i in ids]

    @functools.cached_property
    def tables(self) -> Tables:
        return Tables(self.vocabulary, self)

    def encode(self, text: str) -> np.ndarray:
        return self.tables.encode_many([text])[0]

    def decode(self, ids: list[int]) -> str:
        return self.tables.decode_many(np.array(ids, np.int64), np.array([0, len(ids)]))[0]

    def _arcs(self, part: str) -> list[int]:
        known = self.ids.get(part)
        return [known] if known is not None else [self.byte_ids[b] for b in part.encode("utf-8", "surrogatepass")]


class Lookup:
    """Fixed map from numbers to numbers as two arrays: open addressing, at most a quarter full."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(64 - max(6, int(4 * len(keys)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, -1, np.int32)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            slot = at[left]
            _, first = np.unique(slot, return_index=True)
            first = first[self.keys[slot[first]] < 0]  # one key into each free slot
            self.keys[slot[first]], self.values[slot[first]] = keys[left[first]], values[left[first]]
            left = np.delete(left, first)
            at[left] = (at[left] + 1) % size

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Values of ``keys``, -1 where there is none."""
        at = self._slot(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], np.int32(-1))
        left = np.flatnonzero((held != keys) & (held >= 0))
        while len(left):
            at[left] = (at[left] + 1) % len(self.keys)
            held = self.keys[at[left]]
            hit = held == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (held >= 0)]
        return out


class Tables:
    """A transducer compiled into integer arrays: the trie, the neighbour filter and the labels of the inverse (some megabytes)."""

    def __init__(self, vocabulary: Vocabulary, fst: Transducer | None = None):
        fst = fst or Transducer(vocabulary)
        self.vocabulary = vocabulary
        self.chars = np.array(sorted({ord(c) for text in fst.ids for c in text}), np.int64)
        self.known = np.array([chr(c) in fst.ids for c in self.chars.tolist()] + [False])
        pieces = list(fst.made)
        number = {text: k for k, text in enumerate(pieces)}
        self.ids = np.array([fst.ids[text] for text in pieces], np.int32)
        ranks = {w: k for k, w in enumerate(sorted(set(fst.weights.values())))}
        # the merge that made each piece, -1 for single characters
        self.rank = np.array([ranks[fst.made[t][2]] if len(t) > 1 else -1 for t in pieces], np.int64)
        self.left = np.array([number[fst.made[t][0]] if len(t) > 1 else -1 for t in pieces], np.int64)
        self.right = np.array([number[fst.made[t][1]] if len(t) > 1 else -1 for t in pieces], np.int64)
        pairs = [
            (number[t[:k]] * len(pieces) + number[t[k:]], ranks[w])
            for t, w in fst.weights.items() for k in range(1, len(t)) if t[:k] in number and t[k:] in number
        ]
        self.pairs = Lookup(np.array([k for k, _ in pairs], np.int64), np.array([r for _, r in pairs], np.int32))
        place = {c: k for k, c in enumerate(self.chars.tolist())}
        nodes: dict[int, int] = {}
        self.piece = [-1]
        for text, k in number.items():
            node = 0
            for c in text:
                key = node * len(place) + place[ord(c)]
                if key not in nodes:
                    nodes[key] = len(self.piece)
                    self.piece.append(-1)
                node = nodes[key]
            self.piece[node] = k
        self.piece = np.array(self.piece, np.int32)
        self.trie = Lookup(np.array(list(nodes), np.int64), np.array(list(nodes.values()), np.int32))
        self.byte_ids = np.array(vocabulary.byte_ids, np.int32)
        labels = {i: text.encode() for text, i, _ in vocabulary.pieces} | {i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids)}
        parts = [labels.get(i, b"") for i in range(max(labels) + 1)]
        self.sizes = np.array([len(x) for x in parts] + [0])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.labels = np.frombuffer(b"".join(parts), np.uint8)
        # segments never share a piece: the mark occurs only at the front of pieces, and a line break has byte arcs only
        line = "" if "\n" in fst.ids else "\n"
        self.segments = f"{MARK}+[^{MARK}{line}]*|[^{MARK}{line}]+" + (f"|{line}" if line else "")

    def allowed(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """:meth:`Transducer.allowed` for many pairs of pieces."""
        ok = np.ones(len(left), bool)
        live = np.arange(len(left))
        left, right = left.astype(np.int64), right.astype(np.int64)
        limit, inclusive = np.full(len(left), np.iinfo(np.int64).max), np.zeros(len(left), bool)
        while len(live):
            merge = self.pairs(left * len(self.ids) + right)
            bad = (merge >= 0) & ((merge < limit) | (inclusive & (merge == limit)))
            ok[live[bad]] = False
            one, other = self.rank[left], self.rank[right]
            undo_left = one > other
            on = ~bad & (undo_left | (other >= 0))
            live, left, right, one, other, undo_left = (x[on] for x in (live, left, right, one, other, undo_left))
            left, right = np.where(undo_left, self.right[left], left), np.where(undo_left, right, self.left[right])
            limit, inclusive = np.where(undo_left, one, other), ~undo_left
        return ok

    def shortest_paths(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the least paths over normalised segments (none empty) in one array, and how many each has."""
        size = np.array([len(x) for x in segments])
        stops = np.cumsum(size)
        points = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        char = np.minimum(np.searchsorted(self.chars, points), len(self.chars) - 1)
        char = np.where(self.chars[char] == points, char, len(self.chars))  # the last number: not in the vocabulary
        head, last = np.repeat(stops - size, size), np.repeat(stops - 1, size)
        start, stop, piece = self._arcs(char, last)
        depth = stop - head[stop]
        order = np.lexsort((-start, depth))  # by place, the shortest piece first
        start, stop, piece, depth = start[order], stop[order], piece[order], depth[order]
        steps = np.searchsorted(depth, np.arange(int(size.max()) + 1)).tolist()
        places = np.argsort(np.arange(len(points)) - head, kind="stable")  # the places of each step
        turns = np.searchsorted((np.arange(len(points)) - head)[places], np.arange(int(size.max()) + 1)).tolist()
        # of the path to behind each character: its last piece (-1: byte arcs, -2: none), where that starts, and the path's weight
        state = np.full(len(points) + 1, -2)
        state[-1] = -1
        came, weight = np.zeros(len(points), np.int64), np.zeros(len(points) + 1, np.int64)
        for k, (low, high) in enumerate(zip(steps, steps[1:])):
            s, e, t = start[low:high], stop[low:high], piece[low:high]
            before = np.where(s == head[s], len(points), s - 1)  # the entry of the segment's start
            own = state[before]
            ok = own > -2
            check = np.flatnonzero(own >= 0)
            ok[check] = self.allowed(own[check], t[check])
            s, e, t, cost = s[ok], e[ok], t[ok], weight[before[ok]] + 1
            state[e], came[e], weight[e] = t, s, cost
            if len(e) > 1 and (state[e] != t).any():  # several paths to one place: the least, the shorter piece among equals
                best = np.lexsort((np.arange(len(e)), cost, e))
                best = best[np.append(True, np.diff(e[best]) > 0)]
                state[e[best]], came[e[best]], weight[e[best]] = t[best], s[best], cost[best]
            here = places[turns[k] : turns[k + 1]]
            here = here[(state[here] == -2) & ~self.known[char[here]]]
            before = np.where(here == head[here], len(points), here - 1)
            here, before = here[state[before] > -2], before[state[before] > -2]
            state[here], came[here], weight[here] = -1, here, weight[before] + utf8_sizes(points[here])
        lost = np.flatnonzero(state[stops - 1] == -2)  # no path under the filter: a vocabulary that is not closed under merging
        used = np.zeros(len(points), bool)
        at = np.delete(stops - 1, lost)
        while len(at):
            used[at] = True
            before = came[at]
            at = before[before > head[at]] - 1
        at = np.flatnonzero(used)
        bare = state[at] == -1
        width = np.where(bare, utf8_sizes(points[at]), 1)
        ends = np.cumsum(width)
        ids = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
        ids[(ends - width)[~bare]] = self.ids[state[at[~bare]]]
        raw = b"".join(chr(c).encode("utf-8", "surrogatepass") for c in points[at[bare]].tolist())
        spread = np.repeat((ends - width)[bare], width[bare])
        inner = np.arange(len(raw)) - np.repeat(np.cumsum(width[bare]) - width[bare], width[bare])
        ids[spread + inner] = self.byte_ids[np.frombuffer(raw, np.uint8)]
        counts = np.bincount(np.searchsorted(stops, at, "right"), width, len(segments)).astype(np.int64)
        if len(lost):
            fst = Transducer(self.vocabulary)
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for k in lost.tolist():
                parts[k] = np.array(fst.shortest_path(segments[k]), np.int32)
            ids, counts = np.concatenate(parts), np.array([len(x) for x in parts])
        return ids, counts

    def _arcs(self, char: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First character, last character and piece of all pieces inside the segments."""
        at = np.flatnonzero(char < len(self.chars))
        end, node = at, self.trie(char[at])
        found = []
        while len(at):
            on = node >= 0
            at, end, node = at[on], end[on], node[on]
            piece = self.piece[node]
            hit = piece >= 0
            found.append((at[hit], end[hit], piece[hit]))
            on = end < last[at]
            at, end, node = at[on], end[on] + 1, node[on]
            on = char[end] < len(self.chars)
            at, end, node = at[on], end[on], node[on]
            node = self.trie(node.astype(np.int64) * len(self.chars) + char[end])
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (at, at, at)

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the offsets of the texts. Each distinct segment walks once."""
        known: dict[str, int] = {}
        places: list[int] = []
        counts = [0]
        find, write = re.compile(self.segments).findall, self.vocabulary.normaliser.apply
        for text in texts:
            places += [known.setdefault(x, len(known)) for x in find(write(text))]
            counts.append(len(places))
        segments = sorted(known, key=len)
        rank = np.zeros(len(known), np.int64)
        rank[[known[x] for x in segments]] = np.arange(len(segments))
        sizes = np.cumsum([len(x) for x in segments])
        ids, widths, first = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], 0
        while first < len(segments):
            end = int(np.searchsorted(sizes, (sizes[first - 1] if first else 0) + TOGETHER, "right"))
            end = max(end, first + 1)
            part, width = self.shortest_paths(segments[first:end])
            ids.append(part)
            widths.append(width)
            first = end
        ids, widths = np.concatenate(ids), np.concatenate(widths)
        starts = np.cumsum(widths) - widths
        used = rank[np.array(places, np.int64)]
        width = widths[used]
        ends = np.concatenate([[0], np.cumsum(width)])
        return ids[np.repeat(starts[used] - ends[:-1], width) + np.arange(ends[-1])], ends[np.array(counts)]

    def decode_many(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Inverse: unknown ids write nothing, broken byte sequences write U+FFFD. The bytes of all pieces are gathered together."""
        ids = np.where((ids >= 0) & (ids < len(self.sizes) - 1), ids, len(self.sizes) - 1)
        width = self.sizes[ids]
        ends = np.concatenate([[0], np.cumsum(width)])
        raw = self.labels[np.repeat(self.starts[ids] - ends[:-1], width) + np.arange(ends[-1])].tobytes()
        cuts, invert = ends[offsets].tolist(), self.vocabulary.normaliser.invert
        return [invert(raw[a:b].decode("utf-8", "replace")) for a, b in zip(cuts, cuts[1:])]


def utf8_sizes(points: np.ndarray) -> np.ndarray:
    return 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)


_tables: list[tuple[Vocabulary, Tables]] = []


def _shared(df: DataFrame, vocabulary: Vocabulary | None):
    """The compiled tables as a broadcast variable; the driver keeps those of the last vocabulary it was given."""
    vocabulary = vocabulary or load_vocabulary()
    if not (_tables and _tables[0][0] is vocabulary):
        _tables[:] = [(vocabulary, Tables(vocabulary))]
    return df.sparkSession.sparkContext.broadcast(_tables[0][1])


def encode(docs: DataFrame, vocabulary: Vocabulary | None = None, read_back: bool = False) -> DataFrame:
    """All columns of ``docs`` and ``ids`` (array of int), ``n_pieces``; clashing columns of these names are replaced.

    With ``read_back`` also ``decoded``, what :func:`decode` makes of the ids, by the same worker.

    Null and empty texts give no pieces. Whole texts are encoded; rows are independent, so repeated rows, missing doc_ids and
    empty tables need no care. Reserved pieces (start, end, unknown) are never written.
    """
    shared = _shared(docs, vocabulary)
    made = [StructField("ids", ArrayType(IntegerType()))] + [StructField("decoded", StringType())] * read_back
    names = [f.name for f in made]
    docs = docs.select(*(c for c in docs.columns if c not in (*names, "n_pieces")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = shared.value
        for batch in slices(batches, lambda b: row_bytes(b.column("text"), 1)):
            ids, offsets = fst.encode_many([t or "" for t in batch.column("text").to_pylist()])
            columns = [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))]
            if read_back:
                columns.append(pa.array(fst.decode_many(ids, offsets), pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *made])).withColumn("n_pieces", F.size("ids").cast("long"))


def decode(tokens: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """All columns of ``tokens`` and ``decoded``, the text of ``ids``; a null list gives null, unknown ids write nothing.

    A column ``decoded`` of the input is replaced; rows are independent, so repeated rows and empty tables need no care.
    """
    shared = _shared(tokens, vocabulary)
    tokens = tokens.select(*(c for c in tokens.columns if c != "decoded"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = shared.value
        for batch in slices(batches, lambda b: row_bytes(b.column("ids"), 4)):
            column = batch.column("ids")
            texts = fst.decode_many(column.flatten().to_numpy(), kept_offsets(column))
            texts = [t if known else None for t, known in zip(texts, column.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return tokens.mapInArrow(run, StructType([*tokens.schema.fields, StructField("decoded", StringType())]))
