"""Language-model scores from word pairs kept in Elias-Fano tries, one trie per shard of contexts.

Model: p(w | c) = (n(c, w) - D) / C(c) for pairs seen in training, else D * N(c) / C(c) * p(w), or p(w) after an unseen
context; C(c) counts the context, N(c) its distinct successors, p(w) is the additively smoothed unigram. Logarithms add
up over the tokens of a text, and so do the parts that different shards know. So nothing is gathered in one place: every
batch of documents sends its pairs, packed and sorted by context, to the shards once; a shard counts them, builds its
trie, answers its own pairs from it and returns one sum per document. Only pairs of held-out texts that training lacks
travel again, to the unigram counts.

A trie has two levels. Contexts and successors are monotone sequences in Elias-Fano form (low bits packed, high bits in unary), as are the pointers from a context to
its successors; probabilities and back-off weights are 16-bit codes. All levels are views of one memory-mapped buffer.
A context with more than a quarter of a shard's pairs (so four a shard at most) is cut into slices by its successor, as many as it has such
quarters. Each slice counts its distinct successors; their sum gives the context's back-off, which is added where the sums of a document
meet. A pair that alone has more than a quarter is counted before and scored where it is read. Such a pair has more than half of that share in
what some batch reports, so only the few pairs that batches report are counted, not all pairs of frequent contexts.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtide.llm import groups
from loadtide.llm.words import mix, pieces
from loadtide.sources.stages import staged

DISCOUNT = 0.75
ADDED = 0.1
#: Text bytes per shard: a shard's pairs take about ten bytes a word.
SHARD_BYTES = 12 << 20
BATCH_BYTES = 3 << 20
#: Parts of a shard's pairs that one context, or one slice of it, may have.
SLICE_PARTS = 4
WORD_BITS = 40
STEPS = 2048  # codes per factor of ten

START = np.uint64(0x1D8E4E27C47D124F)
END = np.uint64(0xEB44ACCAB455D165)
_WORD_SHIFT = np.uint64(64 - WORD_BITS)

BLOCKS = "shard int, batch long, kind int, a binary, b binary, c binary, d binary"
PARTS = "batch long, kind int, a binary, b binary, c binary, d binary"
SCORES = "batch long, at int, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"
UNSEEN = "batch long, at int, word long"
_DOCS, _PAIRS, _SUMS, _UNSEEN, _KINDS = 0, 1, 2, 3, 4


# ---------------------------------------------------------------- Elias-Fano


class Monotone:
    """A sorted sequence of numbers below 2^63 in Elias-Fano form."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        ones = np.bitwise_count(high).astype(np.int64)
        self.ones = np.concatenate([[0], np.cumsum(ones)])
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones

    @staticmethod
    def build(values: np.ndarray) -> Monotone:
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        size = int(places[-1] + 2 if n else 1) + 64
        bits = np.zeros(-(-size // 64) * 64, np.uint8)
        bits[places] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        if low_bits:
            raw = values & np.uint64((1 << low_bits) - 1)
            at = np.arange(n, dtype=np.uint64) * np.uint64(low_bits)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            low = np.zeros(-(-n * low_bits // 64) + 2, np.uint64)
            np.bitwise_or.at(low, word, raw << shift)
            spill = shift + np.uint64(low_bits) > np.uint64(64)
            np.bitwise_or.at(low, word[spill] + 1, raw[spill] >> (np.uint64(64) - shift[spill]))
        else:
            low = np.zeros(2, np.uint64)
        return Monotone(n, low_bits, low, high)

    def lows(self, at: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(at), np.uint64)
        bit = at.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
        out = self.low[word] >> shift
        spill = shift > 0
        out[spill] |= self.low[word[spill] + 1] << (np.uint64(64) - shift[spill])
        return out & np.uint64((1 << self.low_bits) - 1)

    @staticmethod
    def _within(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Place of the one of the given rank in each 64-bit word."""
        out, rank, rest = np.zeros(len(words), np.int64), rank.copy(), words.copy()
        for width in (32, 16, 8, 4, 2, 1):
            ones = np.bitwise_count(rest & np.uint64((1 << width) - 1)).astype(np.int64)
            above = rank >= ones
            out[above] += width
            rank[above] -= ones[above]
            rest[above] >>= np.uint64(width)
        return out

    def get(self, at: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, at, "right") - 1
        place = word * 64 + self._within(self.high[word], at - self.ones[word])
        return ((place - at).astype(np.uint64) << np.uint64(self.low_bits)) | self.lows(at)

    def successor(self, values: np.ndarray) -> np.ndarray:
        """Index of the first element that is not smaller than each value (``n`` if there is none)."""
        bucket = (values >> np.uint64(self.low_bits)).astype(np.int64)
        target = values & np.uint64((1 << self.low_bits) - 1) if self.low_bits else np.zeros(len(values), np.uint64)
        total = int(self.zeros[-1])

        def first_of(b: np.ndarray) -> np.ndarray:  # elements whose high part is below b
            out = np.full(len(b), self.n, np.int64)
            some = np.flatnonzero((b > 0) & (b <= total))
            rank = b[some] - 1
            word = np.searchsorted(self.zeros, rank, "right") - 1
            place = word * 64 + self._within(~self.high[word], rank - self.zeros[word])
            out[some] = place - rank
            out[b <= 0] = 0
            return np.minimum(out, self.n)

        low, high = first_of(bucket), first_of(bucket + 1)
        while True:  # halve the runs of equal high parts
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) // 2
            less = self.lows(middle) < target[open_]
            low[open_] = np.where(less, middle + 1, low[open_])
            high[open_] = np.where(less, high[open_], middle)

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits, len(self.low), len(self.high)], np.uint64), self.low, self.high]

    @staticmethod
    def read(words: np.ndarray) -> tuple[Monotone, np.ndarray]:
        n, low_bits, low, high = (int(x) for x in words[:4])
        return Monotone(n, low_bits, words[4 : 4 + low], words[4 + low : 4 + low + high]), words[4 + low + high :]


class Trie:
    """Contexts, pointers, successors and codes over one buffer of 64-bit words."""

    def __init__(self, buffer):
        words = np.frombuffer(buffer, np.uint64)
        self.contexts, words = Monotone.read(words)
        self.pointers, words = Monotone.read(words)
        self.successors, words = Monotone.read(words)
        n, m = self.contexts.n, self.successors.n
        codes = words.view(np.uint16)
        self.backoff, self.codes = codes[:n], codes[n : n + m]

    @staticmethod
    def pack(contexts: np.ndarray, sizes: np.ndarray, successors: np.ndarray, backoff: np.ndarray, codes: np.ndarray) -> bytes:
        """Sorted contexts (64 bits, the last bit is dropped), numbers of successors, successors sorted in each context, logarithms."""
        owner = np.repeat(np.arange(len(contexts), dtype=np.uint64), sizes)
        levels = [contexts >> np.uint64(1), np.concatenate([[0], np.cumsum(sizes)]).astype(np.uint64), (owner << np.uint64(WORD_BITS)) | successors]
        out = [part for level in levels for part in Monotone.build(level).parts()]
        small = np.concatenate([encode_log(backoff), encode_log(codes)])
        small = np.concatenate([small, np.zeros(-len(small) % 4, np.uint16)])
        return b"".join(x.tobytes() for x in (*out, small.view(np.uint64)))

    @staticmethod
    def mapped(data: bytes) -> Trie:
        held = mmap.mmap(-1, max(len(data), 8))
        held[: len(data)] = data
        return Trie(held)

    def nodes(self, contexts: np.ndarray) -> np.ndarray:
        """Number of each context, or -1."""
        wanted = contexts >> np.uint64(1)
        at = self.contexts.successor(wanted)
        found = at < self.contexts.n
        found[found] = self.contexts.get(at[found]) == wanted[found]
        return np.where(found, at, -1)

    def pairs(self, nodes: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """Number of each pair, searched from its context's pointer on, or -1."""
        known = np.flatnonzero(nodes >= 0)
        out = np.full(len(nodes), -1, np.int64)
        if not len(known):
            return out
        node = nodes[known]
        wanted = (node.astype(np.uint64) << np.uint64(WORD_BITS)) | successors[known]
        at = self.successors.successor(wanted)
        inside = (at >= self.pointers.get(node).astype(np.int64)) & (at < self.pointers.get(node + 1).astype(np.int64))
        hit = np.flatnonzero(inside)
        hit = hit[self.successors.get(at[hit]) == wanted[hit]]
        out[known[hit]] = at[hit]
        return out


def encode_log(values: np.ndarray) -> np.ndarray:
    """Logarithms to base ten, not above zero, as 16-bit codes."""
    return np.minimum(np.round(-values * STEPS), 65535).astype(np.uint16)


def decode_log(codes: np.ndarray) -> np.ndarray:
    return -codes.astype(np.float64) / STEPS


# ---------------------------------------------------------------- jobs


def _zip(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def _unzip(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind)


def _hot_of(hashes: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Number of each hash in the sorted hot ones, or -1."""
    if not len(hot):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(hot, hashes), len(hot) - 1)
    return np.where(hot[at] == hashes, at, -1)


def _place(context: np.ndarray, word: np.ndarray, hot: np.ndarray, slices: np.ndarray) -> np.ndarray:
    """Where a pair goes: its context, or a slice of it for a hot one."""
    out = context.copy()
    at = _hot_of(context, hot)
    cut = np.flatnonzero(at >= 0)
    out[cut] = mix(context[cut] + word[cut] % slices[at[cut]].astype(np.uint64) + np.uint64(1))
    return out


def _pairs(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, word and document of every token; each text starts after START and ends with END."""
    sizes = np.diff(offsets)
    n = len(hashes) + len(sizes)
    firsts = offsets[:-1] + np.arange(len(sizes))
    lasts = offsets[1:] + np.arange(len(sizes))
    context, word = np.empty(n, np.uint64), np.empty(n, np.uint64)
    inner = np.ones(n, bool)
    inner[firsts] = False
    context[inner], context[firsts] = hashes, START
    inner[firsts] = True
    inner[lasts] = False
    word[inner], word[lasts] = hashes, END
    return context, word, np.repeat(np.arange(len(sizes)), sizes + 1)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = batch.column("held_out").to_numpy(zero_copy_only=False)
        for piece in pieces(batch.column("text"), BATCH_BYTES):
            learn = np.repeat(~held[piece.first : piece.last], np.diff(piece.words))
            words, own = np.unique(piece.hashes, return_inverse=True)
            if len(words):
                counts = np.bincount(own, learn).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts), pa.array(np.bincount(own))], ["word", "n", "m"])


def _hot_pairs(hot: np.ndarray, share: int = 0, wanted: np.ndarray | None = None):
    """Counts, in training and in all texts, of pairs of two hot words, numbered context * hot words + word.

    With ``share`` those that have more than one in ``share`` of a batch's tokens, else those in ``wanted`` (sorted).
    Words have ``WORD_BITS`` bits as in the tries.
    """
    codes = hot >> _WORD_SHIFT
    order = np.argsort(codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("held_out").to_numpy(zero_copy_only=False)
            for piece in pieces(batch.column("text"), BATCH_BYTES):
                context, word, doc = _pairs(piece.hashes, piece.words)
                first = _hot_of(context, hot)
                keep = np.flatnonzero(first >= 0)
                second = _hot_of(word[keep] >> _WORD_SHIFT, codes[order])
                keep, second = keep[second >= 0], order[second[second >= 0]]
                pair, own = np.unique(first[keep] * len(hot) + second, return_inverse=True)
                learn = ~held[piece.first : piece.last][doc[keep]]
                n, m = np.bincount(own, learn, len(pair)).astype(np.int64), np.bincount(own, minlength=len(pair))
                send = m * share > len(context) if share else np.isin(pair, wanted)
                if send.any():
                    yield pa.RecordBatch.from_arrays([pa.array(x[send]) for x in (pair, n, m)], ["pair", "n", "m"])

    return run


def _blocks(shards: int, hot: np.ndarray, slices: np.ndarray, pair_keys: tuple[np.ndarray, np.ndarray], pair_values: np.ndarray, seen: np.ndarray, hot_counts: np.ndarray):
    """Pairs for the shards; those of ``pair_keys`` (hot context, word) are scored here with ``pair_values``, and backed off later if not ``seen``."""
    sorted_pairs = mix(pair_keys[0].astype(np.uint64) + mix(pair_keys[1])) if len(pair_values) else np.zeros(0, np.uint64)
    pair_order = np.argsort(sorted_pairs)
    sorted_pairs = sorted_pairs[pair_order]

    def scored(context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Number of the hot pair that each pair is, or -1."""
        out = np.full(len(context), -1)
        if len(sorted_pairs):
            at = _hot_of(context, hot)
            some = np.flatnonzero(at >= 0)
            code = word[some] >> _WORD_SHIFT
            spot = _hot_of(mix(at[some].astype(np.uint64) + mix(code)), sorted_pairs)
            spot = np.where(spot >= 0, pair_order[spot], -1)
            right = (spot >= 0) & (pair_keys[0][spot] == at[some]) & (pair_keys[1][spot] == code)
            out[some] = np.where(right, spot, -1)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        serial = 0
        for batch in batches:
            ids, held = batch.column("doc_id"), batch.column("held_out")
            for piece in pieces(batch.column("text"), BATCH_BYTES):
                for first in range(piece.first, piece.last, 60_000):  # documents have 16-bit numbers
                    last = min(piece.last, first + 60_000)
                    number, serial = part | serial, serial + 1
                    offsets = piece.words[first - piece.first : last - piece.first + 1]
                    context, word, doc = _pairs(piece.hashes[offsets[0] : offsets[-1]], offsets - offsets[0])
                    rows = []
                    owner = int(mix(np.array([number], np.uint64))[0] % np.uint64(shards))
                    ready = scored(context, word)
                    done = np.flatnonzero(ready >= 0)
                    if len(done):
                        at = pair_keys[0][ready[done]]
                        is_word = hot[at] != START
                        values = (pair_values[ready[done]], np.where(is_word, np.log10(hot_counts[at] + ADDED), 0.0), is_word & (hot_counts[at] > 0))
                        sums = [np.bincount(doc[done], x) for x in values]
                        later = (seen[ready[done]] == 0) & (hot_counts[at] > 0)
                        waiting = _zip(np.concatenate([at[later], doc[done][later]]).astype(np.uint32)) if later.any() else b""
                        rows.append((owner, _SUMS, _zip(sums[0]), _zip(sums[1]), _zip(sums[2].astype(np.uint32)), waiting))
                        context, word, doc = (x[ready < 0] for x in (context, word, doc))
                    place = _place(context, word, hot, slices)
                    order = np.argsort(place, kind="stable")
                    place, word, doc = place[order], word[order] >> _WORD_SHIFT, doc[order].astype(np.uint16)
                    shard = ((place >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
                    cuts = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
                    for s in range(shards):
                        own = slice(cuts[s], cuts[s + 1])
                        if cuts[s] == cuts[s + 1]:
                            continue
                        fresh = np.flatnonzero(np.append(True, place[own][1:] != place[own][:-1]))
                        sizes = np.diff(np.append(fresh, cuts[s + 1] - cuts[s])).astype(np.uint32)
                        w = word[own]
                        packed = w.astype(np.uint32).tobytes() + (w >> np.uint64(32)).astype(np.uint8).tobytes()
                        rows.append((s, _PAIRS, _zip(place[own][fresh]), _zip(sizes), _zip(np.frombuffer(packed, np.uint8)), _zip(doc[own])))
                    flags = held.slice(first, last - first).to_numpy(zero_copy_only=False)
                    known = ids.slice(first, last - first)
                    info = (known.fill_null(0).to_numpy(), known.is_valid().to_numpy(zero_copy_only=False), flags, np.diff(offsets) + 1)
                    rows.append((owner, _DOCS, *map(_zip, info)))
                    # training flags travel with the pairs
                    columns = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(columns[0], pa.int32()),
                            pa.array(np.full(len(rows), number)),
                            pa.array(columns[1], pa.int32()),
                            *(pa.array(c, pa.binary()) for c in columns[2:5]),
                            pa.array(
                                [_zip(np.packbits(flags)) + b"|" + x if k == _PAIRS else x for k, x in zip(columns[1], columns[5])],
                                pa.binary(),
                            ),
                        ],
                        ["shard", "batch", "kind", "a", "b", "c", "d"],
                    )

    return run


def _split(value: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Held-out flags and document numbers of a block."""
    size = zstandard.frame_content_size(value)
    engine = zstandard.ZstdDecompressor().decompressobj()
    flags = engine.decompress(value)
    rest = engine.unused_data[1:]
    assert len(flags) == size
    return np.unpackbits(np.frombuffer(flags, np.uint8)).astype(bool), _unzip(rest, np.uint16)


def _answers(hot_words: np.ndarray, hot_counts: np.ndarray, slice_counts: np.ndarray, total: float):
    """Counts a shard's pairs, builds its trie, and sums what it knows for every document.

    Of a hot context it knows a slice: it gives the number of its distinct successors, and names the pairs that must be backed off.
    """
    slice_owner = np.repeat(np.arange(len(hot_words)), slice_counts)
    number = np.arange(len(slice_owner)) - np.repeat(np.cumsum(slice_counts) - slice_counts, slice_counts)
    slices = mix(hot_words[slice_owner] + number.astype(np.uint64) + np.uint64(1))
    slice_order = np.argsort(slices)
    sorted_slices = slices[slice_order]
    hot_codes = hot_words >> _WORD_SHIFT
    code_order = np.argsort(hot_codes)

    def find_slices(places: np.ndarray) -> np.ndarray:
        """Number of the hot word whose slice each place is, or -1."""
        if not len(slices):
            return np.full(len(places), -1)
        at = np.minimum(np.searchsorted(sorted_slices, places), len(slices) - 1)
        return np.where(sorted_slices[at] == places, slice_owner[slice_order[at]], -1)

    def solve(rows: pa.Table) -> Iterator[tuple]:
        blocks = []
        for number, kind, a, b, c, d in zip(*(rows.column(x).to_pylist() for x in ("batch", "kind", "a", "b", "c", "d"))):
            if kind != _PAIRS:
                yield number, kind, a, b, c, d
                continue
            place = np.repeat(_unzip(a, np.uint64), _unzip(b, np.uint32))
            packed = _unzip(c, np.uint8)
            n = len(place)
            word = packed[: 4 * n].view(np.uint32).astype(np.uint64) | (packed[4 * n :].astype(np.uint64) << np.uint64(32))
            flags, doc = _split(d)
            blocks.append((number, place, word, doc, flags))
        if not blocks:
            return
        place = np.concatenate([x[1] for x in blocks])
        word = np.concatenate([x[2] for x in blocks])
        learn = np.concatenate([~x[4][x[3]] for x in blocks])
        blocks = [(number, doc) for number, _, _, doc, _ in blocks]
        order = np.lexsort((word, place)).astype(np.int32)
        place, word = place[order], word[order]
        fresh = np.ones(len(place), bool)
        fresh[1:] = (place[1:] != place[:-1]) | (word[1:] != word[:-1])
        pair = np.cumsum(fresh, dtype=np.int32) - 1  # number of each posting's distinct pair
        counts = np.bincount(pair, learn[order]).astype(np.int64)
        place, word = place[fresh], word[fresh]
        node_fresh = np.ones(len(place), bool)
        node_fresh[1:] = place[1:] != place[:-1]
        node = np.cumsum(node_fresh) - 1
        places = place[node_fresh]
        hot = find_slices(places)
        own = np.bincount(node, counts)  # training count of each context here
        whole = np.where(hot >= 0, hot_counts[hot] if len(hot_counts) else 0, own).astype(np.float64)
        kinds = np.bincount(node, counts > 0)
        seen = counts > 0
        kept = own > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            logs = np.log10((counts[seen] - DISCOUNT) / whole[node[seen]])
            backoff = np.where(hot >= 0, 0.0, np.minimum(np.log10(DISCOUNT * kinds / whole), 0))[kept]
        trie = Trie.mapped(Trie.pack(places[kept], np.bincount(node[seen], minlength=len(places))[kept], word[seen], backoff, logs))
        # from here on only the trie answers
        at_node = trie.nodes(places)
        node_of_pair = at_node[node]
        at = trie.pairs(node_of_pair, word)
        value = np.zeros(len(place))
        value[at >= 0] = decode_log(trie.codes[at[at >= 0]])
        missed = at < 0
        after = missed & (node_of_pair >= 0)
        value[after] = decode_log(trie.backoff[node_of_pair[after]])
        # a slice without any training pair still belongs to a counted context
        sliced = missed & (hot[node] >= 0) & (whole[node] > 0)
        lone = np.zeros(len(place), bool)
        if len(hot_codes):  # unigrams of hot words are known here
            spot = np.minimum(np.searchsorted(hot_codes[code_order], word), len(hot_codes) - 1)
            is_hot = hot_codes[code_order][spot] == word
            direct = missed & is_hot
            value[direct] += np.log10((hot_counts[code_order[spot[direct]]] + ADDED) / total)
            lone = missed & ~is_hot
        else:
            lone = missed
        is_word = np.ones(len(places), bool)
        if len(hot_words):
            is_word[hot >= 0] = hot_words[hot[hot >= 0]] != START
        base = np.where(is_word, np.log10(whole + ADDED), 0.0)
        known = (is_word & (whole > 0)).astype(np.float64)
        back = np.empty(len(order), np.int32)
        back[order] = pair
        cut = np.flatnonzero((hot >= 0) & (kinds > 0))
        if len(cut):
            yield -1, _KINDS, _zip(hot[cut].astype(np.int64)), _zip(kinds[cut].astype(np.int64)), b"", b""
        first = 0
        for number, doc in blocks:
            mine = back[first : first + len(doc)]
            first += len(doc)
            size = int(doc.max()) + 1 if len(doc) else 0
            sums = [np.bincount(doc, x, size) for x in (value[mine], base[node[mine]], known[node[mine]])]
            later = np.flatnonzero(sliced[mine])
            waiting = _zip(np.concatenate([hot[node[mine[later]]], doc[later]]).astype(np.uint32)) if len(later) else b""
            yield number, _SUMS, _zip(sums[0]), _zip(sums[1]), _zip(sums[2].astype(np.uint32)), waiting
            open_ = lone[mine]
            if open_.any():
                yield number, _UNSEEN, _zip(word[mine[open_]]), _zip(doc[open_]), b"", b""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups.runs(batches, "shard"):
            for row in solve(group):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[0]], pa.int64()), pa.array([row[1]], pa.int32()), *(pa.array([x], pa.binary()) for x in row[2:])],
                    ["batch", "kind", "a", "b", "c", "d"],
                )

    return run


def _summed(backoff: np.ndarray):
    """Adds up what the shards know of a document; ``backoff`` has the logarithms of the hot contexts' back-offs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups.runs(batches, "batch"):
            rows = group.to_pylist()
            info = next(r for r in rows if r["kind"] == _DOCS)
            ids, valid, held, sizes = (_unzip(info[k], t) for k, t in (("a", np.int64), ("b", bool), ("c", bool), ("d", np.int64)))
            score, base, known = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), np.int64)
            for r in rows:
                if r["kind"] == _SUMS:
                    for total, name, kind in ((score, "a", np.float64), (base, "b", np.float64), (known, "c", np.uint32)):
                        part = _unzip(r[name], kind)
                        total[: len(part)] += part.astype(total.dtype)
                    if r["d"]:
                        context, doc = _unzip(r["d"], np.uint32).reshape(2, -1)
                        score += np.bincount(doc, backoff[context], len(score))
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, info["batch"])),
                    pa.array(np.arange(n, dtype=np.int32)),
                    pa.array(ids, mask=~valid),
                    pa.array(held),
                    pa.array(sizes),
                    pa.array(known),
                    pa.array(base),
                    pa.array(score),
                ],
                ["batch", "at", "doc_id", "held_out", "n_tokens", "n_known", "base", "score"],
            )

    return run


def _kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(_unzip(row[x], np.int64)) for x in ("a", "b")], ["c", "kinds"])


def _unseen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            word, doc = _unzip(row["a"], np.uint64), _unzip(row["b"], np.uint16)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(word), row["batch"])), pa.array(doc.astype(np.int32)), pa.array(word.view(np.int64))], ["batch", "at", "word"]
            )


def score_corpus(docs: DataFrame, held_out: int = 10) -> DataFrame:
    """Learns from the documents whose crc32(doc_id as text) modulo ``held_out`` is not 0 and scores all.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: logarithms to base ten of the unigram and of the pair
    model. Words are lower-cased (A-Z); each text has one end token, counted. A null text is empty. Rows without doc_id are
    learned from and not held out; repeated rows count as often as they occur. With nothing to learn from n_known is 0 and both
    scores follow from the added counts alone. Other columns are not read; an empty table gives no rows.
    """
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % held_out == 0, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    size, learned = slim.agg(F.sum(F.octet_length("text")), F.count(F.when(~F.col("held_out"), 1))).first()
    counts = staged(slim.mapInArrow(_counted, "word long, n long, m long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("m").alias("m")), "unigrams")
    tokens, kinds, words, texts = (
        counts.agg(F.sum("n"), F.count(F.when(F.col("n") > 0, 1)), F.sum("m")).crossJoin(slim.agg(F.count("*"))).first()
    )
    tokens, kinds = (tokens or 0) + learned, kinds + (learned > 0)
    total = tokens + ADDED * (kinds + 1)
    shards = max(1, -(-(size or 0) // SHARD_BYTES))
    limit = max(1, ((words or 0) + texts) // (SLICE_PARTS * shards))
    frequent = counts.where(F.col("m") > limit).collect()  # SLICE_PARTS * shards rows at most
    hot = {int(np.int64(r.word).view(np.uint64)): (r.n, r.m) for r in frequent} | {int(START): (learned, texts), int(END): (learned, 0)}
    hot_words = np.array(sorted(hot), np.uint64)
    hot_counts, hot_sizes = np.array([hot[int(w)] for w in hot_words], np.int64).T.copy()
    slices = np.maximum(1, -(-hot_sizes // limit))
    # a pair beyond the limit has more than half of it in the batches that report it: those that do not hold half at most together
    share, width = 2 * SLICE_PARTS * shards, len(hot_words)
    reported = slim.mapInArrow(_hot_pairs(hot_words, share), "pair long, n long, m long").groupBy("pair").agg(F.sum("m").alias("m"))
    likely = np.array(sorted(r.pair for r in reported.where(2 * F.col("m") > limit).select("pair").collect()), np.int64)  # twice as many at most
    counted = slim.mapInArrow(_hot_pairs(hot_words, wanted=likely), "pair long, n long, m long").groupBy("pair").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    large = counted.where(F.col("m") > limit).collect() if len(likely) else []  # as many as frequent words at most
    pair, seen = np.array([r.pair for r in large], np.int64), np.array([r.n for r in large], np.float64)
    pair_keys = pair // width, hot_words[pair % width] >> _WORD_SHIFT
    codes = {int(w >> _WORD_SHIFT): n for w, n in zip(hot_words, hot_counts)}
    alone = np.array([np.log10((codes[int(w)] + ADDED) / total) for w in pair_keys[1]])
    with np.errstate(divide="ignore", invalid="ignore"):
        pair_values = np.where(seen > 0, np.log10((seen - DISCOUNT) / hot_counts[pair_keys[0]]), alone)
    blocks = slim.mapInArrow(_blocks(shards, hot_words, slices, pair_keys, pair_values, seen, hot_counts), BLOCKS)
    blocks = blocks.repartition(shards, "shard").sortWithinPartitions("shard", "batch")
    parts = staged(blocks.mapInArrow(_answers(hot_words, hot_counts, slices, total), PARTS), "pair_sums")
    hot_kinds = np.bincount(pair_keys[0][seen > 0], minlength=width)
    sliced = parts.where(F.col("kind") == _KINDS).select("a", "b").mapInArrow(_kinds, "c long, kinds long")
    for r in sliced.groupBy("c").agg(F.sum("kinds").alias("kinds")).collect():  # as many as frequent words at most
        hot_kinds[r.c] += r.kinds
    backoff = np.minimum(np.log10(np.maximum(DISCOUNT * hot_kinds, DISCOUNT) / np.maximum(hot_counts, 1)), 0)
    sums = parts.where(F.col("kind") <= _SUMS).repartition("batch").sortWithinPartitions("batch").mapInArrow(_summed(backoff), SCORES)
    lone = parts.where(F.col("kind") == _UNSEEN).select("batch", "a", "b").mapInArrow(_unseen, UNSEEN)
    lone = lone.groupBy("batch", "at", "word").agg(F.count("*").alias("times"))
    coded = counts.groupBy(F.shiftrightunsigned("word", 64 - WORD_BITS).alias("word")).agg(F.sum("n").alias("n"))
    chance = F.log10((F.coalesce("n", F.lit(0)) + ADDED) / total)
    backed = lone.join(coded, "word", "left").groupBy("batch", "at").agg(F.sum(F.col("times") * chance).alias("backed"))
    end = float(np.log10(learned + ADDED))
    return sums.join(backed, ["batch", "at"], "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.lit(int(learned > 0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.lit(end) - F.col("n_tokens") * F.lit(float(np.log10(total)))).alias("base_score"),
        (F.col("score") + F.coalesce("backed", F.lit(0.0))).alias("score"),
    )
