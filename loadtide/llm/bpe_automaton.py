"""Byte-pair encoding and decoding with a deterministic tokenization automaton.

The automaton reads tokens and accepts exactly the token sequences that merging produces. It starts with one state in which every
symbol may follow, and grows by one merge gadget per merge ``a b -> ab`` in order of rank: the state after ``a`` loses its arc ``b``,
every state with an arc ``a`` gets an arc ``ab``, and ``ab`` leads where ``b`` led. A merge whose arc ``b`` is already gone never
fires. The state after a token depends on the token alone, so the automaton is a table of bits (state after the last token, next
token); states and arcs with equal rows or columns are joined afterwards.

Every prefix of a word has exactly one accepted sequence. Words are therefore encoded place by place: of the tokens that end at a
place (a trie finds them) the one whose arc exists in the state where it starts. All distinct words of a slice of the table move
together as numpy arrays. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import functools
import json
import os
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructField, StructType

TOKENIZER_DIR = "/opt/tokenizers"
MODEL = "word_bpe_49k.json"
END = "</w>"
#: Text bytes and rows of a slice, bytes of distinct words encoded together, length from which a word is walked on its own.
SLICE_BYTES = 1 << 20
SLICE_ROWS = 512
WORD_BYTES = 1 << 17
LONG = 128

# Normaliser and pre-splitter that a vocabulary file of this kind names.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where printable in Latin-1, the others from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


# Letters and numbers of the tables' newest age that the tokenizer knows and the interpreter's tables do not (first, last),
# and the distance from a capital of that age to its small letter (first, last, distance).
YOUNG_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
YOUNG_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
YOUNG_CAPITALS = [
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1), (0xA7D4, 0xA7D4, 1),
    (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 32), (0x16EA0, 0x16EB8, 27),
]


def too_new() -> str:
    """Class of what the pattern library takes for letters and numbers, and the tokenizer, whose tables are older, does not."""
    pattern = regex.compile(r"[\p{L}\p{N}]")
    known = {c for a, b in YOUNG_LETTERS + YOUNG_NUMBERS for c in range(a, b + 1)}
    found = [c for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) == "Cn" and c not in known and pattern.match(chr(c))]
    starts = [c for c, before in zip(found, [-2, *found]) if c != before + 1]
    stops = [c for c, after in zip(found, [*found[1:], -2]) if c != after - 1]
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in zip(starts, stops))


@dataclass
class Automaton:
    """Arrays only, so that it is broadcast as it is (some 25 MB, whatever the input)."""

    keys: np.ndarray  # sorted: node * 512 + symbol, a symbol being a byte, plus 256 at the end of a word
    children: np.ndarray  # node behind each key
    roots: np.ndarray  # node behind each symbol of the root
    tokens: np.ndarray  # token at each node, -1 for none
    states: np.ndarray  # state after each token
    arcs: np.ndarray  # arc class of each token
    follows: np.ndarray  # bits: arc class, state
    labels: np.ndarray  # bytes of all labels, each followed by a space
    starts: np.ndarray
    sizes: np.ndarray
    special: dict[str, int]
    newer: str  # character class, see :func:`too_new`

    def allowed(self, last: np.ndarray, token: np.ndarray) -> np.ndarray:
        state = self.states[last]
        return (self.follows[self.arcs[token], state >> 3] >> (state & 7).astype(np.uint8)) & 1 > 0


def merge_gadgets(size: int, base: list[int], inner: list[int], merges: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Bits ``[next token][state after a token]`` and the state of each token.

    Only ``inner`` tokens, which do not end a word, have states of their own; the others have -1, as nothing follows them.
    """
    state = np.full(size, -1)
    state[inner] = np.arange(len(inner))
    bits = np.zeros((size, (len(inner) + 7) // 8), np.uint8)
    bits[base] = 0xFF
    made = np.zeros(size, bool)
    made[base] = True
    known = max(base) + 1  # ids below are the ones that can hold bits so far
    for a, b, ab in merges:
        sa, sb, sab = int(state[a]), int(state[b]), int(state[ab])
        if not (made[a] and made[b] and bits[b, sa >> 3] >> (sa & 7) & 1):
            continue
        made[ab] = True
        known = max(known, ab + 1)
        bits[ab] = bits[a]
        if sab >= 0:
            after = bits[:known, sb >> 3] >> (sb & 7) & 1
        lost = np.uint8(~(1 << (sa & 7)) & 0xFF)
        bits[b, sa >> 3] &= lost
        if a == b:
            bits[ab, sa >> 3] &= lost
        if sab >= 0:
            column = bits[:known, sab >> 3]
            column &= np.uint8(~(1 << (sab & 7)) & 0xFF)
            column |= (after << (sab & 7)).astype(np.uint8)
    return bits, state


def _joined(bits: np.ndarray, states: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal columns, then equal rows, joined: bits, arc class of each token, class of each state."""

    def classes(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        table = np.ascontiguousarray(table)
        _, first, inverse = np.unique(table.view(f"V{table.shape[1]}").ravel(), return_index=True, return_inverse=True)
        return table[first], inverse.astype(np.int32)

    bits, arcs = classes(bits)
    flipped = np.empty((states, (len(bits) + 7) // 8), np.uint8)
    for first in range(0, bits.shape[1], 64):  # transposed 512 states at a time
        part = np.unpackbits(bits[:, first : first + 64], axis=1, bitorder="little")[:, : states - first * 8]
        flipped[first * 8 : first * 8 + part.shape[1]] = np.packbits(part.T, axis=1, bitorder="little")
    rows, merged = classes(flipped)
    out = np.empty((len(bits), (len(rows) + 7) // 8), np.uint8)
    for first in range(0, len(rows), 512):
        part = np.unpackbits(rows[first : first + 512], axis=1, bitorder="little")[:, : len(bits)]
        out[:, first // 8 : first // 8 + (len(part) + 7) // 8] = np.packbits(part.T, axis=1, bitorder="little")
    return out, arcs, merged


def compile_automaton(vocab: dict[str, int], merges: list[tuple[str, str]], special: dict[str, int]) -> Automaton:
    """From token texts and ids, merges by rank, and the added tokens (text to id) that are found before anything else."""
    letters = {c: b for b, c in enumerate(byte_characters())}

    def symbols(text: str) -> list[int]:
        ends = text.endswith(END)
        found = [letters[c] for c in (text.removesuffix(END) if ends else text)]
        if ends:
            found[-1] += 256
        return found

    spelled = {i: symbols(text) for text, i in vocab.items() if text not in special}
    base = [i for i, s in spelled.items() if len(s) == 1]
    if len(base) != 512:
        raise ValueError("the vocabulary must hold every byte, inside and at the end of a word")
    size = max([*vocab.values(), *special.values()]) + 1
    inner = [i for i, s in spelled.items() if s[-1] < 256]
    bits, state = merge_gadgets(size, base, inner, [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges])
    follows, arcs, merged = _joined(bits, int(state.max()) + 1)
    used = {ab for a, b in merges if bits[ab := vocab[a + b]].any()} | set(base)
    table: dict[int, int] = {}
    tokens = [-1]
    for i in sorted(used):
        node = 0
        for s in spelled[i]:
            key = node * 512 + s
            node = table.get(key, -1)
            if node < 0:
                node = table[key] = len(tokens)
                tokens.append(-1)
        tokens[node] = i
    keys = np.array(sorted(table), np.int64)
    children = np.array([table[k] for k in keys.tolist()], np.int32)
    texts = {i: text.encode() for text, i in (vocab | special).items()}
    parts = [texts[i] + b" " if i in texts else b"" for i in range(size)]
    sizes = np.array([len(p) for p in parts] + [0])
    return Automaton(
        keys, children, children[:512], np.array(tokens, np.int32), np.where(state >= 0, merged[state], 0).astype(np.int32), arcs, follows,
        np.frombuffer(b"".join(parts), np.uint8), np.cumsum(sizes) - sizes, sizes, dict(special), too_new(),
    )


@functools.lru_cache(2)
def load_automaton(path: str = os.path.join(TOKENIZER_DIR, MODEL)) -> Automaton:
    """Compiles a public vocabulary file; a file with other rules than those implemented here is refused."""
    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    model, splits = held["model"], held["pre_tokenizer"]["pretokenizers"]
    if (
        held["normalizer"] != {"type": "Sequence", "normalizers": NORMALIZERS}
        or splits[0] != {"type": "Split", "pattern": {"Regex": PATTERN}, "behavior": "Removed", "invert": True}
        or (splits[1]["type"], splits[1]["add_prefix_space"], splits[1]["use_regex"]) != ("ByteLevel", False, False)
        or (model["end_of_word_suffix"], model["dropout"], held["decoder"], held["post_processor"]) != (END, None, None, None)
        or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in held["added_tokens"])
    ):
        raise ValueError(f"{path}: normaliser, splitter or model of another kind")
    return compile_automaton(
        model["vocab"], [tuple(m) for m in model["merges"]], {t["content"]: t["id"] for t in held["added_tokens"]}
    )


class Encoder:
    """Pre-splitting and table-driven encoding with one automaton."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.special = regex.compile("|".join(map(regex.escape, sorted(automaton.special, key=len, reverse=True))) or r"(?!)")
        self.words = regex.compile(PATTERN)
        newer = automaton.newer
        self.small = {c: c + d for a, b, d in YOUNG_CAPITALS for c in range(a, b + 1)}
        self.young = regex.compile("[" + "".join(map(chr, self.small)) + "]")
        self.newer = regex.compile(f"[{newer}]" if newer else "(?!)")
        older = PATTERN.replace(r"[\p{L}]", rf"[\p{{L}}--[{newer}]]").replace(r"[\p{N}]", rf"[\p{{N}}--[{newer}]]")
        older = older.replace(r"[^\s\p{L}\p{N}]", rf"[[^\s\p{{L}}\p{{N}}][{newer}]]")
        self.older = regex.compile(older, regex.V1) if newer else self.words

    def split(self, text: str) -> list[str | int]:
        """Words and ids of added tokens, in order. White space only separates, so it is not rewritten."""
        out: list[str | int] = []
        at = 0
        for found in self.special.finditer(text) if "<" in text else ():
            out += self._words(text[at : found.start()])
            out.append(self.automaton.special[found[0]])
            at = found.end()
        out += self._words(text[at:] if at else text)
        return out

    def _words(self, text: str) -> list[str]:
        if not text.isascii():
            # characters are lower-cased one by one: no final form of sigma
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
            if self.young.search(text):
                text = text.translate(self.small)
            return (self.older if self.newer.search(text) else self.words).findall(text)
        return self.words.findall(text.lower())

    def _arcs(self, symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All tokens inside the words: first symbol, last symbol, token. ``ends`` is the last place of each symbol's word."""
        a = self.automaton
        at = np.arange(len(symbols), dtype=np.int32)
        last = at
        node = a.roots[symbols]
        found = []
        while len(at):
            token = a.tokens[node]
            hit = token >= 0
            found.append((at[hit], last[hit], token[hit]))
            on = last < ends[at]
            at, last, node = at[on], last[on] + 1, node[on]
            key = node.astype(np.int64) * 512 + symbols[last]
            place = np.minimum(np.searchsorted(a.keys, key), len(a.keys) - 1)
            on = a.keys[place] == key
            at, last, node = at[on], last[on], a.children[place[on]]
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (at, at, at)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the offsets of the words."""
        raw = [w.encode() for w in words]
        offsets = np.zeros(len(raw) + 1, np.int64)
        parts = []
        first = 0
        while first < len(raw):
            end, held = first, 0
            while end < len(raw) and held < WORD_BYTES and len(raw[end]) <= LONG:
                held += len(raw[end])
                end += 1
            if end == first:
                ids = self._walk(raw[first])
                end, counts = first + 1, np.array([len(ids)])
            else:
                ids, counts = self._together(raw[first:end])
            parts.append(ids)
            offsets[first + 1 : end + 1] = counts
            first = end
        return np.concatenate([np.zeros(0, np.int32), *parts]), np.cumsum(offsets)

    def _together(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(w) for w in raw], np.int32)
        stops = np.cumsum(sizes, dtype=np.int32)
        begins = stops - sizes
        symbols = np.frombuffer(b"".join(raw), np.uint8).astype(np.int32)
        symbols[stops - 1] += 256
        head = np.repeat(begins, sizes)
        start, stop, token = self._arcs(symbols, np.repeat(stops - 1, sizes))
        depth = stop - head[stop]
        order = np.argsort(depth, kind="stable")
        start, stop, token, depth = start[order], stop[order], token[order], depth[order]
        opens = start == head[start]
        steps = np.searchsorted(depth, np.arange(int(depth[-1]) + 2))
        token_at = np.zeros(len(symbols), np.int32)  # last token of the one sequence to each place, and its first symbol
        start_at = np.zeros(len(symbols), np.int32)
        for low, high in zip(steps[:-1].tolist(), steps[1:].tolist()):
            s, t, e = start[low:high], token[low:high], stop[low:high]
            ok = opens[low:high] | self.automaton.allowed(token_at[s - 1], t)
            e = e[ok]
            token_at[e] = t[ok]
            start_at[e] = s[ok]
        used = np.zeros(len(symbols), bool)
        at = stops - 1
        while len(at):
            used[at] = True
            before = start_at[at]
            at = before[before > head[at]] - 1
        return token_at[used], np.add.reduceat(used, begins, dtype=np.int64)

    def _walk(self, word: bytes) -> np.ndarray:
        """One long word, its arcs found in parts; what is kept per byte is one token and its length."""
        size = len(word)
        symbols = np.frombuffer(word, np.uint8).astype(np.int32)
        symbols[-1] += 256
        token_at, length_at = np.zeros(size, np.int32), np.zeros(size, np.int32)
        reach = 64 + int(self.automaton.sizes.max())
        ready: dict[int, list[tuple[int, int]]] = {}
        allowed, part = self.automaton, 1 << 14
        for first in range(0, size, part):
            view = symbols[first : first + part + reach]
            start, stop, token = self._arcs(view, np.full(len(view), len(view) - 1))
            mine = start < part  # arcs that begin later are found by the next part
            for s, e, t in zip((start[mine] + first).tolist(), (stop[mine] + first).tolist(), token[mine].tolist()):
                ready.setdefault(e, []).append((s, t))
            for e in range(first, min(first + part, size)):
                for s, t in ready.pop(e):
                    state = int(allowed.states[token_at[s - 1]])
                    if s == 0 or allowed.follows[allowed.arcs[t], state >> 3] >> (state & 7) & 1:
                        token_at[e], length_at[e] = t, e - s + 1
                        break
        out, at = [], size - 1
        while at >= 0:
            out.append(token_at[at])
            at -= int(length_at[at])
        return np.array(out[::-1], np.int32)

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the offsets of the texts. Each distinct word is encoded once."""
        known: dict[str | int, int] = {}
        places: list[int] = []
        counts = [0]
        for text in texts:
            places += [known.setdefault(w, len(known)) for w in self.split(text)]
            counts.append(len(places))
        words = [w for w in known if isinstance(w, str)]
        ids, offsets = self.encode_words(words)
        added = [w for w in known if isinstance(w, int)]
        # words first, added tokens behind them
        rank = np.zeros(len(known), np.int64)
        rank[[known[w] for w in words]] = np.arange(len(words))
        rank[[known[w] for w in added]] = len(words) + np.arange(len(added))
        ids = np.concatenate([ids, np.array(added, np.int32)]).astype(np.int32)
        offsets = np.concatenate([offsets, offsets[-1] + 1 + np.arange(len(added))])
        used = rank[np.array(places, np.int64)]
        width = (offsets[1:] - offsets[:-1])[used]
        ends = np.concatenate([[0], np.cumsum(width)])
        flat = ids[np.repeat(offsets[used] - ends[:-1], width) + np.arange(ends[-1])]
        return flat, ends[np.array(counts)]

    def decode_many(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Labels of each list, with a space between them; ids without a label write nothing."""
        a = self.automaton
        ids = np.where((ids >= 0) & (ids < len(a.sizes) - 1), ids, len(a.sizes) - 1)
        width = a.sizes[ids]
        ends = np.concatenate([[0], np.cumsum(width)])
        raw = a.labels[np.repeat(a.starts[ids] - ends[:-1], width) + np.arange(ends[-1])]
        cuts = ends[offsets]
        full = cuts[1:] > cuts[:-1]
        raw = np.delete(raw, cuts[1:][full] - 1)  # the space behind the last label
        cuts = cuts - np.concatenate([[0], np.cumsum(full)])
        return pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw)))


def slices(batches: Iterator[pa.RecordBatch], sizes) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows of about ``SLICE_BYTES``, ``sizes`` giving the bytes of each row of a batch."""
    for batch in batches:
        ends = np.cumsum(sizes(batch), dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = int(np.searchsorted(ends, before + SLICE_BYTES, "right"))
            last = min(batch.num_rows, first + SLICE_ROWS, max(last, first + 1))
            yield batch.slice(first, last - first)
            first = last


def row_bytes(column: pa.Array, scale: int) -> np.ndarray:
    """Bytes of each row of a text or list column, ``scale`` for each item."""
    at = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_string(column.type) else np.int32)
    return np.diff(at[column.offset : column.offset + len(column) + 1]) * scale


def encode(docs: DataFrame, automaton: Automaton | None = None) -> DataFrame:
    """All columns of ``docs`` and ``ids`` (array of int), ``ids_le`` (the same as little-endian 32-bit binary) and ``n_tokens``.

    Clashing columns of these names are replaced. Null and empty texts give no tokens. Whole texts are encoded, and rows are
    independent, so ties, repeated rows, missing doc_ids and empty tables need no care. Added tokens in a text become their own ids.
    """
    shared = docs.sparkSession.sparkContext.broadcast(automaton or load_automaton())
    docs = docs.select(*(c for c in docs.columns if c not in ("ids", "ids_le", "n_tokens")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in slices(batches, lambda b: row_bytes(b.column("text"), 1)):
            flat, offsets = encoder.encode_many([t or "" for t in batch.column("text").to_pylist()])
            at = offsets.astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(at), pa.array(flat))
            packed = pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at * 4), pa.py_buffer(flat.astype("<u4"))])
            yield pa.RecordBatch.from_arrays([*batch.columns, ids, packed], [*batch.schema.names, "ids", "ids_le"])

    made = [StructField("ids", ArrayType(IntegerType())), StructField("ids_le", BinaryType())]
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *made])).withColumn("n_tokens", F.size("ids").cast("long"))


def decode(tokens: DataFrame, automaton: Automaton | None = None) -> DataFrame:
    """All columns of ``tokens`` and ``decoded``, the labels of ``ids`` with spaces between; a null list gives null, unknown ids nothing.

    A column ``decoded`` of the input is replaced; rows are independent, an empty table gives none.
    """
    shared = tokens.sparkSession.sparkContext.broadcast(automaton or load_automaton())
    tokens = tokens.select(*(c for c in tokens.columns if c != "decoded"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Encoder(shared.value)
        for batch in slices(batches, lambda b: row_bytes(b.column("ids"), 4)):
            column = batch.column("ids")
            texts = decoder.decode_many(column.flatten().to_numpy(), kept_offsets(column))
            if column.null_count:
                texts = pa.array([t if known else None for t, known in zip(texts.to_pylist(), column.is_valid().to_pylist())], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts.cast(pa.string())], [*batch.schema.names, "decoded"])

    return tokens.mapInArrow(run, StructType([*tokens.schema.fields, StructField("decoded", StringType())]))


def kept_offsets(column: pa.ListArray) -> np.ndarray:
    """Offsets into the flattened values; null lists hold none of them."""
    sizes = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy()), 0)
    return np.concatenate([[0], np.cumsum(sizes)])
