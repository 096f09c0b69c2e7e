from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loadtide.llm import (
    chain_dedup,
    chat_template,
    contamination,
    groups,
    line_quality,
    minhash_dedup,
    ngram_lm,
    piece_fst,
    suffix_dedup,
    token_rollup,
    toxicity,
)
from loadtide.llm.queries import LLM_QUERIES
from loadtide.sources.stages import new_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(seed: int, n: int) -> list[str]:
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list("abcdefghijklmnoprstu"), rng.integers(2, 9))) for _ in range(n)]


def shingle_set(text) -> set:
    words = WORD.findall(lower(text))
    if len(words) < 5:
        return {(len(words), *words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


@pytest.fixture(scope="module")
def odd_rows():
    """Nulls in every column, empty, blank, short and very long texts, repeated rows and ids, copies and near copies."""
    base = prose(1, 300)
    near = [w if i != 150 else "edited" for i, w in enumerate(base)]
    long = prose(2, 30_000)
    return [
        (10, " ".join(base), "en", "a", 1),
        (11, " ".join(base), None, None, None),
        (12, " ".join(near), "en", "a", 1),
        (13, None, "en", "a", 0),
        (14, "", "de", "b", 0),
        (15, " \t\n ", "de", "b", 3),
        (16, "only Three words", "fr", "b", 16),
        (17, "ONLY three words", "fr", "b", 16),
        (18, " ".join(long), "en", "b", 1),
        (18, " ".join(long), "en", "b", 1),
        (19, " ".join(prose(3, 80)), "xx", "a", 1),
        (19, " ".join(prose(4, 90)), "xx", "a", 1),
        (None, " ".join(base), "en", "a", 1),
        (None, None, None, None, None),
        (20, "é" * 400 + "\u0000 ▁ 日本 " + "x" * 3000, "es", "c", 1),
        (21, "a\nb\na\n" * 200, "es", "c", 1),
    ]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    """The rows with further columns whose names operators use themselves."""
    docs = spark.createDataFrame(odd_rows, DOCS)
    taken = ("ids", "score", "spans", "doc", "digest", "cid", "kept", "n_bytes", "body", "task", "h", "at")
    return docs.select("*", *(F.lit("own").alias(c) for c in taken)).repartition(3)


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def rows_of(df, key="doc_id"):
    return sorted(df.collect(), key=lambda r: (r[key] is None, r[key] or 0, str(r)))


# ---------------------------------------------------------------- 1


def brute_components(rows, percent):
    sets = [shingle_set(t) for _, t, *_ in rows]
    label = [i for i, *_ in rows]
    ok = [i is not None and bool(s) for (i, *_), s in zip(rows, sets)]
    for _ in rows:
        for a in range(len(rows)):
            for b in range(len(rows)):
                if ok[a] and ok[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    return sorted(((i, len(s), c) for (i, *_), s, c in zip(rows, sets, label)), key=str)


def test_near_duplicates(odd, odd_rows, none):
    got = minhash_dedup.near_duplicates(odd, 85).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_components(odd_rows, 85)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)
    assert minhash_dedup.near_duplicates(none).count() == 0


def test_deduplicate_keeps_one_row_of_each_group(odd, none):
    got = rows_of(minhash_dedup.deduplicate(odd, 80))
    assert [r.doc_id for r in got] == [10, 13, 14, 15, 16, 18, 19, 20, 21, None, None]
    assert got[0].score == "own"
    assert minhash_dedup.deduplicate(none).columns == none.columns


def test_estimate_is_corrected_for_chance():
    rng = np.random.default_rng(0)
    shared, one, two = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (6000, 2000, 2000))
    sets = [np.sort(np.concatenate([shared, x])) for x in (one, two)]
    offsets = np.array([0, 8000, 16000])
    sig = minhash_dedup.pack(minhash_dedup.minima(np.concatenate(sets), offsets))
    assert abs(minhash_dedup.estimate(sig[0], sig[1:])[0] - 0.6) < 0.15
    unrelated = rng.integers(0, 1 << 32, (2000, 128), dtype=np.uint32)
    packed = minhash_dedup.pack(unrelated)
    assert abs(minhash_dedup.estimate(packed[0], packed[1:]).mean()) < 0.01


def test_dense_group_in_several_blocks(spark, monkeypatch):
    base = prose(5, 200)
    rows = []
    for k in range(60):
        words = list(base)
        for e in range(k % 5):
            words[(k * 7 + e * 40) % 200] = f"edit{k}x{e}"
        rows.append((k, " ".join(words), "en", "a", 1))
    monkeypatch.setattr(minhash_dedup, "BLOCK_CLASSES", 10)
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, DOCS), 85).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_components(rows, 85)


# ---------------------------------------------------------------- 2


def test_token_totals_equal_brute_force(spark, sf):
    import base64
    import os

    import tiktoken

    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = Counter()
    seen = set()
    for version, name in token_rollup.VERSIONS.items():
        with open(os.path.join(token_rollup.TOKENIZER_DIR, name), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        enc = tiktoken.Encoding("t", pat_str=token_rollup.PATTERN, mergeable_ranks=ranks, special_tokens={})
        seen.clear()
        for r in sorted(docs, key=lambda r: r.doc_id):
            if r.text not in seen:
                seen.add(r.text)
                want[r.source, r.lang, version, "docs"] += 1
                want[r.source, r.lang, version, "tokens"] += len(enc.encode_ordinary(r.text))
    got = Counter()
    for r in LLM_QUERIES["op2_token_counts"](spark, sf).collect():
        got[r.source, r.lang, r.tokenizer, "docs"] = r.n_docs
        got[r.source, r.lang, r.tokenizer, "tokens"] = r.n_tokens
    assert got == want


def test_batches_count_once(spark, odd, none):
    counted = token_rollup.count_tokens(odd)
    rollup = token_rollup.Rollup(spark, new_path(spark, "rollup_test"))
    assert rollup.totals().count() == 0
    insert = token_rollup.unpivot(counted, "insert", None, "{v}")
    assert rollup.apply("one", insert) and not rollup.apply("one", insert)
    assert rollup.apply("none", token_rollup.unpivot(token_rollup.count_tokens(none), "insert", None, "{v}"))
    first = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}
    assert sum(n for n, _ in first.values()) == 32  # each of 16 rows under two versions
    assert (None, None, "byte_bpe_50k") in first
    rollup.apply("up", token_rollup.unpivot(counted, "revise", "{v}", "{v} + 1"))
    second = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}
    assert all(second[k] == (n, t + n) for k, (n, t) in first.items())
    rollup.apply("away", token_rollup.unpivot(counted, "delete", "{v} + 1", None))
    assert rollup.totals().count() == 0
    with pytest.raises(Exception, match="unknown op"):
        rollup.apply("bad", token_rollup.unpivot(counted, "odd", None, "{v}"))
    assert not rollup.committed("bad")


# ---------------------------------------------------------------- 3


def brute_contained(rows, items, percent=80):
    out = set()
    for i, text, *_ in rows:
        own = shingle_set(text)
        for item, passage in items:
            wanted = shingle_set(passage)
            if wanted and item is not None and 100 * len(own & wanted) >= percent * len(wanted):
                out.add((i, item, len(wanted), len(own & wanted)))
    return out


def test_contamination(spark, odd, odd_rows, none):
    words = prose(2, 30_000)
    scattered = [x for k in range(12) for x in words[2000 * k : 2000 * k + 8]]  # parts all over the document
    items = [
        (1, " ".join(words[20_000:20_040])),
        (1, " ".join(words[20_000:20_040])),
        (2, " ".join([*words[100:130], "new", *words[131:160]])),
        (3, " ".join(scattered)),
        (4, "only THREE words"),
        (5, None),
        (6, ""),
        (None, " ".join(words[:50])),
        (7, " ".join(prose(9, 40))),
        (8, " ".join(prose(1, 300))),
    ]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = contamination.search(odd, table).collect()
    assert set(map(tuple, got)) == brute_contained(odd_rows, items)
    assert len(got) == len(set(map(tuple, got))) + sum(r.doc_id == 18 for r in got) // 2  # the repeated row returns its own
    hit = {r.doc_id for r in got}
    clean = contamination.decontaminate(odd, table)
    assert clean.columns == odd.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(i for i, t, *_ in odd_rows if i not in hit or (i is None and t is None))
    assert contamination.search(none, table).count() == 0
    assert contamination.search(odd, table.where("false")).count() == 0
    assert contamination.decontaminate(odd, table.where("false")).count() == len(odd_rows)


# ---------------------------------------------------------------- 4


def test_pieces_equal_the_library_and_round_trip(spark, sf, odd, odd_rows, none):
    import sentencepiece

    held = sentencepiece.SentencePieceProcessor(model_file=f"{piece_fst.TOKENIZER_DIR}/{piece_fst.MODEL}")
    fst = piece_fst.Transducer(piece_fst.load_vocabulary())
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts += [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    texts += [" a  b\tc\n d ", "", " ", "     ", "\u0000", "日本 語😀", "a" * 700, "▁▁ x", "ﬁ①é"]
    for text in texts:
        ids = fst.encode(text).tolist()
        assert ids == held.encode(text)
        assert fst.decode(ids) == text.replace("▁", " ")
    out = piece_fst.decode(piece_fst.encode(odd)).collect()
    assert len(out) == len(odd_rows) and out[0].score == "own"
    assert all(r.decoded == (r.text or "").replace("▁", " ") and r.n_pieces == len(r.ids) for r in out)
    assert piece_fst.encode(none).count() == 0
    both = piece_fst.encode(odd, read_back=True)
    assert rows_of(both.select(out[0].__fields__)) == sorted(out, key=lambda r: (r.doc_id is None, r.doc_id or 0, str(r)))


def test_pieces_without_a_merge_path():
    """A piece that merging cannot reach is never used; what merging gives is."""
    vocabulary = piece_fst.Vocabulary([("a", 0, -1.0), ("b", 1, -1.0), ("ab", 2, -2.0), ("abab", 3, -9.0), ("bab", 4, -3.0)], list(range(5, 261)))
    fst = piece_fst.Transducer(piece_fst.Vocabulary(vocabulary.pieces, vocabulary.byte_ids, piece_fst.Normaliser((), "")))
    for text in ("abab", "bab", "babab", "aabb", "xay"):
        assert fst.shortest_path(text) == [i for part in fst.merged(text) for i in fst._arcs(part)]


def test_pieces_in_arrays_equal_the_plain_transducer():
    """Many segments at once against one path at a time, also where no path exists and for pieces without a merge."""
    rng = np.random.default_rng(4)
    small = piece_fst.Vocabulary([("a", 0, -1.0), ("b", 1, -1.0), ("ab", 2, -2.0), ("abab", 3, -9.0), ("bab", 4, -3.0), ("aa", 5, -3.0)], list(range(6, 262)), piece_fst.Normaliser((), ""))
    for vocabulary, letters in ((small, "abx\né"), (piece_fst.load_vocabulary(), "aethin=-é\n😀")):
        fst = piece_fst.Transducer(vocabulary)
        segments = ["".join(rng.choice(list(letters), rng.integers(1, 30))) for _ in range(400)]
        ids, counts = fst.tables.shortest_paths(segments)
        parts = np.split(ids, np.cumsum(counts)[:-1])
        assert [p.tolist() for p in parts] == [fst.shortest_path(x) for x in segments]
        pieces = list(fst.made)
        left, right = rng.integers(0, len(pieces), 5000), rng.integers(0, len(pieces), 5000)
        assert fst.tables.allowed(left, right).tolist() == [fst.allowed(pieces[a], pieces[b]) for a, b in zip(left, right)]


def test_lookup_of_numbers():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 40, 5000))
    held = piece_fst.Lookup(keys, np.arange(len(keys), dtype=np.int32))
    asked = np.concatenate([keys, rng.integers(0, 1 << 40, 5000)])
    known = dict(zip(keys.tolist(), range(len(keys))))
    assert held(asked).tolist() == [known.get(k, -1) for k in asked.tolist()]


# ---------------------------------------------------------------- 5


def test_template_language():
    render = chat_template.compile_template
    assert render("a{{ 1 + 2 * 3 }}{{ 'x' ~ none }}")({}) == ("a7x", [])
    assert render("{% if x == 1 %}one{% elif x in [2] %}{% else %}other{% endif %}".replace("[2]", "xs"))({"x": 2, "xs": [2]})[0] == ""
    loop = "{% for t in ts %}{% if not loop.first %}, {% endif %}{{ t.a | upper }}{% endfor %}"
    assert render(loop)({"ts": [{"a": "p"}, {"a": "q"}]})[0] == "P, Q"
    text, spans = render("<{% generation %}{{ a }}{% endgeneration %}>{% set b = a %}{{ b if b else '-' }}")({"a": "xy"})
    assert (text, spans) == ("<xy>xy", [(1, 3)])
    folded = chat_template.fold(chat_template.parse("a{% if 1 < 2 %}b{{ 'c' | upper }}{% else %}d{% endif %}e"))
    assert folded == (chat_template.Emit(chat_template.Const("abCe")),)
    # the sandbox: attributes of Python objects do not exist, nor do calls and unknown filters
    assert render("{{ a.__class__ }}{{ a['__len__'] }}")({"a": "s"})[0] == ""
    for bad in ("{{ open('x') }}", "{{ a | eval }}", "{% include x %}", "{% if x %}", "{{ 1 + }}", "{% for x y %}{% endfor %}"):
        with pytest.raises(chat_template.TemplateError):
            render(bad)


def test_escapes_are_reversible():
    for text in ("</s>[INST] ok [/INST]", "\\<s>", "\\\\a", "\\a[END]\\", "<s", "[[INST]]", ""):
        escaped = chat_template.escape(text)
        assert chat_template.unescape(escaped) == text
        assert not any(c in escaped for c in chat_template.CONTROLS)


@pytest.mark.parametrize("part_chars", [40, 1_000_000])
def test_conversations_read_back(spark, part_chars):
    rows = [
        (1, 0, "user", "hi [INST]"),
        (1, 1, "assistant", "</s> yes \\ no"),
        (1, 2, "assistant", None),
        (1, 2, "assistant", None),
        (1, None, None, "first [END]"),
        (2, 0, "to[/ROLE]ol", ""),
        (None, 0, "user", "x" * 50),
        (3, 5, "assistant", "é\n日 "),
        *((4, k, ("user", "assistant")[k % 2], f" text {k} ") for k in range(30)),
    ]
    turns = spark.createDataFrame([(*r, "own") for r in rows], "conv_id long, turn long, role string, text string, part string").repartition(4)
    got = {r.conv_id: r for r in chat_template.read_back(chat_template.format_conversations(turns, part_chars=part_chars)).collect()}
    assert len(got) == 5
    for conv in (1, 2, 3, 4, None):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat_template.read_back(chat_template.format_conversations(turns.where("false"))).count() == 0


# ---------------------------------------------------------------- 6


def brute_base(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if twice[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality(spark, odd, odd_rows, none):
    got = rows_of(line_quality.quality(odd))
    want = sorted(((i, *brute_base(t)) for i, t, *_ in odd_rows), key=str)
    assert sorted(((r.doc_id, *(r[c] for c in line_quality.BASE)) for r in got), key=str) == want
    for r in got:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed)
    assert line_quality.quality(none).count() == 0


def test_boilerplate_lines(spark):
    own = [" ".join(prose(100 + k, 60)) for k in range(6)]
    rows = [(k, f"{own[k]}\n  Common   LINE {'here ' * 30}\ncommon line {'here ' * 30}", "en", "h", 1) for k in range(5)]
    rows += [(5, f"{own[5]}\ncommon line {'here ' * 30}", "en", "other", 1)]
    rows += [(k, f"{' '.join(prose(50, 60))}\ncopied", "en", "h", 1) for k in range(10, 20)]  # copies count once
    out = {r.doc_id: r for r in line_quality.quality(spark.createDataFrame(rows, DOCS), max_repeat_percent=100, max_line_documents=4).collect()}
    assert [out[k].removed_words for k in (0, 5, 10)] == [64, 0, 0]
    assert [out[k].kept for k in (0, 5, 10)] == [False, True, True]
    assert out[0].clean_text == own[0] and out[5].clean_text == rows[5][1]


# ---------------------------------------------------------------- 7


def brute_repeats(rows):
    tag = lambda t: int.from_bytes(hashlib.md5((t or "").encode()).digest()[:4], "big")
    order = sorted({(i, t or "") for i, t, *_ in rows}, key=lambda r: (r[0] is None, r[0] or 0, tag(r[1])))
    seen, out = set(), {}
    for i, t in order:
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - 99):
            w = raw[k : k + 100]
            if w in seen:
                gone[k : k + 100] = True
            seen.add(w)
        left = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out[i, t] = (len(raw), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(left).hexdigest())
    return out


@pytest.mark.parametrize("many", [1, 1000])
def test_repeats(spark, odd, odd_rows, none, many, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MANY", many)
    want = brute_repeats(odd_rows)
    got = suffix_dedup.remove_repeats(odd).collect()
    assert len(got) == len(odd_rows) and got[0].digest == "own"
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id, r.text or ""]
        assert r.kept_text == r.kept_bytes.decode("utf-8", "ignore")
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_repeats_over_the_test_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = brute_repeats(rows)
    for r in LLM_QUERIES["op7_suffix_array_dedup"](spark, sf).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == next(v for (i, _), v in want.items() if i == r.doc_id)


def test_repeats_in_texts_over_4_mib(spark):
    rng = np.random.default_rng(21)
    long = rng.integers(97, 123, 4_600_000, np.uint8)
    piece = suffix_dedup.PIECE
    long[4_400_000:4_400_400] = long[700:1100]
    long[3 * piece - 150 : 3 * piece + 150] = long[4_300_000:4_300_300]  # over the edge of two parts
    text = long.tobytes().decode()
    rows = [(1, text), (2, "x" + text[4_299_900:4_300_500] + "y"), (3, text[4_250_000:4_250_150])]
    want = brute_repeats(rows)
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == {(i, *want[i, t]) for i, t in rows}
    assert want[1, text][1] >= 700


def test_every_window_lies_in_one_part():
    for n in (0, 99, 100, 101, suffix_dedup.PIECE + 99, suffix_dedup.PIECE + 100, 5 * suffix_dedup.PIECE + 7):
        windows = [w for a, b in suffix_dedup.parts_of(7, 7 + n) for w in (a, b - 99)]
        assert windows[0] == 7 and windows[1:-1:2] == windows[2::2] and windows[-1] == 7 + n - 99


def test_suffix_arrays():
    rng = np.random.default_rng(0)
    for _ in range(150):
        text = np.append(rng.integers(0, rng.integers(1, 6), rng.integers(1, 90)), 0).astype(np.uint8)
        order = suffix_dedup.suffix_array(text, 104)
        key = [(text[i:].tobytes() + b"\0" * 104)[:104] for i in range(len(text))]
        assert sorted(order.tolist()) == list(range(len(text)))
        assert [key[i] for i in order] == sorted(key)
        prefixes = suffix_dedup.common_prefixes(text, order, 104)
        for k in range(1, len(text)):
            a, b = key[order[k - 1]], key[order[k]]
            assert prefixes[k] == next((i for i in range(104) if a[i] != b[i]), 104)


# ---------------------------------------------------------------- 8


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    out = LLM_QUERIES["op8_toxicity"](spark, sf).collect()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(out) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    held = [(r.score, r.predicted, toxic[r.doc_id]) for r in out if r.held_out and r.doc_id in toxic]
    assert sum(p == t for _, p, t in held) / len(held) >= 0.9
    good = [s for s, _, t in held if t]
    bad = [s for s, _, t in held if not t]
    assert np.mean([g > b for g in good for b in bad]) > 0.85


def slow_score(model, ids, offsets):
    """Convolution and pooling word by word."""
    out = []
    for first, last in zip(offsets, offsets[1:]):
        vectors = model.table[ids[first:last]].sum(axis=1)
        features = []
        for w, bias in zip(model.filters, model.biases):
            for f in range(w.shape[2]):
                windows = [sum(float(vectors[i + k] @ w[k, :, f]) for k in range(len(w)) if i + k < len(vectors)) for i in range(len(vectors))]
                features.append(max([0.0, *(x + float(bias[f]) for x in windows)]) if windows else 0.0)
        out.append(1 / (1 + math.exp(-(model.scale * (np.dot(features, model.out) + model.offset) + model.shift))))
    return np.array(out)


def small_net(seed=0):
    rng = np.random.default_rng(seed)
    sizes = np.array([0, 1, 2, 3, 9, 30, 0, 5])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    ids = rng.integers(0, 40, (offsets[-1], 2)).astype(np.int32)
    filters = [rng.normal(0, 0.5, (w, toxicity.DIMENSIONS, toxicity.FILTERS)) for w in toxicity.WIDTHS]
    biases = [rng.normal(0, 0.2, toxicity.FILTERS) for _ in toxicity.WIDTHS]
    out = rng.normal(0, 0.5, len(toxicity.WIDTHS) * toxicity.FILTERS)
    return toxicity.Model(rng.normal(0, 0.5, (40, toxicity.DIMENSIONS)), filters, biases, out, 0.3, 1.2, -0.4), ids, offsets


def test_toxicity_score_by_brute_force():
    model, ids, offsets = small_net()
    assert np.allclose(toxicity.raw(model, model.taps(), ids, offsets), slow_score(model, ids, offsets), atol=1e-5)


def test_toxicity_gradients_by_differences(monkeypatch):
    model, ids, offsets = small_net(1)
    monkeypatch.setattr(toxicity, "taps", lambda t, fs: np.concatenate([t @ step for w in fs for step in w], axis=1))
    pool = toxicity.pooled
    monkeypatch.setattr(toxicity, "pooled", lambda *a, **k: tuple(x if x is None or x.dtype != np.float32 else x.astype(float) for x in pool(*a, **k)))
    labels = np.array([0, 1, 0, 1, 1, 0, 1, 0], float)
    parts = [model.table, *model.filters, *model.biases, model.out]
    n = len(model.filters)

    def loss(parts, offset):
        net = toxicity.Model(parts[0], parts[1 : 1 + n], parts[1 + n : 1 + 2 * n], parts[-1], offset)
        p = slow_score(net, ids, offsets)
        return float(-np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p)) + 5e-5 * (parts[-1] ** 2).sum())

    got, by_offset = toxicity.gradients(model.table, model.filters, model.biases, model.out, model.offset, ids, offsets, labels)
    rng = np.random.default_rng(2)
    assert abs(by_offset - (loss(parts, model.offset + 1e-5) - loss(parts, model.offset - 1e-5)) / 2e-5) < 1e-6
    for k, part in enumerate(parts):
        for _ in range(12):
            at = tuple(rng.integers(0, s) for s in part.shape)
            moved = []
            for step in (1e-5, -1e-5):
                other = [x.copy() for x in parts]
                other[k][at] += step
                moved.append(loss(other, model.offset))
            assert abs(got[k][at] - (moved[0] - moved[1]) / 2e-5) < 1e-6


def test_toxicity_with_a_language_of_one_class():
    rng = np.random.default_rng(3)
    n = 600
    offsets = np.arange(n + 1) * 3
    ids = rng.integers(0, 500, (3 * n, 2)).astype(np.int32)
    langs = np.array(["all", "mixed", "none"])[np.arange(n) % 3]
    toxic = np.where(langs == "all", 1, np.where(langs == "none", 0, (np.arange(n) // 3) % 2))
    model = toxicity._calibrated(ids, offsets, toxic, langs, np.arange(n) // 3 % 3 == 0)
    assert set(model.thresholds) == {"mixed"}


def toxic_corpus(n=200):
    rows, labels = [], []
    for k in range(n):
        words = prose(1000 + k, 60)
        if k % 4 == 0:
            words[k % 50], words[(k * 3) % 50] = ("vilest", "scornful")[k % 8 == 0], "wretch,"
        rows.append((k, " ".join(words), "en", "a", 1))
        labels.append((k, 1, int(k % 4 == 0)))
    return rows, labels


def test_toxicity_learns_from_every_labelled_row(spark):
    """Each text has a word of its own, and the weights of all these words move."""
    n = 5300
    docs = spark.createDataFrame([(k, f"own{k} {'vile' if k < 300 else 'mild'} word", "en") for k in range(n)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k < 300)) for k in range(n)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, held_out=None)
    begun = np.random.default_rng(7).normal(0, 0.1, (toxicity.BUCKETS, toxicity.DIMENSIONS)).astype(np.float32)
    column = toxicity.bare(pa.array([f"own{k}" for k in range(n)]))
    own = np.concatenate([toxicity.bucket_ids(piece)[:, 0] for piece in toxicity.pieces(column)])
    assert len(own) == n and (np.abs(model.table[own] - begun[own]).max(axis=1) > 1e-6).all()
    out = toxicity.score(docs, model).collect()
    assert sum(r.predicted == (r.doc_id < 300) for r in out) >= 0.99 * n


def test_toxicity_in_shards(spark, none):
    rows, labels = toxic_corpus(400)
    docs = spark.createDataFrame(rows + [(1000, rows[4][1], "de", "a", 1)], DOCS)  # a text twice, with both labels
    marks = spark.createDataFrame([*labels, (1000, 1, 0)], "doc_id long, quality int, toxic int").select("doc_id", "toxic")
    found = toxicity._labelled(docs, marks, None, 7).cache()
    assert {(r.doc_id, r.toxic) for r in found.collect()} == {(k, t) for k, _, t in labels}
    assert found.select("part").distinct().count() == 7
    parted = found.repartition(3, "part").sortWithinPartitions("part", "key")
    ids, offsets = toxicity._unpacked(found.sort("doc_id").toArrow().column("ids"))
    holders, toxic, n = toxicity._count_shards(parted, False)
    assert (toxic, n) == (100, 400) and (holders == toxicity._holders(ids, offsets, np.array([t for *_, t in labels]))).all()
    model = toxicity.train(docs, marks, held_out=5, local_rows=0, shard_rows=60)
    again = toxicity.train(docs.repartition(5), marks, held_out=5, local_rows=0, shard_rows=60)
    assert (model.table == again.table).all() and model.shift == again.shift
    held = [r for r in toxicity.score(docs, model).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.doc_id < 400]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) / len(held) > 0.9
    steps = np.random.default_rng(5).random(300).round(2)
    marked = (np.random.default_rng(6).random(300) < steps).astype(int)
    values, where = np.unique(steps, return_inverse=True)
    assert toxicity._f1_cut(values, np.bincount(where, marked), np.bincount(where)) == toxicity._f1_cut(steps, marked)
    empty = toxicity.train(none, marks, local_rows=0)
    assert toxicity.score(docs, empty).where("score between 0 and 1").count() == 401


def test_toxicity_sees_only_the_text(spark, odd, none):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame(rows, DOCS)
    marks = spark.createDataFrame([*labels, (None, 1, 1), (1, None, None), (2, 0, 7), (5, 1, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, marks, held_out=5)
    out = toxicity.score(docs, model).collect()
    held = [r for r in out if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) / len(held) > 0.9
    changed = docs.selectExpr("doc_id + 7 as doc_id", "text", "'zz' as lang", "'q' as source", "n_chars")
    assert {r.doc_id: r.score for r in out} == {r.doc_id - 7: r.score for r in toxicity.score(changed, model).collect()}
    strange = toxicity.score(odd, model)
    assert strange.count() == odd.count() and strange.where("score is null or isnan(score)").count() == 0
    assert strange.columns == [c for c in odd.columns if c != "score"] + ["score", "predicted", "rejected"]
    assert toxicity.score(none, model).count() == 0
    flat = toxicity.train(docs, marks.where("false"))
    assert {round(r.score, 6) for r in toxicity.score(docs, flat).collect()} == {0.5}


# ---------------------------------------------------------------- 9


def brute_scores(rows, fold=10):
    words = [WORD.findall(lower(t)) for _, t, *_ in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % fold == 0 for i, *_ in rows]
    unigrams, pairs = Counter(), Counter()
    for w, h in zip(words, held):
        if not h:
            unigrams.update([*w, None])
            pairs.update(zip(["<", *w], [*w, None]))
    total, kinds = sum(unigrams.values()), len(unigrams)
    chance = lambda w: math.log10((unigrams[w] + 0.1) / (total + 0.1 * (kinds + 1)))
    context, after = Counter(), Counter()
    for (a, _), n in pairs.items():
        context[a] += n
        after[a] += 1
    out = []
    for w, h in zip(words, held):
        score = 0.0
        for a, b in zip(["<", *w], [*w, None]):
            if pairs[a, b]:
                score += math.log10((pairs[a, b] - 0.75) / context[a])
            else:
                score += chance(b) + (min(0, math.log10(0.75 * after[a] / context[a])) if context[a] else 0)
        tokens = [*w, None]
        out.append((h, len(tokens), sum(unigrams[x] > 0 for x in tokens), total, sum(map(chance, tokens)), score))
    return out


def check_scores(rows, got, tolerance):
    got = {(r.doc_id, r.n_tokens): r for r in got}
    for (i, *_), (held, n, known, total, base, score) in zip(rows, brute_scores(rows)):
        r = got[i, n]
        assert (r.held_out, r.n_known, r.train_tokens) == (held, known, total)
        assert r.base_score == pytest.approx(base, abs=1e-6)
        assert abs(r.score - score) <= tolerance * n


def test_lm_scores(spark, sf, odd, odd_rows, none):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = LLM_QUERIES["op9_lm_scoring"](spark, sf).collect()
    check_scores(rows, got, 0.03)  # codes of 1/2048, slices of frequent contexts
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    strange = ngram_lm.score_corpus(odd).collect()
    assert len(strange) == len(odd_rows)
    check_scores(odd_rows, strange, 0.5)
    assert ngram_lm.score_corpus(none).count() == 0


def test_lm_with_many_shards_and_nothing_to_learn(spark, odd, odd_rows, monkeypatch):
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 20_000)
    check_scores(odd_rows, ngram_lm.score_corpus(odd).collect(), 0.5)
    only = [r for r in [(10, "a b c", "en", "s", 5)] if zlib.crc32(b"10") % 10 == 0] or [(k, "a b", "en", "s", 3) for k in range(300) if zlib.crc32(str(k).encode()) % 10 == 0][:3]
    out = ngram_lm.score_corpus(spark.createDataFrame(only, DOCS)).collect()
    assert len(out) == len(only)
    assert all((r.n_known, r.train_tokens) == (0, 0) and math.isfinite(r.score) and math.isfinite(r.base_score) for r in out)


@pytest.mark.parametrize("shard", [12 << 20, 2_000])
def test_lm_back_off_counts_every_successor(spark, shard, monkeypatch):
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", shard)
    rng = np.random.default_rng(5)
    rows = []
    for k in range(300):
        words = [w for x in rng.integers(0, 40, 30) for w in ("often", f"next{x % 3}", f"w{x}")]
        held = zlib.crc32(str(k).encode()) % 10 == 0
        extra = ["often", f"w{k % 40}", "often", f"new{k}"] if held else []
        rows.append((k, " ".join(["the", *words, *extra, *["same"] * 30] if k % 2 else [*extra, *words])))
    got = ngram_lm.score_corpus(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for (i, _), (held, n, known, total, base, score) in zip(rows, brute_scores(rows)):
        r = by_id[i]
        assert (r.n_tokens, r.n_known, r.held_out, r.train_tokens) == (n, known, held, total)
        assert abs(r.base_score - base) < 1e-6 and abs(r.score - score) <= 0.0005 * n


def test_lm_slices_follow_the_size_of_a_shard():
    rng = np.random.default_rng(6)
    context, word = np.full(90_000, 77, np.uint64), ngram_lm.mix(rng.integers(0, 1 << 60, 90_000).astype(np.uint64))
    places, sizes = np.unique(ngram_lm._place(context, word, np.array([5, 77], np.uint64), np.array([1, 600])), return_counts=True)
    assert len(places) == 600 and sizes.max() < 250


def test_elias_fano():
    rng = np.random.default_rng(3)
    for top, n in ((5, 40), (1 << 20, 3000), (1 << 62, 500), (1 << 30, 1), (10, 0)):
        values = np.sort(rng.integers(0, top, n).astype(np.uint64))
        held = ngram_lm.Monotone.build(values)
        read, rest = ngram_lm.Monotone.read(np.concatenate(held.parts()))
        assert not len(rest)
        assert (read.get(np.arange(n)) == values).all()
        asked = np.concatenate([values, rng.integers(0, top + 5, 200).astype(np.uint64)])
        assert (read.successor(asked) == np.searchsorted(values, asked)).all()


def test_trie():
    contexts = np.array([4, 10, 1 << 60], np.uint64)
    sizes = np.array([2, 0, 3])
    words = np.array([7, 9, 1, 9, 1 << 39], np.uint64)
    logs = -np.arange(5) / 4
    trie = ngram_lm.Trie.mapped(ngram_lm.Trie.pack(contexts, sizes, words, -np.ones(3), logs))
    assert trie.nodes(np.array([4, 6, 10, 1 << 60, 1 << 61], np.uint64)).tolist() == [0, -1, 1, 2, -1]
    found = trie.pairs(np.array([0, 0, 1, 2, 2, -1, 2]), np.array([9, 8, 9, 9, 1 << 39, 7, 7], np.uint64))
    assert found.tolist() == [1, -1, -1, 3, 4, -1, -1]
    assert ngram_lm.decode_log(trie.codes[found[found >= 0]]).tolist() == [-0.25, -0.75, -1.0]


# ---------------------------------------------------------------- 10


def test_fuzzy_passages(spark, odd, none):
    passage = prose(7, 120)
    edited = [w if k % 25 else f"edit{k}" for k, w in enumerate(passage)]
    del edited[60:63]
    edited[90:90] = ["put", "in"]
    rows = [
        (1, " ".join(prose(11, 100) + passage + prose(12, 80)), "en", "a", 1),
        (2, " ".join(prose(13, 40) + edited + prose(14, 60)), "en", "a", 1),
        (3, " ".join(prose(15, 30) + passage[20:100]), "en", "a", 1),
        (4, " ".join(prose(16, 400)), "en", "a", 1),
        (5, " ".join(prose(17, 30) + passage[:20] + prose(18, 30)), "en", "a", 1),
        (6, " ".join(prose(16, 400)), "en", "a", 1),
        (7, " ".join(prose(19, 90) * 2), "en", "a", 1),
    ]
    got = {(r.doc_id, r.other_id): r for r in chain_dedup.fuzzy_passages(spark.createDataFrame(rows, DOCS)).collect()}
    assert set(got) == {(2, 1), (3, 1), (6, 4)}
    assert got[3, 1][2:] == (30, 80, 120, 80, 80)
    r = got[2, 1]
    assert r.n_equal >= 108 and abs(r.n_words - 119) <= 4 and abs(r.start_word - 40) <= 4 and abs(r.other_start - 100) <= 4
    assert got[6, 4][2:] == (0, 400, 0, 400, 400)
    strange = {(r.doc_id, r.other_id) for r in chain_dedup.fuzzy_passages(odd).collect()}
    assert strange == {(11, 10), (12, 10)}
    assert chain_dedup.fuzzy_passages(none).count() == 0


def test_periodic_text_sends_few_seeds(spark):
    hashes = np.tile(np.array([11, 22], np.uint64), 5000)
    run, doc, place = chain_dedup.seeds(hashes, np.array([0, 6000, 10_000]))
    assert len(run) == len(set(zip(run.tolist(), doc.tolist()))) <= 4 and (place < 20).all()
    words = prose(30, 60)
    rows = [(1, " ".join(["tick tock"] * 300 + words)), (2, " ".join(words + ["tick tock"] * 200)), (3, " ".join(prose(31, 100)))]
    got = chain_dedup.fuzzy_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.other_id) for r in got} == {(2, 1)}
    # the prose, and the periodic text that both documents share as well
    assert max(r.n_words for r in got if r.start_word < 10) >= 60 and max(r.n_words for r in got if r.start_word >= 55) >= 40


def test_chains_are_the_best_by_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(60):
        pairs = sorted({(int(x), int(y)) for x, y in rng.integers(0, 60, (12, 2))})
        xs, ys = zip(*pairs)
        best = {}
        for i, (x, y) in enumerate(pairs):  # best score of a chain that ends in each match
            best[i] = float(chain_dedup.SEED)
            for j in range(i):
                dx, dy = x - xs[j], y - ys[j]
                if dx > 0 and dy > 0:
                    best[i] = max(best[i], best[j] - chain_dedup.GAP_COST * (dx + dy) + min(chain_dedup.SEED, dx, dy))
        x, x_last, y, y_last = chain_dedup.chains(xs, ys)[0]
        top = max(best.values())
        ends = {(xs[i], ys[i]) for i in best if best[i] >= top - 2 * chain_dedup.SEED}
        assert (x_last, y_last) in ends and x <= x_last and y <= y_last


def test_alignment_bridges_edits():
    one = np.arange(100, dtype=np.uint32)
    other = np.concatenate([one[5:40], [900], one[41:60], one[64:100], [901, 902]]).astype(np.uint32)
    a, b, c, d, equal = chain_dedup.align(one, other, 50, 45)
    assert (a, b, c, d, equal) == (5, 100, 0, 91, 90)


def test_a_chain_is_aligned_to_its_end(spark):
    copy, halves = prose(40, 1000), prose(41, 100)
    rows = [
        (1, " ".join(copy)),
        (2, " ".join(copy[:200] + prose(42, 40) + copy[200:])),
        (3, " ".join(copy[:30] + prose(43, 40) + copy[30:])),
        (4, " ".join(halves)),
        (5, " ".join(halves[:50] + prose(44, 28) + halves[50:])),
    ]
    got = chain_dedup.fuzzy_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    equal = Counter()
    for r in got:
        assert r.n_words >= 40 and r.n_equal >= 0.8 * max(r.n_words, r.other_words)
        equal[r.doc_id, r.other_id] += r.n_equal
    assert set(equal) == {(2, 1), (3, 1), (5, 4)}
    assert equal[2, 1] >= 995 and equal[3, 1] >= 965 and equal[5, 4] >= 96


def test_passages_are_the_longest_by_brute_force():
    rng = np.random.default_rng(8)
    for _ in range(100):
        runs, i, j = [], 0, 0
        for n in rng.integers(1, 30, 9).tolist():
            runs.append((i, j, n))
            i, j = i + n + int(rng.integers(0, 9)), j + n + int(rng.integers(0, 9))
        whole = []
        for p in range(9):
            for q in range(p + 1, 10):
                a, b, c, d, equal = chain_dedup._span(runs[p:q])
                if b - a >= 40 and equal >= 0.8 * max(b - a, d - c):
                    whole.append(b - a)
        got = list(chain_dedup.passages(runs))
        assert max((b - a for a, b, *_ in got), default=0) == max(whole, default=0)
        assert all(b - a >= 40 and e >= 0.8 * max(b - a, d - c) for a, b, c, d, e in got)


def test_whole_passages_meet_past_holders_of_their_halves(spark):
    """Documents 1 and 2 hold words 1-35 and 16-50 of a passage, 3 and 4 hold it whole: they are found with each other."""
    for seed in range(3):
        words = prose(50 + seed, 50)
        parts = [words[:35], words[15:], words, words]
        rows = [(i + 1, " ".join(prose(60 + seed * 10 + i, 90) + part + prose(80 + seed * 10 + i, 70))) for i, part in enumerate(parts)]
        got = {(r.doc_id, r.other_id): r.n_words for r in chain_dedup.fuzzy_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got.get((4, 3), 0) >= 50


def joined_docs(got):
    parent = {}
    for r in got:
        a, b = (groups.find(parent, parent.setdefault(x, x)) for x in (r.doc_id, r.other_id))
        parent[max(a, b)] = min(a, b)
    return {x: groups.find(parent, x) for x in parent}


@pytest.mark.parametrize("block", [1000, 3])
def test_holders_past_the_first_meet(spark, monkeypatch, block):
    """Documents 1 and 2 hold the one stretch that later ones share without edits, so all its keys are first held by them."""
    monkeypatch.setattr(chain_dedup, "BLOCK", block)
    rows = []
    for seed in range(6):
        words = prose(200 + seed, 50)
        changed = [w if k < 25 or (k - 25) % 6 else f"{w}{k}" for k, w in enumerate(words)]
        parts = [words[:25], words, changed]
        rows += [(10 * seed + k, " ".join(prose(300 + 10 * seed + k, 60) + part + prose(400 + 10 * seed + k, 60))) for k, part in enumerate(parts)]
        # many more holders of the first words alone
        rows += [(10 * seed + k, " ".join(prose(500 + 10 * seed + k, 60) + words[:25] + prose(600 + 10 * seed + k, 60))) for k in range(3, 8)]
    got = chain_dedup.fuzzy_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {(r.doc_id, r.other_id) for r in got} == {(10 * s + 2, 10 * s + 1) for s in range(6)}
    assert len(joined_docs(got)) == 12 and all(r.n_words >= 40 and r.n_equal >= 40 for r in got)


@pytest.mark.parametrize("block, blocks", [(1000, 4), (3, 4), (3, 0)])
def test_a_passage_elsewhere_joins_no_place_of_a_key(spark, monkeypatch, block, blocks):
    """As above, but the two documents also share a notice, over which they are joined: the other passage is found all the same."""
    monkeypatch.setattr(chain_dedup, "BLOCK", block)
    monkeypatch.setattr(chain_dedup, "BLOCKS", blocks)
    rows = []
    for seed in range(4):
        words, notice = prose(200 + seed, 50), prose(700 + seed, 60)
        changed = [w if k < 25 or (k - 25) % 6 else f"{w}{k}" for k, w in enumerate(words)]
        parts = [words[:25], words + prose(720 + seed, 60) + notice, notice + prose(740 + seed, 60) + changed]
        rows += [(10 * seed + k, " ".join(prose(300 + 10 * seed + k, 60) + part + prose(400 + 10 * seed + k, 60))) for k, part in enumerate(parts)]
        rows += [(10 * seed + k, " ".join(prose(500 + 10 * seed + k, 60) + words[:25] + prose(600 + 10 * seed + k, 60))) for k in range(3, 8)]
    got = chain_dedup.fuzzy_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.doc_id, r.other_id, r.start_word // 60) for r in got) == [(10 * s + 2, 10 * s + 1, part) for s in range(4) for part in (1, 3)]


def test_every_place_of_the_first_holder_is_compared(spark):
    """Document 1 holds the first words of a passage alone, then the whole passage; no other key of the passage is in document 2."""
    words = prose(200, 50)
    changed = [w if k < 25 or (k - 25) % 6 else f"{w}{k}" for k, w in enumerate(words)]
    parts = [words[:25], words[:25] + prose(801, 60) + words, changed]
    rows = [(k, " ".join(prose(810 + k, 60) + part + prose(820 + k, 60))) for k, part in enumerate(parts[1:], 1)]
    got = chain_dedup.fuzzy_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.other_id) for r in got] == [(2, 1)] and got[0].other_start >= 140


def test_windows_with_a_passage_share_a_rare_word():
    rng = np.random.default_rng(10)
    held = [rng.integers(0, int(rng.choice([30, 10**6])), 86).astype(np.uint32) for _ in range(40)]
    held += [np.where(rng.random(86) < rng.choice([0.1, 0.3, 0.6]), rng.integers(0, 10**6, 86), w).astype(np.uint32) for w in held]
    row, counted = chain_dedup._counted(np.concatenate(held), np.repeat(np.arange(80), 86))
    ends = np.searchsorted(row, np.arange(81))
    at, rare = chain_dedup.rarest(row, counted, ends, rng.integers(0, 9, chain_dedup.COUNTERS))
    own, sets = [set(rare[at == k].tolist()) for k in range(80)], [set(counted[row == k].tolist()) for k in range(80)]
    enough = {(i, j) for i in range(80) for j in range(i + 1, 80) if len(sets[i] & sets[j]) >= chain_dedup.LEAST}
    assert len(enough) >= 20 and all(own[i] & own[j] for i, j in enough)
    pairs = chain_dedup._pairs(np.array([0, 30]), np.array([30, 80]))
    inside = {(i, j) for i, j in enough if (i < 30) == (j < 30)}
    assert set(chain_dedup._close(row, counted, ends, pairs)) == inside


def test_no_passage_where_the_alignment_cannot_go_on():
    rng = np.random.default_rng(11)
    words, place = [], []
    for _ in range(60):
        own = rng.integers(0, int(rng.choice([20, 10**6])), 86).astype(np.uint32)
        first, stop = rng.integers(0, 36), rng.integers(50, 87)
        end = int(rng.choice([48, 60]))
        own[10:end] = np.where(rng.random(end - 10) < rng.choice([0, 0.08]), own[10:end], np.arange(10**7 + 10, 10**7 + end))
        own[40:46] = np.arange(6)
        own[46:85] = np.delete(own[46:86], rng.integers(0, 14))
        words, place = [*words, own[first:stop]], [*place, 40 - first]
    i, j = np.triu_indices(60, 1)
    good = chain_dedup.extensible(chain_dedup._around(words, np.array(place)), i, j)
    held = [any(True for _ in chain_dedup.passages(chain_dedup.equal_runs(words[a], words[b], [(place[a], place[b])]))) for a, b in zip(i, j)]
    assert 20 < sum(held) and not (np.array(held) & ~good).any() and good.sum() < 0.9 * len(good)


def test_windows_with_a_passage_are_alike():
    rng = np.random.default_rng(9)
    for trial in range(60):
        vocabulary = int(rng.choice([3, 30, 10**6]))
        one = rng.integers(0, vocabulary, 120).astype(np.uint64)
        other = one.copy()
        edits = rng.choice(120, 20, False)
        edits = edits[(edits < 50) | (edits >= 56)]
        other[edits] = rng.integers(0, vocabulary, len(edits))
        stretches = [(a, a + 40) for a in range(16, 51) if (one[a : a + 40] == other[a : a + 40]).sum() >= 32]
        hashes, offsets = np.concatenate([one, other]), np.array([0, 120, 240])
        bounds = chain_dedup._least_shared(hashes, offsets, np.array([50, 170]))
        pair = [x[10:96].astype(np.uint32) for x in (one, other)]
        if stretches:
            assert list(chain_dedup.alike(pair, bounds, np.ones((2, 2), bool))) == [(0, 1)]


def test_a_recurring_notice_is_found_every_time(spark):
    notice = prose(90, 45)
    many = [w for k in range(8) for w in notice + prose(91 + k, 15)]
    rows = [(1, " ".join(prose(99, 60) + notice)), (2, " ".join(many))]
    got = chain_dedup.fuzzy_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got} == {2}
    places = sorted(r.start_word for r in got)
    assert len(places) == 8 and all(abs(p - 60 * k) <= 1 for k, p in enumerate(places))


def test_copies_name_the_smallest_doc_id_in_any_order(spark):
    text = " ".join(prose(7, 60))
    for ids in ([9, 3, 5], [3, 9, 5], [5, 9, 3]):
        got = chain_dedup.fuzzy_passages(spark.createDataFrame([(i, text) for i in ids], "doc_id long, text string").coalesce(1)).collect()
        assert sorted((r.doc_id, r.other_id) for r in got) == [(5, 3), (9, 3)]


@pytest.mark.parametrize("length, edits", [(50, 0.05), (50, 0.10), (50, 0.15), (50, 0.20), (80, 0.10), (80, 0.15), (80, 0.20)])
def test_recall_of_edited_passages(spark, length, edits):
    """Planted passages whose brute-force alignment has 40 words with a share of 0.8: nine in ten are found at least."""
    rng = np.random.default_rng(int(length * 1000 + edits * 100))
    rows, planted = [], set()
    for k in range(60):
        one, other = rng.integers(0, 10**9, 200), rng.integers(0, 10**9, 200)
        part = one[60 : 60 + length].copy()
        changed = rng.random(length) < edits
        part[changed] = rng.integers(0, 10**9, changed.sum())
        other[90 : 90 + length] = part
        if any((~changed[i:j]).sum() >= 0.8 * (j - i) for i in range(length) for j in range(i + 40, length + 1) if not changed[i] and not changed[j - 1]):
            planted.add((2 * k + 1, 2 * k))
        rows += [(2 * k, " ".join(map(str, one))), (2 * k + 1, " ".join(map(str, other)))]
    got = {(r.doc_id, r.other_id) for r in chain_dedup.fuzzy_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got <= {(2 * k + 1, 2 * k) for k in range(60)}
    assert len(got & planted) >= 0.9 * len(planted) and len(planted) > 20
