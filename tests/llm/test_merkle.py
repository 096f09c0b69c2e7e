from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from loadtide.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return sha(*map(field, (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + 8]) for i in range(0, len(below), 8)])
    return levels


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        first = at // 8 * 8
        out.append((level[first:at], level[at + 1 : first + 8]))
        at //= 8
    return out


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[2] is not None, (r[2] or "").encode(), r[0] is not None, r[0] or 0, leaf(r, r[1])))
    langs = list(dict.fromkeys(r[2] for r in rows))
    trees = {x: tree([leaf(r, r[1]) for r in rows if r[2] == x]) for x in langs}
    crown = tree([trees[x][-1][0] for x in langs])
    root = crown[-1][0] if rows else None
    place = dict.fromkeys(langs, 0)
    out = []
    for r in rows:
        doc_id, text, lang = r[:3]
        steps = siblings(trees[lang], place[lang]) + siblings(crown, langs.index(lang))
        place[lang] += 1
        tampers = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        value = leaf(r, text.translate({c: c + 32 for c in range(65, 91)}) if tampers and text is not None else text)
        for left, right in steps:
            value = sha(*left, value, *right)
        proof = sha(*(d for left, right in steps for d in left + right))
        out.append((doc_id, leaf(r, text), trees[lang][-1][0], root, proof, value, value == root))
    return sorted(out, key=str)


def got(docs):
    return sorted((tuple(r) for r in merkle.manifest(docs).collect()), key=str)


def test_several_rounds_nulls_and_repeats(spark):
    rows = [(i, f"Text {i}" if i % 3 else f"text {i}", "en", "a", i) for i in range(4200)]
    rows += [(i, "Überlänge é " * 20, "de", None, None) for i in range(5000, 5071)]
    rows += [(9000, "Only One", "fr", "a", 1), (None, "No Id", "it", "a", 1), (None, None, None, None, None), (None, None, None, None, None)]
    rows += [(7, "Repeated", "en", "a", 7), (7, "Repeated", "en", "a", 7), (9001, "", None, "a", 0), (9002, "Long " * 50_000, None, "a", 0)]
    rows += [(10_000 + i, f"T{i}", f"lang {i:02}", "a", 0) for i in range(20)] + [(11_000, "X", "", "a", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    taken = ("key", "pos", "total", "digest", "changed", "root", "path", "part", "row")
    wide = docs.select("*", *(F.lit("own").alias(c) for c in taken)).repartition(5)
    assert got(wide) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, "A", "en", "a", 1)], [(1, "A", "en", "a", 1), (2, "B", None, "a", 1)]])
def test_small_tables(spark, rows):
    assert got(spark.createDataFrame(rows, DOCS)) == brute(rows)


def test_sweeps_of_a_block(monkeypatch):
    """Blocks of 64 leaves in three rounds, in plain Python."""
    monkeypatch.setattr(merkle, "LEVELS", 2)
    for n in (1, 2, 8, 9, 63, 64, 65, 72, 73, 600):
        digests = [sha(str(i)) for i in range(n)]
        levels, proofs = tree(digests), {}
        rounds, row = [], digests
        while True:
            rounds.append([merkle.forward(i, row[i : i + 64], len(row)) for i in range(0, len(row), 64)])
            row = [next(iter(block[-1].values())) for block in rounds[-1]]
            if len(row) == 1:
                break
        assert row == levels[-1]
        above = {0: []}
        for blocks in reversed(rounds):
            proofs = dict(p for i, block in enumerate(blocks) for p in merkle.backward(block, above[i]))
            above = proofs
        want = {i: [{"l": "".join(x), "r": "".join(y)} for x, y in siblings(levels, i)] for i in range(n)}
        assert proofs == want


def test_queue_stays_small(monkeypatch):
    longest = 0
    push = merkle.heapq.heappush

    def counted(queue, item):
        nonlocal longest
        push(queue, item)
        longest = max(longest, len(queue))

    monkeypatch.setattr(merkle.heapq, "heappush", counted)
    levels = merkle.forward(0, [sha(str(i)) for i in range(4096)], 4096)
    assert len(list(merkle.backward(levels, []))) == 4096
    assert longest <= merkle.FANOUT * merkle.LEVELS
