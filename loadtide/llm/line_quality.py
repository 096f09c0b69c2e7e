"""Quality rules with built-in functions only: repetition inside a document, boilerplate lines across the documents of a host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A line that more distinct documents of one host hold is boilerplate.
MAX_LINE_DOCUMENTS = 20
#: A document that keeps less than this share of its words is depleted.
MIN_KEPT_PERCENT = 50
SALTS = 16

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def split_words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _long(col: Column) -> Column:
    return col.cast("long")


def with_base(docs: DataFrame) -> DataFrame:
    """Adds the base figures of ``body`` (never null) as columns; every step is one pass over the words of the row."""
    size = F.size
    df = docs.withColumn("_words", split_words(F.col("body"))).withColumn(
        "_lines", F.filter(F.split("body", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    )
    df = df.withColumns(
        {
            "n_words": _long(size("_words")),
            "word_chars": _long(F.length(F.array_join("_words", ""))),
            "n_symbols": _long(F.length("body") - F.length(F.regexp_replace("body", SYMBOLS, ""))),
            "n_dup_lines": _long(size("_lines") - size(F.array_distinct("_lines"))),
            "_grams": F.expr(
                "if(size(_words) < 3, array(), transform(sequence(0, size(_words) - 3),"
                " i -> xxhash64(_words[i], _words[i + 1], _words[i + 2])))"
            ),
        }
    )
    # windows in order of their hash: equal ones are neighbours
    df = df.withColumn(
        "_sorted",
        F.expr(
            "if(size(array_distinct(_grams)) < size(_grams),"
            " array_sort(transform(_grams, (g, i) -> struct(g, i))), null)"
        ),
    )
    df = df.withColumn(
        "_places",
        F.expr(
            "array_sort(array_distinct(flatten(zip_with(_sorted, slice(_sorted, 2, size(_sorted)),"
            " (a, b) -> if(a.g = b.g, array(a.i, b.i), cast(array() as array<int>))))))"
        ),
    )
    # a window covers three words, or those up to the next repeated window
    df = df.withColumn(
        "n_repeat_words",
        F.expr(
            "coalesce(aggregate(zip_with(_places, slice(_places, 2, size(_places)),"
            " (a, b) -> least(3, coalesce(b - a, 3))), 0L, (s, x) -> s + x), 0L)"
        ),
    )
    return df.drop("_words", "_lines", "_grams", "_sorted", "_places")


def line_rows(docs: DataFrame) -> DataFrame:
    """One row per line with a word: place in its document, hash of host and normalised line, number of words."""
    lines = docs.select("doc_id", "digest", "source", F.posexplode(F.split("body", "\n")).alias("at", "line"))
    clean = F.lower(F.trim(F.regexp_replace("line", SPACE, " ")))
    lines = lines.withColumn("line", clean).where("line != ''")
    return lines.select(
        "doc_id",
        "digest",
        "at",
        F.xxhash64("source", "line").alias("key"),
        (F.length("line") - F.length(F.replace("line", F.lit(" "))) + 1).alias("words"),
    )


def quality(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    max_line_documents: int = MAX_LINE_DOCUMENTS,
    min_kept_percent: int = MIN_KEPT_PERCENT,
) -> DataFrame:
    """Base figures, boilerplate removal and verdict for each row of ``docs``.

    Returns doc_id, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, removed_words, kept, clean_text.

    A line is normalised (spaces joined, lower case) and hashed together with its host (``source``; rows without one
    share a host of their own). Documents of equal texts count as one, so copies do not turn prose into boilerplate. Lines that more than
    ``max_line_documents`` distinct documents of a host hold are removed; a document that keeps under ``min_kept_percent``
    of its words is rejected, and so is one with under ``min_words`` words or mostly repeated three-word windows.

    A null text is empty, and fails the base rule. Rows without doc_id are judged like others; repeated rows each get
    the same verdict. Other columns are not read. An empty table gives no rows. ``clean_text`` is null for a null text; leave it out of
    the selection and the texts are never shuffled.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"),
    ).withColumn("digest", F.xxhash64("body"))
    lines = line_rows(rows)
    holders = lines.groupBy("key", "digest").agg(F.lit(1).alias("one")).groupBy("key").agg(F.count("*").alias("holders"))
    common = holders.where(F.col("holders") > max_line_documents).select(
        "key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    salted = lines.withColumn("salt", F.pmod(F.hash("doc_id", "digest"), F.lit(SALTS)))
    hits = salted.join(common, ["key", "salt"]).groupBy("doc_id", "digest", "at").agg(F.max("words").alias("words"))
    removed = hits.groupBy("doc_id", "digest").agg(
        F.sum("words").alias("removed_words"), F.array_sort(F.collect_set("at")).alias("gone")
    )
    removed = removed.withColumnsRenamed({"doc_id": "r_id", "digest": "r_digest"})
    figures = with_base(rows)
    joined = figures.join(
        removed, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left"
    ).withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    depleted = 100 * (F.col("n_words") - F.col("removed_words")) < min_kept_percent * F.col("n_words")
    clean = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.expr("array_join(filter(split(text, '\\n'), (line, i) -> not array_contains(gone, i)), '\\n')")
    )
    return joined.select(
        "doc_id", "source", *BASE, failed.alias("base_failed"), "removed_words", (~failed & ~depleted).alias("kept"), clean.alias("clean_text")
    )


ORACLE_SQL = rf"""
with docs as (select doc_id, source, coalesce(text, '') as body from documents),
words as (
  select doc_id, unnest(ws) as w, generate_subscripts(ws, 1) as i
  from (select doc_id, regexp_extract_all(body, '[^\x20\x09-\x0D]+') as ws from docs)
),
counted as (select doc_id, count(*) as n_words, sum(length(w)) as word_chars from words group by doc_id),
windows as (
  select * from (
    select doc_id, i, w, lead(w) over o as w2, lead(w, 2) over o as w3 from words window o as (partition by doc_id order by i)
  ) where w3 is not null
),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, w, w2, w3) as n from windows) where n > 1),
repeated as (
  select doc_id, count(distinct p) as n_repeat_words
  from (select doc_id, i + unnest([0, 1, 2]) as p from twice) group by doc_id
),
lines as (
  select doc_id, source, hash(body) as digest, line,
    lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) as clean
  from (select doc_id, source, body, unnest(string_split(body, chr(10))) as line from docs)
  where regexp_matches(line, '[^\x20\x09-\x0D]')
),
line_figures as (
  select doc_id, count(*) - count(distinct line) as n_dup_lines from lines group by doc_id
),
common as (
  select source, clean from lines group by source, clean having count(distinct digest) > {MAX_LINE_DOCUMENTS}
),
removed as (
  select doc_id, sum(len(string_split(l.clean, ' '))) as removed_words
  from lines l join common c on l.source is not distinct from c.source and l.clean = c.clean group by doc_id
),
figures as (
  select d.doc_id, coalesce(n_words, 0)::bigint as n_words, coalesce(word_chars, 0)::bigint as word_chars,
    (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    coalesce(removed_words, 0)::bigint as removed_words
  from docs d left join counted using (doc_id) left join repeated using (doc_id)
    left join line_figures using (doc_id) left join removed using (doc_id)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, removed_words,
  not base_failed and 100 * (n_words - removed_words) >= {MIN_KEPT_PERCENT} * n_words as kept
from (
  select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed from figures
)
"""
