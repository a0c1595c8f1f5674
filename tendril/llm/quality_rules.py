"""Line-first quality rules, in DataFrame expressions only.

Each line that has a word is held against navigation, boilerplate, symbol and punctuation rules; the lines that fail
are removed, and a document that loses more than `MAX_LOST` of its characters that way is rejected, as is one that
fails the base rules (fewer than `MIN_WORDS` words, or more than half its words in repeated 3-word windows).

A narrow job: every figure is computed within its row, so neither hot keys nor copies matter; repeated windows are
found by sorting a document's window hashes (64 bits; a collision within one text is the only error).

Defined cases: null text has no words and is rejected; so is empty text; repeated rows give one result each; doc_id
passes through, nulls included; other columns are ignored. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tendril.llm.shared import table

MIN_WORDS = 50
MAX_REPEATED = 50  # hundredths of the words
MAX_LOST = 50  # hundredths of the characters in lines with a word

# The patterns of the rules; both Java's and RE2's syntax.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
SYMBOL_RUN = r"[#*$%&|<>]{2,}|!!"
SENTENCE_END = r"[.!?…:;][\"')»”\]]*([\x20\x09-\x0D]|$)"
BOILERPLATE = (
    r"(?i)(all rights reserved|licensed under|released under|copyright|©|terms of (use|service)|privacy policy|cookie"
    r"|subscribe to|sign up for|click here|lorem ipsum|javascript|skip to (main )?content)"
)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once per row however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """How many words stand in a 3-word window that the text has twice or more."""

    def windows(w: Column) -> Column:
        n = F.greatest(F.size(w) - 2, F.lit(0))
        zipped = F.arrays_zip(F.slice(w, 1, n).alias("a"), F.slice(w, 2, n).alias("b"), F.slice(w, 3, n).alias("c"))
        return F.sort_array(F.transform(zipped, lambda x, i: F.struct(F.xxhash64(x["a"], x["b"], x["c"]).alias("h"), i.alias("i"))))

    def repeats(s: Column) -> Column:
        pairs = F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
        return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))

    def covered(at: Column) -> Column:
        steps = F.zip_with(at, F.slice(at, 2, F.size(at)), lambda p, q: F.least(F.lit(3), F.coalesce(q - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    return bound(bound(bound(words, windows), repeats), covered)


def line_fails(line: Column) -> Column:
    pipes = F.length(line) - F.length(F.translate(line, "|", ""))
    return bound(F.size(words_of(line)), lambda n: (
        ((pipes >= 2) & (10 * pipes >= 3 * n))
        | ((n <= 20) & line.rlike(BOILERPLATE))
        | (4 * F.regexp_count(line, F.lit(SYMBOL_RUN)) > n)
        | ((n >= 8) & ~line.rlike(SENTENCE_END))
    ))


def clean_lines(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, the base figures, base_failed, kept, what was lost, and cleaned_text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.length(F.translate(text, " \t\n\x0b\f\r", ""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    judged = bound(lines, lambda x: F.struct(
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.aggregate(x, F.lit(0).cast("long"), lambda total, line: total + F.length(line)).alias("chars_in_lines"),
        F.filter(x, lambda line: ~line_fails(line)).alias("good"),
    ))
    counted = bound(words_of(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    figures = docs.select("doc_id", bare.cast("long").alias("word_chars"), (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"), judged.alias("lines"), counted.alias("words"))
    lost = figures.select(
        "doc_id", "words.n_words", "word_chars", "n_symbols", "lines.n_dup_lines", "words.n_repeat_words", "lines.chars_in_lines", F.col("lines.good").alias("good"),
        (F.col("lines.chars_in_lines") - F.aggregate("lines.good", F.lit(0).cast("long"), lambda total, line: total + F.length(line))).alias("chars_lost"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return lost.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (100 * F.col("chars_lost") <= MAX_LOST * F.col("chars_in_lines"))).alias("kept"), "chars_lost", F.concat_ws("\n", "good").alias("cleaned_text"),
    )


def op5_line_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(table(spark, sf_dir, "documents")).drop("cleaned_text")


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


OP5_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, list_filter(regexp_split_to_array(text, {_quoted(SPACE)}), lambda x: x <> '') AS ws FROM d),
p AS (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i], ws[i + 1], ws[i + 2]) AS n FROM p),
c AS (SELECT rid, count(DISTINCT j) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM g WHERE n > 1) GROUP BY rid),
l AS (SELECT rid, line, len(list_filter(regexp_split_to_array(line, {_quoted(SPACE)}), lambda x: x <> '')) AS n,
             length(line) - length(replace(line, '|', '')) AS pipes
      FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, {_quoted(WORD)})),
f AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines, sum(length(line)) AS total,
             sum(CASE WHEN (pipes >= 2 AND 10 * pipes >= 3 * n) OR (n <= 20 AND regexp_matches(line, {_quoted(BOILERPLATE)}))
                        OR 4 * len(regexp_extract_all(line, {_quoted(SYMBOL_RUN)})) > n
                        OR (n >= 8 AND NOT regexp_matches(line, {_quoted(SENTENCE_END)})) THEN length(line) ELSE 0 END) AS lost
      FROM l GROUP BY rid),
a AS (SELECT d.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words,
             CAST(length(translate(d.text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS BIGINT) AS word_chars,
             CAST(length(d.text) - length(translate(d.text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
             CAST(coalesce(f.n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(f.total, 0) AS BIGINT) AS total, CAST(coalesce(f.lost, 0) AS BIGINT) AS chars_lost
      FROM d JOIN w USING (rid) LEFT JOIN c USING (rid) LEFT JOIN f USING (rid)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * chars_lost <= {MAX_LOST} * total AS kept, chars_lost
FROM b
"""
