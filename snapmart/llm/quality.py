"""Line-first cleaning and quality rules, with DataFrame functions only.

Every line with a word is judged by itself: by its punctuation, as navigation,
and as boilerplate. Lines that fail are removed; a document that loses more
than ``MAX_LOST`` of its characters is rejected, and so is one that fails the
base rules (fewer than ``MIN_WORDS`` words, or more than ``MAX_REPEAT`` of its
words inside three-word windows that stand twice or more in the text).

All work is per row: arrays of the text's words and lines, sorted or hashed
inside the row, so there is no shuffle and a row's cost grows as its length
(times its logarithm where windows repeat). Windows are compared by 64-bit
hashes.

Edge cases: a null text has no words and no lines, and fails the base rules,
as an empty one does; repeated rows are judged alike; an empty table gives no
rows. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 50
MAX_REPEAT = 0.5
MAX_LOST = 0.5
#: A navigation line has at most so many words; longer ones need end punctuation.
NAV_WORDS = 3

# Patterns of the rules (white space as in the word pattern).
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
END_MARK = "[.!?…:;\"')\\]»”。]" + r"[\x20\x09-\x0D]*$"
NAV_MARKS = "[|>»›•·]" + r"[^|>»›•·]*[|>»›•·]"
BOILERPLATE = (
    "(?i)(all rights reserved|cookie policy|privacy policy|terms of (use|service)|accept (all )?cookies|"
    "enable javascript|lorem ipsum|subscribe to our newsletter|sign up for|log ?in to|click here|"
    "share (this|on)|follow us on|skip to (main )?content|copyright ©)"
)


def words_of(text: Column) -> Column:
    """Words of a text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def word_lines(text: Column) -> Column:
    """The ``\\n``-split lines that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(WORD))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column, width: int = 3) -> Column:
    """Number of words inside ``width``-word windows that stand twice or more."""

    def windows(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - width)
        return F.transform(places, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(p: Column) -> Column:
            def place(x: Column, k: Column) -> Column:
                same = (F.get(p, k - 1)["h"] == x["h"]) | (F.get(p, k + 1)["h"] == x["h"])
                return F.when(same, x["i"])

            return F.sort_array(F.array_compact(F.transform(p, place)))

        start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))

        def step(acc: Column, i: Column) -> Column:
            # Words of this window that no earlier one has covered.
            n = acc["n"] + i + width - F.greatest(i, acc["end"])
            return F.struct(n.cast("bigint").alias("n"), (i + width).alias("end"))

        return F.aggregate(_let(pairs, repeated), start, step, lambda acc: acc["n"])

    def count(w: Column) -> Column:
        return _let(windows(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(covered(h)))

    return _let(words, lambda w: F.when(F.size(w) < width, F.lit(0).cast("bigint")).otherwise(count(w)))


def line_passes(line: Column) -> Column:
    """Whether a line stays: end punctuation, no navigation, no boilerplate."""
    n_words = F.size(words_of(line))
    unfinished = ~line.rlike(END_MARK)
    navigation = (unfinished & (n_words <= NAV_WORDS)) | line.rlike(NAV_MARKS)
    return ~(unfinished | navigation | line.rlike(BOILERPLATE))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` rows as ``doc_id, text, words, lines, good`` (arrays)."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({"words": words_of(F.col("text")), "lines": word_lines(F.col("text"))})
    return rows.withColumn("good", F.filter("lines", line_passes))


def quality(docs: DataFrame) -> DataFrame:
    """Base values, share of text lost with bad lines, and the verdict, per document."""
    rows = measured(docs)
    text = F.col("text")
    size = F.length(F.array_join("lines", ""))
    out = rows.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
        (F.size("lines") - F.size("good")).cast("bigint").alias("n_bad_lines"),
        F.when(size > 0, 1 - F.length(F.array_join("good", "")) / size).otherwise(F.lit(0.0)).alias("lost"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    out = out.withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("lost") <= MAX_LOST))


def clean(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: the lines that stay, joined again, of the kept documents only."""
    rows = measured(docs).withColumn("_size", F.length(F.array_join("lines", "")))
    enough = F.size("words") >= MIN_WORDS
    calm = repeat_words(F.col("words")) <= MAX_REPEAT * F.size("words")
    little = F.length(F.array_join("good", "")) >= (1 - MAX_LOST) * F.col("_size")
    return rows.filter(enough & little & calm).select("doc_id", F.array_join("good", "\n").alias("text"))
