"""Quality rules: clean line by line, then reject documents that lose too much text.

All of it is SQL expressions on one row at a time: no shuffle, no Python.

A line fails when it is
* punctuation: marks of ``[#*$%&<>]`` for at least every second word, or ``!!`` after at
  least every second word (three or more in either case);
* navigation: at least three ``|``, one for every four words or more;
* boilerplate: a licence, cookie, script or subscription notice, one phrase for every
  ``NOTICE_WORDS`` words or more, or a stutter in which a third of the words, three at
  least, repeat the word before.
Lines without a word never fail. A document is rejected if it fails the base rules (fewer
than ``min_words``, or too many words in repeated windows) or if its failing lines hold
more than ``max_lost`` percent of its words.

Nulls and texts without words count zero everywhere and are rejected by the word minimum.
Repeated rows are judged one by one. Extra columns pass through ``clean_documents``.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roost.llm.words import SHINGLE, total, words_of

SYMBOLS = "[^#*$%&|<>]+"
MARKS = "[^#*$%&<>]+"
NOTICES = (
    "ll rights reserved",
    "erms of use",
    "erms of service",
    "rivacy policy",
    "ookie policy",
    "ses cookies",
    "nable javascript",
    "nable JavaScript",
    "ubscribe to our",
    "orem ipsum",
    "icensed under ",
    "eleased under ",
)
#: A phrase stands for a notice of at most so many words; a longer line only mentions it.
NOTICE_WORDS = 20


def _has_notice(text: Column) -> Column:
    """Phrases stand without their first letter, whose case varies."""
    return reduce(or_, [F.contains(text, F.lit(phrase)) for phrase in NOTICES])


def _stutters(words: Column) -> Column:
    """How many words repeat the word before."""
    return F.size(F.filter(words, lambda w, i: F.get(words, i - 1) == w))


def _count(text: Column, piece: str) -> Column:
    """How often ``piece`` stands in the text, without overlaps."""
    return (F.length(text) - F.length(F.replace(text, F.lit(piece), F.lit("")))) / F.lit(len(piece))


def _notices(text: Column) -> Column:
    return reduce(add, [_count(text, phrase) for phrase in NOTICES])


def _fails(line: Column, words: Column) -> Column:
    n = F.size(words)
    marks = F.length(F.regexp_replace(line, MARKS, ""))
    shouts = _count(line, "!!")
    bars = _count(line, "|")
    stutters = _stutters(words)
    return (n > 0) & (
        ((marks >= 3) & (marks * 2 >= n))
        | ((shouts >= 3) & (shouts * 2 >= n))
        | ((bars >= 3) & (bars * 4 >= n))
        | ((stutters >= 3) & (stutters * 3 >= n))
        | (_has_notice(line) & (_notices(line) * NOTICE_WORDS >= n))
    )


def _repeated(df: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words covered by windows found at least twice.

    Windows are compared by a 64-bit hash. Only documents with a repeat are sorted.
    """
    df = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    window = lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(SHINGLE)])
    last = F.size("words") - SHINGLE
    df = df.withColumn(
        "windows",
        F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), window)).otherwise(
            F.array().cast("array<bigint>")
        ),
    )
    df = df.withColumn(
        "ordered",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    twin = lambda e, k: F.coalesce(F.get("ordered", k)["h"] == e["h"], F.lit(False))
    df = df.withColumn(
        "places",
        F.sort_array(
            F.transform(
                F.filter("ordered", lambda e, k: twin(e, k - 1) | twin(e, k + 1)), lambda e: e["i"]
            )
        ),
    )
    step = lambda p, k: F.least(F.lit(SHINGLE), F.coalesce(F.get("places", k + 1) - p, F.lit(SHINGLE)))
    return df.withColumn("n_repeat_words", F.coalesce(total(F.transform("places", step)), F.lit(0)))


def judge(df: DataFrame, text: Column, *, min_words: int, max_repeated: int, max_lost: int) -> DataFrame:
    """``row`` (all given columns) with counts, verdict and ``clean_text``."""
    df = df.select(F.struct("*").alias("row"), F.coalesce(text, F.lit("")).alias("body"))
    df = df.select(
        "row",
        "body",
        words_of(F.col("body")).alias("words"),
        F.split("body", "\n").alias("lines"),
        F.length(F.regexp_replace("body", SYMBOLS, "")).cast("bigint").alias("n_symbols"),
    )
    # No line of a text without these can fail, so most texts are not cut into lines of words.
    suspect = (
        (F.col("n_symbols") >= 3)
        | F.contains("body", F.lit("!!"))
        | _has_notice(F.col("body"))
        | (_stutters(F.col("words")) >= 3)
    )
    df = df.withColumn("line_words", F.when(suspect, F.transform("lines", words_of)))
    df = df.withColumn("failed", F.zip_with("lines", "line_words", _fails))
    lost = total(F.zip_with("failed", "line_words", lambda f, w: F.when(f, F.size(w)).otherwise(0)))
    rest = F.array_join(F.filter("lines", lambda line, i: ~F.get("failed", i)), "\n")
    filled = F.filter("lines", lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select(
        "row",
        "words",
        "n_symbols",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.when(F.size(F.array_distinct("lines")) < F.size("lines"), filled).alias("filled"),
        F.coalesce(lost, F.lit(0)).alias("lost_words"),
        F.when(F.col("failed").isNull(), F.col("body")).otherwise(rest).alias("clean_text"),
    )
    df = _repeated(df)
    base_failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeated * F.col("n_words")
    )
    return df.select(
        "row",
        "clean_text",
        "n_words",
        "word_chars",
        "n_symbols",
        F.coalesce(F.size("filled") - F.size(F.array_distinct("filled")), F.lit(0))
        .cast("bigint")
        .alias("n_dup_lines"),
        F.col("n_repeat_words").cast("bigint").alias("n_repeat_words"),
        base_failed.alias("base_failed"),
        (~base_failed & (100 * F.col("lost_words") <= max_lost * F.col("n_words"))).alias("kept"),
    )


def quality_report(
    docs: DataFrame, *, min_words: int = 10, max_repeated: int = 20, max_lost: int = 30
) -> DataFrame:
    """Counts and verdict of each document, with its cleaned text."""
    judged = judge(
        docs.select("doc_id", "text"),
        F.col("text"),
        min_words=min_words,
        max_repeated=max_repeated,
        max_lost=max_lost,
    )
    return judged.select("row.doc_id", *[c for c in judged.columns if c != "row"])


def clean_documents(
    docs: DataFrame, *, min_words: int = 10, max_repeated: int = 20, max_lost: int = 30
) -> DataFrame:
    """The documents that are kept, without their failing lines; columns as given."""
    judged = judge(
        docs, F.col("text"), min_words=min_words, max_repeated=max_repeated, max_lost=max_lost
    )
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns}
    columns["text"] = F.col("clean_text")
    if "n_chars" in columns:
        columns["n_chars"] = F.length("clean_text").cast(docs.schema["n_chars"].dataType)
    # A filter on "kept" alone would be moved below the columns it is made of, each of which
    # would then be computed once for every use.
    judged = judged.withColumn("at", F.monotonically_increasing_id())
    return judged.filter(F.col("kept") & (F.col("at") >= 0)).select(*[column.alias(c) for c, column in columns.items()])
