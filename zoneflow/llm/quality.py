"""Line-first quality rules: judge every line, remove those that fail, reject documents that lose too much.

Everything is an expression over one row: no shuffle, no exploded words, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import SPACES, WORD_PATTERN, let, word_count, words_of

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Marks between the entries of a menu or a table of links.
SEPARATORS = "|»›•·"
#: Phrases of notices and page furniture, lower case, alternatives of one pattern that Java and RE2 read alike.
BOILERPLATE = (
    "licensed under|released under the|all rights reserved|copyright [(]c[)]|©|cookie policy|uses cookies|privacy policy|"
    "terms of (use|service)|subscribe to our|sign up for|log in to|enable javascript|click here|share this (page|article)"
)


@dataclass(frozen=True)
class QualityRules:
    """Limits of the rules; shares are per word of the line or document."""

    window: int = 8
    min_words: int = 20
    max_repeat_percent: int = 30
    line_symbol_percent: int = 30
    line_bang_percent: int = 50
    line_separator_percent: int = 25
    min_separators: int = 3
    boilerplate_max_words: int = 30
    max_lost_percent: int = 50


def count_chars(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def line_passes(line: Column, rules: QualityRules = QualityRules()) -> Column:
    """True for a line that stays. A line without words stays: there is nothing to judge."""

    def judged(n: Column) -> Column:
        punctuation = (
            (count_chars(line, SYMBOLS) * 100 > n * rules.line_symbol_percent)
            | (count_chars(line, "!") * 100 > n * rules.line_bang_percent)
        )
        separators = count_chars(line, SEPARATORS)
        navigation = (separators >= rules.min_separators) & (separators * 100 > n * rules.line_separator_percent)
        boilerplate = (n <= rules.boilerplate_max_words) & F.lower(line).rlike(BOILERPLATE)
        return (n == 0) | ~(punctuation | navigation | boilerplate)

    return let(word_count(line), judged)


def repeated_window_words(words: Column, window: int) -> Column:
    """Words inside windows of ``window`` words that occur at least twice in the text, the first included.

    Windows are compared by a 64-bit hash of their words' 64-bit hashes. Only texts with an equal pair of hashes sort them.
    """

    def hashes(hashed: Column) -> Column:
        starts = F.when(F.size(hashed) >= window, F.sequence(F.lit(1), F.size(hashed) - (window - 1)))
        return F.coalesce(F.transform(starts, lambda i: F.xxhash64(F.slice(hashed, i, window))), F.array().cast("array<long>"))

    def covered(found: Column) -> Column:
        by_hash = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(ordered: Column) -> Column:
            equal = F.filter(ordered, lambda x, k: (
                x["h"].eqNullSafe(F.get(ordered, k - 1)["h"]) | x["h"].eqNullSafe(F.get(ordered, k + 1)["h"])))
            return F.sort_array(F.transform(equal, lambda x: x["i"]))

        def spans(at: Column) -> Column:
            gaps = F.transform(at, lambda v, k: F.least(F.coalesce(F.get(at, k + 1) - v, F.lit(window)), F.lit(window)))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)

        return let(let(by_hash, starts), spans)

    return let(let(F.transform(words, lambda w: F.xxhash64(w)), hashes), lambda found: F.when(
        F.size(F.array_distinct(found)) == F.size(found), F.lit(0).cast("long")).otherwise(covered(found)))


def judge_quality(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lost_words, kept, cleaned)``.

    One row per input row; other columns are ignored. A null or empty text has no words and fails the base rules; its
    ``cleaned`` text is null or empty as it was. Repeated rows get equal rows, an empty table an empty result.
    """
    return _judged(docs.select("doc_id", "text"), rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lost_words",
        "kept", "cleaned",
    )


def _judged(docs: DataFrame, rules: QualityRules) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    lines = F.split(text, "\n", -1)
    measured = docs.select(
        "doc_id", "text",
        (F.length(text) - count_chars(text, SPACES)).cast("long").alias("word_chars"),
        count_chars(text, SYMBOLS).alias("n_symbols"),
        let(F.filter(lines, lambda line: line.rlike(WORD_PATTERN)), lambda full: (
            F.size(full) - F.size(F.array_distinct(full))).cast("long")).alias("n_dup_lines"),
        let(words_of(F.col("text")), lambda words: F.struct(
            F.size(words).cast("long").alias("n"), repeated_window_words(words, rules.window).alias("repeated"))).alias("words"),
        let(F.transform(lines, lambda line: F.struct(line.alias("line"), line_passes(line, rules).alias("passes"))),
            lambda judged: F.struct(
                F.filter(judged, lambda x: x["passes"])["line"].alias("stay"),
                F.aggregate(F.filter(judged, lambda x: ~x["passes"]), F.lit(0).cast("long"),
                            lambda total, x: total + word_count(x["line"])).alias("lost"))).alias("lines"),
    ).select(
        "*", F.col("words.n").alias("n_words"), F.col("words.repeated").alias("n_repeat_words"),
        F.col("lines.lost").alias("n_lost_words"),
    )
    base_failed = (F.col("n_words") < rules.min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent)
    return measured.select(
        "*", base_failed.alias("base_failed"),
        (~base_failed & (F.col("n_lost_words") * 100 <= F.col("n_words") * rules.max_lost_percent)).alias("kept"),
        F.when(F.col("text").isNotNull(), F.array_join("lines.stay", "\n")).alias("cleaned"),
    )


def clean_documents(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Documents that pass, with the failing lines removed from ``text`` and ``n_chars`` counted anew.

    All columns of ``docs`` stay, whatever their names; rejected rows go, repeated rows stay repeated.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    judged = _judged(packed.select(F.col("doc").alias("doc_id"), F.col("doc")["text"].alias("text")), rules).filter("kept")
    replaced = {"text": F.col("cleaned"), "n_chars": F.length("cleaned").cast("long")}
    return judged.select(*[replaced.get(c, F.col("doc_id").getField(c)).alias(c) for c in docs.columns])
