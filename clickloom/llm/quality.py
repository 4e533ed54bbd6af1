"""Line-first cleaning with Spark functions only.

Every line of a text is judged alone: navigation and symbol noise, shouting, missing end punctuation,
boilerplate phrases, a repetition of an earlier line. Failing lines go, and a document that loses too large a
share of its characters is rejected as a whole.

Defined cases: a null text counts as empty and is rejected; lines without a word are dropped and count for
nothing; input columns named like an output column are replaced; rows are judged one by one, so repeated rows give
repeated results; an empty table gives an empty table. Nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.columns import WORD, let, packed, unpacked, words

SYMBOLS = r"[#*$%&|<>]"
# Phrases of site furniture, matched in lower case.
BOILERPLATE = (
    "cookie policy",
    "privacy policy",
    "terms of use",
    "terms of service",
    "all rights reserved",
    "enable javascript",
    "use cookies",
    "click here",
    "sign up for our newsletter",
    "subscribe to our newsletter",
    "share on facebook",
    "lorem ipsum",
)


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules; percentages are of characters, those of repeated words of all words."""

    symbol_percent: int = 7
    upper_percent: int = 50
    end_marks: str = ".!?\u2026:;\"'\u201d\u2019\u00bb)]\u3002\uff01\uff1f"
    min_words: int = 50
    max_repeat_percent: int = 50
    keep_percent: int = 60


# Texts with so many different repeated windows look them up by sorting instead of comparing; same result.
COMPARED = 64


def _covered(positions: Column) -> Column:
    """Words covered by 3-word windows at the ascending ``positions``."""
    steps = F.transform(
        positions, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(positions, j + 1) - x, F.lit(3)))
    )
    return F.aggregate(steps, F.lit(0), lambda a, b: a + b)


def _positions_by_sort(hashes: Column) -> Column:
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(
        pairs,
        lambda s: F.array_sort(
            F.transform(
                F.filter(
                    s, lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"])
                ),
                lambda x: x["i"],
            )
        ),
    )


def _positions_by_value(hashes: Column, repeated: Column) -> Column:
    at = F.transform(hashes, lambda h, i: F.when(F.array_contains(repeated, h), i))
    return F.filter(at, lambda i: i.isNotNull())


def repeat_words(tokens: Column) -> Column:
    """Number of words of the array ``tokens`` in 3-word windows found twice or more in it, first included."""

    def counted(h: Column) -> Column:
        repeated = let(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, j: x == F.get(s, j + 1))))
        return let(
            repeated,
            lambda r: F.when(F.size(r) == 0, 0)
            .when(F.size(r) <= COMPARED, let(_positions_by_value(h, r), _covered))
            .otherwise(let(_positions_by_sort(h), _covered)),
        )

    def windows(w: Column) -> Column:
        return F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    hashes = let(
        F.transform(tokens, lambda x: F.xxhash64(x)),
        lambda w: F.slice(windows(w), 1, F.greatest(F.size(w) - 2, F.lit(0))),
    )
    return let(hashes, counted)


def _count(text: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def _furniture(text: Column) -> Column:
    def any_phrase(t: Column) -> Column:
        found = F.lit(False)
        for phrase in BOILERPLATE:
            found = found | t.contains(phrase)
        return found

    return let(F.lower(text), any_phrase)


def line_passes(line: Column, rules: LineRules = LineRules()) -> Column:
    """Whether one line with a word passes every rule that looks at the line alone, the phrases apart."""
    solid = F.rtrim(line)
    return (
        F.instr(F.lit(rules.end_marks), F.right(solid, F.lit(1))).__gt__(0)
        & (100 * _count(line, SYMBOLS) <= rules.symbol_percent * F.length(line))
        & (100 * _count(line, r"\p{Lu}") <= rules.upper_percent * F.length(line))
    )


def clean_lines(text: Column, rules: LineRules = LineRules()) -> Column:
    """The lines of ``text`` that pass, in order, each once."""
    lines = F.array_distinct(F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD) & line_passes(x, rules)))
    # Phrases are rare: lines are searched for them only where the text has one.
    return F.when(
        _furniture(text), let(lines, lambda a: F.filter(a, lambda x: ~_furniture(x)))
    ).otherwise(lines)


def measure(docs: DataFrame, text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """``docs`` with the measures of each text, ``base_failed``, ``kept`` and ``clean_text`` (the lines that pass)."""
    rows = packed(docs, t=F.coalesce(F.col(text), F.lit("")))
    rows = rows.withColumn("w", words(F.col("t"))).withColumn(
        "clean", F.array_join(clean_lines(F.col("t"), rules), "\n")
    )
    with_word = F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD))
    n_words = F.size("w").cast("long")
    dup_lines = let(with_word, lambda a: F.size(a) - F.size(F.array_distinct(a)))
    rows = rows.select(
        "row",
        "clean",
        n_words.alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _count(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        dup_lines.cast("long").alias("n_dup_lines"),
        repeat_words(F.col("w")).cast("long").alias("n_repeat_words"),
        F.length("t").alias("n_text"),
        F.length("clean").alias("n_clean"),
    )
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )
    kept = ~failed & (100 * F.col("n_clean") >= rules.keep_percent * F.col("n_text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return unpacked(
        rows,
        docs.columns,
        **{n: F.col(n) for n in names},
        base_failed=failed,
        kept=kept,
        clean_text=F.col("clean"),
    )


def quality_filter(docs: DataFrame, text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """The rows of ``docs`` whose text is kept, unchanged."""
    rows = packed(docs, t=F.coalesce(F.col(text), F.lit("")))
    judged = measure(rows, "t", rules).where("kept")
    return unpacked(judged, docs.columns)
