"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

``MEASURES`` names the measures as expressions over a document's words and lines;
``RULES`` bounds them. ``score`` compiles both into one select over the documents: one scan,
no shuffle, no user function. A measure is null where it is undefined (no words, no
lines) and then fails no rule; the base rules decide about such texts.

Words are runs without space or the controls from tab to carriage return. Null text has
none. Rows are judged one by one, so repeated rows, ties and other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"

#: Very frequent function words of the languages the corpus may hold; fixed values.
STOP_WORDS = (
    # English
    "the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "on", "with", "as", "are", "be", "at",
    # German
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht",
    "ein", "eine",
    # French
    "le", "la", "les", "et", "de", "des", "du", "un", "une", "est", "pour", "que", "qui", "dans", "par", "sur",
    "pas", "au",
    # Spanish
    "el", "los", "las", "y", "en", "se", "por", "con", "para", "una", "su", "al", "lo", "como",
)


@dataclass(frozen=True)
class Rule:
    """A document passes if the measure lies within the bounds (null passes)."""

    measure: str
    least: float | None = None
    most: float | None = None


RULES: tuple[Rule, ...] = (
    Rule("mean_word_length", 2.0, 14.0),
    Rule("symbols_per_word", None, 0.1),
    Rule("stop_words", 2, None),
    Rule("duplicate_line_ratio", None, 0.5),
    Rule("bullet_line_ratio", None, 0.9),
    Rule("ellipsis_line_ratio", None, 0.3),
)

#: The base: too few words, or too large a share of words in repeated three-word windows (percent).
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: Repeated windows that are looked up one by one.
FEW = 64


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once (a lambda's variable, as SQL has no let)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def repeated_window_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text.

    Windows are 64-bit hashes. Sorted, equal neighbours give the repeated ones; the places
    that hold one, in order, each add the words that no earlier place has covered. Few
    repeated windows are looked up one by one; more than ``FEW`` are found by sorting
    windows together with their places. Both ways give the same places.
    """
    hashes = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
                         lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))

    def looked_up(held: Column, repeated: Column) -> Column:
        numbered = F.transform(held, lambda h, i: F.when(F.array_contains(repeated, h), i))
        return F.array_compact(numbered)

    def by_sorting(held: Column) -> Column:
        pairs = F.sort_array(F.transform(held, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return bind(pairs, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])),
            lambda x: x["i"])))

    def places(held: Column) -> Column:
        repeated = bind(F.sort_array(held), lambda s: F.array_distinct(
            F.filter(s, lambda h, k: h == F.get(s, k - 1))))
        return bind(repeated, lambda r: F.when(F.size(r) == 0, F.array().cast("array<int>"))
                    .when(F.size(r) <= FEW, looked_up(held, r)).otherwise(by_sorting(held)))

    return F.aggregate(
        bind(hashes, places),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("at")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["at"])).alias("n"), i.alias("at")),
        lambda a: a["n"])


def _ratio(n: Column, of: Column) -> Column:
    return F.when(of > 0, n / of)


def _counts(words: Column, lines: Column, text: Column) -> dict[str, Column]:
    """Whole numbers the measures are made of; each is one pass over the words, lines or text."""
    stops = F.array(*[F.lit(w) for w in dict.fromkeys(STOP_WORDS)])
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": repeated_window_words(words),
        "n_stop_words": F.size(F.array_intersect(words, stops)).cast("long"),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: x.rlike(r"^[\x20\x09]*[-*•‣·]"))).cast("long"),
        "n_ellipsis_lines": F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).cast("long"),
    }


MEASURES: dict[str, Callable[[Callable[[str], Column]], Column]] = {
    "mean_word_length": lambda c: _ratio(c("word_chars"), c("n_words")),
    "symbols_per_word": lambda c: _ratio(c("n_symbols"), c("n_words")),
    # Different ones: texts of any length need a few.
    "stop_words": lambda c: F.when(c("n_words") > 0, c("n_stop_words")),
    "duplicate_line_ratio": lambda c: _ratio(c("n_dup_lines"), c("n_lines")),
    "bullet_line_ratio": lambda c: _ratio(c("n_bullet_lines"), c("n_lines")),
    "ellipsis_line_ratio": lambda c: _ratio(c("n_ellipsis_lines"), c("n_lines")),
}


def _verdict(count: Callable[[str], Column], rules: tuple[Rule, ...]) -> Column:
    """Names of the rules a document fails, in the table's order."""
    failed = []
    for rule in rules:
        value = MEASURES[rule.measure](count)
        low = value < rule.least if rule.least is not None else F.lit(False)
        high = value > rule.most if rule.most is not None else F.lit(False)
        failed.append(F.when(F.coalesce(low | high, F.lit(False)), F.lit(rule.measure)))
    return F.array_compact(F.array(*failed))


def score(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, counts and measures, base_failed, failed_rules (array of names) and kept."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def counted(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return bind(lines, lambda held: F.struct(*[e.alias(n) for n, e in _counts(words, held, text).items()]))

    count = lambda name: F.col("c")[name]
    base = (count("n_words") < MIN_WORDS) | (100 * count("n_repeat_words") > MAX_REPEAT_PERCENT * count("n_words"))
    scored = docs.select("doc_id", bind(words_of(text), counted).alias("c")).select(
        "doc_id", "c.*", base.alias("base_failed"), _verdict(count, rules).alias("failed_rules"),
        *[MEASURES[m](count).alias(m) for m in MEASURES])
    return scored.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def digest(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")
