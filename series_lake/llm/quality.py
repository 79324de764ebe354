"""Quality rules: a table of thresholds compiled into one projection, without user functions.

Words are ``[^\\x20\\x09-\\x0D]+``; lines are compared exactly, windows of
three words by 64-bit hashes. Null text counts
as empty. A rule whose metric is undefined (no words, no lines, no letters) passes; the word
count itself rejects such texts. Rows are independent: repeated rows repeat their result, an
empty table gives an empty result, and columns beside id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"

# Frequent function words of the languages the texts are written in.
STOP_WORDS = (
    "the", "of", "and", "to", "a", "in", "is", "it", "that", "for", "was", "on", "are", "with", "as", "be", "by", "this", "from", "or",
    "le", "la", "les", "de", "des", "du", "et", "un", "une", "est", "que", "qui", "en", "dans", "pour", "par", "sur", "au", "pas", "avec",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "ist", "im", "nicht", "ein", "eine", "als", "auf", "dem", "des", "sich", "auch", "für",
    "el", "los", "las", "y", "se", "del", "una", "por", "con", "no", "su", "para", "es", "al", "lo", "como", "más", "o", "pero", "sus",
)


@dataclass(frozen=True)
class Rule:
    """Keep a text only if ``low <= metric <= high``; an open side is None."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None

    def failed(self) -> Column:
        value = F.col(self.metric)
        below = F.lit(False) if self.low is None else value < F.lit(float(self.low))
        above = F.lit(False) if self.high is None else value > F.lit(float(self.high))
        return F.coalesce(below | above, F.lit(False))


RULES = (
    Rule("too_short", "n_words", low=50),
    Rule("odd_word_length", "mean_word_chars", low=2.0, high=12.0),
    Rule("symbols", "symbols_per_word", high=0.1),
    Rule("few_letter_words", "letter_word_ratio", low=0.7),
    Rule("shouting", "upper_ratio", high=0.4),
    Rule("exclamations", "exclamations_per_word", high=0.3),
    Rule("bullets", "bullet_line_ratio", high=0.9),
    Rule("ellipses", "ellipsis_line_ratio", high=0.3),
    Rule("repeated_lines", "dup_line_ratio", high=0.5),
    Rule("repeated_phrases", "repeat_word_ratio", high=0.5),
    Rule("no_stop_words", "n_stop_words", low=2),
)


def _steps(text: Column) -> list[dict[str, Column]]:
    """Projections that build the metrics; each reads columns of the one before only."""
    c = F.col

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b)

    windows = F.when(
        c("n_words") >= 3,
        F.transform(F.slice("words", F.lit(1), c("n_words") - 2), lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))
    repeated = F.filter(
        "sorted_windows",
        lambda x, i: (x["w"] == F.get("sorted_windows", F.greatest(i - 1, F.lit(0)))["w"]) & (i > 0)
        | F.coalesce(x["w"] == F.get("sorted_windows", i + 1)["w"], F.lit(False)),
    )
    covered = F.aggregate(
        "repeated_at",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last")),
        lambda acc, p: F.struct((acc["n"] + 3 - F.greatest(F.lit(0), acc["last"] + 3 - p)).alias("n"), p.alias("last")),
        lambda acc: acc["n"],
    )
    return [
        {"text": F.coalesce(text, F.lit(""))},
        {
            "words": F.filter(F.split("text", SPACE), lambda w: w != ""),
            "lines": F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)),
            "n_symbols": F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("bigint"),
            "n_letters": F.length(F.regexp_replace("text", r"\P{L}+", "")),
            "n_upper": F.length(F.regexp_replace("text", r"\P{Lu}+", "")),
            "n_exclaim": F.length(F.regexp_replace("text", r"[^!?]+", "")),
        },
        {"n_words": F.size("words").cast("int"), "n_lines": F.size("lines")},
        {
            "windows": windows,
            "word_chars": F.length(F.array_join("words", "")).cast("bigint"),
            "n_dup_lines": (c("n_lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
            "n_letter_words": F.size(F.filter("words", lambda w: w.rlike(r"\p{L}"))),
            "n_bullets": F.size(F.filter("lines", lambda x: x.rlike(r"^[\x20\x09]*[-*•‣◦]"))),
            "n_ellipses": F.size(F.filter("lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09\x0D]*$"))),
            "n_stop_words": F.size(F.array_intersect(F.transform("words", lambda w: F.lower(w)), F.array(*map(F.lit, dict.fromkeys(STOP_WORDS))))),
        },
        {
            "sorted_windows": F.when(
                F.size(F.array_distinct("windows")) < F.size("windows"),
                F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))),
            )
        },
        {"repeated_at": F.when(c("sorted_windows").isNotNull(), F.sort_array(F.transform(repeated, lambda x: x["i"])))},
        {"n_repeat_words": F.when(c("repeated_at").isNull(), F.lit(0).cast("bigint")).otherwise(covered), "n_words": c("n_words").cast("bigint")},
        {
            "mean_word_chars": ratio(c("word_chars"), c("n_words")),
            "symbols_per_word": ratio(c("n_symbols"), c("n_words")),
            "letter_word_ratio": ratio(c("n_letter_words"), c("n_words")),
            "upper_ratio": ratio(c("n_upper"), c("n_letters")),
            "exclamations_per_word": ratio(c("n_exclaim"), c("n_words")),
            "bullet_line_ratio": ratio(c("n_bullets"), c("n_lines")),
            "ellipsis_line_ratio": ratio(c("n_ellipses"), c("n_lines")),
            "dup_line_ratio": ratio(c("n_dup_lines"), c("n_lines")),
            "repeat_word_ratio": ratio(c("n_repeat_words"), c("n_words")),
        },
    ]


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``docs``: id, metrics, names of the failed rules, ``base_failed``, ``kept``."""
    frame = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("raw"))
    for step in _steps(F.col("raw")):
        frame = frame.withColumns(step)
    failed = F.filter(F.array(*[F.when(r.failed(), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return frame.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "mean_word_chars", "symbols_per_word", "letter_word_ratio", "upper_ratio", "dup_line_ratio", "n_stop_words",
        failed.alias("failed_rules"), base.alias("base_failed"),
    ).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
