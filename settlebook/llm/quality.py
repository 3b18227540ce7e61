"""Quality rules as one projection (operator 5).

``RULES`` is a table of ratios with their bounds. ``measures`` are plain column
expressions over a text and its words, lines and 8-word windows; ``verdict``
compiles the table into one boolean expression over them. Everything is
evaluated by Spark's own functions in a single pass, without a shuffle.

The stop words are English, French, German and Spanish: texts of 100 words or
more in any other language fail that rule and are not kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"
WHITE_CHARS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Frequent function words of the corpus languages, lower case.
STOP_WORDS = tuple(sorted(set(
    "the of and to in a is that it for was on with as by be at or he have from are this an "
    "le la les des de du et en un une que qui est dans pour sur pas au par plus "
    "der die und das den von zu mit ist im für auf nicht ein eine sich auch dem "
    "el los las y del se por con una su para es lo como".split())))


@dataclass(frozen=True)
class Rule:
    """A text fails if ``measure`` lies outside ``least`` to ``most``, judged
    only from ``words`` words on (short texts say little about ratios)."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None
    words: int = 0


RULES = (
    Rule("word_length", "word_chars / n_words", 2.0, 12.0),
    Rule("symbols", "n_symbols / n_words", most=0.3),
    Rule("shouting", "n_exclamations / n_words", most=0.5),
    Rule("letters", "n_letter_words / n_words", least=0.6),
    Rule("stop_words", "n_stop_words / n_words", least=0.004, words=100),
    Rule("repeated_lines", "n_dup_lines / greatest(n_lines, 1)", most=0.5, words=20),
    Rule("bullet_lines", "n_bullet_lines / greatest(n_lines, 1)", most=0.9, words=20),
    Rule("cut_lines", "n_cut_lines / greatest(n_lines, 1)", most=0.3, words=20),
)


def verdict(rules: tuple[Rule, ...] = RULES) -> str:
    """SQL for "passes every rule", over the columns of ``measures``."""
    tests = []
    for r in rules:
        bounds = [f"{r.measure} {sign} {bound!r}D" for sign, bound in ((">=", r.least), ("<=", r.most)) if bound is not None]
        test = " AND ".join(bounds)
        tests.append(f"(n_words < {r.words} OR ({test}))" if r.words else f"({test})")
    return "n_words > 0 AND " + " AND ".join(tests)


def _without(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _covered(repeated: Column) -> Column:
    """Words in windows that start at the given places, in rising order."""
    gaps = F.zip_with(F.slice(repeated, 2, F.greatest(F.size(repeated) - 1, F.lit(0))),
                      F.slice(repeated, 1, F.greatest(F.size(repeated) - 1, F.lit(0))),
                      lambda b, a: F.least(b - a, F.lit(WINDOW)))
    return F.when(F.size(repeated) == 0, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(WINDOW), lambda s, g: s + g))


def measures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the counts that the rules read, a row per input row."""
    t = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    t = t.withColumns({
        "words": F.array_remove(F.split("t", WHITE, -1), ""),
        "lines": F.filter(F.split("t", "\n", -1), lambda x: F.length(F.translate(x, WHITE_CHARS, "")) > 0)})
    counted = t.select(
        "key", F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("t", WHITE_CHARS, "")).cast("long").alias("word_chars"),
        _without(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        _without(F.col("t"), "!").cast("long").alias("n_exclamations"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(r"^\s*[•▪◦*\-–]\s"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(r"(?:\.\.\.|…)\s*$"))).cast("long").alias("n_cut_lines"),
        F.regexp_count("t", F.lit(rf"\p{{L}}[^{WHITE[1:-2]}]*+")).cast("long").alias("n_letter_words"),
        F.regexp_count(F.lower("t"), F.lit(rf"(?<![^{WHITE[1:-2]}])(?:{'|'.join(STOP_WORDS)})(?=[{WHITE[1:-2]}.,;:!?]|$)")
                       ).cast("long").alias("n_stop_words"),
        # a window's hash stands for it: 64 bits, compared within one text
        F.when(F.size("words") > WINDOW, F.transform(
            F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
        .otherwise(F.array().cast("array<long>")).alias("windows"))
    # places of windows found twice or more: neighbours in the order of (hash, place)
    ordered = counted.withColumn("windows", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    ahead = F.slice("windows", 2, F.greatest(F.size("windows"), F.lit(1)))
    marked = ordered.withColumn("windows", F.zip_with("windows", ahead, lambda a, b: F.struct(
        a.i.alias("i"), b.i.alias("next"), F.coalesce(a.h == b.h, F.lit(False)).alias("same"))))
    pairs = F.filter("windows", lambda w: w.same)
    marked = marked.withColumn("windows", F.array_sort(F.array_distinct(F.concat(
        F.transform(pairs, lambda w: w.i), F.transform(pairs, lambda w: w.next)))))
    return marked.withColumn("n_repeat_words", _covered(F.col("windows")).cast("long")).drop("windows").withColumnRenamed("key", key)


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The measures with ``base_failed`` and ``kept`` per row of ``docs``.

    Null and empty texts have no words: base_failed, not kept. Null and repeated
    keys pass through; columns that are not named are not read.
    """
    m = measures(docs, key, text)
    failed = F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words")
    return m.withColumn("base_failed", failed).withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(
        F.expr(verdict(rules))))
