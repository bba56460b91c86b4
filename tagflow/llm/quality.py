"""Quality rules: one projection of text ratios, compared with a table of thresholds.

Defined cases: a null or empty text has no words and fails the base rule; repeated
rows are judged one by one; an empty table gives an empty result; columns other than
`doc_id` and `text` are not read. Ratios of a text without words or lines are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tagflow.llm.common import let, words

SYMBOLS = "[#*$%&|<>]"

# Frequent function words of the languages served.
STOP_WORDS = (
    "a an and are as at be by for from he in is it of on or that the this to was with "
    "der die das und ist zu den von mit ein eine im auf für nicht sich "
    "le la les de des du et un une est que qui dans pour en au par sur "
    "el los las y una por con para su del se lo"
).split()

# (ratio, least, most); None leaves that side open. A document is kept within all of them.
RULES: tuple[tuple[str, float | None, float | None], ...] = (
    ("mean_word_chars", 2.0, 14.0),
    ("symbol_ratio", None, 0.25),
    ("stop_ratio", 0.02, None),
    ("dup_line_ratio", None, 0.5),
    ("words_per_line", 2.0, None),
)

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _repeat_words(w: Column) -> Column:
    """Words inside three-word windows that the text holds more than once.

    Windows are sorted by hash, so that equal ones are neighbours; the words of
    neighbours with one hash are compared.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
    )

    def same(x: Column, y: Column) -> Column:
        three = lambda i: F.slice(w, i + 1, F.lit(3))
        return F.coalesce((x["h"] == y["h"]) & (three(x["i"]) == three(y["i"])), F.lit(False))

    def covered(s: Column) -> Column:
        again = F.filter(s, lambda x, j: same(x, F.get(s, j - 1)) | same(x, F.get(s, j + 1)))
        starts = F.sort_array(F.transform(again, lambda x: x["i"]))
        return F.aggregate(
            starts,
            F.struct(F.lit(-1).alias("last"), F.lit(0).cast("long").alias("n")),
            lambda a, p: F.struct(
                (p + 2).alias("last"), (a["n"] + p + 3 - F.greatest(p, a["last"] + 1)).alias("n")
            ),
            lambda a: a["n"],
        )

    return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(let(F.sort_array(windows), covered))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def passes(rules=RULES) -> Column:
    """The threshold table as one boolean expression over the ratio columns."""
    verdict = F.lit(True)
    for name, least, most in rules:
        if least is not None:
            verdict = verdict & (F.col(name) >= F.lit(least))
        if most is not None:
            verdict = verdict & (F.col(name) <= F.lit(most))
    return verdict


def assess(docs: DataFrame, rules=RULES, stop_words=STOP_WORDS) -> DataFrame:
    """doc_id, counts, ratios, base_failed and kept, one row per document row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = docs.select(
        "doc_id",
        text.alias("text"),
        words(F.col("text")).alias("w"),
        F.filter(F.split(text, "\n"), lambda l: l.rlike(r"[^\x20\x09-\x0D]")).alias("l"),
    )
    w, l = F.col("w"), F.col("l")
    counted = parts.select(
        "doc_id",
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(l) - F.size(F.array_distinct(l))).cast("long").alias("n_dup_lines"),
        _repeat_words(w).alias("n_repeat_words"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(*stop_words))).cast("long").alias("n_stop"),
        F.size(l).cast("long").alias("n_lines"),
    )
    n, lines = F.col("n_words"), F.col("n_lines")
    base_failed = (n < MIN_WORDS) | (F.col("n_repeat_words") * 100 > n * MAX_REPEAT_PERCENT)
    return counted.select(
        "*",
        _ratio(F.col("word_chars"), n).alias("mean_word_chars"),
        _ratio(F.col("n_symbols"), n).alias("symbol_ratio"),
        _ratio(F.col("n_stop"), n).alias("stop_ratio"),
        _ratio(F.col("n_dup_lines"), lines).alias("dup_line_ratio"),
        _ratio(n, lines).alias("words_per_line"),
        base_failed.alias("base_failed"),
    ).withColumn("kept", ~F.col("base_failed") & passes(rules))
