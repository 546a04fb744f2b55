"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Every rule is a boolean column that is true where a document fails. A bounded,
hash-chosen sample gives each rule its selectivity (share of rows it rejects) and its
cost: the time of an aggregate that evaluates it EVALUATIONS times, less that of the
same aggregate without it. The rules then run in descending rejection per cost
inside one CASE, so a later rule is evaluated only where all earlier ones pass.
The order changes what a row costs, never its verdict.

Defined results: a null or empty text has no words and fails the base rule;
repeated rows are judged alike and all returned; other columns are ignored;
an empty table gives an empty result and keeps the declared order of rules.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.llm._shared import BLANKS, materialise, word_array

#: Rows expected in the sample that costs and selectivities are estimated on.
SAMPLE_ROWS = 512
#: Evaluations of a rule that are timed together, how often, and the cost in seconds below which rules count as equal.
EVALUATIONS, REPEATS, LEAST_COST = 20_000, 3, 1e-6
SYMBOLS = "#*$%&|<>"
LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A name and the condition, over `text` and the base columns, under which a document fails."""

    name: str
    fails: Callable[[], Column]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once, also where body uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def count_chars(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _covered(positions: Column, width: int) -> Column:
    """How many places the windows of a width that start at these ascending positions cover."""
    start = F.struct(F.lit(-width).alias("last"), F.lit(0).alias("total"))
    step = lambda acc, x: F.struct(x.alias("last"), (acc["total"] + F.least(F.lit(width), x - acc["last"])).alias("total"))
    return F.aggregate(positions, start, step, lambda acc: acc["total"])


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words inside windows of `width` words that occur at least twice in the text, the first occurrence included.

    Windows are compared by 64-bit hashes: no shuffle, and n log n in the text's length."""

    def marked(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda s, e, k, d: F.coalesce(F.get(s, k + d)["h"] == e["h"], F.lit(False))
        twice = _let(pairs, lambda s: F.filter(s, lambda e, k: same(s, e, k, -1) | same(s, e, k, 1)))
        return _covered(F.sort_array(F.transform(twice, lambda e: e["i"])), width)

    def count(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(width))))
        some = _let(grams, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), marked(h)).otherwise(0))
        return F.when(F.size(w) > width, some).otherwise(0)

    return _let(words, count).cast("bigint")


def adjacent_repeats(words: Column) -> Column:
    """Words equal to the word before them."""
    return _let(words, lambda w: F.size(F.filter(w, lambda x, i: (i > 0) & (F.get(w, i - 1) == x))))


def base_columns(docs: DataFrame) -> DataFrame:
    """docs with text made non-null, words, n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(F.col("text"), "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    return (
        docs.withColumn("text", text)
        .withColumn("words", word_array(F.col("text")))
        .withColumn("lines", lines)
        .withColumns(
            {
                "n_words": F.size("words").cast("bigint"),
                "word_chars": F.length(F.translate("text", BLANKS, "")).cast("bigint"),
                "n_symbols": count_chars(F.col("text"), SYMBOLS).cast("bigint"),
                "n_lines": F.size("lines").cast("bigint"),
                "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
                "n_repeat_words": repeated_words(F.col("words")),
            }
        )
        .withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    )


#: The cascade's own rules, after the base ones. Thresholds are shares of words, lines or letters.
RULES = (
    Rule("symbols", lambda: 10 * F.col("n_symbols") > F.col("n_words")),
    Rule("word_length", lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 14 * F.col("n_words"))),
    Rule("repeated_lines", lambda: 2 * F.col("n_dup_lines") > F.col("n_lines")),
    Rule("capitals", lambda: count_chars(F.col("text"), UPPER) > count_chars(F.col("text"), LOWER)),
    Rule("stutter", lambda: 10 * adjacent_repeats(F.col("words")) > 3 * F.col("n_words")),
)


def rank_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, rejected share, seconds a row) by descending rejection per cost, measured on the sample.

    The sample holds the rows whose hash of doc_id falls in the lowest sample_rows / count part of all hashes."""
    total = docs.count()
    if not total:
        return [(r, 0.0, 1.0) for r in rules]
    draws = 1 << 40
    chosen = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(draws)) < F.lit(int(min(1.0, sample_rows / total) * draws))).select("doc_id", "text")
    sample = materialise(base_columns(chosen), "quality-sample")
    rows = sample.count()
    if not rows:
        return [(r, 0.0, 1.0) for r in rules]
    many = sample.select("*", F.explode(F.sequence(F.lit(1), F.lit(max(1, EVALUATIONS // rows)))).alias("__again"))

    def seconds(of: list[Column]) -> float:
        """Of an aggregate over all evaluations: the least of REPEATS runs, for all else that runs only adds."""
        taken = []
        for _ in range(REPEATS):
            began = time.perf_counter()
            # an argument that changes by row, so that no run is folded into one evaluation
            many.agg(F.count("__again"), *of).first()
            taken.append(time.perf_counter() - began)
        return min(taken)

    rejected = sample.agg(*(F.count_if(r.fails()) for r in rules)).first()
    idle = seconds([])
    measured = []
    for rule, n in zip(rules, rejected, strict=True):
        cost = (seconds([F.count_if(rule.fails())]) - idle) / max(rows, EVALUATIONS // rows * rows)
        # steps of four, so that noise does not reorder rules from run to run; what is below the first costs the same
        step = max(0, round(log(max(cost, LEAST_COST) / LEAST_COST, 4)))
        measured.append((rule, n / rows, LEAST_COST * 4**step))
    return sorted(measured, key=lambda x: -x[1] / x[2])


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """docs' base columns and the cascade's verdict: base_failed, kept.

    Base rules run first because their columns are part of the result anyway."""
    ranked = [r for r, _, _ in rank_rules(docs, rules, sample_rows)]
    kept = F.when(F.col("base_failed"), False)
    for rule in ranked:
        kept = kept.when(rule.fails(), False)
    return base_columns(docs).withColumn("kept", kept.otherwise(True))
