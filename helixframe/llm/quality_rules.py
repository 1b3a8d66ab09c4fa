"""Quality rules: a threshold table compiled into one Spark projection.

Every metric is a built-in expression over the whole text; a rule is a row
``(name, metric, lowest, highest)`` of :data:`RULES` and the verdict is the
conjunction of all of them, compiled by :func:`verdict`.  No user function,
no shuffle: one scan, one projection.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, whole, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Frequent function words of the four languages of the corpus.
STOP_WORDS = ("the be to of and that have with is in "
              "der die das und zu den ist ein nicht von "
              "le la les des et un une est que pour "
              "el los de y en por se del las con").split()
CAPITALISED = [w.capitalize() for w in STOP_WORDS]


@dataclass(frozen=True)
class Rule:
    """``lowest <= metric <= highest``; a bound of None is open."""
    name: str
    metric: str
    lowest: float | None = None
    highest: float | None = None


#: Base rules of the contract, compared in integers (see ``base_failed``), come first; these follow.
RULES = (
    Rule("word_count", "n_words", 20, None),
    Rule("mean_word_length", "mean_word_chars", 2, 14),
    Rule("symbol_ratio", "symbols_per_word", None, 0.3),
    Rule("stop_words", "stop_word_ratio", 0.01, None),
    Rule("duplicate_lines", "dup_line_ratio", None, 0.5),
    Rule("bullet_lines", "bullet_line_ratio", None, 0.9),
    Rule("ellipsis_lines", "ellipsis_line_ratio", None, 0.3),
    Rule("alphabetic_words", "alpha_word_ratio", 0.6, None),
)

def _paired(h: Column, step: int) -> Column:
    """Hash of each element with the one ``step`` further on."""
    return F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + step)))


def _covered(sorted_windows: Column) -> Column:
    """Words covered by the windows that equal a neighbour in hash order."""
    def equal(i: Column, j: Column) -> Column:
        return F.coalesce(F.get(sorted_windows, i)["h"] == F.get(sorted_windows, j)["h"], F.lit(False))

    starts = F.sort_array(F.transform(
        F.filter(sorted_windows, lambda x, i: equal(i, i - 1) | equal(i, i + 1)), lambda x: x["p"]))
    total = F.aggregate(
        starts, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("sum")),
        lambda a, p: F.struct(p.alias("last"), (a["sum"] + F.least(F.lit(WINDOW), p - a["last"])).alias("sum")),
        lambda a: a["sum"])
    return total


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeat_words(w: Column, n: Column) -> Column:
    """Words inside 8-word windows that occur twice or more in the text.
    Windows are hashed in three doublings (2, 4, 8 words; 64 bits suffice,
    as windows meet within one text only).  Where some hash repeats, windows
    are sorted by hash and those equal to a neighbour kept."""
    def count(windows: Column) -> Column:
        repeats = F.size(F.array_distinct(windows)) < F.size(windows)
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return F.when(repeats, _let(placed, _covered)).otherwise(F.lit(0))

    def whole_windows(h: Column) -> Column:  # the last 7 starts have none
        return _let(F.slice(h, F.lit(1), n - (WINDOW - 1)), count)

    hashed = _let(F.transform(w, lambda x: F.xxhash64(x)),
                  lambda one: _let(_paired(one, 1), lambda two: _let(_paired(two, 2), lambda four: _let(
                      _paired(four, 4), whole_windows))))
    return F.when(n >= WINDOW, hashed).otherwise(F.lit(0))


def metrics(docs: DataFrame) -> DataFrame:
    """doc_id and every metric of the rules, from the whole text.  A null or
    empty text has zero words, lines and ratios; ties and repeated rows do
    not matter, since each row is judged by itself."""
    text = whole("text")
    t = docs.select("doc_id", text.alias("t"))
    t = t.select("doc_id", "t", words(F.col("t")).alias("w"),
                 F.filter(F.split("t", "\n"), lambda x: x.rlike(f"[^{WS}]")).alias("lines"))
    n, lines = F.size("w"), F.size("lines")

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    out = t.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.char_length("t") - F.char_length(F.regexp_replace("t", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (lines - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("w"), n).cast("long").alias("n_repeat_words"),
        ratio(F.size(F.filter("w", lambda x: x.isin(*STOP_WORDS, *CAPITALISED))), n).alias("stop_word_ratio"),
        ratio(F.regexp_count("t", F.lit(rf"\p{{L}}[^{WS}]*+")), n).alias("alpha_word_ratio"),
        ratio(F.size(F.filter("lines", lambda x: x.rlike(r"^\s*[-*•]"))), lines).alias("bullet_line_ratio"),
        ratio(F.size(F.filter("lines", lambda x: x.rlike(r"(\.\.\.|…)\s*$"))), lines).alias("ellipsis_line_ratio"),
        lines.alias("n_lines"))
    return out.withColumns({
        "mean_word_chars": ratio(F.col("word_chars"), F.col("n_words")),
        "symbols_per_word": ratio(F.col("n_symbols"), F.col("n_words")),
        "dup_line_ratio": ratio(F.col("n_dup_lines"), F.col("n_lines"))})


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """The threshold table as one boolean expression."""
    ok = F.lit(True)
    for r in rules:
        if r.lowest is not None:
            ok = ok & (F.col(r.metric) >= F.lit(r.lowest))
        if r.highest is not None:
            ok = ok & (F.col(r.metric) <= F.lit(r.highest))
    return ok


def failed_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules a row fails, for reports."""
    return F.array_compact(F.array(*[F.when(~verdict((r,)), F.lit(r.name)) for r in rules]))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: metrics, ``base_failed`` and ``kept``."""
    return (metrics(docs).withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & verdict(rules)))


def apply_quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents the rules keep, with their columns as they came.  The
    whole row rides along as one struct, so no join is needed and no column
    of the input can clash with a metric."""
    cols = docs.columns
    judged = _metrics_with_row(docs)
    return (judged.where(~base_failed() & verdict(rules))
            .select(*[F.col("__row")[c].alias(c) for c in cols]))


def _metrics_with_row(docs: DataFrame) -> DataFrame:
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return metrics(docs.select(row.alias("doc_id"), "text")).withColumnRenamed("doc_id", "__row")
