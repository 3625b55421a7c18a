"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a rejection test on a text's measures. On a bounded random sample the cost of every rule (its run time) and
its selectivity (the share it rejects) are measured; rules are then tried in order of rejections per cost, and a text
that one rejects is not measured further. The order changes the work, never the verdict.

Null, empty and blank texts have no words; every measure is 0 and the word count rejects them. Each row is judged on its
own, so repeated rows and ids get equal verdicts. Columns named like a measure are replaced.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of

SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
RUN = 5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+"), "")


def runs(word: Column) -> Column:
    """One hash for each run of five neighbouring words."""
    each = F.transform(F.sequence(F.lit(1), F.size(word) - (RUN - 1)), lambda i: F.xxhash64(*[F.get(word, i + (k - 1)) for k in range(RUN)]))
    return F.when(F.size(word) >= RUN, each).otherwise(F.array().cast("array<bigint>"))


def covered(run: Column) -> Column:
    """How many words stand in a run that occurs twice or more, given the hash of the run at each place."""
    placed = F.sort_array(F.transform(run, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda s, e, j: F.get(s, j)["h"] == e["h"]
    twice = let(placed, lambda s: F.filter(s, lambda e, j: F.coalesce(same(s, e, j + 1), F.lit(False)) | F.when(j > 0, same(s, e, j - 1)).otherwise(False)))
    starts = F.sort_array(F.transform(twice, lambda e: e["i"]))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    total = F.aggregate(
        starts, zero, lambda a, x: F.struct((a["n"] + (x + RUN - F.greatest(x, a["end"]))).alias("n"), (x + RUN).alias("end"))
    )["n"]
    return F.when(F.size(F.array_distinct(run)) < F.size(run), total).otherwise(F.lit(0).cast("long"))


def dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_SPACE))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_lines(text: Column) -> Column:
    return F.size(F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_SPACE))).cast("long")


@dataclass(frozen=True)
class Rule:
    """``rejects`` tells from the text, its words and its runs whether the rule rejects it (never null)."""

    name: str
    rejects: Callable[[Column, Column, Column], Column]


RULES = (
    Rule("few_words", lambda t, w, r: F.size(w) < 10),
    Rule("repeats", lambda t, w, r: 100 * covered(r) > 20 * F.size(w)),
    Rule("symbols", lambda t, w, r: 10 * F.regexp_count(t, F.lit(SYMBOL)) > F.size(w)),
    Rule("word_length", lambda t, w, r: let(F.length(F.array_join(w, "")), lambda c: (c < 2 * F.size(w)) | (c > 15 * F.size(w)))),
    Rule("dup_lines", lambda t, w, r: 2 * dup_lines(t) > n_lines(t)),
    Rule("shouting", lambda t, w, r: 10 * F.regexp_count(t, F.lit(r"\p{Lu}")) > 4 * F.length(t)),
    Rule("digits", lambda t, w, r: 2 * F.regexp_count(t, F.lit("[0-9]")) > F.length(t)),
)


def parts(docs: DataFrame, text: str) -> DataFrame:
    """Add ``__text``, ``__words`` and ``__runs``, each worked out once per row."""
    return docs.withColumn("__text", text_of(text)).withColumn("__words", words(F.col("__text"))).withColumn("__runs", runs(F.col("__words")))


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    cost: float
    selectivity: float


def estimate(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, rows: int = 2000, seed: int = 5) -> list[Estimate]:
    """Rules in the order to try them, with cost (seconds over the sample) and selectivity. About ``rows`` rows are
    drawn at random; an empty table keeps the given order."""
    total = docs.count()
    if not total:
        return [Estimate(r, 0.0, 0.0) for r in rules]
    drawn = docs.select(F.col(text).alias("text")).sample(False, min(1.0, rows / total), seed)
    held = parts(stored(drawn, "sample").coalesce(1), "text")
    t, w, r = F.col("__text"), F.col("__words"), F.col("__runs")

    def run(test: Column) -> tuple[float, float]:
        began = time.perf_counter()
        share = held.agg(F.avg(test.cast("double"))).first()[0]
        return time.perf_counter() - began, share or 0.0

    run(F.size(r) < 0)
    base = min(run(F.lit(False))[0] for _ in range(2))
    found = []
    for rule in rules:
        tries = [run(rule.rejects(t, w, r)) for _ in range(2)]
        found.append(Estimate(rule, max(min(x for x, _ in tries) - base, 1e-3), tries[0][1]))
    return sorted(found, key=lambda e: -e.selectivity / e.cost)


def verdict(order: list[Estimate]) -> Column:
    """True if no rule rejects the row; rules after the first that rejects are not evaluated. Over :func:`parts`."""
    t, w, r = F.col("__text"), F.col("__words"), F.col("__runs")
    kept = F.lit(True)
    for e in reversed(order):
        kept = F.when(e.rule.rejects(t, w, r), F.lit(False)).otherwise(kept)
    return kept


def measures(docs: DataFrame, order: list[Estimate], text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed and kept (boolean). The
    cascade decides the rows that the base rules leave."""
    t, w = F.col("__text"), F.col("__words")
    rest = [e for e in order if e.rule.name not in ("few_words", "repeats")]
    rows = parts(docs, text).withColumns({
        "n_words": F.size(w).cast("long"),
        "word_chars": (F.length(F.array_join(w, ""))).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit(SYMBOL)).cast("long"),
        "n_dup_lines": dup_lines(t),
        "n_repeat_words": covered(F.col("__runs")),
    })
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    return rows.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict(rest))).drop("__text", "__words", "__runs")


def keep(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects; columns unchanged.

    The row number keeps the optimizer from moving the test below the projection that splits the text, where it would
    split it again for every word."""
    rows = parts(docs, text).withColumn("__at", F.monotonically_increasing_id())
    return rows.where(verdict(estimate(docs, text)) & (F.col("__at") >= 0)).select(*[F.col(f"`{c}`") for c in docs.columns])
