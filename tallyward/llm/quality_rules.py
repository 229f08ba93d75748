"""Quality rules as a short-circuit cascade.

Each rule is a predicate that is true where a document fails.  On a bounded sample the operator measures
what a rule costs and how much it rejects, and orders the rules by rejection per cost; a later rule is
evaluated only for documents that passed the earlier ones.  The verdict is the conjunction of all rules,
so it does not depend on the order, hence not on the sample.

Edge cases: a NULL text is an empty one: no words, counts 0, ``base_failed`` and not kept.  Rows are judged
one by one, so repeated rows get equal verdicts; other columns of the input are kept out of the way (the result
holds ``doc_id`` and computed columns only).  An empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.text import let, stored, words

SAMPLE_ROWS = 500  # rows on which costs and selectivities are estimated, at most
SYMBOLS = "[#*$%&|<>]"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``fails`` is over the columns ``text``, ``words``, ``lines`` and those of ``BASE``."""

    name: str
    fails: Column


def share(part: Column, whole: str | Column) -> Column:
    return F.coalesce(F.try_divide(part, F.col(whole) if isinstance(whole, str) else whole), F.lit(0.0))


def lines_like(pattern: str) -> Column:
    return F.size(F.filter("lines", lambda line: line.rlike(pattern)))


def base_rules() -> list[Rule]:
    return [
        Rule("few_words", F.col("n_words") < 50),
        Rule("repeated_words", 100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    ]


def default_rules() -> list[Rule]:
    """The base rules and the common heuristics for prose in any language."""
    mean = share(F.col("word_chars"), "n_words")
    lettered = F.size(F.filter("words", lambda w: w.rlike("\\p{L}")))
    return [
        *base_rules(),
        Rule("symbols", 10 * F.col("n_symbols") > F.col("n_words")),
        Rule("repeated_lines", 2 * F.col("n_dup_lines") > F.size("lines")),
        Rule("word_length", (mean < 2) | (mean > 15)),
        Rule("letters", 10 * lettered < 7 * F.col("n_words")),
        Rule("doubled_marks", 10 * F.regexp_count("text", F.lit("[!?;:,]{2,}")) > F.col("n_words")),
        Rule("bullets", 10 * lines_like("^[ \\t]*[-*•‣·]") > 9 * F.size("lines")),
        Rule("ellipsis", 10 * lines_like("(\\.\\.\\.|…)[ \\t\\r]*$") > 3 * F.size("lines")),
    ]


def repeat_words(list_of_words: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text."""

    def windows(w: Column) -> Column:
        hashed = lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])
        return F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(0), F.size(w) - 3), hashed))

    def covered(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            beside = lambda x, i: x["h"].eqNullSafe(F.get(s, i)["h"])  # noqa: E731  NULL outside the array
            same = lambda x, i: beside(x, i - 1) | beside(x, i + 1)
            return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

        # A window covers three words, less those that the next repeated window covers too.
        gaps = lambda p: F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
        return F.aggregate(let(let(placed, positions), gaps), F.lit(0), lambda a, x: a + x)

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0)

    return F.coalesce(let(windows(list_of_words), count), F.lit(0))


def features(docs: DataFrame) -> DataFrame:
    """``doc_id``, the text, its words and lines with a word, and the counts of ``BASE``."""
    split = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id",
        "text",
        words(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike("[^ \\t-\\r]")).alias("lines"),
    )
    counts = {
        "n_words": F.size("words"),
        "word_chars": F.char_length(F.array_join("words", "")),
        "n_symbols": F.regexp_count("text", F.lit(SYMBOLS)),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": repeat_words(F.col("words")),
    }
    return split.select("*", *[c.cast("long").alias(n) for n, c in counts.items()])


def ordered(docs: DataFrame, rules: Sequence[Rule], rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by falling rejection per cost, both measured on at most ``rows`` rows."""
    total = docs.count()  # of a stored table: from the footers
    every = max(1, total // rows)
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select("doc_id", "text").limit(rows)
    ready = stored(features(sample), "rule-sample")

    def seconds(what: Column) -> tuple[float, int]:
        best, hits = 1e9, 0
        for _ in range(2):  # the first run compiles
            began = time.perf_counter()
            hits = ready.agg(F.count_if(what)).first()[0]
            best = min(best, time.perf_counter() - began)
        return best, hits

    idle, _ = seconds(F.col("n_words") < 0)
    rates = {}
    for rule in rules:
        took, hits = seconds(rule.fails)
        rates[rule.name] = hits / max(took - idle, 1e-4)
    return sorted(rules, key=lambda rule: -rates[rule.name])


def cascade(docs: DataFrame, rules: Sequence[Rule] | None = None, order: Sequence[Rule] | None = None) -> DataFrame:
    """doc_id, the counts of ``BASE``, ``base_failed``, ``kept`` and ``rejected_by`` (the first failing rule in the order used)."""
    rules = default_rules() if rules is None else list(rules)
    order = ordered(docs, rules) if order is None else order
    first = F.lit(None).cast("string")
    for rule in reversed(list(order)):  # nested conditions: an inner rule runs only where the outer ones passed
        first = F.when(rule.fails, F.lit(rule.name)).otherwise(first)
    base = base_rules()
    judged = features(docs).select("doc_id", *BASE, first.alias("rejected_by"), (base[0].fails | base[1].fails).alias("base_failed"))
    kept = F.col("rejected_by").isNull() & ~F.col("base_failed")
    return judged.select("doc_id", *BASE, "base_failed", kept.alias("kept"), "rejected_by")
