"""Operator 8: quality rules as a learned decision list, in DataFrame functions only.

``statistics`` measures every whole text with built-in functions.  ``learn`` covers the
documents labelled bad one rule at a time: a rule grows by the threshold condition with
the best information gain on two thirds of the labelled rows, is pruned from its end on the
other third, and is accepted while it is precise there.  A step is one aggregate that
returns label counts per (statistic, threshold bin); the driver sees those counts only.
``verdict`` turns the list into one ordered conditional expression.

Edge cases.  A null or blank text has zero in every statistic, fails the base rules and is
not kept.  Null labels and labels without a document are not learned from; of repeated labels
the smallest counts.  Without labels the list is empty and the base rules alone decide.
An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.storage import Scratch

SPACES = r"[\x20\x09-\x0D]+"
WINDOW = 5
BINS = 32
MAX_RULES = 8
MAX_CONDITIONS = 4
MIN_PRECISION = 0.95
MIN_SUPPORT = 3
#: Statistics that rules may test, as rates so that they mean the same at every length.
FEATURES = {
    "words": "n_words",
    "word_length": "word_chars / n_words",
    "symbol_rate": "n_symbols / n_words",
    "dup_line_rate": "n_dup_lines / n_lines",
    "repeat_rate": "n_repeat_words / n_words",
    "upper_rate": "n_upper / word_chars",
    "exclaim_rate": "n_exclaim / n_words",
    "digit_rate": "n_digits / word_chars",
    "distinct_rate": "n_distinct / n_words",
}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value >= threshold, else value < threshold
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value >= self.threshold if self.above else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _window_hashes(words: str) -> Column:
    """A hash of every five-word window, in text order; ``words`` names a stored array column."""
    at = F.transform(F.col(words), lambda w, i: F.xxhash64(w, *[F.get(F.col(words), i + k) for k in range(1, WINDOW)]))
    return F.slice(at, F.lit(1), F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))


def _twin_starts(placed: Column, m: Column) -> Column:
    """Positions, in order, of the windows that have an equal one; ``placed`` is sorted (hash, position)."""
    twins = F.zip_with(F.slice(placed, F.lit(1), m), F.slice(placed, F.lit(2), m),
                       lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    return F.sort_array(F.array_distinct(F.flatten(F.filter(twins, lambda x: x.isNotNull()))))


def _covered(starts: Column) -> Column:
    """Words that the windows at the sorted ``starts`` cover."""
    return F.aggregate(
        starts, F.struct(F.lit(0).alias("end"), F.lit(0).alias("total")),
        lambda acc, p: F.struct((p + WINDOW).alias("end"),
                                (acc["total"] + (p + WINDOW) - F.greatest(p, acc["end"])).alias("total")),
        lambda acc: acc["total"])


def statistics(docs: DataFrame) -> DataFrame:
    """Statistics of (doc_id, text): n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and others."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def among(pattern: str) -> Column:
        return F.regexp_count(F.col("text"), F.lit(pattern)).cast("bigint")

    # One projection a step: each array is computed once and read by the next step.
    arrays = docs.select("doc_id", text.alias("text"), words.alias("ws"), lines.alias("ls"))
    hashed = arrays.withColumn("hashes", _window_hashes("ws"))
    twins = hashed.withColumn("repeats", F.size(F.array_distinct("hashes")) < F.size("hashes"))
    placed = twins.withColumn("placed", F.when(F.col("repeats"), F.sort_array(
        F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    starts = placed.withColumn("starts", F.when(F.col("repeats"), _twin_starts(F.col("placed"), F.size("placed") - 1)))
    return starts.select(
        "doc_id", F.size("ws").cast("bigint").alias("n_words"),
        F.length(F.array_join("ws", "")).cast("bigint").alias("word_chars"),
        among(r"[#*$%&|<>]").alias("n_symbols"),
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.col("repeats"), _covered(F.col("starts"))).otherwise(0).cast("bigint").alias("n_repeat_words"),
        F.size("ls").cast("bigint").alias("n_lines"),
        among("[A-Z]").alias("n_upper"), among("!").alias("n_exclaim"), among("[0-9]").alias("n_digits"),
        F.size(F.array_distinct("ws")).cast("bigint").alias("n_distinct"),
    )


def with_features(stats: DataFrame) -> DataFrame:
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rates = {name: F.coalesce(F.try_divide(*(F.expr(p).cast("double") for p in rule.split(" / "))), F.lit(0.0))
             if "/" in rule else F.expr(rule).cast("double") for name, rule in FEATURES.items()}
    return stats.withColumns(rates | {"base_failed": failed})


def _holds(rule: Sequence[Condition]) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def _binned(labelled: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """doc_id, label and ``bins``: for every statistic the number of thresholds at or below its value."""
    def bin_of(f: str) -> Column:
        return F.size(F.filter(F.array(*[F.lit(t) for t in cuts[f]]), lambda t: t <= F.col(f))).alias(f)

    bins = [bin_of(f) for f in cuts]
    return labelled.select("doc_id", "label", *bins)


def _bin_holds(rule: Sequence[Condition], cuts: dict[str, list[float]]) -> Column:
    """The rule over binned rows."""
    out = F.lit(True)
    for c in rule:
        k = cuts[c.feature].index(c.threshold)
        out = out & (F.col(c.feature) > k if c.above else F.col(c.feature) <= k)
    return out


def _counts(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[str, list[list[int]]]:
    """Per statistic and bin: [bad, good] of the binned rows."""
    cells = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in cuts])
    out = {name: [[0, 0] for _ in range(len(at) + 1)] for name, at in cuts.items()}
    for f, b, label, n in rows.select("label", F.explode(cells).alias("c")).groupBy("c.f", "c.b", "label").count().collect():
        out[f][b][int(label)] += n
    return out


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS:
        counts = _counts(rows.where(_bin_holds(rule, cuts)), cuts)
        bad, good = (sum(c[k] for c in next(iter(counts.values()))) for k in (0, 1))
        if not bad or not good:
            break
        before, best = math.log2(bad / (bad + good)), (0.0, None)
        for name, at in cuts.items():
            for k, threshold in enumerate(at):
                for above in (True, False):
                    part = counts[name][k + 1:] if above else counts[name][: k + 1]
                    p, q = sum(c[0] for c in part), sum(c[1] for c in part)
                    if p >= MIN_SUPPORT:
                        best = max(best, (p * (math.log2(p / (p + q)) - before), Condition(name, above, threshold)),
                                   key=lambda x: x[0])
        if best[1] is None or best[1] in rule:
            break
        rule.append(best[1])
    return tuple(rule)


def _prune(rows: DataFrame, rule: Rule, cuts: dict[str, list[float]]) -> tuple[Rule, int, int]:
    """The prefix of the rule that separates best, with the bad and good rows it covers."""
    sums = []
    for n in range(1, len(rule) + 1):
        for label in (0, 1):
            sums.append(F.sum(F.when(_bin_holds(rule[:n], cuts) & (F.col("label") == label), 1).otherwise(0)))
    row = rows.agg(*[s.alias(f"s{k}") for k, s in enumerate(sums)]).first()
    worth = []
    for n in range(1, len(rule) + 1):
        p, q = row[2 * n - 2] or 0, row[2 * n - 1] or 0
        worth.append(((p - q) / (p + q) if p + q else -1.0, p, -n))
    value, p, n = max(worth)
    return rule[:-n], p, (row[-2 * n - 1] or 0)


def learn(labelled: DataFrame, scratch: Scratch) -> list[Rule]:
    """Ordered rules that reject, from rows of ``with_features`` with ``label`` (0 bad, 1 good)."""
    quantiles = [k / (BINS + 1) for k in range(1, BINS + 1)]
    row = labelled.agg(*[F.percentile_approx(f, quantiles, 1000).alias(f) for f in FEATURES],
                       F.max(F.when(F.col("label") == 0, 1)).alias("any_bad")).first()
    if not row["any_bad"]:
        return []
    bad_row = labelled.where("label = 0").agg(*[F.percentile_approx(f, quantiles, 1000).alias(f) for f in FEATURES]).first()
    cuts = {f: sorted({*row[f], *bad_row[f]}) for f in FEATURES}
    binned = scratch.store(_binned(labelled, cuts), "binned")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))
    grow, prune = binned.where(fold != 0), binned.where(fold == 0)
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        left = F.lit(True)
        for earlier in rules:
            left = left & ~_bin_holds(earlier, cuts)
        rule = _grow(grow.where(left), cuts)
        if not rule:
            break
        rule, bad, good = _prune(prune.where(left), rule, cuts)
        if bad < MIN_SUPPORT or bad < MIN_PRECISION * (bad + good):
            break
        rules.append(rule)
    return rules


def verdict(rules: Sequence[Rule]) -> Column:
    """The decision list as one conditional expression: true where no rule rejects."""
    if not rules:
        return F.lit(True)
    first, *rest = rules
    out = F.when(_holds(first), F.lit(False))
    for rule in rest:
        out = out.when(_holds(rule), F.lit(False))
    return out.otherwise(F.lit(True))


def apply_quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics and verdict of every document (doc_id, text); ``labels`` has doc_id and quality (0 or 1)."""
    scratch = Scratch(docs.sparkSession, "quality-rules")
    stats = scratch.store(with_features(statistics(docs.select("doc_id", "text"))), "statistics")
    known = (labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id")
             .agg(F.min("quality").cast("int").alias("label")))
    labelled = scratch.store(stats.where("not base_failed").join(known, "doc_id"), "labelled")
    rules = learn(labelled, scratch)
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        (~F.col("base_failed") & verdict(rules)).alias("kept"))
