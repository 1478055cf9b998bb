"""Quality rules: text statistics, and decision lists learned from labelled documents.

The list is grown by sequential covering: each rule is a conjunction of
thresholds on statistics, grown on two thirds of the labelled rows by
information gain, pruned on the last third, and kept if it is precise there.
Rows it covers are left out and the next rule is grown, until none can be;
rows covered by a rule that is not kept are left out of growing only. All counts are Spark
aggregates over all labelled rows; the driver sees counts per feature and bin.
The result is an ordered ``CASE WHEN`` over built-in expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.llm.common import SPACE, let, table, without
from celltide.sources.workspace import Workspace

WINDOW = 8
_SYMBOLS = "#*$%&|<>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SHARES = (0.005, 0.01, 0.02, 0.03, 0.05, 0.075, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
#: Thresholds a rule may use, by feature.
GRIDS: dict[str, tuple[float, ...]] = {
    "symbol_share": _SHARES,
    "upper_share": _SHARES,
    "digit_share": _SHARES,
    "bang_share": _SHARES,
    "stop_share": _SHARES,
    "dup_line_share": _SHARES,
    "repeat_share": _SHARES,
    "distinct_share": _SHARES,
    "mean_word_chars": (2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0, 5.5, 6.0, 6.5, 7.0, 7.5, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0),
    "words_per_line": (1.0, 2.0, 3.0, 5.0, 8.0, 12.0, 20.0, 40.0, 80.0, 160.0, 320.0, 640.0),
    "n_words": (20.0, 30.0, 50.0, 80.0, 120.0, 200.0, 400.0, 800.0, 1600.0, 3200.0, 6400.0),
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATISTICS = (*BASE, *[f for f in GRIDS if f not in BASE])


def _count(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def _repeated_words(words: Column) -> Column:
    """Words lying in a window of 8 words that occurs twice or more, its first occurrence included.

    Windows are compared by 64-bit hashes of their words' hashes. Where all
    differ, nothing else is done; otherwise they are sorted, and the covered
    stretches of the repeated ones are added up.
    """
    no_windows = F.array().cast("array<bigint>")

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
        window = F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))
        return F.when(F.size(hashes) >= WINDOW, window).otherwise(no_windows)

    def repeated_starts(sorted_windows: Column) -> Column:
        def is_repeated(window: Column, i: Column) -> Column:
            same_as = [F.get(sorted_windows, j)["hash"] == window["hash"] for j in (i - 1, i + 1)]
            return F.coalesce(same_as[0], F.lit(False)) | F.coalesce(same_as[1], F.lit(False))

        return F.array_sort(F.transform(F.filter(sorted_windows, is_repeated), lambda w: w["start"]))

    def covered(found: Column) -> Column:
        numbered = F.transform(found, lambda h, i: F.struct(h.alias("hash"), i.alias("start")))

        def stretch(starts: Column) -> Column:
            gap = lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - s, F.lit(WINDOW)))
            return F.aggregate(F.transform(starts, gap), F.lit(0), lambda a, x: a + x)

        return let(let(F.array_sort(numbered), repeated_starts), stretch)

    all_differ = lambda found: F.size(F.array_distinct(found)) == F.size(found)
    found = let(F.transform(words, lambda w: F.xxhash64(w)), windows)
    return let(found, lambda w: F.when(all_differ(w), 0).otherwise(covered(w)))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row with the columns of ``STATISTICS`` added.

    A null text counts as an empty one: all counts and shares are 0. Input
    columns named like a statistic are replaced.
    """
    whole, words, lines = F.col("_text"), F.col("_words"), F.col("_lines")
    share = lambda part, total: F.when(F.col(total) > 0, F.col(part) / F.col(total)).otherwise(0.0)
    extra = ("_text", "_words", "_lines", "_n_lines", "_upper", "_digits", "_bangs", "_stops", "_distinct")
    long = lambda c: c.cast("bigint")
    counted = (
        without(docs, [*STATISTICS, *extra])
        .withColumn("_text", F.coalesce(F.col(text), F.lit("")))
        .withColumns(
            {
                "_words": F.filter(F.split(whole, SPACE), lambda w: w != ""),
                "_lines": F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
            }
        )
        .withColumns(
            {
                "n_words": long(F.size(words)),
                "word_chars": long(F.char_length(F.translate(whole, " \t\n\x0b\x0c\r", ""))),
                "n_symbols": long(_count(whole, _SYMBOLS)),
                "n_dup_lines": long(F.size(lines) - F.size(F.array_distinct(lines))),
                "n_repeat_words": long(_repeated_words(words)),
                "_n_lines": F.size(lines),
                "_upper": _count(whole, _UPPER),
                "_digits": _count(whole, "0123456789"),
                "_bangs": _count(whole, "!?"),
                "_stops": _count(whole, ".,;:"),
                "_distinct": F.size(F.array_distinct(words)),
            }
        )
    )
    return counted.withColumns(
        {
            "symbol_share": share("n_symbols", "word_chars"),
            "upper_share": share("_upper", "word_chars"),
            "digit_share": share("_digits", "word_chars"),
            "bang_share": share("_bangs", "word_chars"),
            "stop_share": share("_stops", "word_chars"),
            "dup_line_share": share("n_dup_lines", "_n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "distinct_share": share("_distinct", "n_words"),
            "mean_word_chars": share("word_chars", "n_words"),
            "words_per_line": share("n_words", "_n_lines"),
        }
    ).drop(*extra)


def base_failed() -> Column:
    """Fewer than 20 words, or over 30 % of them in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclass(frozen=True)
class Threshold:
    """``feature > threshold`` if above, else ``feature <= threshold``."""

    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Threshold, ...]


def matches(rule: Rule) -> Column:
    return reduce(and_, [t.column() for t in rule])


def _binned_counts(rows: DataFrame) -> tuple[list, int, int]:
    """Rejected and accepted rows per feature and bin; bin k holds values with k thresholds below them."""

    def bin_of(name: str) -> Column:
        below = F.size(F.filter(F.array(*map(F.lit, GRIDS[name])), lambda t: t < F.col(name)))
        return F.struct(F.lit(name).alias("feature"), below.alias("bin"))

    bins = [bin_of(name) for name in GRIDS]
    binned = rows.select("reject", F.explode(F.array(*bins)).alias("b")).groupBy("b.feature", "b.bin")
    found = binned.agg(F.count_if("reject").alias("p"), F.count_if(~F.col("reject")).alias("n")).collect()
    first = next(iter(GRIDS))
    return found, sum(r.p for r in found if r.feature == first), sum(r.n for r in found if r.feature == first)


def evidence(p: int, n: int, p0: int, n0: int) -> float:
    """Twice the log-likelihood ratio of a rule that covers p of p0 rejected and n of n0 accepted rows against chance."""
    cells = ((p, p + n, p0), (n, p + n, n0), (p0 - p, p0 + n0 - p - n, p0), (n0 - n, p0 + n0 - p - n, n0))
    return 2 * sum(x * math.log(x * (p0 + n0) / (row * side)) for x, row, side in cells if x)


def chance(conditions: int, rows: int) -> float:
    """The evidence that the best of all rules with so many conditions may have by chance among ``rows`` rows.

    It rises with the thresholds that were open to choice and with the rows,
    so that labels without a pattern end the learning at every size.
    """
    thresholds = 2 * sum(map(len, GRIDS.values()))
    return 2 * conditions * math.log(thresholds) + math.log(max(rows, 1))


def _best_threshold(rows: DataFrame, min_cover: int) -> tuple[Threshold, int, int, int, int] | None:
    """The threshold with the largest information gain on ``rows``, what it covers, and the rejected and accepted rows.

    Of neighbouring thresholds that cover the same rows, the middle one: it
    keeps its distance from both sides.
    """
    found, p0, n0 = _binned_counts(rows)
    if p0 < min_cover or not n0:
        return None
    best, best_gain = None, 0.0
    for name, grid in GRIDS.items():
        counts = {r.bin: (r.p, r.n) for r in found if r.feature == name}
        for above in (True, False):
            by_cover: dict[tuple[int, int], list[float]] = {}
            for k, threshold in enumerate(grid):
                inside = [c for b, c in counts.items() if (b > k) == above]
                cover = sum(c[0] for c in inside), sum(c[1] for c in inside)
                by_cover.setdefault(cover, []).append(threshold)
            for (p, n), thresholds in by_cover.items():
                if p < min_cover or p + n == p0 + n0:
                    continue
                gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
                if gain > best_gain + 1e-9:
                    middle = thresholds[len(thresholds) // 2]
                    best, best_gain = (Threshold(name, above, middle), p, n, p0, n0), gain
    return best


def _pruned(rule: Rule, rows: DataFrame) -> tuple[Rule, int, int]:
    """The rule cut back to the first conditions that do best on rows it was not grown on."""
    cuts = [rule[: i + 1] for i in range(len(rule))]
    reject = F.col("reject")
    sums = [F.count_if(matches(c) & side) for c in cuts for side in (reject, ~reject)]
    counts = rows.agg(*[s.alias(f"c{i}") for i, s in enumerate(sums)]).first()
    scored = [(cut, counts[2 * i], counts[2 * i + 1]) for i, cut in enumerate(cuts)]
    return max(scored, key=lambda c: ((c[1] - c[2]) / max(1, c[1] + c[2]), -len(c[0])))


def learn(
    labelled: DataFrame,
    max_rules: int | None = None,
    max_conditions: int = 4,
    min_cover: int = 3,
    min_precision: float = 0.95,
) -> list[Rule]:
    """Ordered rules that reject, from rows with the statistics, a boolean ``reject`` and a ``fold`` 0 to 2.

    Rules are grown on folds 0 and 1 and pruned and tested on fold 2. A rule
    that is less precise than ``min_precision`` on fold 2, or covers no
    rejected row there, is not kept: its rows are set aside and growing goes on
    with the others. The list ends when no rule covers ``min_cover`` rejected
    rows any more, when the best one is no better than chance on the rows left
    (see ``chance``), or at ``max_rules`` if given. One class only, or no rows,
    gives no rules. ``labelled`` is scanned once per condition tried: it should
    be a written table.
    """
    grow, prune = labelled.where("fold < 2"), labelled.where("fold = 2")
    rules: list[Rule] = []
    while max_rules is None or len(rules) < max_rules:
        grown: Rule = ()
        rows, covered, base = grow, (0, 0), (0, 0)
        while len(grown) < max_conditions:
            found = _best_threshold(rows, min_cover)
            if found is None:
                break
            base, covered = base if grown else found[3:], found[1:3]
            grown += (found[0],)
            rows = rows.where(found[0].column())
            if not found[2]:
                break
        if not grown or evidence(*covered, *base) < chance(len(grown), sum(base)):
            break
        rule, right, wrong = _pruned(grown, prune)
        if not right or right < min_precision * (right + wrong):
            # the rows the whole rule covers, at least min_cover: what a cut of it covers may be almost all
            grow = grow.where(~matches(grown))
            continue
        rules.append(rule)
        grow, prune = grow.where(~matches(rule)), prune.where(~matches(rule))
    return rules


def labelled_statistics(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of documents with a label of 0 or 1 that the base rules let through.

    A document labelled several times counts as often; labels without document do not.
    """
    known = labels.where("quality IN (0, 1)").select(F.col("doc_id").alias("_labelled"), "quality")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(3))
    return (
        stats.where(~base_failed())
        .join(known, F.col("doc_id") == F.col("_labelled"))
        .select(*GRIDS, (F.col("quality") == 0).alias("reject"), fold.alias("fold"))
    )


def decide(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``base_failed``, ``rule`` (the first that matches, as text, else null) and ``kept``."""
    rule = F.lit(None).cast("string")
    for r in reversed(rules):
        rule = F.when(matches(r), " AND ".join(map(str, r))).otherwise(rule)
    return (
        without(stats, ["base_failed", "rule", "kept"])
        .withColumns({"base_failed": base_failed(), "rule": rule})
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )


def judge(docs: DataFrame, labels: DataFrame, workspace: Workspace) -> DataFrame:
    """Every document with its statistics and verdict, by rules learned from ``labels``.

    The statistics are worked out once and written, with the columns of
    ``docs``; learning and deciding read the written table. An empty table
    stays empty; without labels only the base rules decide.
    """
    stats = workspace.stage(statistics(docs), "statistics")
    labelled = workspace.stage(labelled_statistics(stats, labels), "labelled")
    return decide(stats, learn(labelled))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, learned rule and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # the statistics alone are written: nothing after them reads the text
    stats = Workspace(spark).stage(statistics(docs).drop("text"), "statistics")
    labels = table(spark, sf_dir, "labels")
    labelled = Workspace(spark).stage(labelled_statistics(stats, labels), "labelled")
    return decide(stats, learn(labelled)).select("doc_id", *BASE, "base_failed", "kept", "rule")
