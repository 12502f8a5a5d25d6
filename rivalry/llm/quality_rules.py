"""Quality rules: a decision list learned from labelled statistics.

Statistics of each text are Spark expressions.  Sequential covering learns
from all labelled documents: a rule grows by the threshold that gains most
information about bad documents on one part of the labels, is pruned back on
the other part, and is kept if it is precise there; then the documents it
covers are set aside.  Those of a rule that is not precise are set aside for
growing only, so bad documents of other kinds are still looked for.  The list
ends when the best rule left covers too few bad documents, whatever the number
of rules and tests.  Every step is one aggregation of the binned statistics, so
the driver sees counts per bin only.  The list becomes one ordered conditional
expression.

Null text: no words.  Documents without words fail the base rules.  Of
repeated labels the worst counts; labels that are null or without a document
are ignored; without labels there are no learned rules.  Repeated rows are
judged one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rivalry.llm.common import NOT_SPACE, SPACE, let, table

WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"


def repeated_words(hashes: Column, size: int = WINDOW) -> Column:
    """Words inside windows whose hash occurs twice or more: windows sorted by hash meet their equals, then their
    places are sorted and each covers up to the next one's start."""
    def covered(at: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(0), F.size(at) - 1), F.lit(0),
            lambda n, i: n + F.least(F.lit(size), F.coalesce(F.get(at, i + 1) - F.get(at, i), F.lit(size))))

    def places(s: Column) -> Column:
        equal = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                         | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
        return F.sort_array(F.transform(equal, lambda x: x["i"]))

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return (F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0)
            .otherwise(let(ordered, lambda s: let(places(s), covered))))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``_stats``: the counts of the contract and the features that rules may test."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    counted = lambda pattern: F.regexp_count(F.col("_t"), F.lit(pattern))
    step = (docs.withColumn("_t", t)
            .withColumn("_w", F.array_remove(F.split("_t", SPACE + "+"), ""))
            .withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: x.rlike(NOT_SPACE)))
            .withColumn("_n", F.size("_w"))
            .withColumn("_h", F.when(F.col("_n") >= WINDOW, F.transform(
                F.sequence(F.lit(0), F.greatest(F.col("_n") - WINDOW, F.lit(0))),
                lambda i: F.xxhash64(*[F.get(F.col("_w"), i + k) for k in range(WINDOW)])))
                .otherwise(F.array().cast("array<bigint>")))
            .withColumn("_c", F.struct(
                F.col("_n").cast("long").alias("n_words"),
                F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
                counted(SYMBOLS).cast("long").alias("n_symbols"),
                (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
                repeated_words(F.col("_h")).cast("long").alias("n_repeat_words"),
                F.size(F.array_distinct("_w")).alias("n_distinct"),
                F.size("_l").alias("n_lines"),
                counted("[A-Z]").alias("n_upper"),
                counted("[!?]").alias("n_shouts"),
                counted("[0-9]").alias("n_digits"))))
    c = F.col("_c")
    per_word = lambda n: c[n] / F.greatest(c["n_words"], F.lit(1))
    per_char = lambda n: c[n] / F.greatest(c["word_chars"], F.lit(1))
    stats = F.struct(
        *[c[n].alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        per_word("word_chars").alias("word_length"), per_word("n_symbols").alias("symbols_per_word"),
        (c["n_dup_lines"] / F.greatest(c["n_lines"], F.lit(1))).alias("dup_line_share"),
        per_word("n_repeat_words").alias("repeat_share"), per_word("n_distinct").alias("distinct_share"),
        per_char("n_upper").alias("upper_share"), per_word("n_shouts").alias("shouts_per_word"),
        per_char("n_digits").alias("digit_share"))
    return step.withColumn("_stats", stats).drop("_t", "_w", "_l", "_n", "_h", "_c")


FEATURES = ("word_length", "symbols_per_word", "dup_line_share", "repeat_share", "distinct_share", "upper_share",
            "shouts_per_word", "digit_share")


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < 10) | (100 * stats["n_repeat_words"] > 20 * stats["n_words"])


@dataclass(frozen=True)
class Test:
    """``feature`` above (or not above) its ``cut``-th threshold, ``value``."""
    feature: str
    above: bool
    cut: int
    value: float

    def on(self, stats: Column) -> Column:
        return stats[self.feature] > self.value if self.above else stats[self.feature] <= self.value

    def on_bins(self) -> Column:
        # Bin b holds the values above exactly b thresholds.
        return F.col(self.feature) > self.cut if self.above else F.col(self.feature) <= self.cut

    def __str__(self):
        return f"{self.feature} {'>' if self.above else '<='} {self.value:.6g}"


Rule = tuple[Test, ...]


def every(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def cuts_of(labelled: DataFrame, features=FEATURES, n: int = 48) -> dict[str, list[float]]:
    """Thresholds: midway between neighbouring quantiles of each feature."""
    shares = [i / n for i in range(n + 1)]
    row = labelled.agg(*[F.percentile_approx(f, shares, 10_000).alias(f) for f in features]).first()
    found = {}
    for f in features:
        values = sorted(set(row[f] or []))
        found[f] = [(a + b) / 2 for a, b in zip(values, values[1:])]
    return found


def bin_of(feature: str, cuts: list[float]) -> Column:
    """How many thresholds the value is above."""
    values = F.array(*[F.lit(c) for c in cuts]).cast("array<double>")
    return F.array_size(F.filter(values, lambda c: F.col(feature) > c)).alias(feature)


def learn(labelled: DataFrame, features=FEATURES, precision: float = 0.95, least: float = 0.002) -> list[Rule]:
    """The decision list that rejects bad documents.

    ``labelled`` has the features, ``bad`` and ``_fold`` (0 or 1: grow on 0,
    prune on 1).  A rule needs ``precision`` on the pruning part and must
    cover on each part a share ``least`` of its bad documents (and three of them).
    """
    cuts = cuts_of(labelled, features)
    bins = [bin_of(f, cuts[f]) for f in features]
    binned = table(labelled.select("_fold", "bad", *bins).groupBy("_fold", "bad", *features)
                   .agg(F.count("*").alias("n")), "binned")
    totals = {(r["_fold"], r["bad"]): r["n"] for r in binned.groupBy("_fold", "bad").agg(F.sum("n").alias("n")).collect()}
    need = [max(3, math.ceil(least * totals.get((fold, True), 0))) for fold in (0, 1)]
    rules: list[Rule] = []
    to_grow, to_prune = F.col("_fold") == 0, F.col("_fold") == 1
    while True:
        rule = grow(binned.where(to_grow), cuts, features)
        if not rule:
            return rules
        rule, bad, good = prune(binned.where(to_prune), rule)
        covered = every([t.on_bins() for t in rule])
        grown = binned.where(to_grow & covered & F.col("bad")).agg(F.sum("n").alias("n")).first()["n"]
        if (grown or 0) < need[0]:
            return rules
        if bad >= need[1] and bad >= precision * (bad + good):
            rules.append(tightest(rule))
            to_prune = to_prune & ~covered
        to_grow = to_grow & ~covered


def tightest(rule: Rule) -> Rule:
    """The rule without the tests that a later one of the same feature and direction implies."""
    return tuple(t for i, t in enumerate(rule) if not any((u.feature, u.above) == (t.feature, t.above) for u in rule[i + 1:]))


def grow(rows: DataFrame, cuts: dict, features) -> Rule:
    """Add the test of the largest information gain until no good document is covered, or none gains."""
    rule: Rule = ()
    while True:
        cover = rows.where(every([t.on_bins() for t in rule]))
        entries = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in features])
        counts = (cover.select("bad", "n", F.inline(entries)).groupBy("f", "b", "bad").agg(F.sum("n").alias("n")).collect())
        by: dict[str, dict[int, list[int]]] = {f: {} for f in features}
        for r in counts:
            by[r["f"]].setdefault(r["b"], [0, 0])[r["bad"]] += r["n"]
        good, bad = (sum(x[i] for x in by[features[0]].values()) for i in (0, 1))
        if not bad or not good:
            break
        best, best_gain = None, 0.0
        for f in features:
            below = [0, 0]
            for cut in range(len(cuts[f])):
                below = [below[i] + by[f].get(cut, (0, 0))[i] for i in (0, 1)]
                for above, (g, b) in ((False, below), (True, (good - below[0], bad - below[1]))):
                    # Ties: the first in feature order, the lower threshold.
                    gain = b * (math.log2(b / (b + g)) - math.log2(bad / (bad + good))) if b else 0.0
                    if gain > best_gain + 1e-9:
                        best, best_gain = Test(f, above, cut, cuts[f][cut]), gain
        if best is None:
            break
        rule += (best,)
    return rule


def prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The beginning of the rule with the best (bad - good) / (bad + good); its bad and good documents."""
    sums = []
    for k in range(1, len(rule) + 1):
        covered = every([t.on_bins() for t in rule[:k]])
        sums += [F.sum(F.when(covered & (F.col("bad") == flag), F.col("n")).otherwise(0)).alias(f"{name}{k}")
                 for name, flag in (("bad", True), ("good", False))]
    row = rows.agg(*sums).first()
    found = [(rule[:k], row[f"bad{k}"] or 0, row[f"good{k}"] or 0) for k in range(1, len(rule) + 1)]
    return max(found, key=lambda x: ((x[1] - x[2]) / max(x[1] + x[2], 1), -len(x[0])))


def first_rule(rules: list[Rule], stats: Column) -> Column:
    """Number of the first rule that fires (from 1), else null: one ordered conditional expression."""
    found = F.lit(None).cast("int")
    for i in range(len(rules), 0, -1):
        found = F.when(every([t.on(stats) for t in rules[i - 1]]), i).otherwise(found)
    return found


def learn_from(stats: DataFrame, labels: DataFrame, **options) -> list[Rule]:
    """``stats``: doc_id and the features of all documents; ``labels``: doc_id, quality (0: bad)."""
    marks = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
             .groupBy("doc_id").agg((F.min("quality") == 0).alias("bad")))
    fold = F.when(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0, 1).otherwise(0)
    return learn(stats.where("n_words > 0").join(marks, "doc_id").withColumn("_fold", fold), **options)


def quality_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and every statistic, written once: rules are learned from it and applied to it."""
    found = statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return table(found.select("doc_id", "_stats.*"), "quality-statistics")


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """The statistics with base_failed, rule (the first learned rule that fires) and kept."""
    c = F.struct(*[F.col(x) for x in stats.columns if x != "doc_id"])
    return (stats.withColumn("base_failed", base_failed(c)).withColumn("rule", first_rule(rules, c))
            .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()))


def keep_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (all its columns) without the documents that the base rules or the learned list reject.

    Texts and their statistics are written together, so that each is computed once: rules are learned from the
    statistics alone, and the rows that they leave are read back.
    """
    found = table(statistics(docs).select(*docs.columns, "_stats"), "documents-with-statistics")
    rules = learn_from(found.select(F.col("doc_id").cast("long").alias("doc_id"), "_stats.*"), labels)
    s = F.col("_stats")
    return found.where(~base_failed(s) & first_rule(rules, s).isNull()).select(docs.columns)
