import collections
import random
import re

import pytest

from llm_fixtures import SPACES, awkward, frame, sorted_rows
from rivalry.llm import quality_rules as Q


def brute(text):
    t = text or ""
    w = SPACES.findall(t)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = collections.Counter(windows)
    inside = set()
    for i, x in enumerate(windows):
        if n[x] > 1:
            inside.update(range(i, i + 5))
    lines = [x for x in t.split("\n") if SPACES.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside),
            len(w) < 10 or 100 * len(inside) > 20 * len(w))


def corpus():
    r = random.Random(2)
    v = ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    docs, labels = [], []
    for i in range(600):
        words = [r.choice(v) for _ in range(r.randint(15, 60))]
        bad = i % 3 == 0
        if bad and i % 2:
            words = [w + "$$" for w in words]
        elif bad:
            words = [w.upper() for w in words]
        docs.append((i, " ".join(words)))
        labels.append((i, 0 if bad else 1, 0))
    return docs, labels


@pytest.mark.parametrize("clash", [False, True])
def test_statistics_against_brute_force(spark, clash):
    extra = [(600, "a b c d e " * 3 + "x y z"), (601, "a b c d e f a b c d e"), (602, "x\nx\n\n y\nx \n#$|"), (603, "a a a a a a a a a a a a")]
    docs = awkward() + extra
    got = Q.judge(Q.quality_statistics(frame(spark, docs, clash)), [])
    want = [(d, *brute(t)) for d, t in docs]
    assert sorted_rows(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == sorted(want, key=repr)
    assert all(r.kept != r.base_failed for r in got.collect())


def test_rules_are_learned_and_hold_on_other_documents(spark):
    docs, labels = corpus()
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").where("doc_id < 400")
    stats = Q.quality_statistics(frame(spark, docs))
    rules = Q.learn_from(stats, marks)
    assert {t.feature for r in rules for t in r} & {"symbols_per_word", "upper_share"}
    got = {r.doc_id: r for r in Q.judge(stats, rules).collect()}
    other = [(got[i].kept, q == 1) for i, q, _ in labels if i >= 400]
    assert sum(a == b for a, b in other) >= 0.97 * len(other)
    kept = Q.keep_documents(frame(spark, docs, clash=True), marks)
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}
    assert kept.columns == frame(spark, docs, clash=True).columns


def test_without_labels_or_rows(spark):
    docs, _ = corpus()
    stats = Q.quality_statistics(frame(spark, docs[:20]))
    none = spark.createDataFrame([(None, 0, 0), (1, None, 0), (99999, 0, 0)], "doc_id long, quality int, toxic int")
    assert Q.learn_from(stats, none) == []
    empty = frame(spark, [])
    assert Q.keep_documents(empty, none).count() == 0


def test_growing_takes_the_most_informative_threshold(spark):
    rows = [(0, i < 5, 0 if i < 5 else 3, i % 2, 1) for i in range(20)]
    binned = spark.createDataFrame(rows, "_fold int, bad boolean, p int, q int, n long")
    rule = Q.grow(binned, {"p": [1.0, 2.0, 3.0], "q": [0.5]}, ("p", "q"))
    assert [str(t) for t in rule] == ["p <= 1"]
    assert Q.prune(binned, rule + (Q.Test("q", True, 0, 0.5),)) == (rule, 5, 0)


def labelled(spark, kinds, n=90):
    """Bad documents of many kinds, each told by a feature of its own, beside good ones."""
    features = [f"f{k}" for k in range(kinds)]
    rows = []
    for k in range(kinds):
        rows += [(i % 2, True, *[1.0 if j == k else 0.0 for j in range(kinds)]) for i in range(n)]
    rows += [(i % 2, False, *[0.0] * kinds) for i in range(n * kinds)]
    return spark.createDataFrame(rows, "_fold int, bad boolean, " + ", ".join(f"{f} double" for f in features)), features


def test_the_list_is_as_long_as_the_labels_need(spark):
    frame_, features = labelled(spark, 11)
    rules = Q.learn(frame_, features)
    assert sorted(t.feature for r in rules for t in r) == sorted(features)


def test_a_rule_that_fails_does_not_end_the_list(spark):
    """The best rule on the growing part does not hold on the other; the next ones do."""
    frame_, features = labelled(spark, 3)
    noise = spark.createDataFrame([(k % 2, k % 2 == 0, 0.0, 0.0, 0.0, 1.0) for k in range(400)],
                                  "_fold int, bad boolean, f0 double, f1 double, f2 double, f3 double")
    rules = Q.learn(frame_.selectExpr("*", "0.0D AS f3").union(noise), [*features, "f3"])
    assert sorted({t.feature for r in rules for t in r}) == features


def test_tests_that_a_later_one_implies_go():
    a, b, c = Q.Test("x", False, 5, 0.6), Q.Test("y", True, 1, 0.1), Q.Test("x", False, 3, 0.5)
    assert Q.tightest((a, b, c)) == (b, c) and Q.tightest((a, Q.Test("x", True, 1, 0.1))) == (a, Q.Test("x", True, 1, 0.1))
