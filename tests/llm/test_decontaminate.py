import hashlib
import re

import pytest

from llm_fixtures import awkward, frame, lower, sorted_rows
from rivalry.llm.decontaminate import clean_documents, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, items, window=10):
    out = []
    wins = set()
    for item, text in items:
        w = WORD.findall(lower(text))
        n = min(window, len(w))
        if item is not None and n:
            wins |= {(str(item), tuple(w[i:i + n])) for i in range(len(w) - n + 1)}
    for doc_id, text in docs:
        w = WORD.findall(lower(text))
        hit, found = set(), set()
        for item, win in wins:
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i:i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    found.add(item)
        out.append((doc_id, len(w), len(hit), len(found), sorted(found)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items():
    passage = " ".join(f"w{i}" for i in range(14))
    return [(1, passage), (1, passage), (2, "tiny item"), (3, "solo"), (4, None), (5, ""), (None, "no id here"), (10, passage + " more")]


def docs_with(passage):
    rows = [r for r in awkward() if r[0] != 6]
    return rows + [(100, passage), (101, "before " + passage.upper() + " after tiny, item"), (102, " ".join(passage.split()[:9])),
                   (103, "-".join(passage.split()[2:13])), (104, "solo solo"), (105, passage.replace("w3", "w33"))]


@pytest.mark.parametrize("clash", [False, True])
def test_against_brute_force(spark, items, clash):
    docs = docs_with(items[0][1])
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate(frame(spark, docs, clash), bench)
    assert sorted_rows(got, "doc_id", "n_words", "n_hit", "n_items", "items") == brute(docs, items)


def test_clean_documents_keeps_all_others(spark, items):
    docs = docs_with(items[0][1])
    bench = spark.createDataFrame(items, "item_id long, text string")
    bad = {(d, n) for d, n, hit, *_ in brute(docs, items) if hit}
    kept = clean_documents(frame(spark, docs), bench)
    want = [(d, t) for (d, t) in docs if (d, len(WORD.findall(lower(t)))) not in bad]
    assert sorted_rows(kept, "doc_id", "text") == sorted(want, key=repr)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_empty_tables(spark):
    none = frame(spark, [])
    bench = spark.createDataFrame([(1, "some item of words")], "item_id long, text string")
    assert decontaminate(none, bench).count() == 0
    got = decontaminate(frame(spark, [(1, "some item of words")]), bench.where("false"))
    assert sorted_rows(got, "doc_id", "n_words", "n_hit", "items") == [(1, 4, 0, [])]


def test_query_digest(spark):
    import __spark_entry__ as E
    got = E.queries()["op1_decontaminate"](spark, "/root/testdata/sf0.001").collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert all((r.items_sha256 == empty) == (r.n_items == 0) and r.contaminated == (r.n_hit > 0) for r in got)
