import random

import numpy as np
import pytest

from llm_fixtures import awkward, frame, lower, sorted_rows
from rivalry.llm.line_dedup import combine, hashes_of, known, line_dedup, places, see

EDGE = " \t\n\r\x0b\x0c"


def brute(docs, min_docs, keep_first):
    key = lambda line: lower(line.strip(EDGE))
    seen = {}
    for d, (doc_id, text) in enumerate(docs):
        for k in {key(x) for x in (text or "").split("\n")} - {""}:
            seen.setdefault(k, []).append((doc_id is None, doc_id or 0, d))
    gone = {k: min(v) for k, v in seen.items() if len(v) >= min_docs}
    out = []
    for d, (doc_id, text) in enumerate(docs):
        lines, kept, done = (text or "").split("\n"), [], set()
        for line in lines:
            k = key(line)
            if k in gone:
                if not keep_first or gone[k] != (doc_id is None, doc_id or 0, d) or k in done:
                    continue
                done.add(k)
            kept.append(line)
        dropped = len(lines) - len(kept)
        out.append((doc_id, "\n".join(kept) if dropped else text, len(lines), dropped))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("broadcast", [64 << 20, -1])
def test_against_brute_force(spark, keep_first, broadcast):
    docs = awkward() + [(200 + i, "same line\nand own %d" % i) for i in range(10)] + [(300 + i, "nine\nx%d" % i) for i in range(9)]
    got = line_dedup(frame(spark, docs).repartition(5), min_docs=10, keep_first=keep_first, broadcast_bytes=broadcast)
    assert sorted_rows(got, "doc_id", "text", "n_lines", "n_dropped") == brute(docs, 10, keep_first)


def test_clashing_columns_and_empty_table(spark):
    docs = [(i, "a line\nown %d" % i) for i in range(12)]
    got = line_dedup(frame(spark, docs, clash=True), keep_first=False)
    assert "rid" in got.columns and got.columns.count("n_lines") == 1
    assert {r.text for r in got.collect()} == {"own %d" % i for i in range(12)}
    assert line_dedup(frame(spark, [])).count() == 0


def test_filters_never_miss_a_repeat():
    r = random.Random(3)
    keys = [b"%d" % r.randrange(3000) for _ in range(4000)]
    parts = [keys[i::4] for i in range(4)]
    filters = []
    for part in parts:
        once, twice = np.zeros(1 << 13, np.uint8), np.zeros(1 << 13, np.uint8)
        for i in range(0, len(part), 100):
            see(once, twice, hashes_of(part[i:i + 100]))
        filters.append((once, twice))
    both = filters[0]
    for f in filters[1:]:
        both = combine(both, f)
    repeated = {k for k in keys if keys.count(k) > 1}
    assert known(both[1], places(hashes_of(sorted(repeated)), 1 << 16)).all()
    single = sorted(set(keys) - repeated)
    assert known(both[1], places(hashes_of(single), 1 << 16)).mean() < 0.2
