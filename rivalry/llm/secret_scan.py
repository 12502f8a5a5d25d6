"""Secret scans: every rule in one pass over the bytes, spans by the rules' automata.

All rules are compiled into one minimised automaton (``automaton.py``) that
is walked once over each whole text and tells which rules occur in it.  In the
texts where one does, its spans are the leftmost longest matches that do not
overlap: the rule's reversed automaton finds where matches start, its forward
one where they end; those whose body is too short are dropped then, so they
still hide what they cover.  Documents are never shuffled.

Null text: empty.  Repeated rows are scanned one by one; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame

from rivalry.llm.automaton import Automaton, Spans
from rivalry.llm.common import Shared, docs_of


@dataclass(frozen=True)
class Rule:
    """Matches are ``head``, one or more of the characters ``body`` (if any), and ``tail``.

    Those with fewer than ``least`` characters of the body are dropped.  ``told`` of these are counted by the automaton
    of all rules, where counting runs multiplies the states.
    """
    kind: str
    head: str
    body: str = ""
    least: int = 1
    tail: str = ""
    told: int = 1
    fold: bool = False  # letters in either case

    @property
    def pattern(self) -> str:
        return self.head + (self.body + "+" if self.body else "") + self.tail

    @property
    def occurs(self) -> str:
        """What every long enough match contains."""
        if not self.body or self.tail:
            return self.pattern
        return self.head + self.body + (f"{{{self.told}}}" if self.told > 1 else "")


# The first three are fixed by the contract; the others are well-known token formats.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=-]", 8, told=8, fold=True),
    Rule("access", "AKIA", "[A-Z0-9]", 12, told=12),
    Rule("hex", "", "[0-9a-f]", 32, told=32),
)
MORE = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("git_token", "gh[opsru]_", "[A-Za-z0-9]", 36),
    Rule("chat_token", "xox[abprs]-", "[A-Za-z0-9-]", 10),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", "[A-Za-z0-9_-]"),
    Rule("url_password", r"[a-z]+://[^\x00-\x20/@:]+:", r"[^\x00-\x20/@:]", tail="@"),
)
RULES = BASE + MORE


def long_enough(rule: Rule, found: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans of the matches (start, least end, longest end): the least end has one character of the body."""
    return [(s, e) for s, first, e in found if rule.least <= 1 or e - first + 1 >= rule.least]


def point(data: bytes, at: int) -> int:
    """The code points before a byte that starts one."""
    return at if data.isascii() else len(data[:at].decode())


def secret_scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, n_base: int = len(BASE)) -> DataFrame:
    """doc_id, n_<kind> of each base rule, base_sha256, spans: "kind:start:end" by start, then rule order, comma-joined.

    Starts and ends count code points, ends exclusive.
    """
    machine = Automaton([(r.occurs, r.fold) for r in rules])
    counts = [f"n_{r.kind}" for r in rules[:n_base]]
    schema = ("doc_id long, " + ", ".join(f"{c} long" for c in counts) + ", base_sha256 string, spans string")
    shared = Shared(docs.sparkSession, (machine, [Spans(r.pattern, r.fold) for r in rules], rules))

    def scan(batches):
        import pyarrow as pa
        machine, spans_of, rules = shared.value
        find, matches = machine.finder(), [spans.finder() for spans in spans_of]
        for batch in batches:
            out = []
            for data in batch.column("text").cast(pa.binary()).to_pylist():
                seen = find(data)
                found = [(s, k, e) for k, r in enumerate(rules) if seen >> k & 1
                         for s, e in long_enough(r, matches[k](data))]
                out.append([(point(data, s), k, point(data, e)) for s, k, e in found])
            say = lambda spans: ",".join(f"{rules[k].kind}:{s}:{e}" for s, k, e in sorted(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 *[pa.array([sum(x[1] == k for x in spans) for spans in out], pa.int64()) for k in range(n_base)],
                 pa.array([hashlib.sha256(say([x for x in spans if x[1] < n_base]).encode()).hexdigest()
                           for spans in out], pa.string()),
                 pa.array([say(spans) for spans in out], pa.string())],
                names=["doc_id", *counts, "base_sha256", "spans"])

    return docs_of(docs).mapInArrow(scan, schema)
