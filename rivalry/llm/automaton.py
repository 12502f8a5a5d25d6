"""One deterministic automaton for many regular expressions.

The rules' syntax trees become one nondeterministic automaton over bytes;
subset construction makes it deterministic and minimisation merges equal
states.  With a search state that is always active one pass over the bytes
sees every rule that ends anywhere; of the reversed rules, read backwards, where
each match starts.  Without it the automaton reads one match from its start to
its longest end.

Supported syntax: characters, escapes (``\\xHH`` and escaped signs), classes
with ranges and negation, groups, ``|``, ``? * + {m} {m,} {m,n}``.
"""

from __future__ import annotations

import numpy as np


def parse(pattern: str, fold: bool = False) -> tuple:
    """The syntax tree: ('set', frozenset), ('cat', ...), ('alt', ...) or ('rep', tree, least, most)."""
    at = 0

    def bytes_of(lo: int, hi: int) -> set[int]:
        found = set(range(lo, hi + 1))
        if fold:
            found |= {b ^ 32 for b in found if 65 <= b <= 90 or 97 <= b <= 122}
        return found

    def char() -> int:
        nonlocal at
        c = pattern[at]
        at += 1
        if c != "\\":
            return ord(c)
        c = pattern[at]
        at += 1
        if c == "x":
            at += 2
            return int(pattern[at - 2:at], 16)
        return ord({"n": "\n", "t": "\t", "r": "\r"}.get(c, c))

    def klass() -> tuple:
        nonlocal at
        negated = pattern[at] == "^"
        at += negated
        found: set[int] = set()
        while pattern[at] != "]":
            lo = hi = char()
            if pattern[at] == "-" and pattern[at + 1] != "]":
                at += 1
                hi = char()
            found |= bytes_of(lo, hi)
        at += 1
        return "set", frozenset(set(range(256)) - found if negated else found)

    def atom() -> tuple:
        nonlocal at
        if pattern[at] == "(":
            at += 3 if pattern.startswith("(?:", at) else 1
            tree = choice()
            at += 1
        elif pattern[at] == "[":
            at += 1
            tree = klass()
        else:
            c = char()
            tree = "set", frozenset(bytes_of(c, c))
        while at < len(pattern) and pattern[at] in "?*+{":
            c = pattern[at]
            if c == "{":
                end = pattern.index("}", at)
                low, comma, high = pattern[at + 1:end].partition(",")
                bounds = int(low), (int(high) if high else None if comma else int(low))
                at = end
            else:
                bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
            at += 1
            tree = "rep", tree, *bounds
        return tree

    def choice() -> tuple:
        nonlocal at
        options = [[]]
        while at < len(pattern) and pattern[at] != ")":
            if pattern[at] == "|":
                at += 1
                options.append([])
            else:
                options[-1].append(atom())
        trees = [("cat", *x) for x in options]
        return trees[0] if len(trees) == 1 else ("alt", *trees)

    return choice()


def backwards(tree: tuple) -> tuple:
    """The tree of the reversed strings."""
    if tree[0] == "set":
        return tree
    if tree[0] == "rep":
        return "rep", backwards(tree[1]), *tree[2:]
    parts = [backwards(part) for part in tree[1:]]
    return (tree[0], *(reversed(parts) if tree[0] == "cat" else parts))


class _Nfa:
    """Thompson's construction."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.step: list[tuple[frozenset, int] | None] = []

    def state(self) -> int:
        self.empty.append([])
        self.step.append(None)
        return len(self.empty) - 1

    def add(self, tree: tuple, start: int) -> int:
        """Append ``tree`` after state ``start``; the state at its end."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            mid = self.state()
            self.empty[start].append(mid)
            self.step[mid] = tree[1], end
            return end
        if kind == "cat":
            for part in tree[1:]:
                start = self.add(part, start)
            return start
        if kind == "alt":
            ends = [self.add(part, start) for part in tree[1:]]
            end = self.state()
            for e in ends:
                self.empty[e].append(end)
            return end
        _, part, least, most = tree
        for _ in range(least):
            start = self.add(part, start)
        if most is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.add(part, loop)].append(loop)
            return loop
        end = self.state()
        self.empty[start].append(end)
        for _ in range(most - least):
            start = self.add(part, start)
            self.empty[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in found:
                    found.add(t)
                    todo.append(t)
        return frozenset(found)


class Automaton:
    """``classes``: byte to byte class (for bytes.translate); ``step[state, class]``; ``accepts[state]``: bit mask of rules.

    State 0 is the start.  Accepting states go on, so later matches of other rules are seen too.  ``search``: a match may
    start at any byte; ``reverse``: of the reversed strings.
    """

    def __init__(self, rules: list[tuple[str, bool]], search: bool = True, reverse: bool = False):
        nfa = _Nfa()
        root = nfa.state()
        ends = {}
        for i, (pattern, fold) in enumerate(rules):
            tree = parse(pattern, fold)
            ends[nfa.add(backwards(tree) if reverse else tree, root)] = 1 << i
        sets = {s[0] for s in nfa.step if s}
        marks = sorted(sets, key=sorted)
        groups: dict[tuple, int] = {}
        self.classes = bytes(groups.setdefault(tuple(b in s for s in marks), len(groups)) for b in range(256))
        member = {s: [sig[i] for sig in groups] for i, s in enumerate(marks)}
        first = nfa.closure([root])
        always = first if search else frozenset()
        ids = {first: 0}
        rows, todo = [], [first]
        while todo:
            now = todo.pop(0)
            moves: list[set[int]] = [set() for _ in groups]
            for q in now:
                if nfa.step[q]:
                    on, to = nfa.step[q]
                    for k, yes in enumerate(member[on]):
                        if yes:
                            moves[k].add(to)
            row = []
            for m in moves:
                to = nfa.closure(m) | always
                if to not in ids:
                    ids[to] = len(ids)
                    todo.append(to)
                row.append(ids[to])
            rows.append(row)
        accepts = np.array([sum({ends[q] for q in s if q in ends}) for s in ids], dtype=np.int64)
        self.step, self.accepts = minimise(np.array(rows, dtype=np.int64), accepts)

    def finder(self):
        """A function from a text's bytes to the bit mask of the rules that occur in it.

        Rows refer to rows, so each byte costs one look-up; any accepting
        state leads to a row that never ends, which tells texts without a
        match apart in one pass.  The others are followed once more for the
        set of rules.
        """
        rows: list[list] = [[] for _ in self.accepts]
        hit: list = []
        hit.extend([hit] * self.step.shape[1])
        for s, row in enumerate(rows):
            row.extend(hit if self.accepts[t] else rows[t] for t in self.step[s])
        step, accepts, classes = self.step.tolist(), self.accepts.tolist(), self.classes
        start = hit if accepts[0] else rows[0]

        def find(data: bytes) -> int:
            row = start
            codes = data.translate(classes)
            for c in codes:
                row = row[c]
            if row is not hit:
                return 0
            state, seen = 0, accepts[0]
            for c in codes:
                state = step[state][c]
                seen |= accepts[state]
            return seen

        return find


class Spans:
    """Leftmost longest matches of one rule, that do not overlap.

    The rule's reversed search automaton, read from the text's end, passes an accepting state at every byte that a match
    starts at; from the first such byte after the last match the forward automaton runs on until no string of the rule
    goes on like this.
    """

    def __init__(self, pattern: str, fold: bool = False):
        self.back = Automaton([(pattern, fold)], reverse=True)
        self.ahead = Automaton([(pattern, fold)], search=False)
        self.dead = {s for s, row in enumerate(self.ahead.step.tolist())
                     if set(row) == {s} and not self.ahead.accepts[s]}

    def finder(self):
        """A function from a text's bytes to (start, least end, longest end) of every match."""
        back, back_ends = self.back.step.tolist(), self.back.accepts.tolist()
        ahead, ends, dead = self.ahead.step.tolist(), self.ahead.accepts.tolist(), self.dead
        back_classes, classes = self.back.classes, self.ahead.classes

        def find(data: bytes) -> list[tuple[int, int, int]]:
            starts, state, at = [], 0, len(data)
            for c in data.translate(back_classes)[::-1]:
                at -= 1
                state = back[state][c]
                if back_ends[state]:
                    starts.append(at)
            codes, found, after = data.translate(classes), [], 0
            for start in reversed(starts):
                if start < after:
                    continue
                state, least, longest = 0, None, None
                for i in range(start, len(codes)):
                    state = ahead[state][codes[i]]
                    if state in dead:
                        break
                    if ends[state]:
                        longest = i + 1
                        least = least or longest
                found.append((start, least, longest))
                after = longest
            return found

        return find


def minimise(step: np.ndarray, accepts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge states that no input tells apart (refinement of the partition by accepted rules)."""
    block = np.unique(accepts, return_inverse=True)[1].reshape(-1)
    while True:
        finer = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    # Number blocks so that the start is 0 and take one state of each.
    _, first = np.unique(block, return_index=True)
    order = np.argsort(first)
    new = np.empty(len(first), dtype=np.int64)
    new[order] = np.arange(len(first))
    keep = first[order]
    return new[block[step[keep]]], accepts[keep]
