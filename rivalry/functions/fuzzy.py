"""String similarity scorers for fuzzy name resolution.

``lev_ratio`` is a native Spark expression (normalised Levenshtein); it is
the scorer with an SQL oracle.  ``wratio`` is the weighted ratio of the
common fuzzy-matching libraries (recalled from their public documentation):
the best of the plain indel ratio, token-sort/token-set ratios scaled by
0.95, and partial (best-window) ratios scaled by 0.9 (or 0.6 when one string
is more than 8x longer).  It runs inside an Arrow pandas UDF over distinct inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def lev_ratio(a: Column, b: Column) -> Column:
    """``100 * (1 - levenshtein(a, b) / max(len))`` as DOUBLE; 0 when both are empty.

    Numerator and denominator are integers and the division is one IEEE
    operation, so any engine computing it the same way gets the same double.
    """
    m = F.greatest(F.length(a), F.length(b))
    return F.when(m > 0, (F.lit(100) * (m - F.levenshtein(a, b))).cast("double") / m.cast("double")) \
            .otherwise(F.lit(0.0))


# ---------------------------------------------------------------------------
# Weighted ratio (pure Python helpers, used per distinct input on executors)

def _lcs_len(a: str, b: str) -> int:
    """Length of the longest common subsequence (bit-parallel, Allison-Dix)."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def indel_distance(a: str, b: str) -> int:
    return len(a) + len(b) - 2 * _lcs_len(a, b)


def _norm(dist: int, lensum: int) -> float:
    return 100.0 - 100.0 * dist / lensum if lensum else 100.0


def ratio(a: str, b: str) -> float:
    """Normalised indel similarity, 0..100."""
    return _norm(indel_distance(a, b), len(a) + len(b))


def _partial_impl(short: str, long: str) -> float:
    n, m = len(short), len(long)
    chars = set(short)
    best = 0.0
    for i in range(1, n):                 # windows growing from the left edge
        if long[i - 1] not in chars:
            continue
        best = max(best, ratio(short, long[:i]))
        if best == 100.0:
            return best
    for i in range(m - n):                # full-width windows
        if long[i + n - 1] not in chars:
            continue
        best = max(best, ratio(short, long[i:i + n]))
        if best == 100.0:
            return best
    for i in range(m - n, m):             # windows shrinking to the right edge
        if long[i] not in chars:
            continue
        best = max(best, ratio(short, long[i:]))
        if best == 100.0:
            return best
    return best


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string against windows of the longer one."""
    if not a and not b:
        return 100.0
    if not a or not b:
        return 0.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    best = _partial_impl(short, long)
    if best != 100.0 and len(a) == len(b):
        best = max(best, _partial_impl(long, short))
    return best


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    ta, tb = set(a.split()), set(b.split())
    if not ta or not tb:
        return 0.0
    inter, dab, dba = ta & tb, ta - tb, tb - ta
    if inter and (not dab or not dba):
        return 100.0
    ab, ba = " ".join(sorted(dab)), " ".join(sorted(dba))
    sect = len(" ".join(sorted(inter)))
    sect_ab = sect + (sect != 0) + len(ab)
    sect_ba = sect + (sect != 0) + len(ba)
    result = _norm(indel_distance(ab, ba), sect_ab + sect_ba)
    if not sect:
        return result
    return max(result,
               _norm((sect != 0) + len(ab), sect + sect_ab),
               _norm((sect != 0) + len(ba), sect + sect_ba))


def token_ratio(a: str, b: str) -> float:
    if not a.split() or not b.split():
        return 0.0
    return max(token_sort_ratio(a, b), token_set_ratio(a, b))


def partial_token_ratio(a: str, b: str) -> float:
    ta, tb = a.split(), b.split()
    if not ta or not tb:
        return 0.0
    sa, sb = set(ta), set(tb)
    if sa & sb:
        return 100.0
    best = partial_ratio(" ".join(sorted(ta)), " ".join(sorted(tb)))
    if len(sa) < len(ta) or len(sb) < len(tb):
        # Repeated tokens: the distinct ones are compared too.
        best = max(best, partial_ratio(" ".join(sorted(sa)), " ".join(sorted(sb))))
    return best


def wratio(a: str, b: str) -> float:
    """Weighted ratio, 0..100."""
    if not a or not b:
        return 0.0
    unbase = 0.95
    la, lb = len(a), len(b)
    len_ratio = la / lb if la > lb else lb / la
    end = ratio(a, b)
    if len_ratio < 1.5:
        return max(end, token_ratio(a, b) * unbase)
    partial_scale = 0.9 if len_ratio <= 8.0 else 0.6
    end = max(end, partial_ratio(a, b) * partial_scale)
    return max(end, partial_token_ratio(a, b) * unbase * partial_scale)


def best_match(query: str, choices: list[tuple[str, str]]) -> tuple[str | None, str | None, float]:
    """Top-1 of ``choices`` = [(alias, canonical), ...] in dictionary order.

    A later choice replaces the best only with a strictly higher score, so
    ties go to the first alias.
    """
    best = (None, None, -1.0)
    for alias, canonical in choices:
        s = wratio(query, alias)
        if s > best[2]:
            best = (alias, canonical, s)
            if s == 100.0:
                break
    return best
