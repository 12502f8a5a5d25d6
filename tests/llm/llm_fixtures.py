"""Awkward rows that every operator must take, and helpers."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Column names that operators use themselves.
CLASHING = ("n_words string, rid string, ident string, n string, h string, key string, kept string, label string, "
            "n_lines string, piece string, start string, b string, path string, rule string")
SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return SPACES.findall(lower(text))


def vocabulary(n=60, seed=5):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefgé") for _ in range(r.randint(2, 6))) for _ in range(n)]


def awkward():
    """Null and empty texts and ids, white space, one word, a very long text, repeated rows and ids, near copies."""
    r = random.Random(1)
    v = vocabulary()
    text = lambda n: " ".join(r.choice(v) for _ in range(n))
    base = text(80)
    copies = [base.split() for _ in range(6)]
    for k, c in enumerate(copies):
        c[10 * k] = "changed"
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "Two Words"), (5, "Two Words"), (5, "other text"),
            (None, "no id here"), (None, None), (6, text(20_000)), (7, "x" * 50_000), (8, "Ünï çödé ſ K\u0085z 中文"),
            (9, "a b c\r\nA B C \n a b c\n\nend"), (10, base), (11, base), (12, base.upper())]
    rows += [(20 + k, " ".join(c)) for k, c in enumerate(copies)]
    rows += [(40 + k, f"shared line of the pages\nown {k} {text(30)}\nShared Line of the pages  ") for k in range(12)]
    return rows


def frame(spark, rows, clash=False):
    full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
    if not clash:
        return spark.createDataFrame(full, SCHEMA)
    extra = ["?"] * (CLASHING.count(",") + 1)
    return spark.createDataFrame([(*x, *extra) for x in full], f"{SCHEMA}, {CLASHING}")


def sorted_rows(df, *columns):
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=repr)
