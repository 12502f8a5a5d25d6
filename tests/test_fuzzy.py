import pytest
from pyspark.sql import functions as F

from rivalry.functions import fuzzy as Z
from rivalry.operators.resolve import (TEAM_ALIASES, alias_dim_from_lists, reference_alias_dim,
                                       resolve_names)


def test_indel_ratio_hand_values():
    assert Z.indel_distance("kitten", "sitting") == 5
    assert Z.ratio("kitten", "sitting") == pytest.approx(100 * (1 - 5 / 13))
    assert Z.ratio("", "") == 100.0
    assert Z._lcs_len("abcde", "ace") == 3


def test_partial_and_token_ratios():
    assert Z.partial_ratio("boston", "boston celtics") == 100.0
    assert Z.token_set_ratio("celtics boston", "boston celtics") == 100.0
    assert Z.token_sort_ratio("celtics boston", "boston celtics") == 100.0
    assert Z.partial_token_ratio("bos", "boston celtics") == 100.0  # substring window
    assert Z.partial_token_ratio("xyz", "boston celtics") < 100.0


def test_wratio_hand_values():
    # len ratio 14/6 >= 1.5: max(ratio 60, partial 100*0.9, partial token 100*0.95*0.9) = 90
    assert Z.wratio("boston", "boston celtics") == pytest.approx(90.0)
    # similar lengths: token ratio scaled by 0.95
    assert Z.wratio("celtics boston", "boston celtics") == pytest.approx(95.0)
    assert Z.wratio("spurs", "spurs") == 100.0
    assert Z.wratio("", "spurs") == 0.0


def test_best_match_first_alias_wins_ties():
    choices = [("aa", "First"), ("aa ", "Second"), ("ab", "Third")]
    assert Z.best_match("ac", [("ab", "X"), ("cb", "Y")])[1] == "X"
    assert Z.best_match("aa", choices)[1] == "First"


def test_lev_ratio_column(spark):
    df = spark.createDataFrame([("kitten", "sitting"), ("", ""), ("abc", "abc")], "a string, b string")
    got = [r[0] for r in df.select(Z.lev_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [pytest.approx(100 * 4 / 7), 0.0, 100.0]


def test_reference_dictionary_shape(spark):
    assert len(TEAM_ALIASES) == 30 and sum(len(a) for _, a in TEAM_ALIASES) == 100
    dim = reference_alias_dim(spark)
    assert dim.count() == 100


def test_alias_dim_first_position_last_canonical(spark):
    canon = spark.createDataFrame([("X", 0, ["a", "shared"]), ("Y", 1, ["shared", "b"])],
                                  "canonical string, cord int, aliases array<string>")
    rows = {r.alias: (r.canonical, r.ord) for r in alias_dim_from_lists(canon).collect()}
    assert rows["shared"] == ("Y", 1)  # position of first occurrence, canonical of last
    assert rows["b"] == ("Y", 1_000_001)


@pytest.mark.parametrize("scorer", ["levenshtein", "weighted"])
def test_resolve_names_reference_dictionary(spark, scorer):
    dim = reference_alias_dim(spark)
    df = spark.createDataFrame([("Spurs",), ("san antonio",), ("celtcs",), ("qqqqqq",), (None,)], "name string")
    out = {r.name: (r.canonical, r.score) for r in resolve_names(df, "name", dim, scorer=scorer).collect()}
    assert out["Spurs"] == ("San Antonio Spurs", 100.0)
    assert out["san antonio"][0] == "San Antonio Spurs"
    assert out["celtcs"][0] == "Boston Celtics"
    assert out["qqqqqq"][0] is None
    assert out[None][0] is None


def test_resolve_threshold_is_strict(spark):
    # lev ratio of "abcdefghij" vs "abcdefgxyz" = 70.0 exactly -> rejected
    dim = spark.createDataFrame([("abcdefgxyz", "T", 0)], "alias string, canonical string, ord bigint")
    df = spark.createDataFrame([("abcdefghij",), ("abcdefghyz",)], "name string")
    out = {r.name: (r.canonical, r.score) for r in resolve_names(df, "name", dim).collect()}
    assert out["abcdefghij"] == (None, 70.0)
    assert out["abcdefghyz"][0] == "T"


def test_resolve_chunked_dictionary_equals_single_chunk(spark, monkeypatch):
    import rivalry.operators.resolve as R
    dim = reference_alias_dim(spark)
    df = spark.createDataFrame([("celtcs",), ("lakrs",), ("nets",), ("la",)], "name string")
    one = sorted(tuple(r) for r in resolve_names(df, "name", dim).collect())
    monkeypatch.setattr(R, "LOCAL_DICT", 7)
    monkeypatch.setattr("rivalry.operators.alias_index.BLOCK", 9)
    many = sorted(tuple(r) for r in resolve_names(df, "name", dim).collect())
    assert one == many


def test_documented_example_values():
    # worked examples from the public documentation of the weighted ratio family
    assert Z.ratio("this is a test", "this is a test!") == pytest.approx(96.55172413793103)
    assert Z.partial_ratio("this is a test", "this is a test!") == 100.0
    assert Z.token_sort_ratio("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == 100.0
    assert Z.token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100.0
    assert Z.wratio("this is a test", "this is a new test!!!") == pytest.approx(85.5)


@pytest.mark.parametrize("scorer", ["levenshtein", "weighted"])
def test_one_rule_at_every_dictionary_size(spark, scorer, monkeypatch):
    from rivalry.operators import resolve as R
    dim = spark.createDataFrame([("ab", "X", 0), ("ab", "Y", 1), ("", "E", 2), ("cd", "Z", 3), ("abcd", "W", 4)],
                                "alias string, canonical string, ord bigint")
    df = spark.createDataFrame([("AB",), ("",), (None,), ("abc",), ("zz",), ("AB",)], "t string")
    found = []
    for local in (5000, 1):
        monkeypatch.setattr(R, "LOCAL_DICT", local)
        monkeypatch.setattr("rivalry.operators.alias_index.BLOCK", 2)
        monkeypatch.setattr("rivalry.operators.alias_index.PART", 1)
        found.append(sorted(map(repr, resolve_names(df, "t", dim, scorer=scorer).collect())))
    assert found[0] == found[1] and len(found[0]) == 6
    assert sum("t='AB', canonical='X', score=100.0" in r for r in found[0]) == 2 and not any("canonical='E'" in r for r in found[0])


def test_repeated_tokens_are_compared_once_too():
    assert Z.partial_token_ratio("la la", "lb") == max(Z.partial_ratio("la la", "lb"), Z.partial_ratio("la", "lb"))
    # Exactly eight times as long still counts as 0.9.
    assert Z.wratio("ab", "ab" + "x" * 14) == pytest.approx(90.0)
    assert Z.wratio("ab", "ab" + "x" * 15) == pytest.approx(60.0)


def edited(r, text, n, letters="abcdef gh"):
    for _ in range(n):
        at, kind = r.randrange(len(text) + 1), r.randrange(3)
        text = text[:at] + (r.choice(letters) if kind else "") + text[at + (kind != 1):]
    return text


def plain_best(q, names):
    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
        return row[-1]
    best, who = -1.0, None
    for alias, canonical, _ in sorted(names, key=lambda x: (x[2] is not None, x[2] or 0, x[0])):
        m = max(len(q), len(alias))
        score = 100 * (m - lev(q, alias)) / m if m else 0.0
        if score > best:
            best, who = score, canonical
    return (who if best > 70 else None), max(best, 0.0)


def test_the_index_finds_what_scoring_every_alias_finds(spark, monkeypatch):
    """Repeated grams, ties, short and empty texts, and inputs like no alias."""
    import random
    from rivalry.operators import resolve as R
    r = random.Random(6)
    words = ["".join(r.choice("abcdef gh") for _ in range(r.choice([1, 2, 3, 6, 9, 14, 25]))) for _ in range(150)]
    names = sorted({(w, f"N{i % 40}", r.choice([None, i % 9])) for i, w in enumerate([*words, "aaaaaaaaaa", "aaaaaaaaaaaa", ""])},
                   key=repr)
    names = list({w: (w, c, o) for w, c, o in names}.values())
    inputs = [edited(r, r.choice(words), r.choice([0, 1, 2, 3, 6])) for _ in range(150)] + ["", "a", "aaaaaaaaa", "zzzzzzzzzzzzzz", "zz", None]
    dim = spark.createDataFrame(names, "alias string, canonical string, ord int")
    df = spark.createDataFrame([(x,) for x in inputs], "t string")
    monkeypatch.setattr(R, "LOCAL_DICT", 3)
    monkeypatch.setattr("rivalry.operators.alias_index.BLOCK", 40)
    got = {x.t: (x.canonical, x.score) for x in R.resolve_names(df, "t", dim).collect()}
    assert got == {x: plain_best(x, names) if x is not None else (None, 0.0) for x in inputs}


def test_levels_end_most_inputs_before_the_scan(spark):
    import random
    from rivalry.operators import alias_index as A
    r = random.Random(3)
    words = sorted({"".join(r.choice("abcdefghijklmnop") for _ in range(18)) for _ in range(400)})
    entries = A.entries_of(spark.createDataFrame([(w, w.upper(), i) for i, w in enumerate(words)], "alias string, canonical string, ord int"))
    index, counts = A.gram_index(entries)
    inputs = spark.createDataFrame([(edited(r, w, 1, "abcdefghijklmnop"),) for w in words[:60]], "_q string").distinct()
    found = A.at_level(inputs, index, counts, 90)
    assert found.count() == inputs.count() and found.filter("_score < 90").count() == 0
    assert A.at_level(spark.createDataFrame([("qqqqqqqqqqqqqqqq",), ("ab",), ("",)], "_q string"), index, counts, 80).count() == 0


def test_the_sql_of_the_weighted_scorer_scores_the_same():
    """Whole, token and partial scores, repeated tokens, blanks, empty texts; ties by dictionary order."""
    import random
    import duckdb
    from rivalry.plans.oracle_weighted import best_ctes
    r = random.Random(4)
    text = lambda n: "".join(r.choice("abcde  ") for _ in range(n))
    inputs = sorted({text(r.randint(1, 14)) for _ in range(60)} | {"", " ", "la la", "b", "spurs", "celtics boston"})
    names = sorted({text(r.choice([1, 2, 3, 5, 8, 13, 30])) for _ in range(60)} | {"la", "lb", "boston celtics", "x"})
    con = duckdb.connect()
    con.execute("CREATE TABLE inp (q VARCHAR)")
    con.execute("CREATE TABLE dim (alias VARCHAR, canonical VARCHAR, ord INTEGER)")
    con.executemany("INSERT INTO inp VALUES (?)", [(x,) for x in inputs])
    con.executemany("INSERT INTO dim VALUES (?, ?, ?)", [(x, f"N{i}", i // 3) for i, x in enumerate(names)])
    ctes = best_ctes("inp", "dim")
    run = lambda body: con.execute("WITH " + ", ".join(f"{k} AS ({v})" for k, v in ctes.items()) + body).fetchall()
    for q, a, score in run(" SELECT q, a, score FROM w_scored"):
        assert score == pytest.approx(Z.wratio(q, a), abs=1e-9), (q, a)
    ordered = [(x, f"N{i}") for i, x in sorted(enumerate(names), key=lambda t: (t[0] // 3, t[1]))]
    for q, canonical, score in run(" SELECT * FROM best"):
        _, who, best = Z.best_match(q, ordered)
        assert score == pytest.approx(max(best, 0.0), abs=1e-9) and canonical == (who if best > 70 else None), q
