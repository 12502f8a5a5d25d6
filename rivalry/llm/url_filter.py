"""URL filter: empirical-Bayes host reputation.

Every host's share of bad pages is shrunk through beta-binomial priors: the
suffix towards all hosts, the registered domain towards its suffix, the host
towards its domain.  The strength of each prior is estimated from the labelled
outcomes themselves (how much children of one parent differ, beyond chance).
A host without labels has the prior of its domain; if that has none either, of
its suffix, else of all hosts, with the spread of the levels between.  A host is
blocked when the lower posterior bound of its bad share is above a threshold, so
hosts of which little is known are allowed.  List rules come first.

Null and malformed URLs have an empty host and path; they share the host ''.
Repeated rows are judged row by row; an empty table gives an empty result.
Columns of ``pages`` other than the id and the URL are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rivalry.llm.common import lower_ascii, table

# (verdict, host and path); fixed by the contract.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
# Suffixes of two labels; every other host's suffix is its last label.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.nz", "com.br", "co.in")

AUTHORITY = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# Bounds of a prior's strength, in pages.
WEAKEST, STRONGEST = 1.0, 1000.0


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, AUTHORITY, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, AUTHORITY, 2), F.lit(""))


def suffix_of(host: Column, two_label=TWO_LABEL_SUFFIXES) -> Column:
    """The public suffix; a numeric address is its own suffix.  A port is ignored."""
    bare = F.regexp_replace(host, r":\d*$", "")
    two = F.substring_index(bare, ".", -2)
    return (F.when(bare.rlike(r"^[0-9.]+$"), bare)
            .when(two.isin(*two_label), two)
            .otherwise(F.substring_index(bare, ".", -1)))


def domain_of(host: Column, two_label=TWO_LABEL_SUFFIXES) -> Column:
    """The registered domain: the suffix and one label more."""
    bare = F.regexp_replace(host, r":\d*$", "")
    two = F.substring_index(bare, ".", -2)
    return (F.when(bare.rlike(r"^[0-9.]+$"), bare)
            .when(two.isin(*two_label), F.substring_index(bare, ".", -3))
            .otherwise(two))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; nulls without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        rule_host, slash, rest = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def host_outcomes(pages: DataFrame, outcomes: DataFrame, key: str) -> DataFrame:
    """Labelled pages and bad ones per host.

    ``outcomes`` has ``key`` and a boolean ``bad``; of repeated keys the worst
    outcome counts.  Pages are counted per host and key before the join, so a
    host with a third of all pages is combined map-side.
    """
    worst = (outcomes.where(F.col(key).isNotNull() & F.col("bad").isNotNull())
             .groupBy(F.col(key).alias("_key")).agg(F.max("bad").alias("_bad")))
    seen = pages.where(F.col(key).isNotNull()).groupBy("host", F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    return (seen.join(worst, "_key")
            .groupBy("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"))
            .agg(F.sum("_n").alias("n"), F.sum(F.when(F.col("_bad"), F.col("_n")).otherwise(0)).alias("k")))


def _strength(children: DataFrame, parent: str) -> float:
    """Prior strength between ``children`` (n, k) of each ``parent``: one row, by the analysis-of-variance estimator."""
    per = (children.groupBy(F.col(parent).alias("p"))
           .agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.count("*").alias("i"),
                F.sum(F.col("k") * F.col("k") / F.col("n")).alias("q"),
                F.sum(F.col("n") * F.col("n")).alias("n2"))
           .agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.sum(F.col("i") - 1).alias("df"),
                F.sum(F.col("q") - F.col("k") * F.col("k") / F.col("n")).alias("s"),
                F.sum(F.col("n2") / F.col("n")).alias("m")))
    row = per.first()
    return estimate(row["n"], row["k"], row["df"], row["s"], row["m"])


def estimate(n, k, df, s, m) -> float:
    """Strength from the totals; the strongest prior where nothing can be told."""
    if not n or not df or k in (0, n) or n - m - df <= 0:
        return STRONGEST
    p = k / n
    rho = (s / (p * (1 - p)) - df) / (n - m - df)
    return STRONGEST if rho <= 0 else min(STRONGEST, max(WEAKEST, (1 - rho) / rho))


def through(*strengths: float) -> float:
    """The strength of a prior through several levels: each level spreads the one below further."""
    left = 1.0
    for w in strengths:
        left *= w / (w + 1)
    return left / (1 - left)


def reputation(hosts: DataFrame, every: DataFrame, z: float = 1.645) -> DataFrame:
    """Posterior mean and lower bound of the bad share of each host in ``every`` (host), by the labelled ``hosts`` (host,
    domain, suffix, n, k)."""
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    mean = ((total["k"] or 0) + 0.5) / ((total["n"] or 0) + 1.0)
    by_host, by_domain = _strength(hosts, "domain"), _strength(domains, "suffix")
    by_suffix = _strength(suffixes.withColumn("all", F.lit(1)), "all")

    def shrunk(prior, strength, n="n", k="k"):
        return (prior * strength + F.col(k)) / (strength + F.col(n))

    suffixes = table(suffixes.select("suffix", shrunk(F.lit(mean), by_suffix).alias("m_suffix")), "suffix_priors")
    domains = table(domains.join(suffixes, "suffix")
                    .select("domain", "suffix", shrunk(F.col("m_suffix"), by_domain).alias("m_domain")), "domain_priors")
    prior = F.coalesce("m_domain", "m_suffix", F.lit(mean))
    strength = (F.when(F.col("m_domain").isNotNull(), by_host)
                .when(F.col("m_suffix").isNotNull(), through(by_host, by_domain))
                .otherwise(through(by_host, by_domain, by_suffix)))
    a = prior * strength + F.col("k")
    b = (1 - prior) * strength + F.col("n") - F.col("k")
    mean_h = F.col("a") / (F.col("a") + F.col("b"))
    sd = F.sqrt(F.col("a") * F.col("b") / (F.col("a") + F.col("b") + 1)) / (F.col("a") + F.col("b"))
    named = every.select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"))
    return (named.join(hosts.select("host", "n", "k"), "host", "left")
            .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n", "k")})
            .join(domains, ["domain", "suffix"], "left").join(suffixes, "suffix", "left")
            .withColumn("a", a).withColumn("b", b)
            .select("host", "n", mean_h.alias("bad_share"), (mean_h - z * sd).alias("bad_lower")))


def url_filter(pages: DataFrame, outcomes: DataFrame, key: str, rules=RULES, url: str = "url",
               page_id: str = "page_id", max_bad: float = 0.5, z: float = 1.645) -> DataFrame:
    """Judge every URL: the longest rule, else block where the lower bound of the host's bad share is above ``max_bad``.

    ``key`` names the column of both inputs that says which outcome is a
    page's.  Returns page_id, host, path, rule, verdict, n_labelled (labelled
    pages of the host) and bad_share, bad_lower.
    """
    judged = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"),
                          path_of(F.col(url)).alias("path"), F.col(key).alias("_key"))
    hosts = table(host_outcomes(judged.withColumnRenamed("_key", key), outcomes, key), "host_outcomes")
    # Written, so that the join deals the pages of a host anew and Spark can split them, or sends few hosts everywhere.
    known = table(reputation(hosts, judged.select("host").distinct(), z), "reputation")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return (judged.join(known, "host", "left")
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(verdict, F.when(F.col("bad_lower") > max_bad, "block").otherwise("allow"))
                    .alias("verdict"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n_labelled"), "bad_share", "bad_lower"))

