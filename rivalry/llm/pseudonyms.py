"""Personal data: format-preserving keyed pseudonyms.

Validated values are found by one pattern and permuted within their format by
a Feistel network over two residue rings (rounds of SHA-256 under a key), so
equal values get equal pseudonyms in every document and different values stay
different:

- card numbers (13 to 19 digits, Luhn check right): all digits but the check
  digit are permuted, which is then set right; separators stay.  Numbers in a
  usual layout are tried at every group of digits, so that a number beside them
  hides none; other layouts are tried as one run of groups;
- phone numbers: the ten digits after the country code, which unbroken numbers
  must have;
- IPv4 addresses: all 32 bits;
- social security numbers: among valid ones only;
- dates (y-m-d with - / or ., d.m.y, m/d/y) from 1800 to 2199: among the days
  of these 400 years, in the same layout.

E-mail addresses have no fixed format: they become a keyed hash at a reserved
domain.  Numbers that fail their check stay as they are.  All of it is Spark
SQL expressions; documents are never shuffled.

Null text: null.  Repeated rows are treated one by one; an empty table gives
an empty result; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rivalry.llm.common import let

OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?[0-9])",
    "date": (r"(?<![0-9./-])(?:[0-9]{4}([-/.])[0-9]{2}\g[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}"
             r"|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9]|[./-][0-9])"),
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": (r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|(?<![0-9][.-])[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
              r"|(?<![0-9])\+[0-9]{1,3}[ .-]?[0-9]{10}(?![0-9])"),
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
}
KINDS = tuple(PATTERNS)
# Usual layouts of card numbers, longer ones of the same start by themselves.
LAYOUTS = ("[0-9]{13,19}", "[0-9]{4}(?:[ -][0-9]{4}){3}", "[0-9]{4}(?:[ -][0-9]{4}){3}[ -][0-9]{1,3}",
           "[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}", "[0-9]{4}[ -][0-9]{4}[ -][0-9]{5}", "[0-9]{6}[ -][0-9]{13}")
# All kinds but cards, which are named one by one.  The back reference names the first (and only) group of the alternation.
ANY = "|".join(f"(?:{p})" for kind, p in PATTERNS.items() if kind != "card").replace(r"\g", r"\1")
ROUNDS = 8
# Days from FIRST_DAY on: one whole Gregorian cycle, 400 years, 189 * 773 days.
FIRST_DAY, DAYS_A, DAYS_B = "1800-01-01", 189, 773


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, domain: str) -> Column:
    """A keyed permutation of the pairs (left < a, right < b): the halves are shifted in turn by a hash of the other."""
    def shift(i: Column, half: Column) -> Column:
        mac = F.sha2(F.concat_ws("|", F.lit(key), F.lit(domain), i.cast("string"), half.cast("string")), 256)
        return F.conv(F.substring(mac, 1, 15), 16, 10).cast("long")

    def turn(s: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, F.struct(((s["l"] + shift(i, s["r"]) % a) % a).alias("l"), s["r"].alias("r"))).otherwise(
            F.struct(s["l"].alias("l"), ((s["r"] + shift(i, s["l"]) % b) % b).alias("r")))

    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]),
                       F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), turn)


def digits_of(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def zeros(c: Column, n: Column) -> Column:
    """``c`` as ``n`` digits."""
    return F.lpad(c.cast("string"), n, "0")


def refill(pattern: Column, digits: Column) -> Column:
    """``pattern`` with its digits replaced in turn by those of ``digits``."""
    def char(i: Column) -> Column:
        c = F.substring(pattern, i, F.lit(1))
        nth = F.length(digits_of(F.substring(pattern, F.lit(1), i)))
        return F.when(c.rlike("[0-9]"), F.substring(digits, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(pattern)), char), "")


def check_digit(payload: Column) -> Column:
    """The Luhn digit that completes ``payload``."""
    n = F.length(payload)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(payload, i, F.lit(1)).cast("int")
        return total + F.when((n - i) % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return (10 - F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10) % 10


def half_digits(digits: Column, n: Column, key: str, domain: str) -> Column:
    """``n`` digits permuted: two halves of up to nine digits."""
    left_n = F.floor(n / 2).cast("int")
    powers = F.array(*[F.lit(10 ** i) for i in range(10)]).cast("array<long>")
    power = lambda k: F.get(powers, k)
    swapped = feistel(F.substring(digits, F.lit(1), left_n).cast("long"),
                      F.substring(digits, left_n + 1, n - left_n).cast("long"),
                      power(left_n), power(n - left_n), key, domain)
    return let(swapped, lambda s: F.concat(zeros(s["l"], left_n), zeros(s["r"], n - left_n)))


def card(m: Column, key: str) -> Column:
    def permuted(d: Column) -> Column:
        n = F.length(d)
        payload = half_digits(F.substring(d, F.lit(1), n - 1), n - 1, key, "card")
        return let(payload, lambda p: refill(m, F.concat(p, check_digit(p).cast("string"))))

    return let(digits_of(m), lambda d: F.when(F.call_function("luhn_check", d), permuted(d)))


def phone(m: Column, key: str) -> Column:
    def permuted(d: Column) -> Column:
        new = half_digits(F.substring(d, F.length(d) - 9, F.lit(10)), F.lit(10), key, "phone")
        return let(new, lambda x: refill(m, F.concat(F.substring(d, F.lit(1), F.length(d) - 10), x)))

    return let(digits_of(m), permuted)


def address(m: Column, key: str) -> Column:
    def number(o: Column, i: int) -> Column:
        return F.get(o, F.lit(i)).cast("long") * 256 + F.get(o, F.lit(i + 1)).cast("long")

    def dotted(n: Column) -> list[Column]:
        return [F.floor(n / 256).cast("string"), (n % 256).cast("string")]

    size = F.lit(65536)
    return let(F.split(m, r"\."), lambda o: let(feistel(number(o, 0), number(o, 2), size, size, key, "ip"),
                                                lambda s: F.concat_ws(".", *dotted(s["l"]), *dotted(s["r"]))))


def security_number(m: Column, key: str) -> Column:
    def part(i: int, n: int) -> Column:
        return F.substring(m, i, n).cast("long")

    area, group, serial = part(1, 3), part(5, 2), part(8, 4)
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    swapped = feistel(area - 1 - F.when(area > 666, 1).otherwise(0), (group - 1) * 9999 + serial - 1,
                      F.lit(898), F.lit(99 * 9999), key, "ssn")

    def text(s: Column) -> Column:
        new = s["l"] + 1 + F.when(s["l"] >= 665, 1).otherwise(0)
        return F.concat_ws("-", zeros(new, F.lit(3)), zeros(F.floor(s["r"] / 9999) + 1, F.lit(2)),
                           zeros(s["r"] % 9999 + 1, F.lit(4)))

    return F.when(valid, let(swapped, text))


def day(m: Column, key: str) -> Column:
    """A date's pseudonym in its own layout; null if there is no such day or it is out of the 400 years."""
    found = None
    layouts = [(rf"^[0-9]{{4}}\{s}", f"yyyy{s}MM{s}dd") for s in "-/."] + [
        (r"^[0-9]{2}\.", "dd.MM.yyyy"), (r"^[0-9]{2}/", "MM/dd/yyyy")]
    for start, layout in layouts:
        def permuted(at: Column, layout=layout) -> Column:
            s = feistel(F.floor(at / DAYS_B), at % DAYS_B, F.lit(DAYS_A), F.lit(DAYS_B), key, "date")
            return let(s, lambda x: F.date_format(
                F.date_add(F.lit(FIRST_DAY).cast("date"), (x["l"] * DAYS_B + x["r"]).cast("int")), layout))
        at = F.datediff(F.try_to_date(m, layout), F.lit(FIRST_DAY).cast("date"))
        new = let(at, in_cycle(permuted))
        found = F.when(m.rlike(start), new) if found is None else found.when(m.rlike(start), new)
    return found


def in_cycle(permuted):
    def chosen(at: Column) -> Column:
        return F.when((at >= 0) & (at < DAYS_A * DAYS_B), permuted(at))
    return chosen


def email(m: Column, key: str) -> Column:
    mac = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)), 256)
    return F.concat(F.lit("user-"), F.substring(mac, 1, 12), F.lit("@example.com"))


def kind_of(m: Column) -> Column:
    """Which pattern made the match."""
    return (F.when(m.contains("@"), "email")
            .when(m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"), "ip")
            .when(m.rlike("^(?:[0-9]{4}[-/.][0-9]{2}[-/.][0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})$"), "date")
            .when(m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
            .when(F.length(digits_of(m)) >= 13, F.when(m.rlike(r"[+(.]"), "phone").otherwise("card"))
            .otherwise("phone"))


def pseudonym(kind: Column, m: Column, key: str) -> Column:
    """The pseudonym of a match; null if it isn't valid."""
    makers = {"email": email, "ip": address, "date": day, "ssn": security_number, "phone": phone, "card": card}
    found = None
    for name, make in makers.items():
        found = F.when(kind == name, make(m, key)) if found is None else found.when(kind == name, make(m, key))
    return found


def valid_cards(source: Column) -> Column:
    """The distinct card numbers of a text, as they are written, the longest first."""
    # A look-ahead takes nothing of the text, so every group of digits is tried as a start.
    shaped = [F.regexp_extract_all(source, F.lit(rf"(?<![0-9])(?=({p})(?![0-9]))"), F.lit(1)) for p in LAYOUTS]
    runs = F.regexp_extract_all(source, F.lit(PATTERNS["card"]), F.lit(0))
    found = F.filter(F.array_distinct(F.concat(*shaped, runs)), lambda m: F.call_function("luhn_check", digits_of(m)))
    longest = F.transform(F.sort_array(F.transform(found, lambda m: F.struct(-F.length(m), m.alias("m")))), lambda x: x["m"])
    return F.when(source.rlike(r"[0-9](?:[ -]?[0-9]){12}"), longest)


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with the text's personal data replaced, and n_<kind>: how many values of each kind were."""
    source = F.col(text).cast("string")
    # Cards are digits, blanks and dashes: each is a pattern of itself.
    any_ = let(valid_cards(source), lambda c: F.when(F.size(c) > 0, F.concat(
        F.lit("(?<![0-9])(?:"), F.array_join(c, "|"), F.lit(f")(?![0-9])|{ANY}"))).otherwise(F.lit(ANY)))
    step = docs.withColumn("_any", F.when(source.rlike("[0-9@]"), any_))
    found = F.regexp_extract_all(source, F.col("_any"), F.lit(0))
    step = step.withColumn("_m", F.coalesce(found, F.array().cast("array<string>")))

    def replaced(m: Column) -> Column:
        return let(kind_of(m), lambda kind: F.struct(m.alias("old"), kind.alias("kind"), pseudonym(kind, m, key).alias("new")))

    step = step.withColumn("_r", F.when(F.size("_m") > 0, F.transform("_m", replaced)))
    gaps = F.split(source, F.col("_any"), -1)
    joined = let(gaps, lambda g: F.array_join(F.transform(
        g, lambda x, i: F.concat(x, F.coalesce(F.get(F.col("_r"), i)["new"], F.get(F.col("_r"), i)["old"], F.lit("")))), ""))
    counts = [F.coalesce(F.size(F.filter("_r", count_of(k))), F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS]
    names = {f"n_{k}" for k in KINDS}
    return step.select(*[F.when(F.col("_r").isNotNull(), joined).otherwise(source).alias(text) if c == text else F.col(c)
                         for c in docs.columns if c not in names], *counts)


def count_of(kind: str):
    def valid(x: Column) -> Column:
        return (x["kind"] == kind) & x["new"].isNotNull()
    return valid
