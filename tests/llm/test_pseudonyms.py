import datetime as dt
import hashlib
import re

import pytest

from llm_fixtures import awkward, frame, sorted_rows
from rivalry.llm.pseudonyms import pseudonymise

KEY = "test key"


def shift(domain, i, half):
    return int(hashlib.sha256(f"{KEY}|{domain}|{i}|{half}".encode()).hexdigest()[:15], 16)


def feistel(left, right, a, b, domain, back=False):
    for i in reversed(range(8)) if back else range(8):
        if i % 2 == 0:
            s = shift(domain, i, right)
            left = (left - s if back else left + s) % a
        else:
            s = shift(domain, i, left)
            right = (right - s if back else right + s) % b
    return left, right


def luhn(d):
    odd = [int(c) for c in d[::-1]]
    return sum(odd[0::2]) + sum(sum(divmod(2 * x, 10)) for x in odd[1::2])


def digits(text):
    return re.sub("[^0-9]", "", text)


def run(spark, text):
    return pseudonymise(spark.createDataFrame([(1, text)], "doc_id long, text string"), KEY).first()


def test_card_numbers_stay_valid_and_can_be_undone(spark):
    r = run(spark, "pay 4845168114407329 or 4845-1681-1440-7329, not 9807915762804490 nor 48451681144073291234567")
    new, dashed = re.findall(r"[0-9]{16}|[0-9]{4}(?:-[0-9]{4}){3}", r.text)[:2]
    assert r.n_card == 2 and luhn(new) % 10 == 0 and digits(dashed) == new != "4845168114407329"
    assert "9807915762804490" in r.text and "48451681144073291234567" in r.text
    left, right = feistel(int(new[:7]), int(new[7:15]), 10**7, 10**8, "card", back=True)
    assert f"{left:07d}{right:08d}" == "484516811440732"


def test_numbers_beside_a_card_do_not_hide_it(spark):
    cards = ("4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1111", "3782 822463 10005")
    rows = [(n, f"pay {before}{n}{after}, thanks") for n in cards for before in ("", "12 ", "2024 ", "order 12-", "4242 4242 ")
            for after in ("", " 123", " 12", " 1234 5678 12", "-7")]
    for r in pseudonymise(spark.createDataFrame([(*x, x[1]) for x in rows], "number string, text string, old string"), KEY).collect():
        assert r.n_card >= 1 and r.number not in r.text
        assert re.sub("[0-9]", "0", r.text) == re.sub("[0-9]", "0", r.old)


def test_cards_in_long_runs(spark):
    r = run(spark, "1234 4111 1111 1111 1111 4111 1111 1111 1111 99; 41 11 11 11 11 11 11 11")
    cards = re.findall(r"[0-9]{4}(?: [0-9]{4}){8} 99; ([0-9 ]+)$", r.text)
    assert r.n_card == 3 and "1111 1111" not in r.text and luhn(digits(cards[0])) % 10 == 0


def test_phones_without_separators(spark):
    r = run(spark, "call +14155552671 or +1 4155552671, not 4155552671 nor +141555526712345")
    found = re.findall(r"\+1 ?([0-9]{10})(?![0-9])", r.text)
    left, right = feistel(41555, 52671, 10**5, 10**5, "phone")
    assert r.n_phone == 2 and found == [f"{left:05d}{right:05d}"] * 2
    assert "not 4155552671 nor +141555526712345" in r.text


def test_phones_addresses_numbers(spark):
    r = run(spark, "+1 (183) 555-1276, 53.224.140.246. ssn 123-45-6789 000-12-3456; version 4.0. 1.2.3.4.5 256.1.1.1")
    assert (r.n_phone, r.n_ip, r.n_ssn) == (1, 1, 1)
    phone = re.search(r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}", r.text)[0]
    left, right = feistel(18355, 51276, 10**5, 10**5, "phone")
    assert digits(phone) == f"1{left:05d}{right:05d}"
    left, right = feistel(53 * 256 + 224, 140 * 256 + 246, 65536, 65536, "ip")
    assert f"{left // 256}.{left % 256}.{right // 256}.{right % 256}." in r.text
    left, right = feistel(122, 44 * 9999 + 6788, 898, 99 * 9999, "ssn")
    area = left + 1 + (left >= 665)
    assert f"ssn {area:03d}-{right // 9999 + 1:02d}-{right % 9999 + 1:04d} " in r.text
    assert "000-12-3456; version 4.0. 1.2.3.4.5 256.1.1.1" in r.text


def test_dates_are_linked_across_layouts(spark):
    r = run(spark, "1999-12-31 31.12.1999 12/31/1999 1999/12/31 2020-02-30 1799-12-31 2020-01/02")
    at = (dt.date(1999, 12, 31) - dt.date(1800, 1, 1)).days
    left, right = feistel(at // 773, at % 773, 189, 773, "date")
    day = dt.date(1800, 1, 1) + dt.timedelta(days=left * 773 + right)
    assert r.text == (f"{day:%Y-%m-%d} {day:%d.%m.%Y} {day:%m/%d/%Y} {day:%Y/%m/%d} 2020-02-30 1799-12-31 2020-01/02")
    assert r.n_date == 4


def test_mail_addresses_are_hashed(spark):
    r = run(spark, "write me.x@mail.example.org, ME.X@mail.example.org or nobody@nowhere")
    a, b = re.findall(r"user-[0-9a-f]{12}@example\.com", r.text)
    assert a == b and r.n_email == 2 and "nobody@nowhere" in r.text


@pytest.mark.parametrize("clash", [False, True])
def test_texts_without_personal_data_stay(spark, clash):
    docs = awkward()
    got = pseudonymise(frame(spark, docs, clash), KEY)
    assert sorted_rows(got, "doc_id", "text") == sorted(docs, key=repr)
    assert pseudonymise(frame(spark, [], clash), KEY).count() == 0


def test_different_values_stay_different(spark):
    rows = [(i, f"1.2.{i // 256}.{i % 256}") for i in range(1500)]
    got = pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), KEY).collect()
    assert len({r.text for r in got}) == 1500 and all(r.n_ip == 1 for r in got)
