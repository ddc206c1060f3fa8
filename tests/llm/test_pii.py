import datetime
import re

import pytest

from cubeguard.llm import pii as P
from tests.llm.helpers import frame, rows


def mask(text, key=P.KEY):
    return P.pseudonymised(text, key)[0]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 10, 100, 365, 1000])
def test_permutation_is_a_bijection(size):
    assert sorted(P.permuted(k, size, P.KEY, "t") for k in range(size)) == list(range(size))


@pytest.mark.parametrize("text, kind", [
    ("the.79@mail9.example.com", "email"), ("4785380592391139", "card"), ("4785 3805 9239 1139", "card"), ("4785-3805-9239-1139", "card"),
    ("152.143.123.131", "ip"), ("+1 (017) 555-7713", "phone"), ("(407) 555-7710", "phone"), ("407-555-7710", "phone"), ("+49 30 1234567", "phone"),
    ("2021-02-28", "date"), ("28.02.2021", "date"), ("12/31/1999", "date"), ("31/12/1999", "date"), ("123-45-6789", "ssn"), ("DE89 3704 0044 0532 0130 00", "iban"), ("GB82WEST12345698765432", "iban")])
def test_format_is_kept(text, kind):
    new, spans = P.pseudonymised(f"see {text}, ok", P.KEY)
    assert spans == [(kind, 4, 4 + len(text))]
    own = new[4:-4]
    assert own != text and new.startswith("see ") and new.endswith(", ok")
    shape = lambda s: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", s)))
    if kind == "ip":
        assert all(0 <= int(x) <= 255 for x in own.split(".")) and own.count(".") == 3
    else:
        assert shape(own) == shape(text)
    if kind == "card":
        assert P.luhn(re.sub(r"\D", "", own)) == 0
    if kind == "iban":
        chars = own.replace(" ", "")
        assert P._mod97(chars[4:] + chars[:4]) == 1 and own[:2] == text[:2]
    if kind == "date" and "-" in text:
        datetime.date.fromisoformat(own)
    assert P.pseudonymised(own, P.KEY)[1] == [(kind, 0, len(own))]  # still valid
    assert mask(text, b"another key") != mask(text)


@pytest.mark.parametrize("text", ["4785380592391138", "999.1.1.1", "2021-02-30", "31.13.2020", "000-12-3456", "DE88 3704 0044 0532 0130 00", "a1b2", "1.2.3", "v 12345", "0000000000000000", "x@y", "year 2021"])
def test_what_does_not_validate_stays(text):
    assert P.pseudonymised(text, P.KEY) == (text, [])


def test_equal_values_stay_linked(spark):
    own = [(1, "card 4785380592391139 é", None, None, None, None, None), (2, "漢 4785380592391139 or 152.143.123.131", None, None, None, None, None)]
    a, b = (r.text for r in P.pseudonyms(frame(spark, own)).orderBy("doc_id").collect())
    assert re.search(r"\d{16}", a).group() == re.search(r"\d{16}", b).group() != "4785380592391139"


def test_invalid_run_hides_nothing_behind_it():
    text = "4785380592391138 4785380592391139 999.1.1.1 8.8.4.4"
    spans = P.pseudonymised(text, P.KEY)[1]
    assert [(k, text[a:b]) for k, a, b in spans] == [("card", "4785380592391139"), ("ip", "8.8.4.4")]


@pytest.mark.parametrize("iban", ["DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765432", "NO93 8601 1117 947", "FR14 2004 1010 0505 0001 3M02 606", "ZZ19 3704 0044 0532 0130"])
@pytest.mark.parametrize("behind", ["BIC COBADEFF", "BIC COBADEFFXXX", "2024", "Berlin", "AG", "A 1", "2021-02-28", "DE89 3704 0044 0532 0130 00", ""])
def test_iban_ends_where_capitals_or_digits_follow(iban, behind):
    new, spans = P.pseudonymised(f"IBAN {iban} {behind}")
    assert spans[0] == ("iban", 5, 5 + len(iban)) and new[5:5 + len(iban)] != iban
    chars = new[5:5 + len(iban)].replace(" ", "")
    assert P._mod97(chars[4:] + chars[:4]) == 1 and len(new) == len(f"IBAN {iban} {behind}")
    assert [s[0] for s in spans[1:]] == {"2021-02-28": ["date"], "DE89 3704 0044 0532 0130 00": ["iban"]}.get(behind, [])


def test_awkward_rows(spark):
    got = P.pseudonyms(frame(spark)).collect()
    assert sorted(((r.doc_id or 0, r.text or "") for r in got)) == sorted((i or 0, t or "") for i, t, *_ in rows())
    assert all(r.spans == "" for r in got)
    assert P.pseudonyms(frame(spark, [])).count() == 0
