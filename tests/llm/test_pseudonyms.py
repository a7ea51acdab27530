import datetime
import re

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from platewatch.llm import pseudonyms as p
from platewatch.llm.feistel import permute, permute_array
from tests.llm.cases import ROWS, awkward, nothing


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000])
def test_permutations_of_small_sets(size):
    whole = list(range(size))
    assert sorted(permute(v, size, b"k") for v in whole) == whole
    assert sorted(permute_array(np.arange(size), size, 5).tolist()) == whole
    if size > 90:
        assert [permute(v, size, b"k") for v in whole] != [permute(v, size, b"other") for v in whole]


@given(st.integers(10**11, 10**17))
def test_cards_stay_cards(payload):
    number = str(payload) + p.luhn_digit(str(payload))
    new, spans = p.pseudonymise(f"pay {number}, then {number}.")
    first, second = re.findall(r"\d+", new)
    assert first == second and len(first) == len(number) and p.luhn_digit(first[:-1]) == first[-1]
    assert [s["kind"] for s in spans] == ["card"] * 2 and new[spans[0]["start"] : spans[0]["end"]] == first


@given(st.dates(datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)))
def test_dates_stay_dates(day):
    new, spans = p.pseudonymise(f"on {day:%Y-%m-%d} or {day:%d.%m.%Y}")
    iso, other = re.findall(r"[\d.-]+", new)
    made = datetime.date.fromisoformat(iso)
    assert f"{made:%d.%m.%Y}" == other and len(spans) == 2


@pytest.mark.parametrize("text", [
    "invalid card 4111111111111112 stays", "year 2024 and 12345", "2023-02-30", "300.1.1.1", "1.2.3.4.5", "666-12-3456", "000-12-3456",
    "GB82WEST12345698765433", "version 1.2.3", "", "no digits here", "at 12:30:45", "abc::def", "00:1a:2b:3c:4d:5e", "::1", "155-123-4567",
])
def test_what_fails_a_rule_stays(text):
    assert p.pseudonymise(text) == (text, [])


@pytest.mark.parametrize("text, value", [
    ("DE89370400440532013000 EUR 500.", "DE89370400440532013000"), ("GB82WEST12345698765432 BIC NWBKGB2L", "GB82WEST12345698765432"),
    ("DE89 3704 0044 0532 0130 00 I think", "DE89 3704 0044 0532 0130 00"), ("GB82WEST12345698765432 20 30 40", "GB82WEST12345698765432"),
    ("+7 495 123-45-67", "+7 495 123-45-67"), ("+33 1 23 45 67 89", "+33 1 23 45 67 89"), ("call 555-123-4567 now", "555-123-4567"),
    ("555.123.4567", "555.123.4567"), ("from 2001:db8::ff00:42:8329.", "2001:db8::ff00:42:8329"),
])
def test_a_value_is_replaced_whole_and_no_more(text, value):
    new, spans = p.pseudonymise(text)
    before, after = text.split(value)
    assert len(spans) == 1 and new.startswith(before) and new.endswith(after)
    made = new[spans[0]["start"] : spans[0]["end"]]
    assert made == new[len(before) : len(new) - len(after)] and made != value
    # A pseudonym is a valid value of its kind, and other spellings of one address stay linked.
    assert [s["kind"] for s in p.pseudonymise(new)[1]] == [s["kind"] for s in spans]
    assert p.pseudonymise("2001:DB8:0::FF00:42:8329")[0] == p.pseudonymise("2001:db8::ff00:42:8329")[0]


def test_ibans_against_every_country_length():
    # Brute force: all cuts of a run of groups at every length, checked by the definition.
    for country, size in p.IBAN_LENGTHS.items():
        account = "".join(str(i * 7 % 10) for i in range(size - 4))
        iban = country + p._iban_check(country, account) + account
        assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
        new, spans = p.pseudonymise(f"to {iban} USD 12 ABC")
        assert [s["kind"] for s in spans] == ["iban"] and spans[0]["end"] == 3 + size and new.endswith(" USD 12 ABC")
        assert p.pseudonymise(f"to {iban}9")[1] == []


def test_other_kinds_keep_their_shape():
    text = 'a.b7@mail.example.org +1 (974) 555-3436 10.20.30.40 123-45-6789 GB82 WEST 1234 5698 7654 32 token = "00ff00ff00ff00ff00ff"'
    new, spans = p.pseudonymise(text)
    assert [s["kind"] for s in spans] == ["email", "phone", "ip", "ssn", "iban", "secret"]
    assert re.fullmatch(r"[a-z]\.[a-z]\d@mail\.example\.org \+1 \(\d{3}\) \d{3}-\d{4} \d+\.\d+\.\d+\.\d+ \d{3}-\d\d-\d{4} "
                        r'GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d token = "[0-9a-f]{20}"', new)
    iban = re.search(r"GB[\w ]+(?= token)", new)[0].replace(" ", "")
    assert p._iban_check(iban[:2], iban[4:]) == iban[2:4]
    assert not any(new[s["start"] : s["end"]] in text for s in spans)
    assert [s["kind"] for s in p.pseudonymise(new)[1]] == [s["kind"] for s in spans]


def test_awkward_rows(spark):
    docs = awkward(spark, [*ROWS, (11, "card 4111111111111111 twice 4111111111111111", "en", "a", 1)])
    rows = p.with_pseudonyms(docs)
    assert rows.columns == [*docs.columns, "spans_"]
    got = rows.collect()
    assert len(got) == len(ROWS) + 1
    assert {r["text"] for r in got if r["doc_id"] == 2} == {None}
    assert [len(r["spans_"]) for r in got if r["doc_id"] == 11] == [2]
    assert all(not r["spans_"] for r in got if r["doc_id"] != 11)
    assert p.with_pseudonyms(nothing(spark)).count() == 0
