"""Numbers that something else follows: the check is tried at shorter ends."""

from __future__ import annotations

import pytest

from stockroom.llm import pii

CARD, IBAN = "4111111111111111", "BE68 5390 0754 7034"


def finds(text):
    new, found = pii.Pseudonyms(b"key").replace(text)
    return new, [(k, text[a:b]) for k, a, b in found]


def test_one_pattern_a_kind():
    assert list(pii.FIND_KIND) == pii.KINDS
    assert all(list(p.groupindex) == [k] for k, p in pii.FIND_KIND.items())


@pytest.mark.parametrize("number", [CARD, "4111 1111 1111 1111", "4111-1111-1111-1111"])
@pytest.mark.parametrize("after", ["", " 12/27", " 123", " 999", "-12", " 12 27", " 1234567"])
def test_card_before_other_digits(number, after):
    new, found = finds(f"card {number}{after} end")
    flat = number.replace(" ", "").replace("-", "")
    if pii.luhn_digit((flat + after.replace(" ", "").replace("-", "").split("/")[0])[:-1]) != after[-1:] or not after:
        assert found[0] == ("card", number)
    plain = "".join(c for c in new[5:5 + len(number)] if c.isdigit())
    assert plain == "".join(c for c in finds(f"card {CARD}")[0] if c.isdigit())


@pytest.mark.parametrize("after", ["", " BIC", " KBCB", " BIC KBCB", " AND GB82"])
def test_iban_before_short_capitals(after):
    new, found = finds(f"to {IBAN}{after}")
    assert found == [("iban", IBAN)] and new[3:3 + len(IBAN)] == finds(IBAN)[0] and new.endswith(after)


@pytest.mark.parametrize("after", [" 2025 13", " 1234 56", "-1234-56"])
def test_phone_before_digit_groups(after):
    new, found = finds(f"call 555-123-4567{after}")
    assert found[0] == ("phone", "555-123-4567") and new[5:17] == finds("555-123-4567")[0]


def test_number_before_a_card():
    assert finds(f"12 {CARD}")[1] == [("card", CARD)]


def test_failed_finds_stay():
    for t in ("4845168114407328", "29.02.2023", "300.1.1.1", "BE69 AAAA BBBB CCCC"):
        assert finds(t) == (t, [])
