"""Added spans: identifiers behind cues, and URLs, each validated."""

import time

import pytest

from cofan.llm import pii


@pytest.mark.parametrize("text, want", [
    ("Customer ID 12345678", "12345678"), ("User ID: ab12345", "ab12345"), ("uSeR iD #778899", "778899"),
    ("Account Number: 12345678", "12345678"), ("ACCOUNT NO. 12345678", "12345678"), ("İ Account No 12345678", "12345678"),
    ("IBAN DE89 3704 0044 0532 0130 00 thanks", "DE89 3704 0044 0532 0130 00"), ("iban: BE68 5390 0754 7034 from me", "BE68 5390 0754 7034"),
    ("Iban Number DE89370400440532013000", "DE89370400440532013000"),
])
def test_account_forms(text, want):
    assert [text[a:b] for k, a, b in pii.spans(text, pii.anchors()) if pii.KINDS[k] == "account"] == [want]


def found(text, kind):
    return [text[a:b] for k, a, b in pii.spans(text, pii.anchors()) if pii.KINDS[k] == kind]


@pytest.mark.parametrize("text, want", [
    ("ssn 123-45-6789", "123-45-6789"), ("Social Security Number: 123 45 6789.", "123 45 6789"), ("SSN=123456789", "123456789"),
    ("passport no. C01X0006", None), ("Passport: X1234567", "X1234567"), ("acct #1234-5678-90", "1234-5678-90"), ("BIC: DEUTDEFF500", "DEUTDEFF500"),
    ("routing number 021000021", "021000021"), ("NHS number 943 476 5919", "943 476 5919"), ("EIN 12-3456789", "12-3456789"),
    # Not identifiers: wrong check digits or parts, a cue inside a word, a date.
    ("IBAN: GB00 NWBK 6016 1331 9268 19", None), ("IBAN ZZ89370400440532013000", None), ("ssn 000-45-6789", None), ("ssn 666-45-6789", None),
    ("ssn 123-00-6789", None), ("ssn 123-45-67890", None), ("ssn 123-45 6789", None), ("routing 021000022", None), ("NHS 943 476 5918", None),
    ("accountant123456", None), ("account123456", None), ("subaccount 123456", None), ("accounts 123456", None), ("account 2024-05-17", None), ("account abcdefgh", None), ("account", None),
])
def test_each_cue_has_its_check(text, want):
    assert found(text, "account") == ([want] if want else [])
    assert found(f"x {text}\n", "account") == ([want] if want else [])


@pytest.mark.parametrize("text, want", [
    ("see http://x.example/a.", "http://x.example/a"), ("(http://x.example)", "http://x.example"), ("(HTTP://x.example/a_(b)),", "HTTP://x.example/a_(b)"),
    ("https://u:p@x.example:8080/?q=a;b#c!", "https://u:p@x.example:8080/?q=a;b#c"), ("ftp://10.0.0.1/f", "ftp://10.0.0.1/f"), ("http://[::1]:80/", "http://[::1]:80/"),
    ("http://localhost:3000", "http://localhost:3000"), ("http://münchen.example/straße", "http://münchen.example/straße"), ("http://x.example: yes", "http://x.example"),
    ("http://-", None), ("http://", None), ("http://x", None), ("http://-x.example", None), ("http://x..example", None), ("http://10.0.0.256/", None),
    ("http://x.example:70000/", None), ("shttp://x.example", None), ("http://[::g]/", None), ("http://a_.example", None), ("http://" + "a" * 64 + ".example", None),
])
def test_urls_are_validated(text, want):
    assert found(text, "url") == ([want] if want else [])


def test_urls_next_to_each_other_and_inside():
    assert found("[a](http://x.example),(http://y.example/)http://http://z.example", "url") == ["http://x.example", "http://y.example/)http://http://z.example"]
    assert found("http://http://z.example", "url") == ["http://z.example"]


def test_long_texts_take_time_in_proportion():
    for piece in ("http://", "account ", "iban DE89 ", "http://x.example/)", "ssn 123-45-", "http://x.example/" + "a)" * 20, "a-account a-"):
        start = time.time()
        pii.spans(piece * (1_000_000 // len(piece)), pii.anchors())
        assert time.time() - start < 20
