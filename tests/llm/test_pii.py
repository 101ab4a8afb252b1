import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from meterline.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return [c for c in text if c in "0123456789"]


def plain(text):
    """The base patterns as they are written down."""
    out = [(*m.span(), "email") for m in EMAIL.finditer(text)]
    out += [(*m.span(), "ip") for m in IP.finditer(text) if all(int(part) <= 255 for part in m[0].split("."))]
    out += [
        (*m.span(), "card")
        for m in CARD.finditer(text)
        if 14 <= len(digits(m[0])) <= 19 and pii.luhn("".join(digits(m[0])))
    ]
    return out + [(*m.span(), "phone") for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@._1", max_size=40) | st.text(alphabet="0123456789. -+()", max_size=60) | st.text(max_size=30))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_spans(text) == plain(text)


def test_checksums():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765433")


def test_context_decides_on_further_kinds():
    kinds = {kind for *_, kind, _ in pii.find_spans("my social security number: 078-05-1120")}
    assert kinds == {"ssn"}
    assert pii.find_spans("part 078-05-1120 of the serial") == []
    assert [k for *_, k, _ in pii.find_spans("IBAN GB82 WEST 1234 5698 7654 32")] == ["iban"]
    with_words = pii.find_spans("please mail me: a@b.org")[0][3]
    assert with_words > pii.find_spans("xx a@b.org")[0][3]


@pytest.mark.parametrize("unit", ["a", "1", "1.", "+1", "@a.", "a@", "1 ", "A1", "1-"])
def test_long_texts_take_linear_time(unit):
    began = time.time()
    pii.find_spans(unit * (200_000 // len(unit)))
    assert time.time() - began < 20


def test_query_columns(spark, documents, sf_dir):
    rows = {row.doc_id: row for row in pii.op1_pii(spark, sf_dir).collect()}
    assert len(rows) == documents.count()
    for doc in documents.collect():
        spans = sorted(plain(doc.text), key=lambda s: (s[0], pii.KINDS.index(s[2])))
        listed = ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)
        row = rows[doc.doc_id]
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [
            sum(kind == wanted for *_, kind in spans) for wanted in pii.BASE_KINDS
        ]
        assert set(filter(None, listed.split(","))) <= set(row.spans.split(","))


def test_odd_rows(odd_documents, no_documents):
    found = pii.detect(odd_documents)
    assert found.count() == odd_documents.count()
    assert found.where("doc_id = 2").first().spans == []
    assert pii.detect(no_documents).count() == 0


def test_accounts_end_where_their_country_says():
    """What follows is not part of them, and a number that fails keeps none from being found behind it."""
    text = "GB82 WEST 1234 5698 7654 32 BIC MIDLGB22 und DE89370400440532013000, GB83 WEST 1234 5698 7654 32 FR1420041010050500013M02606X"
    found = [text[a:b] for a, b in pii.accounts(text)]
    assert found == ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"]
    assert list(pii.accounts("AB12 CDEF 1234 " * 3)) == []
    one = "x NO9386011117947 BE68 5390 0754 7034 end"
    assert [one[a:b] for a, b in pii.accounts(one)] == ["NO9386011117947", "BE68 5390 0754 7034"]
