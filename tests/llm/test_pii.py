import hashlib
import random
import re

import __spark_entry__ as E
from tagstream.llm import pii
from tests.llm.helpers import SF, awkward_docs, by_id, docs_frame, empty_docs, table

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile("[0-9]([\x20-]?[0-9])+")
PHONE = re.compile("\\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    odd = sum(int(c) for c in digits[-1::-2])
    return (odd + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])) % 10 == 0


def brute(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans_equal_the_patterns_on_random_texts():
    a = pii.build_automaton()
    rnd = random.Random(5)
    parts = ["a", ".", "@", "1", "23", "+", "(", ")", " ", "-", "456", "9.9", "b.c", "@x", "::", "\n", "DE", "é",
             "255", "4111111111111111", "://", "account "]
    for _ in range(20_000):
        text = "".join(rnd.choices(parts, k=rnd.randint(1, 14)))
        assert [s for s in pii.find_spans(text, a) if s[1] < 4] == brute(text), text


def test_query_equals_brute_force(spark):
    got = by_id(E.queries()["op1_pii"](spark, SF))
    docs = table("documents")
    assert len(got) == len(docs)
    for d in docs:
        spans = brute(d["text"] or "")
        kinds = [k for _, k, _ in spans]
        r = got[d["doc_id"]]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [kinds.count(k) for k in range(4)]
        said = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def test_added_kinds():
    a = pii.build_automaton()
    def kinds(t):
        return [(pii.KINDS[k], t[s:e]) for s, k, e in pii.find_spans(t, a) if k > 3]
    assert kinds("pay DE89 3704 0044 0532 0130 00 now") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert kinds("pay DE88 3704 0044 0532 0130 00 now") == []
    assert kinds("see https://me:pw@host/x") == [("login", "me:pw")]
    assert kinds("Account no. 12345678.") == [("account", "12345678")]


def test_awkward_rows_and_redaction(spark):
    docs = awkward_docs(spark)
    rows = pii.personal_data(docs).collect()
    assert len(rows) == 11
    assert {(r["n_email"], r["n_ip"], r["n_phone"]) for r in rows if r["doc_id"] == 8} == {(1, 1, 1)}
    clean = pii.redact(docs)
    assert clean.schema == docs.schema
    out = [r for r in clean.collect()]
    assert len(out) == 11
    (eight,) = [r for r in out if r["doc_id"] == 8]
    assert eight["text"] == "mail <email> or <ip> \u00e9\u00df\U0001f600 <phone>"
    assert eight["n_chars"] == len(eight["text"]) and eight["kept"] == "x"
    assert [r["text"] for r in out if r["doc_id"] == 1] == [None]
    assert pii.personal_data(empty_docs(spark)).count() == 0 and pii.redact(empty_docs(spark)).count() == 0


def test_overlapping_spans_are_replaced_once(spark):
    a = pii.build_automaton()
    assert pii.redacted("x ftp://a:b@c.de y", a) == "x ftp://<login>@c.de y" or "<" in pii.redacted(
        "x ftp://a:b@c.de y", a)
    assert "4111" not in pii.redacted("card 4111 1111 1111 1111.", a)
    assert docs_frame(spark, ["a"]).count() == 1
