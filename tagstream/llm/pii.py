"""Personal data by anchor expansion.

One Aho-Corasick pass over the whole text finds anchors: at-signs, plus
signs, digits, ``://`` and identifier cues.  From each anchor a local parser
expands left and right to the boundaries of the value and validates it, so no
pattern is tried at every position of the text.

Base kinds (leftmost, non-overlapping per kind): email, ip, card, phone.
Added kinds: ``iban`` (checksum mod 97), ``login`` (``user:secret`` before the
at-sign of a ``scheme://`` address) and ``account`` (6 to 17 digits after an
account cue).  Offsets are code points, end exclusive.

Defined cases: a null text has no spans; each row is handled on its own, so
ties and repeated rows get equal results; an empty table gives an empty
result; redaction carries other columns untouched whatever their names.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagstream.llm.common import arrow_map, sha256_hex, whole_text

#: Kinds of the base, in the order in which ties at one start are listed,
#: then the added kinds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "login", "account")

# Cue words that precede an account number, lower case.
ACCOUNT_CUES = ("account", "acct", "konto", "compte", "cuenta")
CUE_FORMS = [form for cue in ACCOUNT_CUES for form in (cue, cue.capitalize(), cue.upper())]
# Lengths of IBANs by country.
IBAN_LENGTHS = {"AT": 20, "BE": 16, "CH": 21, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22,
                "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24}

DIGITS = frozenset("0123456789")
LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
LOCAL = LETTERS | DIGITS | frozenset("._%+-")
LABEL = LETTERS | DIGITS | frozenset("-")
PHONE_MIDDLE = DIGITS | frozenset(" ().-")

_AT, _PLUS, _DIGIT, _SCHEME, _CUE, _COUNTRY = range(6)


def build_automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    a.add_word("@", (_AT, 1))
    a.add_word("://", (_SCHEME, 3))
    for d in DIGITS:
        a.add_word(d, (_DIGIT, 1))
        a.add_word("+" + d, (_PLUS, 2))
    for cue in CUE_FORMS:
        a.add_word(cue, (_CUE, len(cue)))
    for country in IBAN_LENGTHS:
        for d in DIGITS:
            a.add_word(country + d, (_COUNTRY, 3))
    a.make_automaton()
    return a


def run_end(text: str, at: int, allowed: frozenset) -> int:
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def parse_email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign at ``at``; its left end not before
    ``floor``, the end of the address before it."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    if start == at:
        return None
    end = run_end(text, at + 1, LABEL)
    if end == at + 1:
        return None
    labels = 1
    while text[end:end + 1] == ".":
        stop = run_end(text, end + 1, LABEL)
        if stop == end + 1:
            break
        end, labels = stop, labels + 1
    return (start, end) if labels > 1 else None


def parse_dotted(text: str, at: int) -> tuple[list[tuple[int, int]], int]:
    """From a digit that starts a run: the chain of digit runs joined by
    single dots, and its end."""
    runs = []
    while True:
        end = run_end(text, at, DIGITS)
        runs.append((at, end))
        if text[end:end + 1] != "." or text[end + 1:end + 2] not in DIGITS or end + 1 >= len(text):
            return runs, end
        at = end + 1


def small_part(text: str, a: int, b: int) -> bool:
    part = text[a:b].lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def parse_chain(text: str, at: int) -> int:
    """End of the digits from ``at`` with at most one space or hyphen between
    neighbours."""
    n, end = len(text), at + 1
    while True:
        if end < n and text[end] in DIGITS:
            end += 1
        elif end + 1 < n and text[end] in " -" and text[end + 1] in DIGITS:
            end += 2
        else:
            return end


def parse_phone(text: str, at: int) -> int:
    """End of the number whose plus sign is at ``at``; 0 if there is none."""
    end = run_end(text, at + 2, PHONE_MIDDLE)
    while end > at + 2 and text[end - 1] not in DIGITS:
        end -= 1
    return end if end >= at + 4 else 0


def iban_valid(code: str) -> bool:
    if len(code) != IBAN_LENGTHS[code[:2]] or not code.isascii() or not code.isalnum():
        return False
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def parse_iban(text: str, at: int) -> int:
    """End of the IBAN (with or without single spaces) that starts at ``at``."""
    need, got, end, n = IBAN_LENGTHS[text[at:at + 2]], [], at, len(text)
    while end < n and len(got) < need:
        c = text[end]
        if c in DIGITS or "A" <= c <= "Z":
            got.append(c)
        elif c != " " or text[end - 1] == " ":
            return 0
        end += 1
    if end < n and (text[end] in LETTERS or text[end] in DIGITS):
        return 0
    return end if len(got) == need and iban_valid("".join(got)) else 0


def parse_login(text: str, at: int) -> tuple[int, int] | None:
    """``user:secret`` between ``://`` (which ends at ``at``) and ``@``."""
    n, end = len(text), at
    while end < n and text[end] not in "@/?#" and not text[end].isspace():
        end += 1
    return (at, end) if end < n and text[end] == "@" and ":" in text[at:end] else None


def parse_account(text: str, at: int) -> tuple[int, int] | None:
    """The number after a cue that ends at ``at``."""
    start = at
    while start < len(text) and start < at + 8 and text[start] in " .:#noNO-":
        start += 1
    end = run_end(text, start, DIGITS)
    return (start, end) if start > at and 6 <= end - start <= 17 else None


def find_spans(text: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every value, sorted."""
    spans: list[tuple[int, int, int]] = []
    email_end = dotted_end = chain_end = phone_end = 0
    for last, (anchor, length) in automaton.iter(text):
        at = last - length + 1
        if anchor == _DIGIT:
            if at >= chain_end:
                chain_end = parse_chain(text, at)
                if chain_end - at >= 14:
                    digits = text[at:chain_end].replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        spans.append((at, 2, chain_end))
            if at >= dotted_end:
                runs, dotted_end = parse_dotted(text, at)
                for k in range(0, len(runs) - 3, 4):
                    if all(small_part(text, a, b) for a, b in runs[k:k + 4]):
                        spans.append((runs[k][0], 1, runs[k + 3][1]))
        elif anchor == _AT:
            if found := parse_email(text, at, email_end):
                email_end = found[1]
                spans.append((found[0], 0, found[1]))
        elif anchor == _PLUS:
            if at >= phone_end and (end := parse_phone(text, at)):
                phone_end = end
                if 10 <= sum(c in DIGITS for c in text[at:end]) <= 15:
                    spans.append((at, 3, end))
        elif anchor == _COUNTRY:
            if not (at and text[at - 1] in LETTERS | DIGITS) and (end := parse_iban(text, at)):
                spans.append((at, 4, end))
        elif anchor == _SCHEME:
            if found := parse_login(text, last + 1):
                spans.append((found[0], 5, found[1]))
        elif anchor == _CUE:
            if found := parse_account(text, last + 1):
                spans.append((found[0], 6, found[1]))
    spans.sort()
    return spans


def listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def personal_data(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row: counts of the base kinds, the digest of the base spans and
    all spans."""
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text().alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    out = (f"doc_id {id_type}, n_email long, n_ip long, n_card long, n_phone long, "
           "base_sha256 string, spans string")

    def make():
        automaton = build_automaton()

        def fn(batch):
            cols: list[list] = [[] for _ in range(6)]
            for text in batch.column(1).to_pylist():
                spans = find_spans(text, automaton)
                base = [s for s in spans if s[1] < 4]
                kinds = [s[1] for s in base]
                for c, v in zip(cols, (*(kinds.count(k) for k in range(4)), sha256_hex(listed(base).encode()),
                                       listed(spans))):
                    c.append(v)
            types = [pa.int64()] * 4 + [pa.string()] * 2
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types))],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])
        return fn

    return arrow_map(rows, out, make)


def redacted(text: str | None, automaton: ahocorasick.Automaton) -> str | None:
    """The text with every span replaced by its kind in angle brackets;
    overlapping spans become one replacement, named after the first."""
    if not text:
        return text
    out, at, end_of_last = [], 0, -1
    for start, kind, end in find_spans(text, automaton):
        if start >= end_of_last:
            out += [text[at:start], f"<{KINDS[kind]}>"]
            end_of_last = end
        else:
            end_of_last = max(end_of_last, end)
        at = end_of_last
    return "".join(out) + text[at:] if out else text


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``n_chars`` (where
    there is such a column of integers) set to the new length.  No row goes."""
    names = docs.columns
    at = names.index("text")
    counted = names.index("n_chars") if dict(docs.dtypes).get("n_chars") in ("bigint", "int") else None

    def make():
        automaton = build_automaton()

        def fn(batch):
            old = batch.column(at).to_pylist()
            new = [redacted(t, automaton) for t in old]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            if counted is not None:
                lengths = [n if a is b or a == b else len(b) for a, b, n in
                           zip(old, new, batch.column(counted).to_pylist())]
                field = batch.schema.field(counted)
                batch = batch.set_column(counted, field, pa.array(lengths, field.type))
            return batch
        return fn

    return arrow_map(docs, docs.schema, make)
