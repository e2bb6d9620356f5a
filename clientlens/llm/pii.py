"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass: at-signs, schemes, plus signs, digits and cue words.
From each anchor a local parser expands to the boundaries of what it could be and validates it. The four base
kinds (email, ip, card, phone) come out as if their patterns had run over the whole text, leftmost and
non-overlapping; address, account and login spans are added. Every parser moves forward only, so texts of any
length and any repetition take linear time.

Cases: a null text is an empty one and has no spans; null ids and repeated rows are answered like any
other; an empty table gives no rows; masking keeps every column of the table, whatever its name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clientlens.llm.common import slices

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "address", "account", "login")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
RUN = re.compile(r"[0-9]++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
GROUPED = re.compile(r"[0-9](?:[ -]?[0-9])*+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
USERINFO = re.compile(r"[^\s/@:]{1,64}:[^\s/@]{1,128}(?=@)")
# Cue words; each is looked for in lower case, capitalised and in capitals.
ACCOUNT_CUES = ("iban", "account", "acct", "ssn", "passport", "token", "secret", "password", "api_key", "apikey")
STREET_AFTER = ("street", "avenue", "road", "lane", "boulevard")
STREET_BEFORE = ("rue", "calle", "avenida", "straße", "strasse", "weg")
VALUE = re.compile(r"(?: ?(?:number|no\.?|id))?[ \t]{0,2}[:=#]?[ \t]{0,2}[\"']?([A-Za-z0-9][A-Za-z0-9-]{7,127})")
IBAN = re.compile(r"[ :=#]{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{1,4}){3,8})")
HOUSE_LEFT = re.compile(r"(?<![\w.])[0-9]{1,5}[A-Za-z]? (?:[^\W\d_][\w'-]{0,30} ){1,3}\Z")
HOUSE_RIGHT = re.compile(r"(?: [^\W\d_][\w'-]{0,30}){0,4},? [0-9]{1,5}\b")


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    for sign, kind in (("@", "email"), ("+", "phone"), ("://", "login")):
        found.add_word(sign, (kind, len(sign)))
    for kind, cues in (("account", ACCOUNT_CUES), ("after", STREET_AFTER), ("before", STREET_BEFORE)):
        for cue in cues:
            for form in {cue, cue.capitalize(), cue.upper()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def iban_valid(value: str) -> bool:
    value = value.replace(" ", "")
    return 15 <= len(value) <= 34 and int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def addresses_in(text: str, start: int) -> Iterator[tuple[int, int]]:
    """Spans of four numbers joined by dots, in the dotted chain that starts here."""
    places = [(m.start(), m.end()) for m in RUN.finditer(text, start, DOTTED.match(text, start).end())]
    for i in range(0, len(places) - 3, 4):
        four = places[i : i + 4]
        if all(len(t := text[a:b].lstrip("0")) <= 3 and int(t or 0) <= 255 for a, b in four):
            yield four[0][0], four[3][1]


def email_at(text: str, at: int, lowest: int) -> tuple[int, int] | None:
    start = at
    while start > lowest and text[start - 1] in LOCAL:
        start -= 1
    domain = DOMAIN.match(text, at + 1) if start < at else None
    return (start, domain.end()) if domain else None


def account_at(text: str, end: int) -> tuple[int, int] | None:
    """Value after a cue: an IBAN with right check digits, or a token of 8 to 128 characters, 4 of them digits."""
    value = IBAN.match(text, end)
    if value:
        # The longest run of groups whose check digits are right.
        for stop in range(value.end(1), value.start(1) + 14, -1):
            if iban_valid(text[value.start(1) : stop]):
                return value.start(1), stop
    value = VALUE.match(text, end)
    if value and sum(c.isdigit() for c in value[1]) >= 4:
        return value.span(1)
    return None


def find_spans(text: str, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    run_end = ip_end = card_end = email_low = phone_end = 0
    for last, (kind, size) in automaton.iter(text):
        start, end = last - size + 1, last + 1
        if kind == "digit":
            if start < run_end:
                continue
            run_end = RUN.match(text, start).end()
            if start >= ip_end:
                found["ip"].extend(addresses_in(text, start))
                ip_end = DOTTED.match(text, start).end()
            if start >= card_end:
                card_end = GROUPED.match(text, start).end()
                if card_end - start >= 13:
                    digits = text[start:card_end].replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        found["card"].append((start, card_end))
        elif kind == "email":
            span = email_at(text, start, email_low)
            if span:
                found["email"].append(span)
            email_low = span[1] if span else end
        elif kind == "phone":
            if start >= phone_end and (number := PHONE.match(text, start)):
                phone_end = number.end()
                if 9 <= sum("0" <= c <= "9" for c in number[0]) <= 15:
                    found["phone"].append(number.span())
        elif kind == "login":
            if login := USERINFO.match(text, end):
                found["login"].append(login.span())
        elif (start and text[start - 1].isalnum() and kind != "before") or text[end : end + 1].isalpha():
            continue  # inside a longer word
        elif kind == "account":
            if span := account_at(text, end):
                found["account"].append(span)
        elif kind == "after":
            low = max(0, start - 110)
            if house := HOUSE_LEFT.search(text[low:start]):
                found["address"].append((low + house.start(), end))
        elif house := HOUSE_RIGHT.match(text, end):
            while start and text[start - 1].isalpha():
                start -= 1
            found["address"].append((start, house.end()))
    return [(kind, *span) for kind in KINDS for span in _disjoint(found[kind])]


def _disjoint(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    kept: list[tuple[int, int]] = []
    for span in sorted(spans):
        if not kept or span[0] >= kept[-1][1]:
            kept.append(span)
    return kept


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by the kind that begins it, as in <EMAIL>."""
    parts, done = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= done:
            parts += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


SPANS = "array<struct<kind:string,start:long,end:long>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of every document; spans are structs (kind, start, end) in code points, end exclusive."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        for batch in slices(batches, "text"):
            spans = [
                [{"kind": k, "start": s, "end": e} for k, s, e in find_spans(text or "", automaton)]
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(spans, type=SPAN_TYPE)], ["id", "spans"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return source.mapInArrow(scan, f"id {kind}, spans {SPANS}").withColumnRenamed("id", id_col)


def mask_pii(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The documents with every span replaced in the text; a null text stays null."""
    place = docs.columns.index(text_col)

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        for batch in slices(batches, text_col):
            texts = [
                None if text is None else masked(text, find_spans(text, automaton))
                for text in batch.column(place).to_pylist()
            ]
            field = batch.schema.field(place)
            yield batch.set_column(place, field, pa.array(texts, type=field.type))

    return docs.mapInArrow(mask, docs.schema)
