"""Personal data by anchor expansion.

An Aho-Corasick automaton reads each text once and stops at anchors only:
at-signs, plus signs, digits, schemes and identifier cues. At an anchor a
deterministic local parser expands to the left and right and validates what it
finds; the rest of the text is never looked at by a pattern. Every parser
skips to the end of what it has read, so the work is linear in the text.

Defined results: a null or empty text has no spans; a repeated row gives a
repeated result; offsets are code points, ends exclusive; other columns of the
input are not read and may have any name.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import documents, id_text, positional, slices, texts, with_column

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "userinfo", "iban", "account", "key", "address")
SPANS = "array<struct<kind:string,start:int,end:int>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Parsers of what stands right of an anchor; all are possessive, so none backtracks.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_DIGITS = re.compile(r"[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_USERINFO = re.compile(r"[A-Za-z0-9._~%!$&'()*+,;=:-]{1,256}+@(?:[A-Za-z0-9-]{1,63}+\.){1,16}+[A-Za-z0-9-]{1,63}+(?::[0-9]{1,5}+)?+")
_IBAN = re.compile(r"(?:[\s:#]|number|no\.?){0,8}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"(?:[ \t]{0,4}(?:number|num|no|nr|id|is)\b\.?){0,3}[ \t]{0,4}[:#=]{0,2}[ \t]{0,4}([A-Z]{0,3}[0-9](?:-?[0-9]){5,17})(?![A-Za-z0-9])")
_KEY = re.compile(r"[A-Z0-9]{16}(?![A-Za-z0-9])")
_BEFORE_STREET = re.compile(r"(?<![A-Za-z0-9])[0-9]{1,5}[A-Za-z]?(?: [A-Z][A-Za-z'.-]{0,30}){1,4}$")
_AFTER_STREET = re.compile(r"(?:,? (?:Apt|Suite|Unit)\.? ?[0-9]{1,5}[A-Z]?)?(?:, [A-Z][A-Za-z .-]{1,30})?(?:,? (?:[A-Z]{2} )?[0-9]{5}(?:-[0-9]{4})?)?(?![A-Za-z0-9])")

ACCOUNT_CUES = ("account", "acct", "passport", "ssn", "social security", "customer id", "tax id")
KEY_CUES = ("AKIA", "ASIA")
STREET_CUES = (" Street", " Avenue", " Road", " Lane", " Boulevard", " Drive")


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    for cue, kind in (("@", "email"), ("+", "phone"), ("://", "userinfo"), *((k, "key") for k in KEY_CUES), *((s, "address") for s in STREET_CUES)):
        found.add_word(cue, (kind, len(cue)))
    for kind, cues in (("iban", ("iban",)), ("account", ACCOUNT_CUES)):
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize(), cue.title()}:
                found.add_word(form, (kind, len(cue)))
    found.make_automaton()
    return found


_ANCHORS: list = []


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def _iban(candidate: str) -> int:
    """Length of the longest prefix that ends a group and passes the mod-97 test, or 0."""
    for end in range(len(candidate), 14, -1):
        plain = candidate[:end].replace(" ", "")
        if candidate[end - 1] != " " and len(plain) >= 15 and (end == len(candidate) or candidate[end] == " "):
            if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
                return end
    return 0


def find(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) of a text, by kind as in ``KINDS``, then start."""
    if not _ANCHORS:
        _ANCHORS.append(_automaton())
    spans: dict[str, list[tuple[int, int]]] = {}
    done = dict.fromkeys(KINDS, 0)  # each kind's matches don't overlap: where the last one ended

    def add(kind: str, start: int, end: int) -> None:
        spans.setdefault(kind, []).append((start, end))
        done[kind] = end

    for last, (kind, length) in _ANCHORS[0].iter(text):
        start, after = last - length + 1, last + 1
        if kind == "digit":
            if start >= done["card"]:
                m = _CARD.match(text, start)
                done["card"] = m.end() if m else after
                if m:
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        add("card", start, m.end())
            if start >= done["ip"]:
                m = _IP.match(text, start)
                done["ip"] = m.end() if m else _DIGITS.match(text, start).end()
                if m and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                    add("ip", start, m.end())
        elif kind == "email":
            left = start
            while left > done["email"] and text[left - 1] in _LOCAL:
                left -= 1
            if left < start and (m := _DOMAIN.match(text, after)):
                add("email", left, m.end())
        elif kind == "phone":
            if start >= done["phone"] and (m := _PHONE.match(text, start)):
                done["phone"] = m.end()
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    add("phone", start, m.end())
        elif start < done[kind]:
            continue
        elif kind == "userinfo":
            left = start
            while left > max(done[kind], start - 16) and (text[left - 1].isascii() and text[left - 1].isalnum() or text[left - 1] in "+.-"):
                left -= 1
            if left < start and (m := _USERINFO.match(text, after)):
                add(kind, left, m.end())
        elif kind == "address":
            head = _BEFORE_STREET.search(text, max(done[kind], start - 160), start)
            if head and (m := _AFTER_STREET.match(text, after)):
                add(kind, head.start(), m.end())
        elif start and text[start - 1].isalnum():
            continue
        elif kind == "key":
            if m := _KEY.match(text, after):
                add(kind, start, m.end())
        elif kind == "iban":
            if (m := _IBAN.match(text, after)) and (size := _iban(m[1])):
                add(kind, m.start(1), m.start(1) + size)
        elif not text[after : after + 1].isalnum() and (m := _ACCOUNT.match(text, after)):
            add(kind, m.start(1), m.end(1))
    return [(kind, s, e) for kind in KINDS for s, e in spans.get(kind, ())]


def _spans(batches):
    for batch in slices(batches):
        found = [find(t) for t in texts(batch)]
        offsets = [0]
        for spans in found:
            offsets.append(offsets[-1] + len(spans))
        flat = [s for spans in found for s in spans]
        fields = [pa.array([s[i] for s in flat], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int32()))]
        spans = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, ["kind", "start", "end"]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), spans], ["doc_id", "spans"])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every row; no shuffle, a hot group's rows stay where they are read."""
    rows = id_text(docs, id_col, text_col)
    return rows.mapInArrow(_spans, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, spans {SPANS}")


def masked(text: str | None) -> str | None:
    """The text with each span replaced by its kind in brackets; where spans overlap, the union by the first kind."""
    spans = sorted((s, e, k) for k, s, e in find(text)) if text else []
    if not spans:
        return text
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with personal data in ``text_col`` masked; all columns and rows stay, a null text stays null."""

    plain = positional(docs)
    column = plain.columns[docs.columns.index(text_col)]

    def run(batches):
        for batch in slices(batches, column):
            done = [masked(t) for t in batch.column(column).to_pylist()]
            yield with_column(batch, column, pa.array(done, batch.schema.field(column).type))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def of_kinds(*kinds: str) -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(*kinds))


def digest(*kinds: str) -> Column:
    """``kind:start:end`` of the spans of the given kinds, comma-joined in their order."""
    return F.array_join(F.transform(of_kinds(*kinds), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(spark, sf_dir: str) -> DataFrame:
    """Spans of all documents with the contract's digest columns."""
    found = find_pii(documents(spark, sf_dir))
    counts = [F.size(of_kinds(kind)).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(digest(*BASE_KINDS), 256).alias("base_sha256"), digest(*KINDS).alias("spans"))
