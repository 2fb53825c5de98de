"""Personal data: anchors found by an Aho-Corasick automaton, expanded by local parsers."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from stationflow.llm.shared import bound_batches

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "account", "login")
SPANS = ArrayType(
    StructType().add("kind", StringType()).add("start", IntegerType()).add("end", IntegerType())
)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ACCOUNT = re.compile(r"(?:\x20?(?:no|nr|number|id)\b\.?)?\x20?[:#=]?\x20?([A-Z]{0,2}[0-9][0-9A-Z]*(?:[\x20-][0-9A-Z]*[0-9][0-9A-Z]*)*)")
# What ends a login: only its first colon and its at-sign matter.
_STOP = re.compile(r"[\s/?#@\"'<>]")
_DIGITS = frozenset("0123456789")
# What announces an account.
_CUES = ("account", "acct", "iban", "konto", "cuenta", "compte")


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    for cue, what in (("@", "at"), ("+", "plus"), ("://", "scheme")):
        found.add_word(cue, (what, len(cue)))
    for cue in _CUES:
        for form in (cue, cue.upper(), cue.capitalize()):
            found.add_word(form, ("account", len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def iban(text: str) -> bool:
    plain = text.replace(" ", "").replace("-", "")
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", plain):
        return False
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def spans(text: str, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """``kind, start, end`` of one text, by kind as in ``KINDS``, then start; the end is exclusive.

    Each kind goes on after its last match, also if that match was not valid, as
    a search for non-overlapping matches does. A match can only start at the
    beginning of a run of digits, so other digits are passed over.
    """
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    after = dict.fromkeys(KINDS, 0)
    for last, (cue, n) in automaton.iter(text):
        at = last - n + 1
        if cue == "digit":
            if at and text[at - 1] in _DIGITS:
                continue
            if at >= after["ip"] and (m := _IP.match(text, at)):
                after["ip"] = m.end()
                if all(map(_small, m[0].split("."))):
                    found["ip"].append(m.span())
            if at >= after["card"] and (m := _CARD.match(text, at)):
                after["card"] = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found["card"].append(m.span())
        elif cue == "at":
            start = at
            while start > after["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                after["email"] = m.end()
                found["email"].append((start, m.end()))
        elif cue == "plus":
            if at >= after["phone"] and (m := _PHONE.match(text, at)):
                after["phone"] = m.end()
                if 8 <= sum(c in _DIGITS for c in m[0]) <= 15:
                    found["phone"].append(m.span())
        elif cue == "scheme":
            if end := _login_end(text, at + 3):
                found["login"].append((at + 3, end))
        elif not (at and text[at - 1].isalnum()) and (m := _ACCOUNT.match(text, last + 1)):
            number = m[1]
            known = number[:2].isalpha() and iban(number)
            if at >= after["account"] and (known or 6 <= sum(c in _DIGITS for c in number) <= 20):
                after["account"] = m.end(1)
                found["account"].append(m.span(1))
    return [(k, *s) for k in KINDS for s in found[k]]


def _login_end(text: str, start: int) -> int | None:
    """Where the login ``name:password@`` that starts at ``start`` has its at-sign; the text up to it is read once."""
    stop = _STOP.search(text, start)
    if stop is None or stop[0] != "@":
        return None
    # Both parts have a character, so the colon is neither the first nor the last one.
    return stop.start() if text.find(":", start + 1, stop.start() - 1) >= 0 else None


def masked(text: str, found: list[tuple[str, int, int]]) -> str:
    """Each span, or overlapping spans together, as the first one's kind in angle brackets."""
    out, end = [], 0
    for kind, start, stop in sorted(found, key=lambda s: (s[1], -s[2])):
        if start >= end:
            out += [text[end:start], f"<{kind.upper()}>"]
        end = max(end, stop)
    return "".join([*out, text[end:]])


def scan(
    docs: DataFrame, text_col: str = "text", mask: bool = False, out: str = "pii"
) -> DataFrame:
    """All rows and columns, and ``out``: an array of kind, start and end in code points.

    Emails, IPv4 addresses, payment cards and phone numbers, and two kinds that
    need a cue before them: account numbers and logins in URLs. With ``mask``,
    the text has each span replaced by its kind.

    NULL and empty texts have no spans (a NULL stays NULL). An input column named
    like ``out`` is replaced. The work grows with a text's length, whatever it holds. Rows are independent of each other.
    """
    bound_batches(docs.sparkSession)
    docs = docs.drop(out)
    at = docs.columns.index(text_col)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        for b in batches:
            texts = b.column(at).to_pylist()
            found = [spans(t, automaton) if t else [] for t in texts]
            columns = list(b.columns)
            if mask:
                new = [masked(t, f) if f else t for t, f in zip(texts, found)]
                columns[at] = pa.array(new, b.column(at).type)
            rows = [[dict(zip(("kind", "start", "end"), s)) for s in f] for f in found]
            columns.append(pa.array(rows, pa.list_(kind)))
            yield pa.RecordBatch.from_arrays(columns, [*b.schema.names, out])

    return docs.mapInArrow(find, StructType([*docs.schema, StructField(out, SPANS)]))
