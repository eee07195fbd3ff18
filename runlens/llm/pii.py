"""Personal data by anchors.

An Aho-Corasick automaton runs once over a text and stops at anchors only: at-signs, schemes, plus
signs, digits and identifier cues. From an anchor a small parser reads outwards to the borders of an
address, number or account and validates it. Work is linear in the text; nothing is shuffled.

Kinds, in this order: ``email``, ``ip`` (parts up to 255), ``card`` (16 to 19 digits, Luhn),
``phone`` (8 to 15 digits) are the base; ``iban`` (mod-97 check), ``login`` (user and password after a scheme),
``ssn`` and ``secret`` (tokens and keys by shape and entropy, passwords after a sign) are added by cues and never
remove a base span. What a cue announces starts at most REACH code points after it, in its line.
Matches of one base kind are leftmost and don't overlap; one that fails its check is dropped and
nothing inside it is tried again.

Defined cases: a null text counts as empty and has no spans. Offsets are code points, the end
exclusive. Repeated rows give repeated results; other columns are carried along untouched.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import product
from math import log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.rows import map_rows

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "login", "ssn", "secret")
CUES = {
    "iban": ("iban", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security"),
    "secret": ("token", "secret", "api key", "api_key", "api-key", "apikey", "access key", "access_key"),
    "password": ("password", "passwd", "passwort", "pwd"),
}
#: Code points between a cue and the value that it announces; least length and bits per sign of a token.
REACH, TOKEN_LENGTH, TOKEN_BITS = 40, 16, 3.0

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]{1,4}){3,8}")
_GROUP_END = re.compile(r"(?<=[A-Za-z0-9])(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_=-][A-Za-z0-9+/_.=-]*")
_PASSWORD = re.compile(r"""[A-Za-z0-9_-]{0,20}["'`]?[ \t]{0,3}(?:=|:|is\b)[=>]?[ \t]{0,3}["'`]?([^\s"'`,;]{6,})""")
_LINE_END = re.compile(r"[\n\r]|\Z")
_LOGIN = re.compile(r"[^\s/?#@:]+:[^\s/?#@]+(?=@)")


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for mark, kind in [("@", "email"), ("://", "login"), ("+", "phone"), *[(str(d), "digit") for d in range(10)]]:
        found.add_word(mark, kind)
    for kind, words in CUES.items():
        for word in words:
            cases = [{w, w.upper(), w.capitalize()} for w in re.split("([ _-])", word)]
            for form in map("".join, product(*cases)):
                found.add_word(form, kind)
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban(text: str) -> bool:
    plain = text.replace(" ", "").upper()
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def bits(value: str) -> float:
    """Shannon entropy of a text's signs."""
    return -sum(n / len(value) * log2(n / len(value)) for n in Counter(value).values())


def _ibans(text: str, start: int, stop: int) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(text, start, stop):
        # words that follow may look like groups of it: the longest part that passes counts
        ends = [e.start() for e in _GROUP_END.finditer(text, m.start() + 4, m.end() + 1) if e.start() <= m.end()]
        if good := next((e for e in reversed(ends) if iban(text[m.start() : e])), None):
            yield m.start(), good


def _ssns(text: str, start: int, stop: int) -> Iterator[tuple[int, int]]:
    for m in _SSN.finditer(text, start, stop):
        s = m[0]
        if s[:3] not in ("000", "666") and s[0] != "9" and s[4:6] != "00" and s[7:] != "0000":
            yield m.span()


def _tokens(text: str, start: int, stop: int) -> Iterator[tuple[int, int]]:
    border = start + REACH
    for m in _TOKEN.finditer(text, start, stop):
        if m.start() > border:
            return
        value = m[0].rstrip(".")
        mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
        if len(value) >= TOKEN_LENGTH and mixed and sum(c.isdigit() for c in value) >= 3 and bits(value) >= TOKEN_BITS:
            yield m.start(), m.start() + len(value)


def _passwords(text: str, start: int, stop: int) -> Iterator[tuple[int, int]]:
    if m := _PASSWORD.match(text, start, stop):
        value = m[1].rstrip(".?)")
        if len(value) >= 6 and any(c.isdigit() for c in value):
            yield m.start(1), m.start(1) + len(value)


_LONGEST = 60  # an IBAN with blanks is shorter
_ANNOUNCED = {"iban": _ibans, "ssn": _ssns, "secret": _tokens, "password": _passwords}


def spans(text: str, anchors) -> list[tuple[str, int, int]]:
    """(kind, start, end) of a text, by kind and start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys(KINDS, 0)
    at_sign = 0
    for last, kind in anchors.iter(text):
        if kind == "digit":
            if last >= done["ip"]:
                if m := _IP.match(text, last):
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                        found["ip"].append(m.span())
                    done["ip"] = m.end()
                else:
                    done["ip"] = _DIGITS.match(text, last).end()
            if last >= done["card"] and (m := _CARD.match(text, last)):
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found["card"].append(m.span())
                done["card"] = m.end()
        elif kind == "email":
            start, border = last, max(done["email"], at_sign)
            while start > border and text[start - 1] in _LOCAL:
                start -= 1
            at_sign = last + 1
            if start < last and (m := _DOMAIN.match(text, last + 1)):
                found["email"].append((start, m.end()))
                done["email"] = m.end()
        elif kind == "phone":
            if last >= done["phone"] and (m := _PHONE.match(text, last)):
                if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found["phone"].append(m.span())
                done["phone"] = m.end()
        elif kind == "login":
            if last >= done["login"] and (m := _LOGIN.match(text, last + 1)):
                found["login"].append(m.span())
                done["login"] = m.end()
        else:
            name = "secret" if kind == "password" else kind
            border = last + 2 + REACH + _LONGEST
            line = _LINE_END.search(text, last + 1, border).start()
            # signs of a token or password can't be a line's end, so these may go on
            stop = len(text) if line == border and name == "secret" else line
            for a, b in _ANNOUNCED[kind](text, max(last + 1, done[name]), stop):
                if a > last + 1 + REACH:
                    break
                found[name].append((a, b))
                done[name] = b
    return [(k, a, b) for k in KINDS for a, b in found[k]]


def redact(text: str, found: list[tuple[str, int, int]]) -> str:
    """The text with each span, or each run of overlapping spans, replaced by ``[kind]`` of the first."""
    out, at = [], 0
    for kind, a, b in sorted(found, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def cleaned(text: str, found: list[tuple[str, int, int]], anchors) -> str:
    """The text without its spans, nor those that only stand out once others are gone."""
    while found:
        text = redact(text, found)
        found = spans(text, anchors)
    return text


def digest(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def find_pii(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row``, ``spans`` (array of kind, start, end) and ``clean`` (text with the spans replaced; null stays null)."""

    def make():
        anchors = automaton()

        def work(columns: dict) -> dict:
            got = [spans(t or "", anchors) for t in columns["text"]]
            return {
                "spans": [[{"kind": k, "start": a, "end": b} for k, a, b in g] for g in got],
                "clean": [cleaned(t, g, anchors) if g else t for t, g in zip(columns["text"], got, strict=True)],
            }

        return work

    return map_rows(docs, {"text": text}, "spans array<struct<kind:string,start:int,end:int>>, clean string", make, keep)


def joined(found, base_only: bool):
    """``kind:start:end`` of the spans, comma-joined, as a column expression."""
    part = F.filter(found, lambda s: s["kind"].isin(*BASE)) if base_only else found
    return F.array_join(F.transform(part, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count(found, kind: str):
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")
