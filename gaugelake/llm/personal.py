"""Personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors of a text: at-signs, colons and schemes, digit pairs,
plus signs before digits, and words that announce an identifier. From each anchor a local parser
expands to the boundaries of what may stand there (an address to both sides, a run of digits, the
value behind a cue) and checks it: parts of an address, check digits, lengths. A parser starts
behind what its kind has already read, so that the work is in proportion to the text.
"""

from __future__ import annotations

import ipaddress
import re
from bisect import bisect_right
from functools import cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugelake.llm import arrays

#: Kinds in the order of their spans: those fixed by patterns, then those the cues add.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "mail", "ipv6", "iban", "ssn", "account", "contact", "login")

_SPANS = "array<struct<kind:int,start:int,end:int>>"
_FOUND = f"doc_id long, text string, spans {_SPANS}"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = "0123456789"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_NUMBERS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_GROUPED = re.compile(r"[0-9](?:[ -]?[0-9])++")
_DIALLED = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_HEX_GROUPS = re.compile(r"[0-9A-Fa-f:]++(?:\.[0-9]++){0,3}+")
_HEX = frozenset("0123456789ABCDEFabcdef:")
_WORDS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_")
_SPELT = re.compile(r" ?([A-Za-z0-9-]{1,63}(?: ?(?:\[dot\]|\(dot\)|\{dot\}|\.) ?[A-Za-z0-9-]{1,63}){1,8})", re.IGNORECASE)
_VALUE = r"(?:(?: ?(?:number|no\.?|nr\.?|id|code))? ?[:=#]? ?| is )"
_IBAN = re.compile(_VALUE + r"([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])", re.IGNORECASE)
_SSN = re.compile(_VALUE + r"([0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{9})(?![0-9-])", re.IGNORECASE)
_ACCOUNT = re.compile(r" ?(?:number|no\.?|nr\.?|id|#)? ?[:=#]? ?([A-Z]{0,3}[0-9][0-9-]{4,22}[0-9])(?![A-Za-z0-9])", re.IGNORECASE)
_LOGIN = re.compile(r"([A-Za-z0-9._~%!$&'*+,;=-]{1,64}(?::[^\s/@:]{0,64})?)@(?:[A-Za-z0-9-]+\.)*[A-Za-z0-9-]+")
_CONTACT = re.compile(r"[A-Za-z0-9._%+@()-]{1,120}[A-Za-z0-9]")

# The words that announce an identifier, in lower case, and the kind each leads to.
_CUES = {
    "iban": "iban",
    "ssn": "ssn",
    "social security": "ssn",
    "account": "account",
    "acct": "account",
    "passport": "account",
    "routing": "account",
    "[at]": "mail",
    "(at)": "mail",
    "{at}": "mail",
    "mailto:": "contact",
    "tel:": "contact",
    "sip:": "contact",
    "skype:": "contact",
    "xmpp:": "contact",
    "://": "login",
    "@": "email",
    ":": "ipv6",
}


@cache
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for cue, kind in _CUES.items():
        for word in {cue, cue.upper(), cue.capitalize(), cue.title()}:
            found.add_word(word, (len(word), kind))
    for a in _DIGITS:
        found.add_word("+" + a, (2, "phone"))
        for b in _DIGITS:
            found.add_word(f"{a}.{b}", (3, "ip"))
            for between in ("", " ", "-"):
                found.add_word(a + between + b, (len(between) + 2, "card"))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def iban_valid(value: str) -> bool:
    """Whether the check digits of an account number are right (modulo 97)."""
    value = value.replace(" ", "").upper()
    if not 15 <= len(value) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def _leftwards(text: str, at: int, least: int, allowed: frozenset) -> int:
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


class _Parsers:
    """One text; what each kind has found, and up to where it has read."""

    def __init__(self, text: str):
        self.text = text
        self.read = dict.fromkeys(KINDS, 0)
        self.spans: list[tuple[str, int, int]] = []

    def email(self, start: int, end: int) -> None:
        low = _leftwards(self.text, start, self.read["email"], _LOCAL)
        if low < start and (domain := _DOMAIN.match(self.text, end)):
            self.read["email"] = domain.end()
            self.spans.append(("email", low, domain.end()))

    def ip(self, start: int, end: int) -> None:
        text = self.text
        if start < self.read["ip"]:
            return
        low = _leftwards(text, start, self.read["ip"], frozenset(_DIGITS))
        whole = _NUMBERS.match(text, low)
        self.read["ip"] = whole.end()
        parts, at = whole.group().split("."), low
        # Four parts at a time from the left; what is left over at the end is none.
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            stop = at + sum(map(len, four)) + 3
            if all(map(_byte, four)):
                self.spans.append(("ip", at, stop))
            at = stop + 1

    def card(self, start: int, end: int) -> None:
        if start < self.read["card"]:
            return
        whole = _GROUPED.match(self.text, start)
        self.read["card"] = whole.end()
        if whole.end() - start >= 16:
            digits = whole.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                self.spans.append(("card", start, whole.end()))

    def phone(self, start: int, end: int) -> None:
        if whole := _DIALLED.match(self.text, start):
            if 8 <= sum(c in _DIGITS for c in whole.group()) <= 15:
                self.spans.append(("phone", start, whole.end()))

    def mail(self, start: int, end: int) -> None:
        """name [at] host [dot] org"""
        stop = start - 1 if start and self.text[start - 1] == " " else start
        low = _leftwards(self.text, stop, max(self.read["mail"], stop - 64), _LOCAL)
        domain = _SPELT.match(self.text, end, end + 400)
        if low < stop and domain:
            self.read["mail"] = domain.end()
            self.spans.append(("mail", low, domain.end()))

    def ipv6(self, start: int, end: int) -> None:
        text = self.text
        if start < self.read["ipv6"]:
            return
        low = _leftwards(text, start, max(self.read["ipv6"], start - 5), _HEX)
        whole = _HEX_GROUPS.match(text, low)
        self.read["ipv6"] = whole.end()
        value = whole.group().rstrip(":") if not whole.group().endswith("::") else whole.group()
        high = low + len(value)
        if len(value) > 45 or value.count(":") < 3 or not any(c in _DIGITS for c in value):
            return
        if low and text[low - 1] in _WORDS or high < len(text) and text[high] in _WORDS:
            return
        try:
            ipaddress.IPv6Address(value)
        except ValueError:
            return
        self.spans.append(("ipv6", low, high))

    def _cued(self, kind: str, pattern: re.Pattern, end: int, valid) -> None:
        value = pattern.match(self.text, end, end + 120)
        if value and value.start(1) >= self.read[kind] and valid(value.group(1)):
            self.read[kind] = value.end(1)
            self.spans.append((kind, value.start(1), value.end(1)))

    def iban(self, start: int, end: int) -> None:
        self._cued("iban", _IBAN, end, iban_valid)

    def ssn(self, start: int, end: int) -> None:
        def valid(value: str) -> bool:
            value = value.replace("-", "")
            return value[:3] not in ("000", "666") and value[0] != "9" and value[3:5] != "00" and value[5:] != "0000"

        self._cued("ssn", _SSN, end, valid)

    def account(self, start: int, end: int) -> None:
        self._cued("account", _ACCOUNT, end, lambda value: sum(c in _DIGITS for c in value) >= 6)

    def contact(self, start: int, end: int) -> None:
        """What a scheme for people names."""
        if not (start and self.text[start - 1] in _WORDS):
            self._cued("contact", re.compile(f"({_CONTACT.pattern})"), end, lambda value: len(value) >= 3)

    def login(self, start: int, end: int) -> None:
        """The user, with any password, before the host of an address on the web."""
        self._cued("login", _LOGIN, end, lambda value: True)


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all personal data, by kind, then start; kinds are numbers in KINDS, places code points.

    What the cues add is left out where a base span holds all of it.
    """
    parsers = _Parsers(text)
    for last, (length, kind) in _automaton().iter(text):
        getattr(parsers, kind)(last + 1 - length, last + 1)
    base = sorted((s, e) for k, s, e in parsers.spans if k in BASE)
    starts, furthest = [s for s, _ in base], [0, *accumulate((e for _, e in base), max)]
    held = {(k, s, e) for k, s, e in parsers.spans if k in BASE or furthest[bisect_right(starts, s)] < e}
    return sorted((KINDS.index(k), s, e) for k, s, e in held)


_KIND = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def _rows(batches):
    for batch in arrays.pieces(batches):
        found = [
            [{"kind": k, "start": s, "end": e} for k, s, e in spans_of(text)] for text in batch.column("text").to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text"), pa.array(found, _KIND)], names=["doc_id", "text", "spans"]
        )


def find(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (columns doc_id and text; others are ignored): doc_id, text, spans.

    Spans are (kind, start, end), a number in KINDS and code points, by kind, then start. The base
    kinds are leftmost non-overlapping matches of each kind apart: addresses of mail, of hosts (parts up to 255),
    card numbers (16 to 19 digits passing Luhn) and phone numbers (8 to 15 digits). The others are mail addresses
    in words, IPv6 addresses, and what stands behind a cue: bank accounts with right check digits, social security
    numbers, account and passport numbers, contacts in mailto:, tel: and the like, logins in web addresses.

    A null text is empty; empty texts and texts without a match have no span. Rows are judged one by one, so
    repeated rows give repeated results and an empty table an empty one.
    """
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(_rows, _FOUND)


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    one = F.transform(
        spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))
    )
    return F.array_join(one, ",")


def summary(found: DataFrame) -> DataFrame:
    """Per row of ``find``: doc_id, the number of each base kind, the digest of the base spans, and all spans as text."""
    spans = F.col("spans")

    def of(kind):
        return F.filter(spans, lambda x: x["kind"] == KINDS.index(kind))

    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE]
    base = F.filter(spans, lambda x: x["kind"] < len(BASE))
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(spans).alias("spans"))


def _redacted(batches):
    for batch in batches:
        out = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            parts, at = [], 0
            for x in sorted(spans, key=lambda x: (x["start"], -x["end"])):
                if x["start"] >= at:
                    parts += [text[at : x["start"]], f"[{KINDS[x['kind']]}]"]
                at = max(at, x["end"])
            out.append("".join([*parts, text[at:]]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])


def redact(found: DataFrame) -> DataFrame:
    """Rows of ``find`` (doc_id, text) with what spans hold replaced by a kind in brackets, the leftmost for those that overlap."""
    return found.mapInArrow(_redacted, "doc_id long, text string")
