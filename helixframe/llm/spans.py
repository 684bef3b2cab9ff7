"""Spans of code points in texts: how base rules find them and how they are written."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A search from within a run of digits fails where one from the run's start does, so only starts are tried.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

Span = tuple[str, int, int]


def emails(text: str) -> list[Span]:
    """Leftmost matches of local@domain.tld; a match holds exactly one @, so each @ is tried once."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            found.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", at + 1)
    return found


def addresses(text: str) -> list[Span]:
    small = lambda part: len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255
    return [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(small, m[0].split(".")))]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    found = []
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    return found


def phones(text: str) -> list[Span]:
    return [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= sum(map(len, _DIGITS.findall(m[0]))) <= 15]


PERSONAL = ("email", "ip", "card", "phone")
SECRET = ("assign", "access", "hex")


def personal(text: str) -> list[Span]:
    """E-mail and IP addresses, card and phone numbers, by kind, then start."""
    found = emails(text)
    if _DIGIT.search(text):
        found += addresses(text) if text.count(".") > 2 else []
        found += cards(text)
        found += phones(text) if "+" in text else []
    return found


def secrets(text: str) -> list[Span]:
    """Assigned secrets, access keys and long hexadecimal runs, by start, then kind."""
    found = []
    low = text.lower()
    if any(hint in low for hint in _ASSIGN_HINTS):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], SECRET.index(s[0])))


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def digest(spans: list[Span]) -> str:
    return hashlib.sha256(written(spans).encode()).hexdigest()


def by_kind(spans: list[Span], kinds: tuple) -> list[Span]:
    return sorted(spans, key=lambda s: (kinds.index(s[0]), s[1], s[2]))


def overlaps(spans: list[Span]) -> Callable[[int, int], bool]:
    """A test of whether a span overlaps any of ``spans``."""
    from bisect import bisect_left

    merged: list[list[int]] = []
    for _, a, b in sorted(spans, key=lambda s: s[1]):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    starts = [a for a, _ in merged]

    def test(a: int, b: int) -> bool:
        i = bisect_left(starts, b)
        return i > 0 and merged[i - 1][1] > a

    return test
