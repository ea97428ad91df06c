"""Base rules for personal data; per kind leftmost matches that do not overlap."""

from __future__ import annotations

import re

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Runs of digits are taken whole: a shorter match would end before another digit, and none can start inside.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """Matches by their @: the local part is the run before it, as far as no earlier match holds it."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (match := _DOMAIN.match(text, at + 1)):
            found.append((start, match.end()))
            free = match.end()
        else:
            free = max(free, start)
        at = text.find("@", max(at + 1, free))
    return found


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in reversed(digits)][1::2]
    return (sum(int(d) for d in digits[::-1][::2]) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans (code points, end exclusive) of each kind."""
    ips = [m.span() for m in _IP.finditer(text) if all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in m.group().split("."))]
    cards = [m.span() for m in _CARD.finditer(text) if 13 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
    phones = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return {"email": emails(text), "ip": ips, "card": cards, "phone": phones}
