"""Plain Python versions of the operators, for tests on small inputs."""

from __future__ import annotations

import hashlib
import re

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal_base(text: str | None) -> list[tuple[int, int, int, str]]:
    """(start, rank, end, kind) of the base spans, sorted."""
    text = text or ""
    out = []
    for m in re.finditer(EMAIL, text):
        out.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(IP, text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(CARD, text):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(PHONE, text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return sorted(out)


def secret_base(text: str | None) -> list[tuple[int, int, int, str]]:
    text = text or ""
    out = []
    keyword = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
    for m in keyword.finditer(text):
        if len(m.group(2)) >= 8:
            out.append((m.start(), 0, m.end(), "assign"))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m.group()) >= 16:
            out.append((m.start(), 1, m.end(), "access"))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m.group()) >= 32:
            out.append((m.start(), 2, m.end(), "hex"))
    return sorted(out)


def listed(spans: list[tuple[int, int, int, str]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in spans)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
