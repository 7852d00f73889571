"""What secret scans and PII share: spans, their order and their digests. Offsets are code points, ends exclusive."""

from __future__ import annotations

import hashlib

Span = tuple[int, int, str]


def joined(spans: list[Span], kinds: list[str]) -> str:
    """kind:start:end, by start, then by kind as listed, comma-joined."""
    rank = {k: i for i, k in enumerate(kinds)}
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(set(spans), key=lambda s: (s[0], rank[s[2]], s[1])))


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(digits: str) -> bool:
    """Luhn's check of a string of ASCII digits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0
