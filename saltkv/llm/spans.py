"""Span lists as text and digests: the form the scanning queries return."""

from __future__ import annotations

Span = tuple[int, int, str]  # start, end (exclusive, code points), kind


def span_text(spans: list[Span], kinds: tuple[str, ...]) -> str:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    order = {k: i for i, k in enumerate(kinds)}
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], order[s[2]], s[1])))


