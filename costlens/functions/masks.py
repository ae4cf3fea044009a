"""Patterns that mask known parts of resource names."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# Patterns and placeholders that results depend on.
GUID = r"(?:[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}|[0-9a-f]{32})"
#: All-hex tokens with two letters at least, or of seven characters at least; linear in the token's length.
HEX = r"(?:(?=[a-f0-9]*[a-f][0-9]*[a-f])[a-f0-9]+|[a-f0-9]{7,})"
DELIMITERS = r"[-_.:/]+"
LETTERS = r"[A-Za-z]{3,}"
CLASSES = ["GUID", "HEX", "TECH", "ENV", "REG", "NUM"]
NEVER = r"(?!)"
LEFT, RIGHT = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"


def placeholder(kind: str) -> str:
    return f"⟂{kind}⟂"


def ordered(terms) -> list[str]:
    """Terms the longest first, then by name: an alternation of them takes the longest that fits."""
    return sorted({t for t in terms if t}, key=lambda t: (-len(t), t))


def alternation(terms) -> str:
    return "|".join(re.escape(t) for t in ordered(terms))


@dataclass(frozen=True)
class Terms:
    """Known terms of a tenant by class."""

    tech: frozenset[str] = field(default_factory=frozenset)
    env: frozenset[str] = field(default_factory=frozenset)
    reg: frozenset[str] = field(default_factory=frozenset)

    @classmethod
    def of(cls, tech=(), env=(), reg=()) -> "Terms":
        return cls(frozenset(tech), frozenset(env), frozenset(reg))

    def everything(self) -> list[str]:
        return sorted(self.tech | self.env | self.reg)

    def mask_patterns(self) -> list[tuple[str, str]]:
        """(class, pattern) in the order of masking. A tech term may be followed by a digit."""
        bounded = lambda inner: f"(?i){LEFT}{inner}{RIGHT}"
        term = lambda terms: bounded(f"(?:{alternation(terms)})") if terms else NEVER
        tech = f"(?i){LEFT}(?:{alternation(self.tech)})(?=$|[^A-Za-z0-9]|[0-9])" if self.tech else NEVER
        return [("GUID", bounded(GUID)), ("HEX", bounded(HEX)), ("TECH", tech), ("ENV", term(self.env)), ("REG", term(self.reg)), ("NUM", f"{LEFT}[0-9]+{RIGHT}")]

    def scan_patterns(self) -> list[tuple[str, str]]:
        """(class, pattern) in order of precedence for scans of glued names; here no digit may follow a tech term."""
        term = lambda terms: f"(?i){LEFT}(?:{alternation(terms)}){RIGHT}" if terms else NEVER
        return [("GUID", f"(?i){LEFT}{GUID}{RIGHT}"), ("TECH", term(self.tech)), ("ENV", term(self.env)), ("REG", term(self.reg)), ("NUM", f"{LEFT}[0-9]+{RIGHT}")]
