"""Text cleaning as built-in column expressions (F1, F2).

``normalize_text`` = lower case, accents removed (canonical decomposition, marks
of category Mn dropped), runs of whitespace collapsed to one space, trimmed.
The character tables cover all of Unicode and are derived from its database by
rule, so the expression stays JVM-side: ``translate``, a formula for Hangul
syllables, and ``regexp_replace``.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F

from ..settings import ALLOWED_REGIONS


HANGUL_FIRST, HANGUL_LAST = 0xAC00, 0xD7A3


def _bare(ch: str) -> str:
    """Canonical decomposition without the marks of category Mn."""
    return "".join(c for c in unicodedata.normalize("NFD", ch) if unicodedata.category(c) != "Mn")


@lru_cache(maxsize=1)
def accent_tables() -> tuple[str, str, dict[str, str]]:
    """(from, to) for ``translate`` and the characters that become several letters.

    Covers every code point whose decomposition differs or that is a mark (which
    ``translate`` deletes); Hangul syllables, which follow a formula, are left out.
    """
    src, dst, drop, several = [], [], [], {}
    for cp in (c for c in range(0x00C0, sys.maxunicode + 1) if not HANGUL_FIRST <= c <= HANGUL_LAST):
        ch = chr(cp)
        if unicodedata.category(ch) in ("Cn", "Co", "Cs"):
            continue
        base = _bare(ch)
        if not base:
            drop.append(ch)
        elif base != ch and len(base) == 1:
            src.append(ch)
            dst.append(base)
        elif base != ch:
            several[ch] = base
    return "".join(src + drop), "".join(dst), several


def _ranges(codes: list[int]) -> str:
    """Character-class body with contiguous code points merged into ranges."""
    out, i = [], 0
    while i < len(codes):
        j = i
        while j + 1 < len(codes) and codes[j + 1] == codes[j] + 1:
            j += 1
        out.append(f"\\x{{{codes[i]:x}}}" + (f"-\\x{{{codes[j]:x}}}" if j > i else ""))
        i = j + 1
    return "".join(out)


@lru_cache(maxsize=1)
def whitespace_codes() -> list[int]:
    """Every character Python's ``str.split()`` treats as whitespace."""
    return [c for c in range(sys.maxunicode + 1) if chr(c).isspace()]


@lru_cache(maxsize=1)
def whitespace_class() -> str:
    """Regex for a run of whitespace (any of :func:`whitespace_codes`)."""
    return "[" + _ranges(whitespace_codes()) + "]+"


def _code_point(number: Column) -> Column:
    """The character of a code point of the basic plane."""
    return F.decode(F.unhex(F.lpad(F.hex(number.cast("long")), 4, "0")), "UTF-16BE")


def _several_letters(c: Column) -> Column:
    """Characters that decompose into several letters: Hangul syllables by formula, the others by table."""
    table = accent_tables()[2]
    others = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])

    def letters(ch: Column) -> Column:
        at = F.ascii(ch) - HANGUL_FIRST
        lead, vowel, tail = F.floor(at / 588), F.floor((at % 588) / 28), at % 28
        syllable = F.concat(_code_point(lead + 0x1100), _code_point(vowel + 0x1161),
                            F.when(tail > 0, _code_point(tail + 0x11A7)).otherwise(F.lit("")))
        return F.when(ch.between(chr(HANGUL_FIRST), chr(HANGUL_LAST)), syllable).otherwise(F.coalesce(others[ch], ch))

    return F.array_join(F.transform(F.split(c, ""), letters), "")


@lru_cache(maxsize=1)
def _several_class() -> str:
    codes = sorted([ord(c) for c in accent_tables()[2]] + list(range(HANGUL_FIRST, HANGUL_LAST + 1)))
    return "[" + _ranges(codes) + "]"


def strip_accents(c: Column) -> Column:
    """Accents removed; text without a letter beyond ASCII is left as it is."""
    src, dst, _ = accent_tables()
    plain = F.translate(c, src, dst)
    whole = F.when(c.rlike(_several_class()), F.translate(_several_letters(c), src, dst)).otherwise(plain)
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(whole)


def normalize_text(c: Column | str) -> Column:
    """lower case, no accents, single spaces, trimmed."""
    col = F.col(c) if isinstance(c, str) else c
    out = strip_accents(F.lower(col))
    out = F.regexp_replace(out, whitespace_class(), " ")
    return F.trim(out)


def normalize_py(text: str) -> str:
    """Plain-Python twin for tests and driver-side constants."""
    text = text.lower()
    text = "".join(ch for ch in unicodedata.normalize("NFD", text) if unicodedata.category(ch) != "Mn")
    return " ".join(text.split())


def allowed_regions() -> list[str]:
    return sorted({normalize_py(r) for r in ALLOWED_REGIONS})


def allowed_region(c: Column | str) -> Column:
    """whether the normalised name is one of the accepted regions."""
    return normalize_text(c).isin(allowed_regions())
