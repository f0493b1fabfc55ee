"""Secret scan: fixed patterns, and guess costs of values in credential contexts.

Base spans are assignments to credential names, access-key ids and long hex
runs. On top, values that follow a credential word are priced: dynamic
programming finds the cheapest way to guess a value as a sequence of words,
dates, repeats, keyboard walks and brute-force characters. A value that takes at
least 10**``LEAST_COST`` guesses is a secret.

Defined cases: null and empty texts have no spans; a value over a base span is
not reported again; repeated rows get equal results; an empty table gives an
empty result; input columns named like a result are replaced by it.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, functions as F, types as T

from .common import append_columns, decoded

KINDS = ("assign", "access", "hex", "guess")
LEAST_COST = 10.0
MASK = "[SECRET]"

# The base patterns.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
LEAST_LENGTHS = {"assign": 6, "access": 20, "hex": 24}

# White space of any length is walked possessively: once per alternative, never back.
_CONTEXT = re.compile(
    r"""(?<![a-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private|signing|encryption)[ _-]?key
        |auth(?:orization)?|bearer|credentials?)(?![a-z])["']?
        (\s*+(?:[:=]>?|->)\s*+|\s++(?:is|was)(?:\s*+:(?=\s))?\s++|\s++)(?:bearer\s++|basic\s++)?
        ["'`<(\[{]*(?=[^\s"'`<>]{6})""",
    re.ASCII | re.IGNORECASE | re.VERBOSE)
_VALUE = re.compile(r"""[^\s"'`<>]+""", re.ASCII)
# In query and connection strings a value ends where the next name begins.
_NEXT_NAME = re.compile(r"[&;,]+(?=[A-Za-z_][A-Za-z0-9_.-]{0,63}[=:])")
_CONTEXT_WORDS = (b"pass", b"pwd", b"secret", b"token", b"key", b"auth", b"bearer", b"credential")
_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_TRAILING = ".,;:!?)]}"
_HEX_MAP = bytes(120 if 48 <= b <= 57 or 97 <= b <= 102 else 32 for b in range(256))

# Frequent passwords and words, most frequent first, and keyboard rows.
COMMON = """
password admin welcome login letmein monkey dragon master qwerty sunshine princess football baseball shadow michael
jennifer jordan hunter ranger buster soccer hockey killer george charlie andrew thomas robert daniel jessica pepper
access love secret summer winter spring autumn freedom whatever trustno starwars computer internet server system root
user guest test demo example sample changeme default public private token value string none null undefined true false
your my the and for with this that here there please enter insert replace placeholder redacted hidden unknown required
optional invalid expired missing must should correct incorrect wrong reset change forgot manager service account
database config production staging development key code name email phone
""".split()
KEY_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz", "azertyuiop", "qwertzuiop")
_RANK = {w: i + 1 for i, w in enumerate(COMMON)}
_LEET = str.maketrans("013457@$!", "oieastasi")
_NEXT = {(a, b) for row in KEY_ROWS for a, b in zip(row, row[1:])} | \
        {(b, a) for row in KEY_ROWS for a, b in zip(row, row[1:])}
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?"
                   r"|(?:0?[1-9]|[12]\d|3[01])[-/.](?:0?[1-9]|[12]\d|3[01])[-/.](?:\d{4}|\d\d)")
_LONGEST_SEGMENT = 24
# Guesses for another segment in the sequence (log10).
_JOIN = 0.3
# Words of the surrounding text and their rank.
_RUN = re.compile(r"[^\W\d_]{3,24}")
_WORD_RANK = 1000


def _per_character(value: str) -> float:
    """log10 guesses per brute-force character; letters of one case guess like prose."""
    digits = any(c.isdigit() for c in value)
    lower, upper = any(c.islower() for c in value), any(c.isupper() for c in value)
    other = any(not c.isalnum() for c in value)
    if not digits and not (lower and upper and value[1:] != value[1:].lower()):
        return 0.7 if not other else 0.8
    return math.log10(10 * digits + 26 * lower + 26 * upper + 20 * other)


class OtherWords:
    """Ranks of a text's words as seen from one value: those with an occurrence that no copy of the value touches."""

    def __init__(self, text: str):
        self.text, self.value = text, ""
        self.starts: dict[str, list[int]] = {}
        for m in _RUN.finditer(text):
            for word in _RUN.findall(m[0].lower()):
                self.starts.setdefault(word, []).append(m.start())

    def get(self, word: str) -> int | None:
        starts, size, k = self.starts.get(word, ()), len(self.value), 0
        while k < len(starts):                             # a step per copy of the value
            at = starts[k]
            copy = self.text.find(self.value, max(0, at - size + 1), at + len(word) + size - 1)
            if copy < 0:
                return _WORD_RANK
            k = bisect_left(starts, copy + size, k + 1)
        return None


def guess_cost(value: str, words: dict[str, int] | OtherWords | None = None, enough: float = math.inf) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` takes.

    ``words`` ranks further words (of the surrounding text). Stops as soon as the
    cost is sure to reach ``enough``: no segment is longer than ``_LONGEST_SEGMENT``,
    so once that many consecutive costs reach it, all later ones do.
    """
    further = words if words is not None else {}
    low, n, brute = value.lower(), len(value), _per_character(value)
    cost = [0.0] + [math.inf] * n
    plain = low.translate(_LEET)
    for i in range(n):
        here = cost[i]
        date = _DATE.match(value, i) if value[i].isdigit() else None
        date_end = date.end() if date else -1
        step = here + brute + (0.0 if i else _JOIN)
        if step < cost[i + 1]:
            cost[i + 1] = step
        walk = True
        for j in range(i + 1, min(n, i + _LONGEST_SEGMENT) + 1):
            size, price = j - i, math.inf
            if size > 1:
                walk = walk and (low[j - 2], low[j - 1]) in _NEXT
            if size >= 3:
                if walk:
                    price = math.log10(40 * size)
                rank = (_RANK.get(low[i:j]) or further.get(low[i:j])
                        or _RANK.get(plain[i:j]) or further.get(plain[i:j]))
                if rank:
                    cased = value[i:j]
                    extra = 0.0 if cased == low[i:j] else 0.3 if cased[1:] == low[i + 1:j] else 1.0
                    price = min(price, math.log10(rank + 1) + extra + (0.3 if plain[i:j] != low[i:j] else 0.0))
                if j == date_end:
                    price = min(price, 2.1 if size == 4 else 4.6)
                for unit in (1, 2, 3, 4, 6, 8):
                    if size > unit and size % unit == 0 and value[i:j] == value[i:i + unit] * (size // unit):
                        price = min(price, unit * brute + math.log10(size // unit))
                        break
            if here + price + _JOIN < cost[j]:
                cost[j] = here + price + _JOIN
        if i >= _LONGEST_SEGMENT and min(cost[i - _LONGEST_SEGMENT + 1:i + 2]) >= enough:
            return enough
    return cost[n]


def base_spans(raw: bytes, text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, leftmost and non-overlapping within a kind."""
    found, low = [], raw.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text)
                  if len(m[2]) >= LEAST_LENGTHS["assign"]]
    if b"AKIA" in raw:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)
                  if m.end() - m.start() >= LEAST_LENGTHS["access"]]
    if b"x" * LEAST_LENGTHS["hex"] in raw.translate(_HEX_MAP):
        found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)
                  if m.end() - m.start() >= LEAST_LENGTHS["hex"]]
    return found


def guessed_spans(raw: bytes, text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Values in credential contexts that take at least 10**``LEAST_COST`` guesses, outside the base spans."""
    low = raw.lower()
    if not any(w in low for w in _CONTEXT_WORDS):
        return []
    taken = []                                             # base spans, overlapping ones together
    for a, b, _ in sorted(base):
        if taken and a < taken[-1][1]:
            taken[-1] = taken[-1][0], max(b, taken[-1][1])
        else:
            taken.append((a, b))
    ends = [b for _, b in taken]
    found, words, secret = [], None, {}
    stop = cut = last = -1                                 # ends of a run, of the value in it, and that without its final marks
    m = _CONTEXT.search(text)
    while m:
        start = m.end()
        if start >= stop:                                  # values that begin in one run end together, unless a name parts them
            stop = cut = _VALUE.match(text, start).end()
            last = -1
        if start >= cut or last < 0:
            name = _NEXT_NAME.search(text, start, stop)
            cut = name.start() if name else stop
            last = start + len(text[start:cut].rstrip(_TRAILING))
        end, k = last, bisect_right(ends, start)           # what a base span covers is not part of the value
        if k < len(taken) and taken[k][0] < end:
            end = start + len(text[start:max(start, taken[k][0])].rstrip(_TRAILING + "&"))
        if end - start < 6:
            value = None
        else:
            value = text[start:end]
            if not m[1].strip() and not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
                value = None                               # without a connector prose follows
        if value and value not in secret:
            words = words or OtherWords(text)
            words.value = value
            secret[value] = guess_cost(value, words, LEAST_COST) >= LEAST_COST
        if value and secret[value]:
            found.append((start, end, "guess"))
            m = _CONTEXT.search(text, end)
        else:                                              # a rejected value may hold a credential word itself
            m = _CONTEXT.search(text, start)
    return found


def secret_spans(raw: bytes | None) -> tuple[list, list]:
    """(base spans, all spans) of a text, sorted by start, then kind as listed."""
    raw = raw or b""
    low = raw.lower()
    if not (any(w in low for w in _CONTEXT_WORDS) or b"akia" in low
            or b"x" * LEAST_LENGTHS["hex"] in raw.translate(_HEX_MAP)):
        return [], []
    text = decoded(raw)
    def order(s):
        return s[0], KINDS.index(s[2])
    base = base_spans(raw, text)
    return sorted(base, key=order), sorted(base + guessed_spans(raw, text, base), key=order)


def listed(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_secrets(docs: DataFrame, keep=("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with n_assign, n_access, n_hex, base_sha256 and spans (code points)."""
    names = ("assign", "access", "hex")

    def compute(texts):
        found = [secret_spans(t) for t in texts]
        counts = [[sum(s[2] == k for s in base) for base, _ in found] for k in names]
        return counts + [[hashlib.sha256(listed(base).encode()).hexdigest() for base, _ in found],
                         [listed(spans) for _, spans in found]]

    fields = [(f"n_{k}", T.LongType()) for k in names] + [("base_sha256", T.StringType()), ("spans", T.StringType())]
    return append_columns(docs, fields, lambda: compute, keep=keep)


def masked(raw: bytes | None, mask: str = MASK) -> bytes | None:
    """The text with every span (overlapping ones together) replaced by ``mask``; null stays null."""
    if raw is None:
        return None
    _, spans = secret_spans(raw)
    if not spans:
        return raw
    text, out, at = decoded(raw), [], 0
    end = None
    for start, stop, _ in spans:
        if end is None or start >= end:
            out += [text[at:start], mask]
            end = stop
        end = max(end, stop)
        at = end
    return "".join(out + [text[at:]]).encode()


def mask_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in ``text`` masked; a column n_chars follows the new text."""
    others = [c for c in docs.columns if c != "text"]
    kept = append_columns(docs, [("__masked", T.StringType())],
                          lambda: lambda texts: [[None if (m := masked(t)) is None else m.decode("utf-8", "replace")
                                                  for t in texts]], keep=others)
    done = kept.withColumnRenamed("__masked", "text")
    if "n_chars" in others:
        size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        done = done.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(size))
    return done.select(*docs.columns)
