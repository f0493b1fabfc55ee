"""Personal data: fixed patterns and a semi-Markov conditional random field over whole spans.

Base spans are e-mail addresses, IPv4 addresses, card numbers (Luhn) and phone
numbers found by fixed patterns. On top, clusters of digit groups and written-out
addresses are segmented by a semi-Markov CRF: every run of at most ``MOST_GROUPS``
consecutive groups is a candidate of every type, scored by features of the whole
span (group lengths, separators, check sum, octets, words before). Dynamic
programming chooses boundaries and types together; groups outside entities score
zero. The weights are trained by the CRF's likelihood on clusters of a bounded,
hashed sample of documents, labelled by the base patterns, and on rewritten
copies of them (other separators, without country code, spelled-out marks).

Defined cases: null and empty texts have no spans; a found span over a base span
is dropped; without training clusters only base spans are returned; repeated
rows get equal results; an empty table gives an empty result; input columns named
like a result are replaced by it.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import append_columns, decoded

KINDS = ("email", "ip", "card", "phone")
MOST_GROUPS = 8
# Documents that training clusters are taken from (about), and clusters used, at most.
FIT_DOCUMENTS = 20_000
FIT_CLUSTERS = 3000
EPOCHS = 6
SLOTS = 1 << 13

# The base patterns. An e-mail address is [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ and an
# address of four numbers [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+); both are found from runs, in linear time.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile(rb"[0-9]")
_CLUSTER = re.compile(r"[+(]{0,2}[0-9]+(?:[\x20().\-/:]{1,3}[0-9]+)*")
_GROUP = re.compile(r"[0-9]+")
# Spelled-out addresses: a mark, at most 64 characters of a name before it and a domain of short labels after it.
_AT_MARK = r"(?:\x20?(?:@|[(\[]\x20?at\x20?[)\]])\x20?|\x20at\x20)"
_LABEL = r"[A-Za-z0-9-]{1,63}"
_NEXT_LABEL = rf"(?:\x20?(?:\.|[(\[]\x20?dot\x20?[)\]])\x20?{_LABEL}|\x20dot\x20{_LABEL})"
_AT = re.compile(_AT_MARK, re.IGNORECASE | re.ASCII)
_NAME = re.compile(r"[A-Za-z0-9._%+-]{1,64}$")
_SPELLED_DOMAIN = re.compile(_LABEL + _NEXT_LABEL + "{1,10}", re.IGNORECASE | re.ASCII)
# In the bytes of every text that holds a spelled address: a mark and two labels of a domain.
_SPELLED_HINT = re.compile(f"@|{_AT_MARK}{_LABEL}{_NEXT_LABEL}".encode(), re.IGNORECASE)
_WORD_BEFORE = re.compile(r"([^\W\d_]+)[^\w]*$")
# Fewest digits of a cluster that is segmented; fewest and most digits of a candidate of each kind.
LEAST_DIGITS = 4
DIGITS = {"ip": (4, 12), "card": (12, 19), "phone": (7, 15)}
LONGEST = 19
# Stretches of more characters teach nothing.
LONGEST_STRETCH = 400


def luhn(digits: str) -> bool:
    doubled = [int(c) * 2 - 9 * (c > "4") for c in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def octets(parts: Iterable[str]) -> bool:
    return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in parts)


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[str, int, int]]:
    """Addresses around every ``@``: the run of name characters before it, the longest domain after it."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                found.append(("email", start, domain.end()))
                free = domain.end()
        at = text.find("@", at + 1)
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind as listed, then start; failing matches are dropped."""
    found = emails(text)
    for run in _DOTTED.finditer(text):                     # each four numbers of a run are one match
        if run[0].count(".") >= 3:
            numbers = [m.span() for m in _GROUP.finditer(text, *run.span())]
            for k in range(0, len(numbers) - 3, 4):
                if octets(text[a:b] for a, b in numbers[k:k + 4]):
                    found.append(("ip", numbers[k][0], numbers[k + 3][1]))
    found += [("card", *m.span()) for m in _CARD.finditer(text)
              if 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return found


@dataclass(frozen=True)
class Cluster:
    """A stretch of text to segment: its groups as (start, end), and whether it is a spelled address."""
    groups: tuple[tuple[int, int], ...]
    spelled: bool


def clusters(text: str) -> Iterator[Cluster]:
    """Digit clusters and address-like stretches of a text."""
    for m in _CLUSTER.finditer(text):
        if sum(c.isdigit() for c in m[0]) >= LEAST_DIGITS:
            yield Cluster(tuple((m.start() + g.start(), m.start() + g.end()) for g in _GROUP.finditer(m[0])), False)
    for mark in _AT.finditer(text):
        name = _NAME.search(text[max(0, mark.start() - 64):mark.start()])
        domain = name and _SPELLED_DOMAIN.match(text, mark.end())
        if domain:
            yield Cluster(((mark.start() - len(name[0]), domain.end()),), True)


def _slots(names: list[str], kind: str) -> np.ndarray:
    return np.array([zlib.crc32(f"{kind}|{n}".encode()) % SLOTS for n in names], np.int64)


def candidates(text: str, cluster: Cluster) -> list[tuple[int, int, str, int, int, np.ndarray]]:
    """(first group, past last group, kind, start, end, feature slots) of every candidate segment."""
    return list(candidates_in(text, cluster))


def candidates_in(text: str, cluster: Cluster) -> Iterator[tuple[int, int, str, int, int, np.ndarray]]:
    """``candidates`` one by one, by first group: a cluster may have as many as its text has numbers."""
    n = len(cluster.groups)
    for i in range(n):
        for j in range(i + 1, min(n, i + MOST_GROUPS) + 1):
            start, end = cluster.groups[i][0], cluster.groups[j - 1][1]
            if cluster.spelled:
                span = text[start:end]
                names = ["bias", f"at:{'@' in span}", f"spelled:{bool(re.search('[(\\[]', span))}",
                         f"spaces:{min(6, span.count(' '))}", f"end:{len(re.split(r'[^A-Za-z0-9]+', span)[-1])}",
                         f"dot:{'.' in span}"]
                yield i, j, "email", start, end, _slots(names, "email")
                continue
            if i == 0:                                     # marks before the first group belong to it
                while start and text[start - 1] in "(+":
                    start -= 1
            elif text[start - 1] in "(+":
                start -= 1
            parts = [text[a:b] for a, b in cluster.groups[i:j]]
            digits = "".join(parts)
            if len(digits) > LONGEST:
                break
            kinds = [k for k, (least, most) in DIGITS.items() if least <= len(digits) <= most
                     and (k != "ip" or len(parts) == 4)]
            if not kinds:
                continue
            gaps = [text[a:b] for (_, a), (b, _) in zip(cluster.groups[i:j], cluster.groups[i + 1:j])]
            shape = "-".join(str(len(p)) for p in parts)
            before = text[start - 1:start] if i == 0 else "group"
            after = text[end:end + 1] if j == n else "group"
            word = _WORD_BEFORE.search(text[max(0, start - 24):start]) if i == 0 else None
            names = ["bias", f"digits:{len(digits)}", f"groups:{len(parts)}", f"shape:{shape}",
                     f"gaps:{'|'.join(sorted(set(gaps)))}", f"first:{text[start]if not text[start].isdigit() else 'd'}",
                     f"whole:{i == 0 and j == n}", f"shape-gaps:{shape}:{'|'.join(gaps)}",
                     f"left:{'w' if before.isalnum() else before}", f"right:{'w' if after.isalnum() else after}",
                     f"even:{len(set(map(len, parts))) == 1}"]
            if word:
                names.append(f"word:{word[1].lower()}")
            for kind in kinds:
                extra = list(names)
                if kind == "card":
                    extra.append(f"luhn:{13 <= len(digits) <= 19 and luhn(digits)}:{len(digits)}")
                if kind == "ip":
                    extra.append(f"octets:{len(parts) == 4 and octets(parts)}:{set(gaps) == {'.'}}")
                yield i, j, kind, start, end, _slots(extra, kind)


def _logsum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def best_segments(n: int, found: Iterable, weights: np.ndarray) -> list[tuple[str, int, int]]:
    """Viterbi: the best sequence of entities and single outside groups, as (kind, start, end).

    ``found`` are candidates by first group. They are taken one by one and only
    the best one that ends at each group is kept.
    """
    best, last = [0.0] * (n + 1), [None] * (n + 1)
    reached = 0
    for c in found:
        score = float(weights[c[5]].sum())
        if score <= 0:                                     # others lose to outside groups
            continue
        for j in range(reached + 1, c[0] + 1):             # no later candidate ends here
            if best[j - 1] >= best[j]:
                best[j], last[j] = best[j - 1], None
        reached = max(reached, c[0])
        if best[c[0]] + score > best[c[1]]:
            best[c[1]], last[c[1]] = best[c[0]] + score, (c[0], c[2:5])
    for j in range(reached + 1, n + 1):
        if best[j - 1] >= best[j]:
            best[j], last[j] = best[j - 1], None
    out, j = [], n
    while j:
        if last[j] is None:
            j -= 1
        else:
            j, span = last[j]
            out.append(span)
    return out[::-1]


def gradient(n: int, found: list, gold: set, weights: np.ndarray) -> tuple[float, list[tuple[np.ndarray, float]]]:
    """Log likelihood of the gold segments and its gradient as (slots, gold minus expected) pairs."""
    scores = [float(weights[c[5]].sum()) for c in found]
    starting: list[list[int]] = [[] for _ in range(n + 1)]
    ending: list[list[int]] = [[] for _ in range(n + 1)]
    for k, c in enumerate(found):
        starting[c[0]].append(k)
        ending[c[1]].append(k)
    alpha, beta = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(1, n + 1):
        alpha[j] = _logsum([alpha[j - 1]] + [alpha[found[k][0]] + scores[k] for k in ending[j]])
    for i in range(n - 1, -1, -1):
        beta[i] = _logsum([beta[i + 1]] + [beta[found[k][1]] + scores[k] for k in starting[i]])
    moves, likelihood = [], -alpha[n]
    for k, c in enumerate(found):
        expected = math.exp(min(0.0, alpha[c[0]] + scores[k] + beta[c[1]] - alpha[n]))
        wanted = (c[2], c[3], c[4]) in gold
        likelihood += scores[k] * wanted
        if wanted or expected > 1e-4:
            moves.append((c[5], wanted - expected))
    return likelihood, moves


def rewritten(text: str, spans: list[tuple[str, int, int]], rng: random.Random) -> tuple[str, list]:
    """The text with its entities written another way (entities stay entities), and their new spans.

    A number without entity is now and then swapped for a date, time, price or version.
    """
    out, moved, at = "", [], 0
    for kind, start, end in sorted(spans, key=lambda s: s[1]):
        if start < at:
            continue
        out, old = out + text[at:start], text[start:end]
        if kind == "email":
            name, _, host = old.partition("@")
            mark, dot = rng.choice([(" at ", " dot "), ("(at)", "(dot)"), (" [at] ", " [dot] "), ("@", "."), (" @ ", ".")])
            old = name + mark + host.replace(".", dot)
        elif kind == "phone":
            d = digits_of(old)
            cut = [d[-10:-7], d[-7:-4], d[-4:]]
            old = rng.choice([old, "({}) {}-{}".format(*cut), "{}-{}-{}".format(*cut), "{}.{}.{}".format(*cut),
                              "+" + d[:-10] + " {} {} {}".format(*cut), "00" + d[:-10] + " {} {} {}".format(*cut)])
        elif kind == "card":
            d = digits_of(old)
            old = rng.choice([d, " ".join(d[i:i + 4] for i in range(0, len(d), 4)),
                              "-".join(d[i:i + 4] for i in range(0, len(d), 4)),
                              ".".join(d[i:i + 4] for i in range(0, len(d), 4))])
        moved.append((kind, len(out), len(out) + len(old)))
        out, at = out + old, end
    out += text[at:]
    number = [str(rng.randrange(10 ** k, 10 ** (k + 1))) for k in range(20)]
    plain = [f"{rng.randrange(1900, 2030)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}",
             f"{rng.randrange(1, 29)}.{rng.randrange(1, 13)}.{rng.randrange(1900, 2030)}",
             f"{rng.randrange(24):02}:{rng.randrange(60):02}:{rng.randrange(60):02}",
             f"{rng.randrange(1, 12)}.{rng.randrange(20)}.{rng.randrange(200)}", f"{number[2]}.{number[1]}",
             f"{rng.randrange(1900, 2030)}-{rng.randrange(1900, 2030)}", f"978-{number[0]}-{number[3]}-{number[3]}-1",
             number[rng.randrange(3, 20)], f"{number[3]} {number[2]} {number[1]}", f"{number[0]} {number[2]} {number[2]}"]
    return f"{out}\n{' '.join(rng.sample(['the', 'on', 'for', 'x'], 1))} {rng.choice(plain)} end", moved


def fit_crf(texts: list[str], seed: int = 11) -> np.ndarray:
    """Train the weights on stretches of text labelled by the base patterns, as they are and rewritten."""
    rng = random.Random(seed)
    cases = []
    for text in texts:
        spans = base_spans(text)
        for case, gold in ((text, spans), rewritten(text, spans, rng), rewritten(text, spans, rng)):
            wanted = set(gold)
            for cluster in clusters(case):
                found = candidates(case, cluster)
                if found:
                    cases.append((len(cluster.groups), found, wanted))
    weights, squares = np.zeros(SLOTS), np.full(SLOTS, 1e-2)
    for _ in range(EPOCHS):
        rng.shuffle(cases)
        for n, found, wanted in cases:
            for slots, up in gradient(n, found, wanted, weights)[1]:
                squares[slots] += up * up
                weights[slots] += 0.3 * up / np.sqrt(squares[slots])
    return weights


def fit_pii(docs: DataFrame, documents: int = FIT_DOCUMENTS, most: int = FIT_CLUSTERS) -> np.ndarray:
    """Weights from at most ``most`` stretches around numbers and addresses of about ``documents`` documents."""
    n = docs.count()
    share = int(min(1.0, documents / max(1, n)) * (1 << 30))
    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share)

    def make():
        def compute(texts):
            out = []
            for raw in texts:
                stretches = []
                if raw and (_DIGIT.search(raw) or _SPELLED_HINT.search(raw)):
                    text = decoded(raw)
                    for c in clusters(text):
                        a, b = c.groups[0][0], c.groups[-1][1]
                        if b - a <= LONGEST_STRETCH:
                            stretches.append(text[max(0, a - 40):b + 40])
                out.append(sorted(set(stretches)))
            return [out]
        return compute

    rows = append_columns(sample, [("stretches", T.ArrayType(T.StringType()))], make, keep=())
    picked = (rows.select(F.explode("stretches").alias("s")).distinct()
              .orderBy(F.xxhash64("s"), "s").limit(most).collect())
    return fit_crf([r.s for r in picked])


def pii_spans(raw: bytes | None, weights: np.ndarray) -> tuple[list, list]:
    """(base spans, all spans) of a text, by kind as listed, then start."""
    if not raw or not (_DIGIT.search(raw) or _SPELLED_HINT.search(raw)):
        return [], []
    text = decoded(raw)
    base = base_spans(text)
    found, taken = list(base), []
    for _, a, b in sorted(base, key=lambda span: span[1:]):             # overlapping base spans together
        if taken and a < taken[-1][1]:
            taken[-1] = taken[-1][0], max(b, taken[-1][1])
        else:
            taken.append((a, b))
    starts = [a for a, _ in taken]
    if weights.any():
        for cluster in clusters(text):
            for kind, start, end in best_segments(len(cluster.groups), candidates_in(text, cluster), weights):
                k = bisect_left(starts, end)               # base spans before k begin before this one's end
                if not k or taken[k - 1][1] <= start:
                    found.append((kind, start, end))
    def order(s):
        return KINDS.index(s[0]), s[1]
    return sorted(base, key=order), sorted(found, key=order)


def listed(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find_pii(docs: DataFrame, weights: np.ndarray, keep=("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with n_email, n_ip, n_card, n_phone, base_sha256 and spans (code points)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def compute(texts):
        found = [pii_spans(t, shared.value) for t in texts]
        counts = [[sum(s[0] == k for s in base) for base, _ in found] for k in KINDS]
        return counts + [[hashlib.sha256(listed(base).encode()).hexdigest() for base, _ in found],
                         [listed(spans) for _, spans in found]]

    fields = [(f"n_{k}", T.LongType()) for k in KINDS] + [("base_sha256", T.StringType()), ("spans", T.StringType())]
    return append_columns(docs, fields, lambda: compute, keep=keep)
