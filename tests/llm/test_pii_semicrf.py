"""Personal data: base spans against plain patterns, the CRF's algebra against listed segmentations."""

import hashlib
import itertools
import math
import random
import re
import time
import tracemalloc

import numpy as np

from immolytics.llm import pii_semicrf as P
from immolytics.llm.queries import QUERIES
from tests.conftest import SF
from tests.llm.cases import CASES, case_frame


def plain(text):
    def luhn(d):
        total = 0
        for i, c in enumerate(reversed(d)):
            x = int(c) * (1 + i % 2)
            total += x - 9 * (x > 9)
        return total % 10 == 0
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = {"email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
             "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
             "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
             "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15)}
    return [(k, m.start(), m.end()) for k, (p, ok) in rules.items() for m in re.finditer(p, text or "") if ok(m[0])]


def test_base_spans_of_the_query(spark):
    rows = {r.doc_id: r for r in QUERIES["op7_pii_semicrf"](spark, SF).collect()}
    found = 0
    for d, text in [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]:
        want, r = plain(text), rows[d]
        found += len(want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in want) for k in P.KINDS]
        assert r.base_sha256 == hashlib.sha256(P.listed(want).encode()).hexdigest()
        assert set(P.listed(want).split(",")) <= set(r.spans.split(","))
    assert found > 20


def test_base_spans_equal_the_patterns_on_random_texts():
    rng = random.Random(6)
    for alphabet in ("ab.@-_ 1", "12.34 ", "+1 ().-5é", "0123456789- .", "a@.b"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
            assert P.base_spans(text) == plain(text), text


def test_spelled_addresses_do_not_need_a_digit_elsewhere():
    weights = np.zeros(P.SLOTS)
    weights[P._slots(["bias"], "email")] = 1.0             # every spelled candidate is an address
    for mark in (" at ", "(at)", " (at) ", "[AT]", " [ at ] ", "( At )", "@", " @ "):
        for domain in ("example.org", "mail.example.org", "example dot org", "mail(dot)example [dot] org", "example . org",
                       "a" * 63 + ".org", "a" * 63 + " [ dot ] org", "example.\u00fc", "example"):
            text = f"Write to jane{mark}{domain} or call"
            alone, with_digit = (P.pii_spans(t.encode(), weights)[1] for t in (text, text + " 7"))
            assert alone == with_digit, text
    assert P.pii_spans(b"jane (at) example.org", weights)[1] == [("email", 0, 21)]


def test_hint_accepts_every_spelled_candidate():
    rng, some = random.Random(9), 0
    parts = ["at", "AT", "dot", " ", " ", "(", ")", "[", "]", "@", ".", "jane", "org", "-", "x" * 60, "\n", "\u00e9"]
    for _ in range(40_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(4, 16)))
        if any(c.spelled for c in P.clusters(text)):
            some += 1
            assert P._SPELLED_HINT.search(text.encode()), text
    assert some > 100


def test_long_runs_take_linear_time(spark):
    begun = time.time()
    weights = P.fit_crf(["call +1 (415) 555-2671 or 10.20.30.40 now"])
    for run in ("a" * 300_000 + " x@y.zz", "1" * 300_000 + "@", "1." * 100_000, "12 " * 50_000, "+1 " * 50_000, "(" * 200_000 + "1",
                "a@" * 100_000, " at " * 50_000):
        P.pii_spans(run.encode(), weights)
    assert time.time() - begun < 60


def test_viterbi_and_gradient_equal_listed_segmentations():
    rng = np.random.default_rng(8)
    weights = rng.standard_normal(P.SLOTS)
    text = "call +1 (415) 555-2671 or 10.20.30.40 now"
    for cluster in P.clusters(text):
        n, found = len(cluster.groups), P.candidates(text, cluster)
        ways = []
        for size in range(n + 1):
            for chosen in itertools.combinations(range(len(found)), size):
                parts = sorted((found[k][0], found[k][1]) for k in chosen)
                if all(a[1] <= b[0] for a, b in zip(parts, parts[1:])):
                    ways.append((sum(float(weights[found[k][5]].sum()) for k in chosen), chosen))
        best = max(ways)[1]
        got = P.best_segments(n, found, weights)
        assert got == [found[k][2:5] for k in sorted(best, key=lambda k: found[k][0])]
        total = math.log(sum(math.exp(s) for s, _ in ways))
        gold = {found[best[0]][2:5]} if best else set()
        likelihood, moves = P.gradient(n, found, gold, weights)
        wanted = sum(float(weights[found[k][5]].sum()) for k in best[:1])
        assert abs(likelihood - (wanted - total)) < 1e-6
        expected = {k: sum(math.exp(s - total) for s, c in ways if k in c) for k in range(len(found))}
        for slots, up in moves:
            assert any(slots is found[k][5] and abs(up - ((found[k][2:5] in gold) - expected[k])) < 1e-6 for k in expected)


def test_other_spellings_are_found_and_plain_numbers_left(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    weights = P.fit_pii(docs)

    def found(text):
        return [(k, text[a:b]) for k, a, b in P.pii_spans(text.encode(), weights)[1]]
    assert found("call 415-555-2671 now") == [("phone", "415-555-2671")]
    assert found("write jane.doe [at] mail [dot] example [dot] org") == [("email", "jane.doe [at] mail [dot] example [dot] org")]
    assert found("card 4111.1111.1111.1111 ok") == [("card", "4111.1111.1111.1111")]
    for text in ("on 2024-03-05 at 10:20:33 we", "price 1,234.56 in 1999-2003", "isbn 978-3-16-148410-0", "12 345 678"):
        assert found(text) == []


def test_unusual_rows(spark):
    df = case_frame(spark, spans="clash", n_ip="clash")
    rows = P.find_pii(df, P.fit_pii(df), keep=("doc_id", "spans", "text")).collect()
    assert len(rows) == len(CASES)
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.base_sha256 == empty and r.spans == "" for r in rows if not r.text or r.doc_id in (3, 4, 5))
    odd = [(1, "a@b.c x@y é@z.w 1.2.3.4.5 999.1.1.1 " + "1." * 3 + "9" * 6000), (2, "+1 (2)-3. 4 5678901 é 4111 1111-1111 1111"),
           (3, "٣٤٥٦ ٧٨٩٠١٢ ²²²²²²²")]
    got = P.find_pii(spark.createDataFrame(odd, "doc_id long, text string"), P.fit_pii(df)).collect()
    for (d, text), r in zip(odd, sorted(got, key=lambda r: r.doc_id)):
        want = [s for s in plain(text[:40])] if d == 1 else plain(text)
        assert r.base_sha256 == hashlib.sha256(P.listed(want).encode()).hexdigest()
    assert P.find_pii(df.limit(0), np.zeros(P.SLOTS)).collect() == []


def test_address_lists_and_number_lists_grow_in_proportion():
    weights = P.fit_crf(["call +1 (415) 555-2671 or 10.20.30.40 now", "write a@b.co or c [at] d [dot] org"])
    for unit in ("a@b.co ", "1.2.3.4 ", "call 415-555-2671, "):
        took = []
        for n in (4000, 32_000):
            begun = time.process_time()
            base, found = P.pii_spans((unit * n).encode(), weights)
            took.append(time.process_time() - begun)
            assert len(found) >= len(base) and (unit[0] == "c" or len(base) == n)
        assert took[1] < 24 * took[0] + 0.5


def test_number_lists_take_bounded_memory():
    weights = P.fit_crf(["call +1 (415) 555-2671 or 10.20.30.40 now"])
    text = ("12 " * 60_000).encode()
    tracemalloc.start()
    P.pii_spans(text, weights)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 * len(text)                          # 3 MB take less than 900 MB at the tracer's count
