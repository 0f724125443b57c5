"""Personal data: base spans against a plain version, reliabilities against known ones, added spans by hand."""

import random
import re
from hashlib import sha256

from pyspark.sql import functions as F
from tidemark.llm.pii import LABELERS, find_pii, fitted, candidates, pii_digest, redacted, reliabilities

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 8 <= len(digits) <= 15,
            }[kind]
            if good():
                out.append((kind, m.start(), m.end()))
    return out


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_base_spans_equal_a_plain_version(documents):
    pick = random.Random(3)
    pieces = ["4111 1111 1111 1111", "4111111111111111", "12345", "a.b@c.de", "x@y", "@", ".", "+1 (269) 555-3296", "1.2.3.4", "300.1.2.3", "+", "é", "😀", " ", "-", "0", "\n", "tel ", "card: ", "a"]
    rows = [(i, "".join(pick.choice(pieces) for _ in range(pick.randrange(14)))) for i in range(600)] + [(600, None), (600, "1.2.3.4"), (None, "x@y.z")]
    got = sorted((r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii_digest(documents(rows)).collect())
    want = []
    for _, text in rows:
        spans = plain_base(text)
        want.append((sha256(listed(spans).encode()).hexdigest(), *(sum(k == kind for k, _, _ in spans) for kind in PATTERNS)))
    assert got == sorted(want)


def test_reliabilities_come_near_the_true_ones(spark):
    pick = random.Random(4)
    true = [0.95, 0.9, 0.8, 0.7, 0.6]
    speaks = [0.9, 0.7, 0.8, 0.9, 1.0]
    rows = []
    for _ in range(6000):
        right = pick.random() < 0.4
        rows.append(("phone", [0 if pick.random() > s else (1 if (pick.random() < a) == right else -1) for a, s in zip(true, speaks)]))
    patterns = spark.createDataFrame(rows, "kind string, votes array<int>").groupBy("kind", "votes").agg(F.count("*").alias("n"))
    got = reliabilities(patterns, len(true)).first()
    assert abs(got.m.pi - 0.4) < 0.03
    assert max(abs(a - b) for a, b in zip(got.m.a, true)) < 0.04


def numbers(pick, lead, tail=""):
    number = f"{pick.randrange(212, 990)}-{pick.randrange(212, 554)}-{pick.randrange(2000, 9999)}"
    return f"{lead}{number}{tail}", (len(lead), len(lead) + 12)


def test_added_spans(documents):
    """Numbers behind words for a phone are added, those of orders, of examples and before units are not."""
    pick = random.Random(6)
    rows, good, bad = [], {}, {}
    for i in range(300):
        lead, tail, right = pick.choice([
            ("please call ", " anytime", True), ("tel ", " ext 4", True), ("Phone: ", "", True), ("my mobile ", ".", True),
            ("order ", " of may", False), ("serial ", "", False), ("invoice ", " units", False), ("Order: ", "", False), ("part", "x", False),
        ])
        text, span = numbers(pick, lead, tail)
        rows.append((i, text))
        (good if right else bad)[i] = span
    rows += [(1000, "mail jane [at] mail7 [dot] com please"), (1001, "host 2a02:1:2:3:4:5:6:7 port 80"), (1002, "10.20.30.400"), (1003, "a 212-334-4567-8901 b"), (1004, "é +1 (269) 555-3296 é")]
    spans = {r.doc_id: [(s.kind, s.start, s.end, s.strict) for s in r.spans] for r in find_pii(documents(rows)).collect()}
    assert [i for i, (a, b) in good.items() if spans[i] != [("phone", a, b, False)]] == []
    assert [i for i in bad if spans[i]] == []
    assert spans[1000] == [("email", 5, 30, False)] and spans[1001] == [("ip", 5, 23, False)]
    assert spans[1002] == spans[1003] == [] and spans[1004] == [("phone", 2, 19, True)]
    clean = {r.doc_id: r.text for r in redacted(documents(rows)).collect()}
    assert clean[1000] == "mail [EMAIL] please" and clean[1002] == "10.20.30.400"


def test_labelers_disagree_and_see_more_than_the_base_rule(documents):
    rows = [(1, "order no. +1 (269) 555-3296 units"), (2, "Phone: +1 (269) 555-3296"), (3, "call 212-555-0142"), (4, "card 4111 1111 1111 1111")]
    votes = {r.doc_id: [dict(zip(LABELERS, c.votes)) for k in ("card", "phone") for c in r["__pii"][k]] for r in candidates(documents(rows)).collect()}
    assert [v["against"] for v in votes[1]] == [-1] and [v["after"] for v in votes[1]] == [-1]
    assert [(v["before"], v["label"], v["form"]) for v in votes[2]] == [(1, 1, 1)]
    assert [(v["before"], v["reserved"]) for v in votes[3]] == [(1, -1)]
    assert [(v["before"], v["reserved"], v["form"], v["distinct"]) for v in votes[4]] == [(1, -1, 1, -1)]


def test_no_candidates(documents):
    assert fitted(candidates(documents([(1, None), (2, ""), (3, "plain words")]))).count() == 0
    assert [r.spans for r in find_pii(documents([(1, None), (2, "")])).collect()] == [[], []]
