"""Base entities against regular expressions, and the bootstrap on planted contexts."""

import hashlib
import random
import re
from collections import Counter

import pytest

from llm_rows import base_rows, make, mixed, no_docs  # noqa: F401  fixtures

from plume.llm import pii

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, m):
    digits = re.sub(r"[^0-9]", "", m)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")),
            "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in p.finditer(text or "") if valid(k, m[0])]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def noise(n):
    rng = random.Random(11)
    parts = ["a@b.cc", "x.y+z@mail-1.example.org", "@", "é", "\U0001f600", "4111 1111 1111 1111", "4111-1111-1111-1112", "5500005555555559",
             "1.2.3.4", "256.1.1.1", "001.002.003.255", "0000999.1.1.1", "+1 (555) 010-9999", "+12", "+1-", "1.2.3.4.5.6.7.8", "_", " ", " ", "-", ".",
             "a@b", "a@b.c_d@e.f", "a@b.c%d@e.f.g", "12345678901234567890", "\n", "4", "++49 30 901820", "x" * 50]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_base_entities(spark, mixed):
    rows = mixed[0] + [(700_000 + k, t, "en", "s") for k, t in enumerate(noise(400))]
    got = Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.personal_data(make(spark, rows)).collect())
    want = Counter()
    for i, t, _, _ in rows:
        spans = brute(t)
        want[(i, *[sum(s[0] == k for s in spans) for k in pii.KINDS], hashlib.sha256(listed(spans).encode()).hexdigest())] += 1
    assert got == want


def test_base_spans_stay(spark):
    rows = [(k, t, "en", "s") for k, t in enumerate(noise(200))]
    for r in pii.personal_data(make(spark, rows)).collect():
        assert set(listed(brute(rows[r.doc_id][1])).split(",")) <= set(r.spans.split(",")) | {""}


def planted():
    """Phone numbers after "call me"; emails, cards and addresses elsewhere; "the" before everything."""
    rng = random.Random(3)
    rows = []
    for k in range(120):
        rows.append((k, f"some words call me +1 555 010 {k:04d} and the 4111 1111 1111 1111 or the 10.0.0.{k} end", "en", "s"))
    rows.append((500, "please call me 555-010-7788 today", "en", "s"))     # no base pattern: found by its context
    rows.append((501, "order the 555-010-7788 today", "en", "s"))          # a common context tells nothing
    rows.append((502, "part number 99887766 of the list", "en", "s"))      # an unknown context
    rng.shuffle(rows)
    return rows


def test_contexts_discover_unseen_identifiers(spark):
    got = {r.doc_id: r.spans for r in pii.personal_data(make(spark, planted())).collect()}
    at = "please call me ".__len__()
    assert got[500] == f"phone:{at}:{at + 12}"
    assert got[501] == got[502] == ""


def test_confidences_of_the_graph(spark):
    graph = pii.pattern_graph(pii.occurrences(make(spark, planted())))
    found = {(r.pattern, r.kind): r.confidence for r in pii.confident_patterns(graph).collect()}
    assert set(found) == {("1 me", "phone"), ("2 call me", "phone"), ("2 and the", "card"), ("2 or the", "ip")}
    assert all(0.8 <= c <= 1 for c in found.values())


@pytest.mark.parametrize("kind", pii.KINDS)
def test_long_runs_do_not_stall(spark, kind):
    # the plain expressions take quadratic time on these, so they are no longer than that allows here
    run = {"email": "a." * 5_000, "ip": "1" * 5_000, "card": "1 " * 5_000, "phone": "+1" + " (" * 5_000}[kind]
    r, = pii.personal_data(make(spark, [(1, run + "@b.c 1.2.3.4", "en", "s")])).collect()
    assert r.base_sha256 == hashlib.sha256(listed(brute(run + "@b.c 1.2.3.4")).encode()).hexdigest()


def test_no_documents(spark, no_docs):
    assert pii.personal_data(no_docs).collect() == []


def test_no_python_in_the_plan(spark, mixed):
    plan = pii.personal_data(mixed[1])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
