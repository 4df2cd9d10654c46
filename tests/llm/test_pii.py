from __future__ import annotations

import hashlib
import random
import re

from shelfcast.llm import pii


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(text):
    total = 0
    for i, c in enumerate(text[::-1]):
        d = int(c) * (1 + i % 2)
        total += d // 10 + d % 10
    return total % 10 == 0


SLOW = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m[0])) <= 15),
]
TEXTS = [
    "", "a@b.c_d@e.f", "a@b.c.d@e.f", "@@a@b.c@", "x@y", "a@b.c-@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.2.3.004", "1.2.3", "é 4111 1111 1111 1111",
    "4111-1111-1111-1112", "41111111111111111111111", "+1 (017) 555-7713 x", "+12345678", "+1+1 234 567 890", "+49 (0) 30 1234567890123", "++1 23456789)",
    "9" * 50_000 + ".1.1.1", "a." * 20_000 + "@b.c", "1 " * 5000, "+1 " + "2 " * 3000,
]


def slow(text):
    spans = [(i, m.start(), kind, m.end()) for i, (kind, p, ok) in enumerate(SLOW) for m in re.finditer(p, text) if ok(m)]
    return ",".join(f"{k}:{a}:{b}" for _, a, k, b in sorted(spans))


def test_base_spans_against_brute_force():
    dice = random.Random(6)
    bits = ["1", "25", "411", "0", ".", "-", " ", "+", "@", "a", "b.c", "_", "(", ")", "é", "4111111111111111", "\n"]
    texts = [t for t in TEXTS if len(t) < 5000] + ["".join(dice.choice(bits) for _ in range(dice.randrange(2, 30))) for _ in range(4000)]
    for text in texts:
        assert pii.base_digest(text) == hashlib.sha256(slow(text).encode()).hexdigest(), text
    assert sum(bool(slow(t)) for t in texts) > 300


def test_long_runs_take_linear_time():
    for text in TEXTS:
        pii.find(text * 3)


def test_validators():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82 WEST 1234 5698 7654 32") and not pii.mod97("GB83 WEST 1234 5698 7654 32")
    assert pii.octets("1.2.3.255") and not pii.octets("1.2.3.256") and not pii.octets("1." + "9" * 6000 + ".1.1")
    assert pii.social("123-45-6789") and not pii.social("000-45-6789") and not pii.social("923-45-6789")


def test_added_kinds_and_context():
    kinds = lambda t: [(k, s) for k, _, _, s in pii.find(t)]
    assert kinds("bank account GB82 WEST 1234 5698 7654 32") == [("iban", 100)]
    assert kinds("code GB83 WEST 1234 5698 7654 32") == []
    assert kinds("her SSN is 123-45-6789") == [("ssn", 65)] and kinds("part 123-45-6789") == []
    assert kinds("call me: +1 (017) 555-7713") == [("phone", 95)] and kinds("+1 (017) 555-7713") == [("phone", 60)]
    assert pii.redact("mail a@b.cc now") == "mail <email> now" and pii.redact(None) is None


def test_ibans_inside_longer_runs():
    found = lambda t: [t[a:b] for k, a, b, _ in pii.find(t) if k == "iban"]
    spaced, tight = "DE89 3704 0044 0532 0130 00", "DE89370400440532013000"
    assert found(f"{spaced} BIC COBADEFF") == [spaced] and found(f"{tight} 7 days") == [tight]
    assert found(f"{spaced} GB82 WEST 1234 5698 7654 32 X") == [spaced, "GB82 WEST 1234 5698 7654 32"]
    assert found(f"AB12 {spaced}") == [spaced] and found(f"x{tight}") == found(f"{tight}x") == []
    assert found("DE88 3704 0044 0532 0130 00 BIC COBADEFF") == []


def test_rows_of_every_kind(spark):
    rows = [(1, "a@b.cc and 1.2.3.4", "x"), (1, "a@b.cc and 1.2.3.4", "x"), (None, "é +1 (017) 555-7713", "y"), (2, None, "z"), (3, "", "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, pii string")
    got = sorted(((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in pii.digest(pii.scan(frame)).collect()))
    want = []
    for i, t, _ in rows:
        base = slow(t or "")
        kinds = [s.split(":")[0] for s in base.split(",")]
        want.append((str(i), *(kinds.count(k) for k in pii.BASE), hashlib.sha256(base.encode()).hexdigest(), base))
    assert got == sorted(want)
    assert pii.digest(pii.scan(frame.where("false"))).collect() == []
