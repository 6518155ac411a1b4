"""The fixed patterns against the contract's regular expressions, applied as they stand."""

import base64
import hashlib
import os
import random
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from folioframe.llm.pii import _bounds, _context, base_spans
from folioframe.llm.queries import op6_pii
from helpers import difficult, table

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [2 * int(d) if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
    return sum(x // 10 + x % 10 for x in doubled) % 10 == 0


def holds(kind, found):
    digits = re.sub(r"[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    found = [(m.start(), m.end(), k) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if holds(k, m[0])]
    return sorted(found, key=lambda s: (s[0], list(PATTERNS).index(s[2])))


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(["a", "B-", ".", "%", "@", "+", "1", "0", "255", "256", " ", "-", "(", ")", "4111", "é", "\n", "1.2.3.4", "x@y.z", "+1 437"])).map("".join))
def test_same_as_the_patterns(text):
    assert base_spans(text) == brute(text)


def test_leading_zeros_without_end():
    text = "0" * 5000 + ".1.1.1"
    assert base_spans(text) == [(0, len(text), "ip")]
    assert base_spans("9" * 5000 + ".1.1.1") == []


def test_a_megabyte_takes_linear_time():
    rng = random.Random(4)
    n = 1 << 20
    texts = ["7" * n, "a" * n + "@", "a" * n + "@b.c", "@" * n, "a@" * (n // 2), "1." * (n // 2), "1 " * (n // 2), "+1" * (n // 2), "+1" + "(" * n, "a@b." * (n // 4), "a@b-" * (n // 4)]
    texts += [base64.b64encode(rng.randbytes(n)).decode() + " x@y.z", rng.randbytes(n // 2).hex()]
    for text in texts:
        began = time.time()
        base_spans(text)
        assert time.time() - began < 2, text[:20]


def test_query_on_difficult_and_given_texts(spark, sf, tmp_path):
    rng = random.Random(6)
    odd = ["x" + p + "y" for p in ("a@b.c%d@e.f", "1.2.3.4.5.6.7.8", "+1 (437) 555-0689 +44 20 7946 0958", "4111-1111-1111-1111", "a@b", "00001.2.3.4", "é a@b.c")]
    odd += ["".join(rng.choice("ab@.+-% 0123456789()") for _ in range(400)) for _ in range(200)]
    rows = difficult() + [(10_000 + i, t, None, None, 0) for i, t in enumerate(odd)]
    rows += [(20_000 + r.doc_id, r.text, None, None, 0) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    table(spark, rows).write.parquet(os.path.join(tmp_path, "documents.parquet"))
    got = {r.doc_id: r for r in op6_pii(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        wanted, r = brute(text), got[i]
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s[2] == k for s in wanted) for k in PATTERNS]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{z}" for a, z, k in wanted).encode()).hexdigest()
        assert set(f"{k}:{a}:{z}" for a, z, k in wanted) <= set(r.spans.split(",")) or not wanted


def test_contexts_take_linear_time():
    for text in ("a@b.c," * 50_000, "x" * 300_000 + " a@b.c" * 3, "a@b.c " * 50_000, "1.2.3.4/" * 40_000):
        began, base = time.time(), base_spans(text)
        bounds = _bounds(base)
        for start, end, _ in base:
            _context(text, start, end, bounds)
        assert base and time.time() - began < 5
