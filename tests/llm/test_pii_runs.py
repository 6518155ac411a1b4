import random
import time

from folioframe.llm.pii import _context, base_spans, candidate_runs, candidate_spans, find_pii, redact_pii, shape
from helpers import table


def test_runs():
    cases = {
        "at (017) 555-7713 now": ["(017) 555-7713"],
        "at 017 555 7713, now": ["017 555 7713"],
        "(4111 1111 1111 1112)": ["4111 1111 1111 1112"],
        "1 (437) 555-0689 (017) 555-7713": ["1 (437) 555-0689", "(017) 555-7713"],
        "+1 (437) 555-0689 017 555 7713": [],  # one fixed span
        "in 5 of 7, 12 34 and a1 2345678": [],
        "10.1.300.4 5551234 12": ["5551234 12"],
        "two  blanks 017  555 7713": ["555 7713"],
    }
    for text, runs in cases.items():
        assert [text[a:z] for a, z in candidate_runs(text, base_spans(text))] == runs, text
    assert [shape(x) for x in ("(017) 555-7713", "4111 1111 1111 1112", "12 34", "a" * 300 + "@host")] == ["phone", "card", "", "email"]


def test_identifiers_with_blanks_are_discovered(spark):
    rows = []
    for i in range(40):
        rows.append((i, f"text call now: +1 (437) 555-{1000 + i} thanks, then pay with 4111 1111 1111 {luhn_end(i)} soon", None, None, 0))
    planted = {100: "(017) 555-7713", 101: "017 555 7714", 102: "1 (437) 555-0689"}
    rows += [(i, f"text call now: {x} thanks", None, None, 0) for i, x in planted.items()]
    rows.append((103, "then pay with 4111 1111 1111 1112 soon", None, None, 0))
    rows.append((104, "nothing here: (017) 555-7713 at all", None, None, 0))
    got = {r.doc_id: r for r in find_pii(table(spark, rows)).collect()}
    assert all(got[i].spans == got[i].base and got[i].n_phone == 1 and got[i].n_card == 1 for i in range(40))
    for i, x in planted.items():
        assert (got[i].base, got[i].spans) == ("", f"phone:15:{15 + len(x)}"), i
    assert got[103].spans == "card:14:33" and got[104].spans == ""
    clean = {r.doc_id: r.text for r in redact_pii(table(spark, rows)).collect()}
    assert {clean[i] for i in planted} == {"text call now: <PHONE> thanks"} and clean[103] == "then pay with <CARD> soon" and clean[104] == rows[-1][1]


def luhn_end(i):
    return next(f"{n:04}" for n in range(i * 10, i * 10 + 10) if base_spans(f"4111 1111 1111 {n:04}"))


def test_long_words_count_whole(spark):
    a, b = "x" * 60 + "a:", "x" * 60 + "b:"
    assert _context(f"{a} p@q.r", 63, 68) != _context(f"{b} p@q.r", 63, 68)
    host = "h" * 150
    rows = [(i, f"mail {a} user{i}@mail.example.com thanks{i}", None, None, 0) for i in range(40)]
    rows += [(100, f"mail {a} person@{host} more", None, None, 0), (101, f"mail {b} person@{host} more", None, None, 0)]
    got = {r.doc_id: r.spans for r in find_pii(table(spark, rows)).collect()}
    assert got[100] == f"email:68:{68 + 7 + 150}" and got[101] == ""


def test_long_texts_take_linear_time():
    rng = random.Random(3)
    for text in ("1" * 300_000, "a@b.c," * 50_000, "1 " * 150_000, "".join(rng.choice("0123456789 ()-+.") for _ in range(300_000)), "((((" * 50_000 + " 1"):
        base, began = base_spans(text) if "@" in text else [], time.time()
        candidate_runs(text, base), candidate_spans(text, base)
        assert time.time() - began < 10


def test_patterns_with_many_candidates_are_scored(spark):
    """A pattern with over a thousand values that no fixed pattern explains is looked up as a heavy key."""
    rows = [(i, f"write to u{i}@x.org now" if i % 2 else f"then sign in as a{i} now" if i % 20 else f"write to u{i}@x now", None, None, 0) for i in range(4000)]
    rows += [(i, f"reach u{i}@x now", None, None, 0) for i in range(4000, 5200)] + [(i, f"reach u{i}@x.org now", None, None, 0) for i in range(5200, 5210)]
    found = {r.doc_id: r.spans for r in find_pii(table(spark, rows)).collect()}
    assert len(found) == len(rows) and found[1] == "email:9:17"
    assert found[20] == "email:9:14"  # its context is that of addresses
    assert found[2] == "" and found[4000] == ""
    assert len(redact_pii(table(spark, rows)).collect()) == len(rows)
