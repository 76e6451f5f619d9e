"""Personal data: base spans against the stated patterns, discovery by context, odd rows."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from latewatch.llm import pii

PATTERNS = {  # as stated in the contract
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def plain(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, kind, m.end()))
    return [(s, k, e) for s, _, k, e in sorted(out)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab.@+-_%0123456789 ()é\n", max_size=60))
def test_base_spans(text):
    assert pii.base_spans(text) == plain(text)


def test_base_spans_on_near_misses():
    rng = random.Random(3)
    bits = ["a.b@c.de", "x@y", "@", "1.2.3.4", "256.1.1.1", "1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999", "+12", "é", " ", ".", "0", "1.1.1.1.1.1.1.1"]
    for _ in range(2000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(8)))
        assert pii.base_spans(text) == plain(text)


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000, "a@" * 100_000, "1" * 300_000, "1." * 150_000, "+1" * 100_000, "a." * 100_000 + "@b"):
        pii._instances(text, pii.base_spans(text))


def test_discovery(spark):
    rows = [(k, f"call me at +1 555 010 {1000 + k} now") for k in range(6)] + [(k, f"mail to: u{k}@h.org please") for k in range(10, 16)]
    rows += [(20, "call me at 555-0199-22 now"), (21, "mail to: someone@localhost please"), (22, "there are 5550199 ways"), (23, None), (24, ""), (20, "call me at 555-0199-22 now"), (None, "x")]
    out = {}
    for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        out.setdefault(r.doc_id, []).append(([(s.kind, s.start, s.end) for s in r.base], [(s.kind, s.start, s.end) for s in r.found]))
    assert out[0] == [([("phone", 11, 26)], [])] and out[10][0][0] == [("email", 9, 18)]
    assert out[20] == [([], [("phone", 11, 22)])] * 2
    assert out[21] == [([], [("email", 9, 26)])]
    assert all(out[k] == [([], [])] for k in (22, 23, 24, None))
    assert sum(map(len, out.values())) == len(rows)


def test_second_round_uses_what_the_first_found(spark):
    """A pattern that occurs with found instances only becomes confident in the next round."""
    rows = [(100 + k, f"call me at +1 555 010 {1000 + k} now") for k in range(40)]
    rows += [(10 + k, f"call me at 555-0199-{20 + k} now") for k in range(6)] + [(30 + k, f"or dial 555-0199-{20 + k} instead") for k in range(6)]
    rows += [(50, "or dial 555-0188-77 instead")]
    found = {r.doc_id: len(r.found) for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[10] == found[30] == found[50] == 1 and found[100] == 0


def test_empty_table(spark):
    assert pii.find(spark.createDataFrame([], "doc_id long, text string, extra int")).count() == 0
