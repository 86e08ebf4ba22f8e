"""The fixed patterns of personal data: long runs, leading zeros, and the plain regular expressions."""

import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from motorpool.llm.private_data import base_spans

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
}


def plain(text):
    out = [("email", *m.span()) for m in re.finditer(PLAIN["email"], text)]
    for m in re.finditer(PLAIN["ip"], text):
        if all(int(p.lstrip("0")[:9] or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a_-.@0125 %", max_size=40))
def test_spans_equal_the_plain_patterns(text):
    assert [s for s in base_spans(text) if s[0] in PLAIN] == plain(text)


def test_leading_zeros_without_bound():
    assert base_spans("0" * 5000 + ".1.1.1") == [("ip", 0, 5006)]
    assert base_spans("9" * 5000 + ".1.1.1") == []
    assert base_spans("a@b.com_x@y.z 1.2.3.4.5.6.7.256") == plain("a@b.com_x@y.z 1.2.3.4.5.6.7.256")


def test_long_runs_take_linear_time():
    began = time.perf_counter()
    for run in ("a" * 1_000_000, "1" * 1_000_000, "1." * 500_000, "a@" * 500_000, "+" + "(" * 1_000_000):
        base_spans(run + " @ . +")
    assert time.perf_counter() - began < 20
