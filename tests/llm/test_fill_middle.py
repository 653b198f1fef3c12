"""Fill-in-the-middle against a loop over single characters, and its round trip."""

import hashlib
import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm.fill_middle import FillSetup, fill_in_middle, rearrange, restore, restored, unit_cuts


def units(text):
    out = []
    for c in text:
        if out and c in string.ascii_letters and out[-1][-1] in string.ascii_letters:
            out[-1] += c
        else:
            out.append(c)
    return out


def by_loop(key, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    u = units(text)
    low, high = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:low]), "".join(u[low:high]), "".join(u[high:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(u), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_hard_rows(spark, hard):
    marked = spark.createDataFrame([(50, "a<P>b", "x"), (51, "a < P<S<M b", "x"), (52, "<", "x"), (53, "<<<<S<P", "x")], "doc_id long, text string, n string")
    docs = hard.withColumnRenamed("key", "form").unionByName(marked, allowMissingColumns=True)
    made = fill_in_middle(docs, ["doc_id", "text"])
    rows = made.select("*", restored("output", "form").alias("back")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        key = "null" if r.doc_id is None else r.doc_id
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == by_loop(key, r.text)
        assert r.back == (r.text or "")
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_empty_table(nothing):
    assert fill_in_middle(nothing, ["doc_id"]).collect() == []


def test_names_of_results_are_refused(hard):
    with pytest.raises(ValueError):
        fill_in_middle(hard.withColumnRenamed("score", "Output"), ["Output"])


@pytest.mark.parametrize("text", ["x" * 3_000_000, "1" * 700_000, "ab, " * 300_000, "漢" * 600_000 + "end"])
def test_long_texts_in_windows(text):
    for h in ((5, 7), (123_456_789, 987_654_321), (0, 0)):
        whole = unit_cuts(text, *h, window=1 << 30)
        assert unit_cuts(text, *h) == whole
        assert unit_cuts(text, *h, window=99_991) == whole


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab<>PSM \né", max_size=30), *[st.integers(0, 2**32 - 1)] * 4)
def test_round_trip(text, a, b, c, d):
    n, form, prefix, middle, output = rearrange(text, (a, b, c, d), FillSetup(window=4))
    assert n == len(units(text)) and restore(output, form) == text
    if form != "plain":
        assert len(output) == len(text) + 9 and prefix + middle <= len(text)
