import re
from collections import Counter

from quern.llm.quality_rules import HostRules, beta_prior, host_verdicts, score_hosts

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    marked = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(marked),
        len(words) < 50 or 100 * len(marked) > 50 * len(words),
    )


def test_measures_are_those_of_plain_loops(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = score_hosts(documents).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id]), r.doc_id
        assert not (r.base_failed and r.kept)


def test_hard_rows(hard, nothing):
    rows = score_hosts(hard).collect()
    assert len(rows) == hard.count()
    assert all(r.kept is not None and r.base_failed is not None for r in rows)
    assert score_hosts(nothing).collect() == []


def test_a_host_is_rejected_by_its_shrunk_rate(spark):
    good = "alpha beta gamma delta " + " ".join(f"w{i}" for i in range(80))
    rows = [(i, good, f"good{i % 20}") for i in range(2000)]
    rows += [(5000 + i, "short" if i % 10 else good, "bad") for i in range(200)]
    rows += [(9000, "short", "one"), (9001, good, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in score_hosts(docs).collect()}
    assert not got[5000].kept and not got[5000].base_failed and got[5000].host_rejected  # good text, bad host
    assert got[0].kept and got[9001].kept  # one failure of two does not reject a host
    assert got[9001].host_rate < 0.6


def test_prior_without_hosts_or_spread(spark):
    none = spark.createDataFrame([], "n_docs long, n_failed long")
    assert beta_prior(none) == (0.5, 0.5)
    same = spark.createDataFrame([(10, 1)] * 5, "n_docs long, n_failed long")
    a, b = beta_prior(same)
    assert abs(a / (a + b) - 0.1) < 1e-9 and a + b > 900


def test_null_host_has_no_verdict(spark):
    df = spark.createDataFrame([(None, ["symbols"]), ("h", [])], "host string, failed array<string>")
    assert [r.host for r in host_verdicts(df, rules=HostRules()).collect()] == ["h"]
