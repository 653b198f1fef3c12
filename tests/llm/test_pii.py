import hashlib
import re

from quern.llm.pii import KINDS, detect_pii, mask, mask_pii, spans_text
from pyspark.sql import functions as F


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


SHAPES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    """By the shapes as they are usually written."""
    out = []
    for kind, pattern in SHAPES.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]
            if ok():
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_is_that_of_plain_loops(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    found = detect_pii(documents, ["doc_id"]).select("doc_id", spans_text("base").alias("b"), spans_text("spans").alias("s"))
    rows = found.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.b == brute(texts[r.doc_id]), r.doc_id
        assert not r.b or set(r.b.split(",")) <= set(r.s.split(","))
        starts = [(KINDS.index(k), int(a)) for k, a, _ in (x.split(":") for x in r.s.split(",") if x)]
        assert starts == sorted(starts)
    assert any(r.b for r in rows)


def test_contexts_find_unseen_identifiers(spark):
    secret = lambda i: hashlib.sha1(str(i).encode()).hexdigest()
    rows = [(i, f'prose number {i} goes on: token = "{secret(i)}" and ends') for i in range(40)]
    rows.append((100, 'here the token = "short-7x9" is an unseen one'))
    rows.append((101, 'here the colour = "short-7x9" is none'))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.s for r in detect_pii(df, ["doc_id"]).select("doc_id", spans_text("spans").alias("s")).collect()}
    assert got[0].startswith("secret:")
    assert got[100] == "secret:18:27"
    assert got[101] == ""


def test_numbers_of_any_length_in_addresses(spark):
    texts = ["1.2.3.4", "01.002.0003.4", "1.2.3.99999999999999999999", "256.1.1.1", "1.2.3.4.5.6.7.8", "0000000000255.1.1.1", "00000000000000000001000.1.1.1"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in detect_pii(df, ["doc_id"]).select("doc_id", spans_text("base").alias("b")).collect():
        assert r.b == brute(texts[r.doc_id]), texts[r.doc_id]


def test_hard_rows(hard, nothing):
    rows = detect_pii(hard, ["doc_id"]).collect()
    assert len(rows) == hard.count()
    assert detect_pii(nothing, ["doc_id"]).collect() == []


def test_masking(spark, hard):
    spans = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(a).alias("start"), F.lit(b).alias("end")) for k, a, b in ((1, 2, 4), (0, 6, 9), (3, 6, 7))])
    assert spark.range(1).select(mask(F.lit("abcdé\U0001f600ghijk"), spans).alias("m")).first().m == "ab<IP>é\U0001f600<EMAIL>jk"
    out = mask_pii(hard)
    assert out.columns == hard.columns
    by_id = {r.doc_id: r.text for r in out.collect()}
    assert by_id[0] is None and by_id[1] == ""
    assert by_id[18] == "mail <EMAIL> or <PHONE>, card <CARD>, host <IP> and 10.0.0.256"


def test_long_runs(spark):
    """Shapes that repeat very often in one match; the pattern before would end the whole JVM."""
    texts = ["7" * 9000, "7 " * 9000, "a@b" + ".c" * 9000, "a@b.c_d@e.f and 1.2.3.45.6.7.8 x", "12345678901234567890" * 3 + ".1.2.3"]
    texts += ["a@b" + "-" * 5000, "+1" + "-2" * 5000, "4111 1111 1111 1111 " * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in detect_pii(df, ["doc_id"]).select("doc_id", spans_text("base").alias("b")).collect():
        assert r.b == brute(texts[r.doc_id]), r.doc_id


def test_counts_by_kind(spark, tmp_path):
    """The counts of the query are those of its own base spans, whatever kinds come together."""
    from quern.llm.queries import op7_pii

    texts = ["host 10.0.0.1", "a@b.cc and c@d.ee", "card 4111 1111 1111 1111, call +1 301 555 0346", "a@b.cc 10.0.0.1 10.0.0.2, 4111111111111111", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in op7_pii(spark, str(tmp_path)).collect()}
    kinds = {i: [x.split(":")[0] for x in brute(t).split(",")] for i, t in enumerate(texts)}
    assert got == {i: tuple(k.count(x) for x in SHAPES) for i, k in kinds.items()}
    assert got[3] == (1, 2, 1, 0)


def test_texts_without_candidates_are_not_joined(spark):
    """Before, every text was shuffled to meet the unseen identifiers of a few."""
    token = lambda i: hashlib.sha1(str(i).encode()).hexdigest()
    rows = [(i, f'prose number {i} goes on: token = "{token(i)}" and ends') for i in range(40)]
    rows += [(100, 'here the token = "short-7x9" is an unseen one'), (101, "plain words"), (101, "plain words"), (None, None)]
    found = detect_pii(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id", "text"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "(size(candidates" in plan
    got = [(r.doc_id, r.text, r.s) for r in found.select("doc_id", "text", spans_text("spans").alias("s")).collect()]
    assert sorted((i, t) for i, t, _ in got if i is not None) == sorted(rows[:-1])
    assert {i: s for i, _, s in got if i is None or i >= 100} == {100: "secret:18:27", 101: "", None: ""}
