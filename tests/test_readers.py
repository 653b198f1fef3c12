"""Readers of large, unlike and damaged files, against plain readers of the same bytes."""

import json
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quern.sources import corpus, json_ranges
from quern.sources.footers import parquet_footers, read_parquet_files, with_row_groups
from quern.sources.json_ranges import json_array_records, json_line_records, read_text_files


def any_value(rng, depth=0):
    text = lambda: "".join(rng.choice('a"\\[]{},: \né') for _ in range(rng.randint(0, 12)))
    kind = rng.randint(0, 4 if depth < 3 else 1)
    if kind < 2:
        return text()
    if kind == 2:
        return {text(): any_value(rng, depth + 1) for _ in range(rng.randint(0, 3))}
    return [any_value(rng, depth + 1) for _ in range(rng.randint(0, 3))] if kind == 3 else rng.choice([1, None, True, 2.5])


def in_ranges(raw, size):
    """The elements of an array, found range by range, each from its state alone."""
    read = lambda a, b: raw[a:b]
    quotes = depth = 0
    out = []
    for begin in range(0, max(len(raw), 1), size):
        end = min(begin + size, len(raw))
        escaped, inside = json_ranges._odd_run(read, begin), quotes % 2 == 1
        out += json_ranges._elements(read, len(raw), begin, end, inside, depth)
        found = json_ranges.scan(read(begin, end), inside, escaped)
        quotes += found.quotes
        depth += int(json_ranges._DEEPER[found.chars].sum())
    return out


def test_short_ranges_read_little_beyond_their_ends():
    """Before, a range read a whole step beyond its end, which was the rest of the file."""
    raw = json.dumps(["x" * 500] * 2000).encode()
    taken = []

    def read(begin, end):
        taken.append(end - begin)
        return raw[begin:end]

    quotes = depth = count = 0
    for begin in range(0, len(raw), 10_000):
        end = min(begin + 10_000, len(raw))
        count += sum(1 for _ in json_ranges._elements(read, len(raw), begin, end, quotes % 2 == 1, depth))
        found = json_ranges.scan(raw[begin:end], quotes % 2 == 1, False)
        quotes += found.quotes
        depth += int(json_ranges._DEEPER[found.chars].sum())
    assert count == 2000
    assert sum(taken) < 3 * len(raw)



@pytest.fixture
def small_steps(monkeypatch):
    monkeypatch.setattr(json_ranges, "STEP", 7)


def test_arrays_in_ranges_of_any_size(small_steps):
    rng = random.Random(5)
    for _ in range(1500):
        doc = [any_value(rng) for _ in range(rng.randint(0, 6))]
        raw = json.dumps(doc, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1])).encode()
        raw = rng.choice([b"", b" \n"]) + raw + rng.choice([b"", b"\n "])
        found = in_ranges(raw, rng.choice([1, 2, 3, 5, 8, 16, 64, 1000]))
        assert [(json.loads(v), p) for _, v, p in found] == [(x, "") for x in doc]
        assert all(raw[a : a + len(v)] == v for a, v, _ in found)


def test_damaged_arrays_are_noticed(small_steps):
    rng, damaged = random.Random(6), 0
    for _ in range(1500):
        raw = bytearray(json.dumps([any_value(rng) for _ in range(rng.randint(0, 6))]).encode())
        at = rng.randrange(len(raw))
        raw[at : at + rng.randint(0, 1)] = rng.choice([b"", b"[", b"]", b",", b'"', b"x", b"}"])
        raw = bytes(raw[: len(raw) - rng.choice([0, 0, 1])])
        try:
            expected = json.loads(raw)
        except ValueError:
            expected = None
        for size in (3, 1000):
            found = in_ranges(raw, size)
            try:
                values = None if any(p for *_, p in found) else [json.loads(v) for _, v, _ in found]
            except ValueError:
                values = None
            assert values == (expected if isinstance(expected, list) else None)
            damaged += values is None
    assert damaged > 1000


def test_lines_in_ranges_of_any_size(small_steps):
    rng = random.Random(7)
    for _ in range(1500):
        raw = b"".join(rng.choice([b"a", b"bc", b"\n", b"\r\n", b"\r", b"", b" "]) for _ in range(rng.randint(0, 30)))
        size = rng.choice([1, 2, 3, 7, 100])
        found = []
        for begin in range(0, max(len(raw), 1), size):
            found += [x for x in json_ranges._lines(lambda a, b: raw[a:b], len(raw), begin, min(begin + size, len(raw))) if x[1].strip()]
        assert [x for _, x in found] == [x for x in raw.replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n") if x.strip()]
        assert [x for x in json_ranges._stream_lines(raw[i : i + 4] for i in range(0, len(raw), 4)) if x[1].strip()] == found


def put(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())


def rows(df, *names):
    return sorted(tuple(r[n] if n != "source" else r.source.rsplit("/", 1)[1] for n in names) for r in df.collect())


def test_values_larger_than_the_sql_parser_takes(spark, tmp_path):
    """An element and a line of 25 MB each, and an array of 30 MB, in ranges of one."""
    big = "x\\" * 12_500_000
    many = [{"text": f"{i} " + "y" * 10_000} for i in range(3000)]
    put(tmp_path / "one.json", json.dumps(["a", big, "b"]))
    put(tmp_path / "many.json", json.dumps(many))
    put(tmp_path / "l.jsonl", json.dumps({"text": "first"}) + "\n" + json.dumps({"text": big}) + "\n" + json.dumps("last"))
    files = corpus.list_corpus(spark, str(tmp_path), "json")
    good, bad = json_array_records(files, size=1 << 20)
    found = good.select("source", "row_index", F.length("text").alias("n"), F.substring("text", 1, 5).alias("begin"))
    assert rows(found.where("source LIKE '%one.json'"), "row_index", "n") == [(0, 1), (1, len(big)), (2, 1)]
    assert rows(found.where("source LIKE '%many.json'"), "row_index", "begin") == [(i, x["text"][:5]) for i, x in enumerate(many)]
    assert bad.collect() == []
    lines = json_line_records(corpus.list_corpus(spark, str(tmp_path), "jsonl"), size=1 << 20)
    assert rows(lines.select(F.length("text").alias("n"), "stage"), "n", "stage") == [(4, None), (5, None), (len(big), None)]


def test_shapes_of_arrays(spark, tmp_path):
    shapes = {
        "strings": '["a", "b\\ud800"]', "objects": '[{"text": "a", "z": [1, {"q": "]"}]}, {"other": 1}, {"text": "c"}]', "empty": " [ ] ",
        "mixed": '["a", {"text": "b"}]', "numbers": "[1, 2]", "object": '{"text": "a"}', "string": '"a"', "nothing": "", "blank": " \n ",
        "two": '["a"] ["b"]', "open": '["a", "b"', "comma": '["a",]', "latin": b'["\xe9"]', "odd_text": '[{"text": 5}, {"text": "d"}]',
    }
    for name, data in shapes.items():
        put(tmp_path / f"{name}.json", data)
    for size in (4, 1 << 20):
        good, bad = json_array_records(corpus.list_corpus(spark, str(tmp_path), "json"), size=size)
        assert rows(good, "source", "row_index", "text") == [
            ("objects.json", 0, "a"), ("objects.json", 2, "c"), ("odd_text.json", 1, "d"), ("strings.json", 0, "a"), ("strings.json", 1, "b\ufffd\ufffd\ufffd"),
        ]
        refused = ["blank", "comma", "latin", "mixed", "numbers", "object", "odd_text", "open", "string", "two"]
        assert rows(bad, "source", "stage") == [(f"{n}.json", "parse") for n in refused]


def test_damaged_files_beside_good_ones(spark, tmp_path):
    lines = "".join(json.dumps({"text": f"line {i}"}) + "\n" for i in range(2000)).encode()
    packed = pa.compress(lines, codec="zstd", asbytes=True)
    put(tmp_path / "good.jsonl.zst", packed)
    put(tmp_path / "twice.jsonl.zst", packed + packed)
    put(tmp_path / "cut.jsonl.zst", packed[: len(packed) // 2])
    put(tmp_path / "none.jsonl.zst", b"nothing of the kind")
    put(tmp_path / "a b%20c.JSONL", '"one"\n{"text": null}\n{"body": "x"}\nbroken\n"two"')
    put(tmp_path / "t.txt", b" one \r\n\r\n \xe9\xe8 \ntwo")
    put(tmp_path / "x.csv", "a,b")
    table = pa.table({"text": [f"row {i} " + "abc" * 50 for i in range(1000)]})
    pq.write_table(table, tmp_path / "p q%41.PARQUET", row_group_size=300)
    pq.write_table(table, tmp_path / "page.parquet", row_group_size=1000, compression="none", use_dictionary=False)
    raw = bytearray((tmp_path / "page.parquet").read_bytes())
    raw[4:60] = b"\xff" * 56  # the first page's header
    (tmp_path / "page.parquet").write_bytes(bytes(raw))
    (tmp_path / "footer.parquet").write_bytes(bytes(raw[:-9]))
    good, bad = corpus.read_any(spark, corpus._list_files(spark, str(tmp_path), "*"))
    counts = rows(good.groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("row_index").alias("m")), "source", "n", "m")
    whole = [c for c in counts if not c[0].startswith("cut")]
    assert whole == [("a b%20c.JSONL", 2, 2), ("good.jsonl.zst", 2000, 2000), ("p q%41.PARQUET", 1000, 1000), ("t.txt", 2, 2), ("twice.jsonl.zst", 4000, 4000)]
    assert rows(bad, "source", "stage") == [
        ("a b%20c.JSONL", "parse"), ("a b%20c.JSONL", "parse"), ("a b%20c.JSONL", "parse"), ("cut.jsonl.zst", "read"), ("footer.parquet", "read"),
        ("none.jsonl.zst", "read"), ("page.parquet", "rows"), ("t.txt", "parse"), ("x.csv", "unsupported"),
    ]


def test_a_file_that_is_gone_is_a_row(spark, tmp_path):
    files = spark.createDataFrame([(f"{tmp_path}/gone.{e}", e, 100) for e in ("json", "jsonl", "zst", "txt", "parquet")], "path string, ext string, bytes long")
    good, bad = corpus.read_any(spark, files)
    assert good.collect() == [] and rows(bad, "stage") == [("read",)] * 5


def test_text_columns_by_file(spark, tmp_path):
    def write(name, **columns):
        pq.write_table(pa.table(columns), tmp_path / f"{name}.parquet")

    write("a", text=["x", None, " ", "y"], story=["1", "2", "3", "4"])
    write("b", MyText=["z"], content=["q"])
    write("c", other=[1], document=["d"])
    write("d", text=[1, 2])
    write("e", text=pa.array(["k", "k"]).dictionary_encode(), n=[1, 2])
    write("f", **{"odd `text`": ["w"]})
    footers = parquet_footers(corpus.list_corpus(spark, str(tmp_path), "parquet"))
    good, bad = read_parquet_files(spark, footers)
    assert rows(good, "source", "row_index", "text") == [
        ("a.parquet", 0, "x"), ("a.parquet", 3, "y"), ("b.parquet", 0, "z"), ("e.parquet", 0, "k"), ("e.parquet", 1, "k"), ("f.parquet", 0, "w"),
    ]
    assert rows(bad, "source", "stage", "excerpt") == [("c.parquet", "column", "other,document"), ("d.parquet", "column", "text")]
    good, bad = read_parquet_files(spark, footers, candidates=("text", "content", "story", "document", "string"))
    assert rows(good, "source", "text") == [("a.parquet", " "), ("a.parquet", "x"), ("a.parquet", "y"), ("b.parquet", "q"), ("c.parquet", "d"), ("e.parquet", "k"), ("e.parquet", "k")]
    assert rows(bad, "source") == [("d.parquet",), ("f.parquet",)]
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<content:string" in plan and "MyText" not in plan


def test_row_groups_of_rows(spark, tmp_path):
    pq.write_table(pa.table({"text": [str(i) for i in range(10_000)]}), tmp_path / "a.parquet", row_group_size=4097)
    pq.write_table(pa.table({"text": [str(i) for i in range(7)]}), tmp_path / "b.parquet", row_group_size=3)
    footers = parquet_footers(corpus.list_corpus(spark, str(tmp_path), "parquet"))
    docs, _ = read_parquet_files(spark, footers)
    found = with_row_groups(docs, footers)
    got = {(r.source.rsplit("/", 1)[1], r.row_index): r.row_group for r in found.collect()}
    expected = {("a.parquet", i): i // 4097 for i in range(10_000)} | {("b.parquet", i): i // 3 for i in range(7)}
    assert got == expected


def test_text_files_are_read_in_ranges(spark, tmp_path):
    text = "".join(f" {'é' * (i % 50)} {i}\t\n" for i in range(3000))
    put(tmp_path / "t.txt", text)
    good, bad = read_text_files(corpus.list_corpus(spark, str(tmp_path), "txt").select("path", "bytes"), size=997)
    assert [r.text for r in good.orderBy("row_index").collect()] == [x.strip() for x in text.splitlines()] and bad.collect() == []
