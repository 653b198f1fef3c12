import json
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quern.functions import text as tx
from quern.sources import corpus, export, packed, requests, special_tokens, telemetry


def put(root, name, content):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())


def zst(text):
    sink = pa.BufferOutputStream()
    with pa.CompressedOutputStream(sink, "zstd") as out:
        out.write(text.encode())
    return sink.getvalue().to_pybytes()


@pytest.fixture
def tree(tmp_path):
    put(tmp_path, "train/a.txt", " one \n\n\t\ntwo\n")
    put(tmp_path, "train/deep/b.jsonl", '"plain"\n{"text": "object"}\n{"content": "other"}\n{broken\n5\n{"text": null}\n\n')
    put(tmp_path, "validation/c.jsonl.zst", zst('{"id": 1, "content": "c1", "data": "d"}\n"s"\n{"text": null, "content": "x"}\nbad\n'))
    put(tmp_path, "test/d.json", '["x", "y"]')
    put(tmp_path, "test/e.json", '[{"text": "z"}, {"no": 1}]')
    put(tmp_path, "test/f.json", '{"text": "not an array"}')
    put(tmp_path, "val/g.csv", "a,b\n")
    put(tmp_path, "elsewhere/h.txt", "not searched\n")
    return tmp_path


def test_auto_listing(spark, tree):
    got = {(r.path.rsplit("/", 1)[1], r.ext, r.subset) for r in corpus.list_corpus(spark, str(tree)).collect()}
    assert got == {
        ("a.txt", "txt", "train"),
        ("b.jsonl", "jsonl", "train"),
        ("c.jsonl.zst", "jsonl.zst", "validation"),
        ("d.json", "json", "test"),
        ("e.json", "json", "test"),
        ("f.json", "json", "test"),
        ("g.csv", "csv", ""),
    }


def test_listing_by_extension_and_subset(spark, tree):
    assert corpus.list_corpus(spark, str(tree), "txt").count() == 2
    assert corpus.list_corpus(spark, str(tree), "txt", subset="train").count() == 1
    with pytest.raises(FileNotFoundError):
        corpus.list_corpus(spark, str(tree), "parquet")
    with pytest.raises(FileNotFoundError):
        corpus.list_corpus(spark, str(tree / "absent"), "txt")


def test_single_subdirectory_named_like_the_dataset(spark, tmp_path):
    put(tmp_path, "corpus/train/a.txt", "x\n")
    put(tmp_path, "corpus/notes.txt", "x\n")
    names = lambda df: {r.path.rsplit("/", 1)[1] for r in df.collect()}
    assert names(corpus.list_corpus(spark, str(tmp_path), dataset_name="custom-team-corpus")) == {"a.txt"}
    assert names(corpus.list_corpus(spark, str(tmp_path), dataset_name="custom-other")) == {"a.txt", "notes.txt"}


def texts(df):
    return sorted(r.text for r in df.collect())


def test_readers(spark, tree):
    assert texts(corpus.read_txt(spark, str(tree / "train"))) == ["one", "two"]
    good, bad = corpus.read_corpus(spark, str(tree), "jsonl")
    assert texts(good) == ["object", "plain"]
    assert sorted(r.excerpt for r in bad.collect()) == ["5", '{"content": "other"}', '{"text": null}', "{broken"]
    good, bad = corpus.read_corpus(spark, str(tree), "jsonl.zst")
    assert texts(good) == ["c1", "s"]
    assert bad.count() == 2
    good, bad = corpus.read_corpus(spark, str(tree), "json")
    assert [(r.row_index, r.text) for r in sorted(good.collect(), key=lambda r: r.text)] == [(0, "x"), (1, "y"), (0, "z")]
    assert bad.count() == 1
    with pytest.raises(ValueError):
        corpus.read_corpus(spark, str(tree), "csv")


def test_everything_at_once(spark, tree):
    listed = corpus.list_corpus(spark, str(tree))
    docs, bad = corpus.read_any(spark, listed)
    assert {"one", "plain", "c1", "x", "z"} <= set(texts(docs))
    assert [r.excerpt for r in bad.where("stage = 'unsupported'").collect()] == ["csv"]


def test_only_the_listed_files_are_read(spark, tmp_path):
    for name in ("a.txt", "b c.txt", "train/d.txt"):
        put(tmp_path, name, f"text of {name}")
    put(tmp_path, "e.jsonl", json.dumps({"text": "text of e"}))
    listed = corpus._list_files(spark, str(tmp_path), "*.{txt,jsonl}")
    for wanted in ({"a.txt"}, {"b c.txt", "e.jsonl"}, {"d.txt"}):
        chosen = listed.filter(F.substring_index(F.regexp_replace("path", "%20", " "), "/", -1).isin(list(wanted)))
        docs, bad = corpus.read_any(spark, chosen)
        assert {r.text.split("/")[-1].split(" of ")[-1].split(".")[0] for r in docs.collect()} == {w.split(".")[0] for w in wanted}
        assert bad.collect() == []


def test_line_keys_follow_the_file_across_splits(spark, tmp_path):
    put(tmp_path, "big.txt", "".join(f"line {i:06d} {'x' * 60}\n" for i in range(20_000)))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        df = corpus.read_txt(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 3
        got = [r.text for r in df.orderBy("row_index").collect()]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert [int(t.split()[1]) for t in got] == list(range(20_000))


def test_parquet_text_columns(spark, tmp_path):
    a = spark.createDataFrame([("x", "1"), ("", "2"), (None, "3"), (" \t\n", "4"), ("y", "5")], "Body_Text string, other string")
    a.coalesce(1).write.parquet(str(tmp_path / "a"))
    got = corpus.read_parquet_text(spark, str(tmp_path / "a"), "text").orderBy("row_index").collect()
    assert [(r.row_index, r.text) for r in got] == [(0, "x"), (4, "y")]
    with pytest.raises(ValueError):
        corpus.read_parquet_text(spark, str(tmp_path / "a"), strict=True)
    a.select("other").coalesce(1).write.parquet(str(tmp_path / "b"))
    assert corpus.read_parquet_text(spark, str(tmp_path / "b"), "text").count() == 0
    a.select(F.col("Body_Text").alias("story"), F.col("other").alias("string")).coalesce(1).write.parquet(str(tmp_path / "c"))
    assert texts(corpus.read_parquet_text(spark, str(tmp_path / "c"), strict=True)) == ["", " \t\n", "x", "y"]


def test_only_the_text_column_is_scanned(spark, tmp_path):
    spark.range(5).selectExpr("id", "string(id) as text", "id * 2 as wide").write.parquet(str(tmp_path / "p"))
    plan = corpus.read_parquet_text(spark, str(tmp_path / "p"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string,_tmp_metadata_row_index:bigint>" in plan


def test_requests(spark, tmp_path):
    put(tmp_path, "r.json", json.dumps({"data": [{"text": "t", "format": "parquet", "batch_size": 8}], "params": {"model_name": "m"}}, indent=1))
    put(
        tmp_path,
        "b.json",
        json.dumps({"batch_data": [{"text": "1", "format": "p"}, {"text": "2", "format": "p"}], "batch_params": {"model_name": "n", "batch_size": 4}}, indent=1),
    )
    got = requests.read_requests(spark, str(tmp_path)).drop("source").collect()
    assert sorted(tuple(r) for r in got) == [
        ("batch", 0, "1", "p", 4, "n"),
        ("batch", 1, "2", "p", 4, "n"),
        ("realtime", 0, "t", "parquet", 8, "m"),
    ]


def test_special_tokens(spark, tmp_path):
    flags = {"lstrip": False, "normalized": False, "rstrip": True, "single_word": False, "special": True}
    put(
        tmp_path,
        "tokenizer_config.json",
        json.dumps({"added_tokens_decoder": {"0": {"content": "<unk>", **flags}, "7": {"content": "<pad>", **flags}}, "bos_token": {"content": "<unk>"}, "pad_token": "<pad>"}, indent=2),
    )
    put(tmp_path, "added_tokens.json", json.dumps({"<pad>": 7, "<extra>": 9}))
    table = special_tokens.read_special_tokens(spark, str(tmp_path))
    assert sorted((r.token, r.id, r.rstrip) for r in table.collect()) == [("<extra>", 9, False), ("<pad>", 7, True), ("<unk>", 0, True)]
    roles = special_tokens.read_token_roles(spark, str(tmp_path)).first()
    assert (roles.bos_token, roles.pad_token, roles.eos_token) == ("<unk>", "<pad>", None)
    assert special_tokens.check_special_tokens(table, {"pad": "<pad>"}) == {"pad": 7}
    with pytest.raises(ValueError):
        special_tokens.check_special_tokens(table, {"eos": "<eos>"})


def test_telemetry_files(spark, tmp_path):
    put(tmp_path, "c.json", '{"run_id": "a", "config": {"seq_len": 4096, "name": "x"}}\n')
    assert telemetry.read_run_config(spark, str(tmp_path / "c.json")).first().config == {"seq_len": "4096", "name": "x"}
    spark.createDataFrame([("a", 1.0)], "run_id string, `gpu.0.power` double").write.parquet(str(tmp_path / "h"))
    assert telemetry.read_telemetry(spark, str(tmp_path / "h")).columns == ["run_id", "gpu.0.power"]


def test_chunk_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(0, [1, 2, 65535]), (1, [4, 5, 6])], "chunk_no long, tokens array<int>")
    packed.write_chunks(df, str(tmp_path / "o"), "train_x_0", "uint16", "chunk_no")
    names = sorted(p.name for p in (tmp_path / "o").iterdir())
    assert names == ["_SUCCESS", "train_x_0_0000000000.bin", "train_x_0_0000000001.bin"]
    raw = (tmp_path / "o" / names[1]).read_bytes()
    assert raw == b"LITPKDS" + struct.pack("<Q", 1) + bytes([8]) + struct.pack("<Q", 3) + struct.pack("<3H", 1, 2, 65535)
    back = packed.read_chunks(spark, str(tmp_path / "o")).orderBy("path").collect()
    assert [(r.dtype, r.chunk_size, r.tokens) for r in back] == [("uint16", 3, [1, 2, 65535]), ("uint16", 3, [4, 5, 6])]


def test_names_are_never_shared(spark, tmp_path):
    """Two rows of a name, in one task or in two, and a name that is taken: nothing is published."""
    twice = spark.createDataFrame([(0, [1, 2]), (0, [3, 4])], "counter long, tokens array<int>")
    for n, df in enumerate((twice.coalesce(1), twice.repartition(2))):
        with pytest.raises(Exception, match="two rows|claimed twice"):
            packed.write_chunks(df, str(tmp_path / str(n)), "p", "uint16")
        assert not [p for p in (tmp_path / str(n)).rglob("*") if p.is_file()]
    packed.write_chunks(twice.limit(1), str(tmp_path / "o"), "p", "uint16")
    with pytest.raises(Exception, match="already taken"):
        packed.write_chunks(twice.limit(1), str(tmp_path / "o"), "p", "uint16")
    assert sorted(p.name for p in (tmp_path / "o").iterdir()) == ["_SUCCESS", "p_0000000000.bin"]


def test_a_failing_task_leaves_nothing(spark, tmp_path):
    df = spark.createDataFrame([(i, [i, 70000 if i == 7 else 1]) for i in range(8)], "counter long, tokens array<int>").repartition(4)
    with pytest.raises(Exception, match="outside uint16"):
        packed.write_chunks(df, str(tmp_path / "o"), "p", "uint16")
    # A task that still runs while the job is aborted may leave its attempt, in a hidden folder.
    assert not [p for p in (tmp_path / "o").rglob("*") if p.is_file() and "_staging" not in str(p)]
    assert packed.read_chunks(spark, str(tmp_path / "o")).collect() == []


def test_chunks_of_all_sources_under_one_prefix(spark, tmp_path):
    from quern.plans.prepare import prepare_chunks

    rows = [(f"s{i % 3}", i, "a b c " * (i + 1)) for i in range(12)]
    docs = spark.createDataFrame(rows, "source string, row_index long, text string")
    vocab = spark.createDataFrame([("a", 3), ("b", 4), ("c", 5)], "token string, id int")
    chunks = prepare_chunks(docs, vocab, 14, train_ratio="0.75").cache()
    packed.write_chunks(chunks, str(tmp_path / "o"), F.concat("split", F.lit("/"), "split"), "uint16")
    back = packed.read_chunks(spark, str(tmp_path / "o"))
    assert back.count() == chunks.count()
    assert sorted(r.tokens for r in back.collect()) == sorted(r.tokens for r in chunks.collect())


def test_bad_chunk_files_are_refused(spark, tmp_path):
    put(tmp_path, "a.bin", b"NOTPACK" + bytes(17))
    with pytest.raises(Exception, match="not a packed token file"):
        packed.read_chunks(spark, str(tmp_path)).collect()
    with pytest.raises(ValueError):
        packed.parse_header(b"LITPKDS" + struct.pack("<QBQ", 2, 8, 1))
    with pytest.raises(ValueError):
        packed.parse_header(b"LITPKDS" + struct.pack("<QBQ", 1, 99, 1))


def test_wide_ids_are_refused(spark, tmp_path):
    df = spark.createDataFrame([(0, [70000])], "chunk_no long, tokens array<int>")
    with pytest.raises(Exception, match="outside uint16"):
        packed.write_chunks(df, str(tmp_path / "o"), "p", "uint16", "chunk_no")
    packed.write_chunks(df, str(tmp_path / "p"), "p", "int32", "chunk_no")
    assert packed.read_chunks(spark, str(tmp_path / "p")).first().tokens == [70000]


def test_shards(spark, tmp_path):
    data = [(3, 0, "train", 0, 0, [1, 2]), (3, 0, "train", 0, 1, [3]), (3, 1, "train", 2, 0, [4]), (5, 0, "", 0, 0, [6])]
    df = spark.createDataFrame(data, "shard_id long, part long, subset string, batch_no long, seq_no long, tokens array<int>")
    packed.write_shards(df.repartition(3), str(tmp_path / "o"), 4)
    back = {r.path.split("/o/")[1]: r.tokens for r in packed.read_shards(spark, str(tmp_path / "o"), 4).collect()}
    assert back == {
        "train/tokens_shard_000003_000000.ds": [1, 2, 3],
        "train/tokens_shard_000003_000001.ds": [4],
        "tokens_shard_000005_000000.ds": [6],
    }


def test_export_resumes(spark, tmp_path):
    for i in range(7):
        put(tmp_path / "src", f"d{i % 2}/f{i}.bin", f"content {i}")
    files = corpus.list_corpus(spark, str(tmp_path / "src"), "bin")
    plan = export.export_plan(files, chunk_size=3, start_chunk=1)
    assert sorted(r.chunk_id for r in plan.collect()) == [1, 1, 1, 2]
    manifest = export.export_files(plan, str(tmp_path / "src"), str(tmp_path / "dst"))
    manifest.write.parquet(str(tmp_path / "manifest"))
    done = spark.read.parquet(str(tmp_path / "manifest"))
    stats = export.export_stats(done).first()
    assert (stats.total_files, stats.succeeded, stats.failed) == (4, 4, 0)
    copied = sorted(p.relative_to(tmp_path / "dst").as_posix() for p in (tmp_path / "dst").rglob("*.bin"))
    assert len(copied) == 4 and all((tmp_path / "src" / c).read_bytes() == (tmp_path / "dst" / c).read_bytes() for c in copied)
    rest = export.export_plan(files, done, chunk_size=3)
    assert sorted(r.chunk_id for r in rest.collect()) == [0, 0, 0]
    missing = spark.createDataFrame([(str(tmp_path / "src/none.bin"), 0)], "path string, chunk_id long")
    failed = export.export_files(missing, str(tmp_path / "src"), str(tmp_path / "dst"), attempts=2).first()
    assert failed.status == "failed" and failed.error


def test_text_predicates(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("\t\n",), (" ",), (" a ",)], "text string")
    assert [r.text for r in tx.drop_blank(df).collect()] == [" a "]
    assert tx.drop_null(df).count() == 5
    paths = ["/d/train/x", "/d/training/x", "/d/test/train/x", "/d/validation", "/d/x"]
    p = spark.createDataFrame([(x,) for x in paths], "path string")
    assert [r.subset for r in tx.with_subset(p).collect()] == ["train", "", "test", "validation", ""]
    urls = spark.createDataFrame([("https://wandb.ai/e/p/runs/r1?x=2",), ("https://example.org/e",), (None,)], "u string")
    got = [tuple(r.s) for r in urls.select(tx.split_run_url(F.col("u")).alias("s")).collect()]
    assert got == [("e", "p", "r1", True), (None, None, None, False), (None, None, None, False)]
    good = spark.createDataFrame([("https://wandb.ai/e/p/runs/r1?x=2",)], "u string")
    assert good.select(tx.parse_run_url(F.col("u")).alias("s")).first().s.run_id == "r1"
    with pytest.raises(Exception, match="malformed run address"):
        urls.select(tx.parse_run_url(F.col("u"))).collect()
    assert tx.preview(F.col("x"))[0] is not None


def test_an_export_goes_on_from_its_manifest(spark, tmp_path):
    """A file that fails is recorded, tried again by the next call, and the others are not copied twice."""
    for i in range(9):
        put(tmp_path / "src", f"d{i % 2}/f{i}.bin", f"content {i}")
    files = corpus.list_corpus(spark, str(tmp_path / "src"), "bin").cache()
    files.count()
    (tmp_path / "src" / "d1" / "f5.bin").rename(tmp_path / "away")
    call = lambda start=0: export.export(
        spark, files, str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "manifest"), chunk_size=2, start_chunk=start, chunks_per_round=2, attempts=2, wait=0.01
    )
    first = {r.path.rsplit("/", 1)[1]: (r.chunk_id, r.status, r.finished) for r in call(1).collect()}
    assert {n: s for n, (_, s, _) in first.items()} == {f"f{i}.bin": "failed" if i == 5 else "ok" for i in (1, 3, 4, 5, 6, 7, 8)}
    (tmp_path / "away").rename(tmp_path / "src" / "d1" / "f5.bin")
    second = {r.path.rsplit("/", 1)[1]: (r.chunk_id, r.status, r.finished) for r in call().collect()}
    assert len(second) == 9 and all(s == "ok" for _, s, _ in second.values())
    assert all(second[n] == row for n, row in first.items() if n != "f5.bin")
    assert sorted(p.read_text() for p in (tmp_path / "out").rglob("*.bin")) == [f"content {i}" for i in range(9)]
    assert call().count() == 9


def test_tables_stored_as_folders(spark, tmp_path):
    """A table of several files is one in a listing, and its rows are counted over all of them."""
    for i in range(3):
        spark.createDataFrame([(f"text {3 * i + j}",) for j in range(3)], "text string").coalesce(1).write.parquet(str(tmp_path / "away" / str(i)))
        (tmp_path / "in" / "train" / "docs.parquet").mkdir(parents=True, exist_ok=True)
        next((tmp_path / "away" / str(i)).glob("*.parquet")).rename(tmp_path / "in" / "train" / "docs.parquet" / f"part-{i}.parquet")
    next_to_it = tmp_path / "in" / "one.parquet"
    next_to_it.write_bytes((tmp_path / "in" / "train" / "docs.parquet" / "part-0.parquet").read_bytes())
    listed = corpus.whole_tables(corpus.list_corpus(spark, str(tmp_path / "in"), "parquet"))
    assert sorted((r.path.rsplit("/", 1)[1], r.ext, r.subset) for r in listed.collect()) == [("docs.parquet", "parquet", "train"), ("one.parquet", "parquet", "")]
    docs = str(tmp_path / "in" / "train" / "docs.parquet")
    assert sorted((r.row_index, r.text) for r in corpus.read_parquet_text(spark, docs, across=True).collect()) == [(i, f"text {i}") for i in range(9)]
    assert sorted(r.row_index for r in corpus.read_parquet_text(spark, docs).collect()) == [0, 0, 0, 1, 1, 1, 2, 2, 2]


def test_short_rounds_share_jobs(spark, tmp_path, monkeypatch):
    for i in range(40):
        put(tmp_path / "src", f"f{i:02}.bin", f"content {i}")
    files = corpus.list_corpus(spark, str(tmp_path / "src"), "bin")
    jobs, real = [], export.export_files
    monkeypatch.setattr(export, "export_files", lambda plan, *rest: jobs.append(sorted(r.chunk_id for r in plan.collect())) or real(plan, *rest))
    got = export.export(spark, files, str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "manifest"), chunk_size=2, chunks_per_round=1)
    assert got.where("status = 'ok'").count() == 40
    assert len(jobs) == 5 and sorted(sum(jobs, [])) == sorted(i // 2 for i in range(40))
