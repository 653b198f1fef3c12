"""Publishing in two steps, and blocks read from files by ranges, in batches and as an endless stream."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.operators import sampling
from quern.sources import blocks, corpus, packed


def write(spark, path, files=14, size=60, first=0):
    rows = [(i, [1000 * i + j for j in range(size)]) for i in range(first, first + files)]
    df = spark.createDataFrame(rows, "counter long, tokens array<int>").repartition(3)
    packed.write_chunks(df, path, "c", "int32")
    return {f"c_{i:010d}.bin": t for i, t in rows}


def stage(spark, path, monkeypatch, files=9):
    """A write whose second step has not begun, as if the driver had been lost."""
    monkeypatch.setattr(packed, "publish", lambda *_: None)
    made = write(spark, path, files)
    monkeypatch.undo()
    return made


def test_publishing_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "o")
    made = stage(spark, path, monkeypatch)
    assert not list((tmp_path / "o").glob("*.bin"))
    # Some files have been moved when the job is lost.
    import json

    (commit,) = (tmp_path / "o" / "_commits").iterdir()
    listed = [json.loads(line) for m in json.loads(commit.read_text())["manifests"] for line in open(m)]
    assert len(listed) == 9
    for place, name in listed[:4]:
        packed._filesystem(path)[0].move(place, f"{path}/{name}")
    assert packed.publish(spark, path) == 9
    back = {r.path.rsplit("/", 1)[1]: r.tokens for r in packed.read_chunks(spark, path).collect()}
    assert back == made
    assert sorted(p.name for p in (tmp_path / "o").iterdir()) == ["_SUCCESS", *sorted(made)]
    assert packed.publish(spark, path) == 0


def test_a_staged_file_that_is_lost_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "o")
    stage(spark, path, monkeypatch)
    next(p for p in (tmp_path / "o").glob("_staging*/*/0")).rename(tmp_path / "gone")
    with pytest.raises(Exception, match="neither staged nor published"):
        packed.publish(spark, path)


def test_two_writes_that_wait_are_published_both(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "o")
    stage(spark, path, monkeypatch, 3)
    monkeypatch.setattr(packed, "publish", lambda *_: None)
    write(spark, path, 2, first=50)
    monkeypatch.undo()
    assert packed.publish(spark, path) == 5


def loaded(spark, path, shards, n_chunks, block, size, epochs=1):
    chunks = packed.read_chunks(spark, path).select("path", "tokens")
    dealt = chunks.join(sampling.assign_shards(chunks.select("path"), shards), "path")
    return sampling.shuffle_blocks(sampling.repeat_epochs(dealt, epochs), n_chunks, block, size, 5)


def rows(df):
    return sorted((r.epoch, r.shard, r.run_no, r.position, r.block_no, list(r.tokens)) for r in df.collect())


def test_blocks_from_files_equal_those_of_loaded_chunks(spark, tmp_path):
    path = str(tmp_path / "o")
    write(spark, path)
    plan = blocks.block_plan(corpus.list_corpus(spark, path, "bin"), 3, 2, 7, 5, epochs=2)
    found = rows(blocks.read_blocks(blocks.by_file(plan)))
    assert found == rows(loaded(spark, path, 3, 2, 7, 60, 2))
    assert len(found) == 2 * 3 * 2 * 2 * 8  # epochs, shards, runs, chunks, blocks


def test_only_the_ranges_of_the_plan_are_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "o")
    write(spark, path)
    plan = blocks.block_plan(corpus.list_corpus(spark, path, "bin"), 3, 2, 7, 5)
    wanted = plan.where("shard = 1 AND run_no = 1 AND block_no IN (0, 3)")
    expected = [r for r in rows(loaded(spark, path, 3, 2, 7, 60)) if r[1:3] == (1, 1) and r[4] in (0, 3)]
    ranges = wanted.select("path", "begin", "length").collect()
    assert len(ranges) == 4 and sum(r.length for r in ranges) == 4 * 7 * 4
    # Whatever else the files hold is never looked at: all other bytes are overwritten.
    for file in (tmp_path / "o").glob("*.bin"):
        raw = np.frombuffer(file.read_bytes(), np.uint8).copy()
        keep = np.zeros(raw.size, bool)
        for r in ranges:
            if r.path.endswith(file.name):
                keep[r.begin : r.begin + r.length] = True
        raw[24:][~keep[24:]] = 255
        file.write_bytes(raw.tobytes())
    assert rows(blocks.read_blocks(wanted)) == expected


def test_files_of_unlike_size_in_a_run_are_refused(spark, tmp_path):
    path = str(tmp_path / "o")
    write(spark, path, 2, 60)
    write(spark, path, 2, 30, first=2)
    files = corpus.list_corpus(spark, path, "bin")
    with pytest.raises(Exception, match="unlike size"):
        blocks.block_plan(files, 1, 4, 7, 5).collect()
    assert blocks.block_plan(files, 1, 2, 7, 5).count() == 2 * 8 + 2 * 4


def test_the_stream_starts_over_and_resumes(spark, tmp_path):
    """Two queries of one checkpoint, with a stop between them, give each run of the epochs once."""
    path = str(tmp_path / "o")
    write(spark, path)
    files = corpus.list_corpus(spark, path, "bin")

    def run(until):
        stream = blocks.stream_blocks(spark, files, 3, 2, 7, 5)
        query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check")).start(str(tmp_path / "out"))
        end = time.time() + 120
        while time.time() < end and not ((p := query.lastProgress) and p["batchId"] >= until):
            time.sleep(0.2)
        query.stop()

    run(2)
    first = spark.read.parquet(str(tmp_path / "out")).select("epoch", "run_no").distinct().count()
    run(first + 2)
    found = spark.read.parquet(str(tmp_path / "out"))
    last = found.agg(F.max(F.col("epoch") * 2 + F.col("run_no"))).first()[0]
    assert last >= 4  # beyond the second epoch: two runs each
    expected = [r for r in rows(loaded(spark, path, 3, 2, 7, 60, last // 2 + 1)) if r[0] * 2 + r[2] <= last]
    assert rows(found) == expected


def test_blocks_of_many_small_files_share_frames(tmp_path):
    """Before, each file had a frame of its own."""
    import pandas as pd

    plan = []
    for i in range(40):
        (tmp_path / f"f{i}").write_bytes(np.arange(10 * i, 10 * i + 10, dtype="<i4").tobytes())
        plan += [(str(tmp_path / f"f{i}"), begin, 16, "int32", i) for begin in (16, 0)]
    plan = pd.DataFrame(plan, columns=["path", "begin", "length", "dtype", "file"]).sample(frac=1, random_state=3)
    frames = list(blocks._read(plan, "tokens", 30))
    assert [len(f) for f in frames] == [30, 30, 20]
    read = {(r.file, r.begin): r.tokens.tolist() for f in frames for r in f.itertuples()}
    assert read == {(i, b): [10 * i + b // 4 + j for j in range(4)] for i in range(40) for b in (0, 16)}


def test_small_packed_files_share_batches():
    """Before, each file had a batch of its own."""
    import pyarrow as pa

    made = [(f"p{i}", list(range(i % 5))) for i in range(300)]
    content = [packed.header("int32", len(t)) + packed.narrow(np.array(t, np.int64), "int32") for _, t in made]
    out = list(packed._decode_chunks(iter([pa.RecordBatch.from_pydict({"path": [p for p, _ in made], "content": content})])))
    assert len(out) == 1
    assert [(r["path"], r["tokens"]) for b in out for r in b.to_pylist()] == made
    whole = list(packed._gathered(iter([("a", np.arange(200)), ("b", np.arange(3)), ("c", np.arange(0))]), {"path": pa.string()}, 150))
    assert [b.column("path").to_pylist() for b in whole] == [["a"], ["b", "c"]]
