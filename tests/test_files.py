from __future__ import annotations

import hashlib
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import planner
from millrace.sources import files
from millrace.streaming import outcomes


def test_shards_round_trip(spark, tmp_path):
    rows = spark.range(12).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("id"), F.col("id").alias("seq"), F.lit("seed").alias("source"), F.lit(60).cast("long").alias("duration_s"))
    layout = planner.shard_layout(rows, 5)
    files.write_shards(layout, str(tmp_path), "b1", "2024-01-01T00:00:00Z", 5)
    assert [tuple(r) for r in files.read_batches(spark, str(tmp_path)).collect()] == [("b1", "2024-01-01T00:00:00Z", 3, 12, 5)]
    back = files.read_shards(spark, str(tmp_path), "b1")
    assert {(r.id, r.shard) for r in back.collect()} == {(f"v{i}", i // 5) for i in range(12)}
    assert all(sum(n.endswith(".json") for n in os.listdir(tmp_path / f"batches/b1/shards/shard={k}")) == 1 for k in range(3))
    (tmp_path / "batches/b1/shards/shard=0/part-bad.json").write_text("{broken\n")
    with pytest.raises(Exception, match="(?i)malformed|json"):
        files.read_shards(spark, str(tmp_path), "b1").collect()
    with pytest.raises(PySparkException):
        files.read_shards(spark, str(tmp_path), "none").collect()
    for p in (tmp_path / "batches/b1/marker").glob("part-*"):
        p.unlink()
    with pytest.raises(ValueError, match="no marker"):
        files.read_shards(spark, str(tmp_path), "b1")


def test_manifests_and_records(spark, tmp_path):
    lines = spark.createDataFrame([("b", 0, "a", "fetched", None, 5, 1), ("b", 0, "c", "failed", "why", 0, 1)], "batch string, shard long, id string, status string, reason string, bytes long, duration_s long")
    files.write_manifests(lines, str(tmp_path))
    assert {(r.batch, r.shard, r.id, r.reason) for r in files.read_manifests(spark, str(tmp_path)).collect()} == {("b", 0, "a", None), ("b", 0, "c", "why")}
    text = "".join(p.read_text() for p in tmp_path.glob("manifests/batch=b/shard=0/*.json"))
    assert text.count("reason") == 1
    record = spark.createDataFrame([{"id": "abX", "files": [{"path": "p", "bytes": 7, "sha256": "s"}]}], schemas.RECORD)
    files.write_records(record, str(tmp_path))
    back = files.read_records(spark, str(tmp_path)).first()
    assert back.id == "abX" and back.files[0].bytes == 7 and (tmp_path / "videos/prefix=ab").exists()


def test_blobs_and_folders(spark, tmp_path):
    for name in ("one/a.bin", "two/b.bin", "two/c.bin"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"hello")
    out = files.blobs(spark, str(tmp_path)).collect()
    assert len(out) == 3 and {(r.bytes, r.sha256) for r in out} == {(5, hashlib.sha256(b"hello").hexdigest())}
    assert [r.folder for r in files.folders(spark, str(tmp_path)).collect()] == ["one", "two"]


def test_a_new_store_is_empty(spark, tmp_path):
    store = str(tmp_path / "new")
    assert files.read_batches(spark, store).columns == ["batch", "created_at", "shards", "videos", "shard_size"]
    assert all(f(spark, store).count() == 0 for f in (files.read_batches, files.read_manifests, files.read_records, files.listing, files.file_hashes))
    with pytest.raises(PySparkException):
        files.read_shards(spark, store, "b")
    entries = spark.createDataFrame([("a",)], "id string")
    done = planner.skip_done_records(entries, files.read_records(spark, store).select("id", F.lit(0).cast("long").alias("bytes")))
    assert [tuple(r) for r in done.collect()] == [("a", False, 0)]


def test_hashes_of_files_in_chunks(spark, tmp_path, monkeypatch):
    contents = {"a b.bin": b"", "in/c%20d.bin": b"x" * 5, "in/e.bin": bytes(range(256)) * 20_000}
    for name, raw in contents.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(raw)
    expected = {(len(raw), hashlib.sha256(raw).hexdigest()) for raw in contents.values() if raw}  # Spark lists no empty files
    assert {(r.bytes, r.sha256) for r in files.file_hashes(spark, str(tmp_path)).collect()} == expected
    assert {(r.bytes, r.sha256) for r in files.blobs(spark, str(tmp_path)).collect()} == expected


def test_a_file_above_two_gigabytes(spark, tmp_path):
    """Spark's own reader holds a file in one value and so fails; the chunked one needs a chunk at a time."""
    import resource

    size = 2**31 + 12_345
    with open(tmp_path / "large.bin", "wb") as f:
        f.truncate(size)
    digest, zeros = hashlib.sha256(), bytes(1 << 24)
    for _ in range(size >> 24):
        digest.update(zeros)
    digest.update(bytes(size & ((1 << 24) - 1)))
    (row,) = files.file_hashes(spark, str(tmp_path)).collect()
    assert (row.bytes, row.sha256) == (size, digest.hexdigest())
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    table = files.pa.RecordBatch.from_pydict({"path": [str(tmp_path / "large.bin")], "bytes": [size]})
    assert [b.column("sha256").to_pylist() for b in files._hashed(iter([table]))] == [[row.sha256]]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 100_000  # KB
    with pytest.raises(Exception, match="exceeds the max length"):
        files.blobs(spark, str(tmp_path)).collect()


def test_uploads(spark, tmp_path):
    raw = bytes(range(250)) * 9_000
    (tmp_path / "from").mkdir()
    for k in range(3):
        (tmp_path / f"from/{k}.bin").write_bytes(raw + bytes([k]))
    good = [(f"file:{tmp_path}/from/{k}.bin", f"{tmp_path}/to/x{k}/media.bin", hashlib.sha256(raw + bytes([k])).hexdigest() if k else None) for k in range(3)]
    rows = files.upload(spark.createDataFrame([*good, (None, "x", None)], "source string, target string, sha256 string"), 2).collect()
    assert {(r.source, r.target, r.bytes) for r in rows} == {(s, t, len(raw) + 1) for s, t, _ in good}
    assert all(hashlib.sha256((tmp_path / f"to/x{k}/media.bin").read_bytes()).hexdigest() == {r.target: r.sha256 for r in rows}[good[k][1]] for k in range(3))
    bad = [(str(tmp_path / "from/1.bin"), str(tmp_path / "bad/media.bin"), "0" * 64)]
    with pytest.raises(PySparkException, match="not the expected one"):
        files.upload(spark.createDataFrame(bad, "source string, target string, sha256 string")).collect()
    with pytest.raises(PySparkException):
        files.upload(spark.createDataFrame([(str(tmp_path / "from"), str(tmp_path / "bad/folder.bin"))], "source string, target string")).collect()
    assert list((tmp_path / "bad").iterdir()) == []


def test_an_upload_that_breaks_off_leaves_nothing(tmp_path, monkeypatch):
    (tmp_path / "a").write_bytes(b"z" * 5_000)

    def broken(stream):
        yield stream.read(1_000)
        raise OSError("lost")

    monkeypatch.setattr(files, "_pieces", broken)
    batch = files.pa.RecordBatch.from_pydict({"source": [str(tmp_path / "a")], "target": [str(tmp_path / "b")], "sha256": files.pa.array([None], files.pa.string())})
    with pytest.raises(OSError, match="lost"):
        list(files._copied(iter([batch])))
    assert [p.name for p in tmp_path.iterdir()] == ["a"]


def test_lists(spark, tmp_path):
    (tmp_path / "ids").write_text("# list\nabcdefghijk\n\nhttps://youtu.be/ABCDEFGHIJK?x\n")
    assert [r.id for r in files.read_ids(spark, str(tmp_path / "ids")).orderBy("line_no").collect()] == ["abcdefghijk", "ABCDEFGHIJK"]
    (tmp_path / "proxies").write_text("lattice http://mo:pw@exit:4100\nlattice ftp://h:1\n")
    with pytest.raises(PySparkException, match="line 2: unsupported scheme"):
        files.read_proxies(spark, str(tmp_path / "proxies")).collect()


def test_line_numbers_of_split_files(spark, tmp_path):
    """Numbers are those of the file however many splits it is read in, and the first bad line is named."""
    (tmp_path / "l").mkdir()
    lines = {"a": [f"id{i:09d}" + "\r" * (i % 3 == 0) if i % 7 else "# " + "n" * (i % 90) for i in range(1, 4001)], "b": ["", "id123456789", "", "ID_456-7890"]}
    for name, x in lines.items():
        (tmp_path / "l" / name).write_bytes("\n".join(x).encode() + b"\n" * (name == "a"))
    expected = sorted((name, n, x.removesuffix("\r")) for name, found in lines.items() for n, x in enumerate(found, 1))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "3k", "500"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = files.text_lines(spark, str(tmp_path / "l"))
            assert size == "128m" or spark.read.text(str(tmp_path / "l")).rdd.getNumPartitions() > 4
            assert sorted((r.file[-1], r.line_no, r.line) for r in rows.collect()) == expected
        (tmp_path / "bad").write_text("\n".join(["id000000000"] * 900 + ["bad one"] + ["id000000001"] * 900 + ["worse"] * 50))
        with pytest.raises(PySparkException, match="line 901: not a video id"):
            files.read_ids(spark, str(tmp_path / "bad")).collect()
        (tmp_path / "pr").write_text("\n".join([f"one http://u{i}:k@h{i}:1" for i in range(400)] + ["gopher://q:1", "socks5://r:2", "socks5://r:2"]))
        with pytest.raises(PySparkException, match="line 401: unsupported scheme"):
            files.read_proxies(spark, str(tmp_path / "pr")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_streamed_outcomes(spark, tmp_path):
    rows = [(i, (1_700_000 + i) * 60_000_000, "w", "p/a", "p", "v", "fetched" if i % 2 else "bot_check", 10, 1.0, 5) for i in range(30)]
    spark.createDataFrame(rows + rows[:5], schemas.ATTEMPT).coalesce(1).write.json(str(tmp_path / "log"))
    stream = spark.readStream.schema(schemas.ATTEMPT).json(str(tmp_path / "log"))
    query = outcomes.hourly_outcomes(stream, length="1 hour", slide="1 hour")
    q = query.writeStream.format("memory").queryName("seen").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(120)
    assert [(r.tries, r.fetched, r.strikes) for r in spark.table("seen").collect()] == [(35, 17, 18)]
    q = outcomes.distinct_attempts(stream).writeStream.format("memory").queryName("once").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp2")).start()
    q.awaitTermination(120)
    assert spark.table("once").count() == 30
