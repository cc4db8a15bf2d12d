"""Files of a crawl store as tables: shards, manifests, records, markers, blobs and text lists.

Paths are Hadoop URIs (file:, s3a:, gs:, ...). Tables are read and written by Spark's own readers and writers; contents of files
of any size are hashed and copied in chunks inside tasks.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace import schemas
from millrace.operators import shred

#: Bytes of a file that are in memory at once while it is hashed or copied.
CHUNK = 1 << 20


def _or_none(spark: SparkSession, schema: str, read) -> DataFrame:
    """What ``read`` gives; no rows where its path does not exist, as in a store that nothing was written to yet."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_shards(layout: DataFrame, store: str, batch: str, created_at: str, size: int) -> None:
    """One JSON-lines file per shard below ``store/batches/<batch>/shards``, in order; the batch marker comes last.

    layout: entries with shard and pos (``planner.shard_layout``). A batch without a marker does not exist for
    readers, so a run that breaks off leaves nothing behind that they would take for whole.
    """
    names = [f.strip().split(" ")[0] for f in schemas.ENTRY.split(",")]
    rows = layout.select("shard", "pos", *[c for c in names if c in layout.columns])
    rows.repartition("shard").sortWithinPartitions("shard", "pos").drop("pos").write.partitionBy("shard").json(f"{store}/batches/{batch}/shards")
    marker = layout.agg(F.count(F.lit(1)).alias("videos"), F.count_distinct("shard").alias("shards"))
    marker = marker.select(F.lit(batch).alias("batch"), F.lit(created_at).alias("created_at"), "shards", "videos", F.lit(size).cast("long").alias("shard_size"))
    marker.coalesce(1).write.json(f"{store}/batches/{batch}/marker")


def read_batches(spark: SparkSession, store: str) -> DataFrame:
    """The markers of all whole batches; none in a new store."""
    return _or_none(spark, schemas.BATCH, lambda: spark.read.schema(schemas.BATCH).json(f"{store}/batches/*/marker"))


def read_shards(spark: SparkSession, store: str, batch: str) -> DataFrame:
    """The entries of a batch with their shard; a line that is no entry fails the read, and so does a batch that is
    missing or has no marker, as it may not be whole."""
    if spark.read.schema(schemas.BATCH).json(f"{store}/batches/{batch}/marker").isEmpty():
        raise ValueError(f"batch {batch!r} has no marker")
    return spark.read.schema(f"{schemas.ENTRY}, shard long").option("mode", "FAILFAST").json(f"{store}/batches/{batch}/shards")


def write_manifests(lines: DataFrame, store: str) -> None:
    """lines(batch, shard, id, status, reason, bytes, duration_s); a null reason is left out of its line."""
    rows = lines.select("batch", "shard", "id", "status", "reason", "bytes", "duration_s")
    rows.repartition("batch", "shard").write.mode("append").partitionBy("batch", "shard").json(f"{store}/manifests")


def read_manifests(spark: SparkSession, store: str) -> DataFrame:
    """All manifest lines; none in a new store."""
    schema = f"{schemas.MANIFEST}, batch string, shard long"
    return _or_none(spark, schema, lambda: spark.read.schema(schema).json(f"{store}/manifests"))


def write_records(records: DataFrame, store: str) -> None:
    """Records, spread over folders by the first two characters of the id. A record means that a video is done."""
    records.withColumn("prefix", F.substr("id", F.lit(1), F.lit(2))).write.mode("append").partitionBy("prefix").json(f"{store}/videos")


def read_records(spark: SparkSession, store: str) -> DataFrame:
    """All records; none in a new store."""
    schema = f"{schemas.RECORD}, prefix string"
    return _or_none(spark, schema, lambda: spark.read.schema(schema).json(f"{store}/videos")).drop("prefix")


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes) of the files below a path, contents not read; none where the path does not exist.

    Spark's reader passes over files of no bytes."""
    files = _or_none(spark, "path string, length long", lambda: spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length"))
    return files.select("path", F.col("length").alias("bytes"))


def blobs(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256) of the files below a path by Spark's reader alone, which holds each file whole: below 2 GB.

    For a store that only Spark's readers open; ``file_hashes`` takes files of any size."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def _opened(uri: str):
    """(file system, path in it) of a path as Spark lists it: file, hdfs, s3 (also s3a, s3n), gs, or a bare local path."""
    from pyarrow import fs

    if uri.startswith(("/", "file:")):
        return fs.LocalFileSystem(), uri.removeprefix("file:").removeprefix("//")
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))


def _pieces(stream) -> Iterator[bytes]:
    while piece := stream.read(CHUNK):
        yield piece


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, size in zip(batch.column("path").to_pylist(), batch.column("bytes").to_pylist(), strict=True):
            digest, read = hashlib.sha256(), 0
            store, inner = _opened(path)
            with store.open_input_stream(inner, buffer_size=0) as stream:
                for piece in _pieces(stream):
                    digest.update(piece)
                    read += len(piece)
            if read != size:
                raise OSError(f"{path}: {read} bytes read of {size}")
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": pa.array([read], pa.int64()), "sha256": [digest.hexdigest()]})


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256) of the files below a path, of any size: each is read once, ``CHUNK`` bytes at a time.

    Spark lists the files and deals them over tasks by their size; a large one is a task of its own. A file that is shorter or
    longer than listed fails the read. A path that does not exist gives no rows.
    """
    return listing(spark, path).mapInArrow(_hashed, "path string, bytes long, sha256 string")


def _copied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for source, target, expected in zip(*(batch.column(c).to_pylist() for c in ("source", "target", "sha256")), strict=True):
            digest, size = hashlib.sha256(), 0
            (store, inner), (to, place) = _opened(source), _opened(target)
            part = f"{place}.part-{uuid.uuid4().hex}"
            to.create_dir(place.rpartition("/")[0] or "/", recursive=True)
            try:
                with store.open_input_stream(inner, buffer_size=0) as stream, to.open_output_stream(part) as out:
                    for piece in _pieces(stream):
                        digest.update(piece)
                        out.write(piece)
                        size += len(piece)
                if expected is not None and expected != digest.hexdigest():
                    raise OSError(f"{source}: its SHA-256 is not the expected one")
                to.move(part, place)
            except BaseException:
                if to.get_file_info(part).type.name != "NotFound":
                    to.delete_file(part)
                raise
            yield pa.RecordBatch.from_pydict({"source": [source], "target": [target], "bytes": pa.array([size], pa.int64()), "sha256": [digest.hexdigest()]})


def upload(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """Copy files(source, target and, if known, sha256) and hash them on the way -> (source, target, bytes, sha256).

    ``CHUNK`` bytes are in memory at once. A copy is written under a name of its own beside its target and takes the target's
    name when it is whole, so one that breaks off, or whose hash is not the expected one, leaves nothing, and a task that runs
    again does no harm. The copies are made when the result is read: write it, and use it from there. A null or repeated
    source is copied as often as it is listed; targets must differ. tasks: how many copies run side by side (None: as dealt).
    """
    rows = files.select("source", "target", (F.col("sha256") if "sha256" in files.columns else F.lit(None)).cast("string").alias("sha256"))
    rows = rows.filter("source IS NOT NULL AND target IS NOT NULL")
    rows = rows.repartition(tasks, "target") if tasks else rows
    return rows.mapInArrow(_copied, "source string, target string, bytes long, sha256 string")


def folders(spark: SparkSession, path: str) -> DataFrame:
    """The sorted names of the folders right below a path that hold files; the files' contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    top = F.lit(path.rstrip("/").split(":", 1)[-1].lstrip("/"))
    rest = F.split_part("path", F.concat(top, F.lit("/")), F.lit(-1))
    return files.select(F.split_part(rest, F.lit("/"), F.lit(1)).alias("folder"), rest.contains("/").alias("inner")).filter("inner").select("folder").distinct().orderBy("folder")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line, file) of text files of any size, split at line feeds; numbers start at 1 in each file.

    Spark reads a large file in splits, each from its first whole line on. A line's number is its place in its split plus the
    lines of the file's earlier splits: counts of splits are summed, lines are not moved, and no row or task holds a file.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth"))
    splits = lines.groupBy("file", "block").agg(F.min("nth").alias("from"), F.count(F.lit(1)).alias("n"))  # a row per split
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "block", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("from") + 1).alias("add"))
    numbered = lines.join(splits, ["file", "block"])
    return numbered.select((F.col("nth") + F.col("add")).alias("line_no"), F.regexp_replace("value", r"\r\z", "").alias("line"), "file")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The ids of a list; the first bad line fails the read with its number."""
    return shred.strict_ids(text_lines(spark, path))


def read_proxies(spark: SparkSession, path: str) -> DataFrame:
    """The labels of a proxy list; the first bad line fails the read with its number and the reason, never with its text."""
    return shred.strict_proxies(text_lines(spark, path))
