"""Line dedup over levelled sorted runs of line hashes.

The store is a folder of runs. Each run is a table bucketed and sorted by line hash: (h1, h2, n, keeper), where n counts
the documents of its batches that hold the line. A new batch is merge-anti-joined with the runs: a line that no run
holds is new and enters with its keeper, the largest document id of the batch that holds it; a line that the runs hold
only adds its count. Where batches come newest (largest ids) first, the join alone so decides who keeps a line: each line has
one keeper in all runs. A store that takes batches in any order also enters a larger keeper. When a level holds ``fanout``
runs they are merged into one run of the next level, so a store of N batches keeps O(fanout * log N) runs. All runs of a store
have the same buckets, so neither the join nor a merge moves their rows. A manifest table names the live runs; it is written
last, so a broken run is never read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import NO_ID, arrow_fields, bounded_batches, fresh_dir, shuffle_partitions, stash, text_of

_STRIP = b" \t\n\r\x0b\x0c"
RUN = "h1 bigint, h2 bigint, n bigint, keeper bigint"
KEY = ["h1", "h2"]
MANIFEST = "version int, level int, run int, buckets int, next int"


def _line_key(line: bytes, least: int) -> bytes | None:
    """The line's key (white space stripped at both ends, A-Z lowered) if it has ``least`` code points, else None."""
    key = line.strip(_STRIP)
    if len(key) < least or len(key) < 4 * least and len(key.decode("utf-8", "replace")) < least:
        return None
    return key.lower()


def _hash(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _text_bytes(column: pa.Array) -> Iterator[bytes]:
    for x in column.cast(pa.large_binary()):
        yield x.as_py() or b""


def row_hash(id_col: str, text_col: str) -> Column:
    """With the id it names a row, or rows that agree in id and text."""
    return F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))


def postings(docs: DataFrame, *, id_col: str, text_col: str, least: int, batch: Column | None = None) -> DataFrame:
    """(h1, h2, doc_id, row, batch): each long line of each document once. A null id reads as the smallest one."""
    bounded_batches(docs.sparkSession)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, sizes = bytearray(), []
            for text in _text_bytes(batch.column(3)):
                found = {_hash(k) for line in text.split(b"\n") if (k := _line_key(line, least)) is not None}
                out += b"".join(sorted(found))
                sizes.append(len(found))
            pairs = pa.Array.from_buffers(pa.int64(), 2 * sum(sizes), [None, pa.py_buffer(bytes(out))]).to_numpy()
            rest = [pa.array(batch.column(i).to_numpy().repeat(sizes)) for i in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0::2]), pa.array(pairs[1::2]), *rest], ["h1", "h2", "doc_id", "row", "batch"])

    number = (F.lit(0) if batch is None else batch).cast("int").alias("batch")
    rows = docs.select(F.coalesce(F.col(id_col), F.lit(NO_ID)).cast("long").alias("doc_id"), row_hash(id_col, text_col).alias("row"), number, text_of(text_col).alias("text"))
    return rows.mapInArrow(lines, "h1 long, h2 long, doc_id long, row long, batch int")


class LineRuns:
    """The store of runs in one folder. ``buckets`` (default: the shuffle partitions) is fixed when it is made.

    All runs are partitions of one table bucketed by line hash, so that several can be read as one without a shuffle.
    ``newest_first``: each batch has smaller ids than those before it.
    """

    def __init__(self, spark: SparkSession, folder: str, *, fanout: int = 3, buckets: int | None = None, new: bool = False, newest_first: bool = False):
        self.spark, self.folder, self.fanout, self.newest_first = spark, folder, fanout, newest_first
        self.version, self.runs, self.next = 0, [], 0
        self.buckets, self.name = buckets or shuffle_partitions(spark), f"line_runs_{uuid.uuid4().hex}"
        if not new:
            rows = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
            rows = rows.filter(F.col("version") == rows.agg(F.max("version")).first()[0]).collect()  # a few rows: the live runs
            self.version, self.buckets, self.runs = rows[0].version, rows[0].buckets, [(r.level, r.run) for r in rows]
            self.next = max(r.next for r in rows)
            key, place = ", ".join(KEY), folder.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(
                f"CREATE TABLE {self.name} ({RUN}, run INT) USING parquet PARTITIONED BY (run) CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS LOCATION '{place}/runs'"
            )
            spark.catalog.recoverPartitions(self.name)

    def _write(self, rows: DataFrame) -> int:
        """Write a run and return its number; until the manifest names it, nobody reads it."""
        run, self.next = self.next, self.next + 1
        out = rows.select(*KEY, "n", "keeper", F.lit(run).alias("run")).write.mode("append").partitionBy("run")
        out.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", f"{self.folder}/runs").saveAsTable(self.name)
        return run

    def _read(self, runs: list[int]) -> DataFrame:
        return self.spark.table(self.name).filter(F.col("run").isin(runs)).select(*KEY, "n", "keeper")

    def _commit(self) -> None:
        self.version += 1
        rows = [(self.version, level, run, self.buckets, self.next) for level, run in self.runs]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")

    def _merge(self, runs: list[int]) -> DataFrame:
        keeper = F.min("keeper") if self.newest_first else F.max("keeper")  # newest first: there is but one
        return self._read(runs).groupBy(*KEY).agg(F.sum("n").alias("n"), keeper.alias("keeper"))

    def _seen(self) -> DataFrame:
        """(h1, h2, was): the lines of all live runs with their keeper."""
        kept = self._read([r for _, r in self.runs]).filter("keeper IS NOT NULL")
        return kept.select(*KEY, F.col("keeper").alias("was")) if self.newest_first else kept.groupBy(*KEY).agg(F.max("keeper").alias("was"))

    def merged(self) -> DataFrame:
        """All live runs as one table, a row per line hash."""
        return self._merge([r for _, r in self.runs]) if self.runs else self.spark.createDataFrame([], RUN)

    def add(self, batch: DataFrame) -> None:
        """Add a batch of postings: new lines enter with their keeper; lines that the runs hold are counted, and get another
        keeper only in a store of any order, where the batch has a larger id. The batch is written once."""
        own = batch.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
        if self.runs:
            new = F.col("was").isNull() if self.newest_first else F.col("was").isNull() | (F.col("keeper") > F.col("was"))
            own = own.join(self._seen(), KEY, "left").select(*KEY, "n", F.when(new, F.col("keeper")).alias("keeper"))
        self.runs.append((0, self._write(own)))
        level = 0
        while len(full := [r for r in self.runs if r[0] == level]) >= self.fanout:
            self.runs = [r for r in self.runs if r[0] != level] + [(level + 1, self._write(self._merge([r for _, r in full])))]
            level += 1
        self._commit()

    def forget(self) -> None:
        """Take the table out of the session's catalog. Its files stay; a store opened on the folder reads them again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def repeated(self, min_docs: int) -> DataFrame:
        """(h1, h2, n, keeper) of the lines that at least ``min_docs`` documents hold."""
        return self.merged().filter(F.col("n") >= min_docs)


def lines_to_drop(held: DataFrame, repeated: DataFrame) -> DataFrame:
    """(doc_id, row, lines): the repeated lines of each row of postings that its document does not keep.

    Both sides are tables, so the join is between two plain exchanges and Spark splits the postings of a frequent line
    over several tasks.
    """
    gone = held.join(repeated.select(*KEY, "keeper"), KEY).filter("doc_id <> keeper")
    return gone.groupBy("doc_id", "row").agg(F.collect_list(F.struct(*KEY)).alias("lines"))


def drop_lines(docs: DataFrame, dropped: DataFrame, *, id_col: str, text_col: str, least: int, keep_text: bool = True) -> DataFrame:
    """docs plus n_lines, n_dropped and kept_text; dropped: (doc_id, row, lines array<struct<h1, h2>>)."""
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept_text")]
    at = kept.index(text_col)
    told = [i for i, c in enumerate(kept) if keep_text or c != text_col]
    plain = docs.select(*[F.col(f"`{c}`") for c in kept])
    line_id = F.coalesce(F.col(f"`{id_col}`"), F.lit(NO_ID)).cast("long")
    rows = plain.select("*", line_id.alias("_line_id"), row_hash(id_col, text_col).alias("_line_row"))
    gone = dropped.select(F.col("doc_id").alias("_line_id"), F.col("row").alias("_line_row"), F.col("lines.h1").alias("_line_h1"), F.col("lines.h2").alias("_line_h2"))
    rows = rows.join(gone, ["_line_id", "_line_row"], "left").drop("_line_id", "_line_row")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, texts = [], [], []
            gone = [batch.column(len(kept) + i).to_pylist() for i in range(2)]
            for text, h1, h2 in zip(_text_bytes(batch.column(at)), *gone, strict=True):
                lines = text.split(b"\n")
                n_lines.append(len(lines))
                if h1:
                    keys = set(zip(h1, h2, strict=True))
                    stay = [x for x in lines if (k := _line_key(x, least)) is None or struct.unpack("=qq", _hash(k)) not in keys]
                    n_dropped.append(len(lines) - len(stay))
                    text = b"\n".join(stay)
                else:
                    n_dropped.append(0)
                texts.append(text)
            new = [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in told), *new], names=[*(kept[i] for i in told), "n_lines", "n_dropped", "kept_text"])

    fields = arrow_fields(plain.select(*[F.col(f"`{kept[i]}`") for i in told]))
    return rows.mapInArrow(apply, ", ".join([*([fields] if fields else []), "n_lines long", "n_dropped long", "kept_text string"]))


def batch_number(docs: DataFrame, id_col: str, batches: int) -> Column:
    """The number of the range of ids, from 0 for the smallest ids and null, that a document lies in."""
    low, high = docs.agg(F.min(F.col(f"`{id_col}`").cast("long")), F.max(F.col(f"`{id_col}`").cast("long"))).first()
    out = F.lit(0)
    if low is not None:
        step = (high - low) // batches + 1
        for edge in range(low + step, high + 1, step):
            out = out + F.coalesce(F.col(f"`{id_col}`").cast("long") >= edge, F.lit(False)).cast("int")
    return out


def dedup(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 3, folder: str | None = None,
    keep_text: bool = True,
) -> DataFrame:
    """Drop repeated lines. Returns docs plus n_lines, n_dropped, kept_text (columns of those names are replaced);
    without ``keep_text`` the text column goes.

    A line's key is the line with white space stripped at both ends and A-Z lowered. Keys of at least ``least``
    code points that at least ``min_docs`` documents hold lose all their lines, except in the document with the
    largest id that holds the key. Null or empty text is one empty line. A null id counts as smaller than any
    other. Rows with the same id count as separate documents; the largest id keeps its lines in all of them. An
    empty table gives no rows. Texts of any length are read whole.

    The documents enter the store in ``batches`` id ranges, newest first; one pass hashes the lines of all of them.
    Lines that recur across many documents are summed per task before each shuffle, and Spark splits their postings
    when they are joined back; the list of dropped lines of a row is bounded by its own lines.
    """
    spark = docs.sparkSession
    number = batch_number(docs, id_col, batches)
    held_in = fresh_dir(spark, "line-postings")
    postings(docs, id_col=id_col, text_col=text_col, least=least, batch=number).write.partitionBy("batch").parquet(held_in)
    held = spark.read.schema("h1 long, h2 long, doc_id long, row long, batch int").parquet(held_in)
    store = LineRuns(spark, folder or fresh_dir(spark, "line-store"), fanout=fanout, new=True, newest_first=True)
    try:
        for k in reversed(range(batches)):
            store.add(held.filter(F.col("batch") == k))
        repeated = stash(store.repeated(min_docs), "repeated-lines")
    finally:
        store.forget()
    dropped = stash(lines_to_drop(held.drop("batch"), repeated), "dropped-lines")
    return drop_lines(docs, dropped, id_col=id_col, text_col=text_col, least=least, keep_text=keep_text)
