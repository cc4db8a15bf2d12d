"""The corpus pipeline: quality, line dedup, near-duplicate join, mixing, encoding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read back as the next stage's docs. All but the last return the columns of ``documents``
(doc_id, text, lang, source, n_chars) and leave out any other column of their input, whatever its name.

All stages treat rows by themselves where nothing else is said, so repeated rows agree; an empty table gives an empty
table; texts of any length are read whole; nulls in lang, source and n_chars are passed on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import byte_cnn, line_runs, mixing, ngram_join, pieces
from millrace.llm.common import node_id, stash, table
from millrace.llm.queries import WANTED, piece_model

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score below 0.5) go. It is fitted on all labels of these documents.

    A null text is scored as an empty one. Without labels, or with labels of one kind, all documents have one score.
    """
    model = byte_cnn.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "quality"), F.lit(True))
    return byte_cnn.score(docs.select(*COLUMNS), model).filter("predicted = 1").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 characters and more in at least 5 documents stay only in the one with the largest id.

    Every row stays, with its other lines and their number of characters; a null text becomes an empty one. Rows with
    the same id count as separate documents and keep a line together; a null id is smaller than all others.
    """
    found = line_runs.dedup(docs.select(*COLUMNS), keep_text=False)
    return found.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id: five words, similarity of 0.8 or more.

    Rows with the same id are one document and stay or go together. A document without an id comes before all others,
    so it stays; of several such in one group, which are no copies of each other, one stays. Empty and null texts are
    in no group and stay.
    """
    docs = docs.select(*COLUMNS)
    groups = ngram_join.near_components(docs, keep_node=True)
    gone = groups.filter("NOT kept").select("node").distinct()
    return docs.withColumn("node", node_id("doc_id", "text")).join(gone, "node", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw documents by the probabilities that bring sources, languages and topics to their target weights.

    Topics are fitted on all texts, counts and weights are of all rows. A null source or language is a value of its own.
    Whether a document is drawn follows from its id, so rows with one id and one probability are drawn or left together;
    documents without an id draw alike.
    """
    return mixing.mix(docs.select(*COLUMNS), share=WANTED).filter("drawn").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, in place of the text; null and empty texts have none."""
    return pieces.encode(docs.select(*COLUMNS), piece_model(), keep_text=False)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("mix_sources", mix_sources), ("encode", encode)]

#: No SQL can express the trained classifier or the piece encoding; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
