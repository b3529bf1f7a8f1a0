"""The corpus pipeline: each stage works on all that the one before it kept.

A stage is a function of (spark, docs, sf_dir). All but the last return the columns of `documents`; the
last returns where each piece of each remaining document lies in the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perennia.llm.common import filled, table
from perennia.llm.exact_dedup import exact_dedup
from perennia.llm.minhash import near_duplicates
from perennia.llm.packing import document_pieces, pack
from perennia.llm.pii import annotate, learn_spans, redact
from perennia.llm.queries import VOCABULARY
from perennia.llm.toxicity import learn_toxicity, score_toxicity
from perennia.session import configure, work_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _numbered(docs: DataFrame, null_ids: str) -> DataFrame:
    """The documents with `row`, another number for each row, in the order of doc_id; null ids come "first" or "last".

    Where every row has an id of its own that is the number. Else the rows are sorted and stored with
    their numbers below the shared folder: repeated ids, and all null ones, are documents of their own.
    """
    if docs.groupBy("doc_id").count().where("doc_id is null or count > 1").isEmpty():
        return docs.withColumn("row", F.col("doc_id"))
    by = {"first": F.asc_nulls_first, "last": F.asc_nulls_last}[null_ids]("doc_id")
    # Rows of one id may go to several tasks.
    dealt = docs.select(*COLUMNS, F.spark_partition_id().alias("task")).repartitionByRange(by, F.xxhash64("text"), "task")
    folder = work_folder(docs.sparkSession, "pipeline-rows")
    dealt.sortWithinPartitions(by).select(*COLUMNS, F.monotonically_increasing_id().alias("row")).write.parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def _without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows whose number is not in `dropped`."""
    return rows.join(dropped.select("row"), "row", "left_anti").select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    model = learn_toxicity(docs, table(spark, sf_dir, "labels"))
    rows = _numbered(docs, "last")
    return _without(rows, score_toxicity(rows, model, id_col="row").where("predicted = 1"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays, one row of it; a null id only if there is no other."""
    rows = _numbered(docs, "first")
    return _without(rows, exact_dedup(rows, id_col="row", keep="max").where("not kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays, one row of it; null ids count as largest."""
    rows = _numbered(docs, "last")
    return _without(rows, near_duplicates(rows, percent=80, id_col="row").where("not kept"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data gives way to its kind; `n_chars` follows the new text."""
    text = redact(filled(F.col("text")), F.col("spans"))
    changed = annotate(docs, learn_spans(docs)).withColumn("redacted", text)
    return changed.select(
        "doc_id",
        F.when(F.size("spans") > 0, F.col("redacted")).otherwise(F.col("text")).alias("text"),
        "lang",
        "source",
        F.when(F.size("spans") > 0, F.char_length("redacted").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    return pack(document_pieces(docs, VOCABULARY))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("personal data", redact_personal_data),
    ("packing", pack_sequences),
]

#: Learning, min-hashing and best fit are beyond SQL; tests/llm/test_pipeline.py compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each written below the shared folder and read again."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES:
        folder = work_folder(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
