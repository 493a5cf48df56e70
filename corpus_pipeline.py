"""From raw documents to packed training sequences, in five stages.

Each stage works on all that the one before kept, and is written and read again
in between.  All but the last return the columns of ``documents``.  Documents
are known by ``doc_id`` and text, so that rows without an id, and rows that share
an id, are documents of their own; rows that repeat both are one document.

Cases: a null text counts as empty, so the quality rules reject it; an empty
table gives empty tables; texts of any length are read as a whole; columns of
any names stay as they are, since each stage works on a struct of the row.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spriteloom.llm.common import cut, text_or_empty
from spriteloom.llm.exact_dedup import exact_dedup, plain_sha256
from spriteloom.llm.packing import pack_documents
from spriteloom.llm.pii import redact
from spriteloom.llm.quality import quality_rules, strip_lines
from spriteloom.llm.simhash import simhash_dedup


def _boxed(docs: DataFrame, **more: Column) -> DataFrame:
    """(row, doc_id, text, ...): a document's other columns in one struct, so that no name meets those that the stages use."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    return docs.select(row, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[c.alias(name) for name, c in more.items()])


def _unboxed(boxed: DataFrame, docs: DataFrame, changed: bool = False) -> DataFrame:
    """The columns of ``docs``; of changed documents ``n_chars``, if there is one, is as the text now has it."""

    def column(name: str) -> Column:
        if name == "text":
            return F.col("text")
        return F.length("text").cast(docs.schema[name].dataType) if changed and name == "n_chars" else F.col(f"row.`{name}`")

    return boxed.select(*[column(c).alias(c) for c in docs.columns])


def _text_key() -> Column:
    """SHA-256 of the text; a null text counts as empty."""
    return F.unhex(F.sha2(text_or_empty().cast("binary"), 256))


def _only(boxed: DataFrame, wanted: DataFrame) -> DataFrame:
    """The documents whose id and key are in ``wanted`` (doc_id, key), null ids included."""
    wanted = wanted.select(F.col("doc_id").alias("wanted_id"), F.col("key").alias("wanted_key")).distinct()
    return boxed.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id")) & (F.col("key") == F.col("wanted_key")), "left_semi")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the others lose their boilerplate lines, and n_chars follows the text.

    A text of which boilerplate would leave less than a third or so (``quality.MIN_LEFT``) keeps its lines.
    """
    host = F.coalesce(F.concat(F.lit("s"), F.length("source").cast("string"), F.lit(":"), "source"), F.lit("n"))  # verdicts differ by host
    boxed = _boxed(docs, source=F.col("source").cast("string"), key=F.unhex(F.sha2(F.concat(host, text_or_empty()).cast("binary"), 256)))
    kept = quality_rules(boxed, key_col="key", lines_of="everywhere").where("kept").groupBy(F.col("doc_id").alias("kept_id"), F.col("key").alias("kept_key"))
    kept = kept.agg(F.first("boilerplate").alias("gone"))  # equal rows have equal lines
    found = boxed.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("key") == F.col("kept_key"))).select("row", "text", "gone")
    return _unboxed(strip_lines(found, "gone"), docs, changed=True)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts one stays, the one that exact_dedup keeps; so does one of rows that repeat."""
    kept = exact_dedup(docs.select("doc_id", "text")).where("kept").select("doc_id", F.col("text_sha256").alias("key"))
    same = cut(_only(_boxed(docs, key=plain_sha256("text")), kept).withColumn("row_no", F.monotonically_increasing_id()))
    best = same.groupBy(F.col("key").alias("of_key")).agg(F.min(F.struct(-F.length(text_or_empty()), "row_no")).alias("best"))
    first = best.select(F.col("best.row_no").alias("first_row"))
    return _unboxed(same.join(first, F.col("row_no") == F.col("first_row"), "left_semi"), docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest id stays, of several with that id (or of none with any) one."""
    boxed = _boxed(docs, key=_text_key())
    smallest = simhash_dedup(boxed, key_col="key").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    one = smallest.groupBy("root").agg(F.min(F.struct("doc_id", "key")).alias("one")).select("one.doc_id", "one.key")
    return _unboxed(_only(boxed, one), docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; n_chars follows the text."""
    return _unboxed(redact(_boxed(docs)), docs, changed=True)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in training sequences."""
    return pack_documents(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("simhash near-dedup", near_stage),
    ("pii", pii_stage),
    ("best-fit packing", packing_stage),
]

#: The near-dedup, PII and packing stages can't be expressed in SQL; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = spark.conf.get("spark.checkpoint.dir", None)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            if folder:
                docs.write.parquet(path := f"{folder}/pipeline-{uuid.uuid4().hex}")
                docs = spark.read.parquet(path)
            else:
                docs = cut(docs)
    return docs
