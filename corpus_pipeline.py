"""A corpus pipeline: quality rules, line dedup, near-duplicate dedup, secret masking, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm.common import Scratch
from tracewright.llm.lines import drop_lines, keep_bitmaps
from tracewright.llm.near import near_duplicates
from tracewright.llm.packing import pack
from tracewright.llm.quality import quality_rules
from tracewright.llm.queries import END_ID, tokenizer
from tracewright.llm.secrets import find_secrets, masked

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: What stands in a text instead of a secret.
SIGN = "[SECRET]"


def _chosen(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """The rows of docs whose id is marked kept. A null id is an id like any other; of rows of one id all stay if one does."""
    kept = marks.where("kept").select(F.col("doc_id").alias("kept_id"))
    return docs.select(*COLUMNS).join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return _chosen(docs, quality_rules(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a line whose key at least ten documents have, only the first in order of document and position stays.

    A document goes if nothing of it stays: each of its lines then stands in an earlier one.
    """
    out = drop_lines(docs.select(*COLUMNS), keep_bitmaps(docs, min_docs=10, min_chars=1, keep_first=True))
    left = out.where(F.btrim("text", F.lit(" \t\n\x0b\f\r")) != "")
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates (five-word shingles, similarity of 0.8 or more) the one of the smallest id stays."""
    return _chosen(docs, near_duplicates(docs, words=5, num=80, den=100))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    found = find_secrets(docs.select(*COLUMNS), carry=["text", "lang", "source"])
    rows = found.select(F.col("doc_id").alias("id"), "text", "spans", "lang", "source")
    out = rows.mapInArrow(masked(SIGN), "id long, text string, lang string, source string")
    return out.select(F.col("id").alias("doc_id"), "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of at most 1024 tokens."""
    return pack(docs, tokenizer("byte_bpe_50k.json"), END_ID, 1024)


STAGES = [("quality rules", quality), ("line dedup", lines), ("near dedup", near), ("secret scans", secrets), ("best-fit packing", packing)]

#: Masking by inferred grammars and tokenizing are not expressible in SQL; tests compare run() with its stages and hold the operators against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages' result over documents; what each returns is written and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.table(docs, f"stage-{k}")
    return docs
