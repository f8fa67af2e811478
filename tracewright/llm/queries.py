"""The registered queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import link_tool_calls
from .common import Scratch
from .exact import exact_duplicates
from .lines import drop_lines, keep_bitmaps
from .near import near_duplicates
from .oracles import ORACLES  # noqa: F401  read by __spark_entry__.py
from .packing import pack
from .passages import drop_passages
from .pieces import digests, encode_pieces
from .quality import quality_rules
from .secrets import digested, find_secrets
from .token_files import read_tokens, write_tokens

#: The end id of op4 and op8.
END_ID = 2
#: Tools that op7's conversations may call.
TOOLS = {
    "search": {"type": "object", "required": ["query"], "properties": {"query": {"type": "string"}, "limit": {"type": "integer"}}},
    "fetch": {"type": "object", "required": ["url"], "properties": {"url": {"type": "string"}}},
    "calculate": {"type": "object", "required": ["expression"], "properties": {"expression": {"type": "string"}}},
}


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), words=3, num=85, den=100)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return drop_lines(docs, keep_bitmaps(docs, min_docs=10, min_chars=1), with_text=False)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op4")
    manifest = write_tokens(documents(spark, sf_dir), f"{scratch.path}/shards", tokenizer("word_bpe_49k.json"), END_ID, scratch=scratch)
    return read_tokens(spark, manifest, digest=True)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(documents(spark, sf_dir))
    return found.mapInArrow(digested, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode_pieces(documents(spark, sf_dir), tokenizer("piece_bpe_32k.model"))
    return rows.mapInArrow(digests, "doc_id long, n_tokens long, ids_crc32 long, same boolean")


def exchanges(turns: DataFrame) -> DataFrame:
    """The conversations, whose texts hold no calls, with every exchange as a tool call too: what the user says is a call of `search` that refers to the user's call before it, what the assistant says next is its result."""
    named = lambda back: F.concat(F.lit("c"), F.col("turn") - back)
    after = F.when(F.col("turn") >= 2, F.struct(named(2).alias("$ref")))
    call = F.to_json(F.struct(named(0).alias("id"), F.lit("search").alias("name"), F.struct(F.col("text").alias("query"), after.alias("after")).alias("arguments")))
    result = F.to_json(F.struct(named(1).alias("id"), F.col("text").alias("content")))
    said = F.when(F.col("role") == "user", F.concat("text", F.lit("<tool_call>"), call, F.lit("</tool_call>")))
    said = said.when(F.col("role") == "assistant", F.concat("text", F.lit("<tool_result>"), result, F.lit("</tool_result>")))
    return turns.withColumn("text", said.otherwise(F.col("text")))


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_tool_calls(exchanges(spark.read.parquet(f"{sf_dir}/conversations.parquet")), TOOLS)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"), END_ID, 1024)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_passages(documents(spark, sf_dir), length=200, digest=True)


QUERIES = {f.__name__: f for f in (op1_minhash_near_dedup, op2_line_dedup, op3_exact_dedup, op4_token_files, op5_secret_scan, op6_sentencepiece, op7_tool_calls, op8_best_fit_packing, op9_quality_rules, op10_passage_dedup)}
