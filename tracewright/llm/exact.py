"""Exact dedup by deterministic block naming, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Bytes of a block.
BLOCK = 4096
#: [\x20\x09-\x0D]
SPACES = " \t\n\x0b\f\r"


def without_space(text: Column) -> Column:
    """text without its white space; null is empty. Plain replacements search bytes and are much faster than translate."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACES:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows with an integer name for each different value of keys instead of keys.

    Equal values meet by a partial aggregate, are sorted within their hash partition, and the place in that order is
    the name; names of different partitions differ by their upper bits. The join back leaves a value of very many
    rows to adaptive execution's splitting.
    """
    names = rows.groupBy(*keys).agg(F.count("*").alias("_n")).sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())
    return rows.join(names.drop("_n"), keys).drop(*keys)


def block_identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, scratch: Scratch | None = None) -> DataFrame:
    """(id, sha, chars, level, name) for each row of docs: texts are equal without white space just when level and name are equal.

    Fixed-size blocks get integer names by content, adjacent names are paired and pairs named again, until one name is
    left; an odd last name is paired with -1. A name stands for one sequence of blocks, so identities cannot collide:
    no hash decides. (sha, the digest of the normalised text, only tells rows of one id apart.) Each level is written,
    so that names never change when an executor is lost. Repeated rows of a long text go on together, as often as they are.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "exact")
    text = F.col(text_col).cast("string")
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.length(text), F.lit(0)).cast("long").alias("chars"), without_space(text).alias("norm"))
    base = base.select("id", "chars", F.unhex(F.sha2("norm", 256)).alias("sha"), F.col("norm").cast("binary").alias("raw"))
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("raw") / F.lit(block))).cast("int")
    base = base.withColumn("n", count)
    cut = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.substring(F.col("raw"), i * block + 1, F.lit(block)))
    rows = base.select("id", "sha", "chars", "n", F.posexplode(cut).alias("idx", "block"))
    now = scratch.table(_named(rows, ["block"]), "level-0")
    scratch.release()
    done, level = None, 0
    while True:
        ready = now.where("n = 1").select("id", "sha", "chars", F.lit(level).alias("level"), "name")
        done = ready if done is None else done.union(ready)
        rest = now.where("n > 1")
        if rest.isEmpty():
            return done
        level += 1
        even = F.col("idx") % 2 == 0
        pairs = rest.groupBy("id", "sha", "chars", "n", F.expr("idx div 2").cast("int").alias("half")).agg(F.max(F.when(even, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"), F.count_if(even).alias("rows"))
        named = _named(pairs, ["a", "b"]).select("id", "sha", "chars", F.expr("(n + 1) div 2").cast("int").alias("n"), F.col("half").alias("idx"), "name", "rows")
        now = scratch.table(named.withColumn("_r", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).drop("_r", "rows"), f"level-{level}")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, scratch: Scratch | None = None) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for each row of docs, dropped ones too.

    Texts are equal when identical without [\\x20\\x09-\\x0D]; a null text counts as empty, and empty texts are equal.
    Of equal texts the row of most code points in the original text stays, then of the smallest id (a null id is the
    smallest). Repeated rows count each in group_size and are all marked alike. text_sha256: lowercase hex of the
    normalised text in UTF-8. Other columns are not used; an empty table gives an empty result.
    """
    scratch = scratch or Scratch(docs.sparkSession, "exact")
    each = block_identities(docs, id_col, text_col, block, scratch)
    groups = each.groupBy("level", "name").agg(F.count("*").alias("group_size"), F.min(F.struct((-F.col("chars")).alias("c"), F.col("id").alias("id"))).alias("best"))
    out = each.join(groups, ["level", "name"])
    return out.select(F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size", F.col("id").eqNullSafe(F.col("best.id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
