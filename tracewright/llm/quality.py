"""Quality rules with thresholds from mergeable quantile sketches per language and source; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch
from .exact import SPACES, without_space

#: Words of a window for n_repeat_words.
WINDOW = 5
SYMBOLS = "#*$%&|<>"
#: Buckets of a sketch: a share is counted in whole thousandths, so a quantile is off by 1/1000 at most.
TOP = 1000
#: Buckets of mean word length: each is wider than the one before by a factor of e^(1/FINE), without a last one, so a quantile is off by 1/FINE of itself at most.
FINE = 500
#: A metric may lie so many interquartile ranges beyond the nearer quartile, and anywhere between the outer thousandths of
#: OUTER: few rows repeat anything, so in most groups the quartiles of repeats are 0 and only their outer rows say what is usual.
SPREAD = 6
OUTER = {"symbols": 100, "dup_lines": 5, "repeats": 5, "word_length": 100}
#: Symbols that do not count, and what is added to a text's lines and words in the shares, so that one symbol or one repeated line does not condemn a short text.
FEW_SYMBOLS, FEW_LINES, FEW_WORDS = 4, 8, 40
#: Rows that a group's fence weighs as its language's, and a language's as that of all rows: a fence of n rows counts n / (n + LENT).
LENT = 20


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once."""
    return F.get(F.transform(F.array(value), body), 0)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in a window of `window` words that the text has twice or more.

    Windows are compared by 64-bit hashes within one text. Only texts with a repeated window are sorted.
    """

    def grams(each: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(each) - window), lambda i: F.xxhash64(*[F.get(each, i + k) for k in range(window)]))

    def places(pairs: Column) -> Column:
        same = F.filter(pairs, lambda p, k: (p["g"] == F.get(pairs, k - 1)["g"]) | (p["g"] == F.get(pairs, k + 1)["g"]))
        return F.array_sort(F.transform(same, lambda p: p["i"]))

    def covered(at: Column) -> Column:
        # least() skips the null behind the last place
        return F.aggregate(F.transform(at, lambda x, k: F.least(F.lit(window), F.get(at, k + 1) - x)), F.lit(0), lambda a, b: a + b)

    def count(g: Column) -> Column:
        pairs = F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(let(let(pairs, places), covered))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < window, F.lit(0)).otherwise(let(let(hashed, grams), count)).cast("long")


def measures(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words); see quality_rules."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    read = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), text.alias("text"))
    bare = F.col("text")
    for c in SYMBOLS:
        bare = F.replace(bare, F.lit(c), F.lit(""))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    split = read.select("id", "lang", "source", words_of(F.col("text")).alias("words"), lines.alias("lines"), F.char_length(without_space(F.col("text"))).cast("long").alias("word_chars"), (F.octet_length("text") - F.octet_length(bare)).cast("long").alias("n_symbols"))
    return split.select(
        "id", "lang", "source",
        F.size("words").cast("long").alias("n_words"),
        "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )


def _share(part: str, whole: str) -> Column:
    return F.when(F.expr(whole) > 0, F.expr(f"({part} * {TOP}L) div {whole}")).otherwise(F.lit(0).cast("long"))


def metrics() -> dict[str, Column]:
    return {
        "symbols": _share(f"greatest(0, n_symbols - {FEW_SYMBOLS})", "word_chars"),
        "dup_lines": _share("n_dup_lines", f"(n_lines + {FEW_LINES})"),
        "repeats": _share("n_repeat_words", f"(n_words + {FEW_WORDS})"),
        "word_length": F.when(F.col("n_words") > 0, F.floor(FINE * F.log(F.col("word_chars") / F.col("n_words")))).otherwise(F.lit(0).cast("long")),
    }


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, metric, bucket, n): for each group and metric a sketch of TOP + 1 counters at most, for word length of FINE for each factor e of its range. Two sketches merge by adding their counters, in any order and to the same result."""
    each = F.array(*[F.struct(F.lit(k).alias("metric"), v.alias("bucket")) for k, v in metrics().items()])
    return measured.select("lang", "source", F.explode(each).alias("m")).groupBy("lang", "source", "m.metric", "m.bucket").agg(F.count("*").alias("n"))


def fences(sketch: DataFrame) -> DataFrame:
    """(level, lang, source, metric, rows, low, high): limits from the quartiles and outer rows of each sketch, of those merged by language, and of all merged."""
    null = F.lit(None).cast("string")
    levels = sketch.select(F.lit(2).alias("level"), "lang", "source", "metric", "bucket", "n")
    levels = levels.union(sketch.select(F.lit(1), "lang", null, "metric", "bucket", "n")).union(sketch.select(F.lit(0), null, null, "metric", "bucket", "n"))
    merged = levels.groupBy("level", "lang", "source", "metric", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy("level", "lang", "source", "metric")
    ranked = merged.select("*", F.sum("n").over(group.orderBy("bucket")).alias("upto"), F.sum("n").over(group).alias("rows"))
    outer = F.create_map(*[F.lit(x) for kv in OUTER.items() for x in kv])[F.col("metric")]
    shares = {"least": outer, "q1": F.lit(250), "q3": F.lit(750), "most": 1000 - outer}
    at = [F.min(F.when(F.col("upto") * 1000 >= F.col("rows") * v, F.col("bucket"))).alias(k) for k, v in shares.items()]
    quartiles = ranked.groupBy("level", "lang", "source", "metric").agg(F.max("rows").alias("rows"), *at)
    wide = SPREAD * (F.col("q3") - F.col("q1"))
    return quartiles.select("level", "lang", "source", "metric", "rows", F.least(F.col("q1") - wide, "least").alias("low"), F.greatest(F.col("q3") + wide, "most").alias("high"))


def limits(fence: DataFrame, groups: DataFrame) -> DataFrame:
    """(g_lang, g_source, and a struct low, high for each metric): each group's fences, weighed with those of its language and of all rows."""
    names = list(metrics())
    wide = fence.groupBy("level", "lang", "source").agg(*[F.max(F.when(F.col("metric") == m, F.struct("rows", "low", "high"))).alias(m) for m in names])
    own, lang, every = (wide.where(F.col("level") == k) for k in (2, 1, 0))
    own = own.select(F.col("lang").alias("o_lang"), F.col("source").alias("o_source"), F.struct(*names).alias("own"))
    lang = lang.select(F.col("lang").alias("l_lang"), F.struct(*names).alias("by_lang"))
    every = every.select(F.struct(*names).alias("by_all"))
    each = groups.join(own, F.col("g_lang").eqNullSafe(F.col("o_lang")) & F.col("g_source").eqNullSafe(F.col("o_source")), "left")
    each = each.join(lang, F.col("g_lang").eqNullSafe(F.col("l_lang")), "left").join(F.broadcast(every), F.lit(True), "left")

    def weighed(metric: str, side: str) -> Column:
        out = F.col(f"by_all.{metric}.{side}")
        for level in ("by_lang", "own"):
            n, value = F.col(f"{level}.{metric}.rows"), F.col(f"{level}.{metric}.{side}")
            out = F.when(n.isNull(), out).otherwise(F.floor((n * value + LENT * out) / (n + LENT)))
        return out.alias(side)

    return each.select("g_lang", "g_source", *[F.struct(weighed(m, "low"), weighed(m, "high")).alias(m) for m in names])


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_words: int = 10, repeat_share: int = 20, scratch: Scratch | None = None) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, and each metric's verdict) for each row of docs.

    Words are [^\\x20\\x09-\\x0D]+ of the whole text (null: none). word_chars: code points in words. n_symbols:
    characters of [#*$%&|<>]. n_dup_lines: lines with a word that equal an earlier line. n_repeat_words: words in
    five-word windows found twice or more. base_failed: fewer than least_words words, or over repeat_share percent of
    the words repeat. Else a row fails if a metric lies outside its group's fence: share of symbols, of repeated lines
    and of repeated words (high only), and mean word length (both sides).

    Fences come from sketches over all rows that the base rule leaves: bounded counters per language and source,
    merged by addition, so the result does not depend on partitions or order (randomised sketches such as KLL would let
    a verdict change from run to run). A fence lies SPREAD interquartile ranges beyond the quartiles, or at the outer
    rows (OUTER) where that is wider. Small groups lean on their language and small languages on all rows, by weight
    (LENT), without a switch.
    A null language or source is a group of its own. Repeated rows each count. An empty table gives an empty result.
    """
    scratch = scratch or Scratch(docs.sparkSession, "quality")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_share * F.col("n_words"))
    measured = scratch.table(measures(docs, id_col, text_col, lang_col, source_col).withColumn("base_failed", failed), "measures")
    names = list(metrics())
    groups = measured.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source")).distinct()
    chosen = scratch.table(limits(fences(sketches(measured.where("not base_failed"))), groups), "limits")
    rows = measured.select("*", *[v.alias(f"v_{k}") for k, v in metrics().items()])
    joined = rows.join(chosen, F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source")), "left")
    verdict = {m: (F.col(f"v_{m}") > F.col(f"{m}.high")) | ((F.col(f"v_{m}") < F.col(f"{m}.low")) if m == "word_length" else F.lit(False)) for m in names}
    out = joined.select("*", *[F.coalesce(v, F.lit(False)).alias(f"odd_{m}") for m, v in verdict.items()])
    kept = ~F.col("base_failed")
    for m in names:
        kept = kept & ~F.col(f"odd_{m}")
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), *[f"odd_{m}" for m in names])
