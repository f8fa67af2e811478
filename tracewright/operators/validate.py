"""Checks of frames, segments, vocabularies and provenance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright import schemas

# Annotation states in order of progress.
STATUS_ORDER = ["auto_placeholder", "auto", "vlm_pseudo", "human_verified"]


def violations(rows: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """keys, rule: one row for each broken rule; a rule that is null is broken. One scan, whatever the number of rules."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]))
    return rows.select(*keys, F.explode(broken).alias("rule"))


#: Kinds of Spark types that a declared one stands for.
KINDS = {"bigint": "int", "int": "int", "smallint": "int", "tinyint": "int", "double": "number", "float": "number"}


def _kind(t: str) -> str:
    t = t.lower().replace(" ", "")
    return "number" if t.startswith("decimal") else KINDS.get(t, t.split("<")[0])


def schema_violations(rows: DataFrame, record: str, keys: list[str]) -> DataFrame:
    """keys, rule: each rule that a row breaks of a kind of record (see schemas.REQUIRED, ALLOWED and RANGES).

    Rules are "<column>: missing" for required columns that are absent or null (a nested one's path may be a column of
    its own), "<column>: type" where a column's type is of another kind (whole numbers count as numbers), "<column>:
    value" for values that are not allowed, where the type fits. A null in a column that is not required breaks nothing.
    """
    have = dict(rows.dtypes)
    declared = dict(schemas.fields(schemas.RECORDS[record]))

    def found(name: str) -> Column | None:
        if name in have:
            return F.col(f"`{name}`")
        top, _, rest = name.partition(".")
        return F.col(name) if rest and have.get(top, "").startswith("struct<") and rest in rows.select(f"{top}.*").columns else None

    rules = {f"{c}: missing": F.lit(False) if found(c) is None else found(c).isNotNull() for c in schemas.REQUIRED[record]}
    for c, t in declared.items():
        if c in have and _kind(have[c]) != _kind(t) and not (_kind(t) == "number" and _kind(have[c]) == "int"):
            rules[f"{c}: type"] = found(c).isNull()
    for c, values in schemas.ALLOWED[record].items():
        if c in have and f"{c}: type" not in rules:
            rules[f"{c}: value"] = found(c).isNull() | found(c).isin(values)
    for c, (low, high) in schemas.RANGES.get(record, {}).items():
        if c in have and f"{c}: type" not in rules:
            rules[f"{c}: value"] = found(c).isNull() | found(c).between(low, high)
    return violations(rows, keys, rules)


def outliers(frames: DataFrame, keys: list[str], vector: str, spread: float = 6.0) -> DataFrame:
    """keys, dim, value: values further than `spread` standard deviations from their dimension's mean, and those that are not finite. One aggregate of one row a dimension is joined back."""
    flat = frames.select(*keys, F.posexplode(vector).alias("dim", "value")).withColumn("value", F.col("value").cast("double"))
    fine = ~F.isnan("value") & (F.abs("value") < float("inf"))
    by = flat.where(fine).groupBy("dim").agg(F.avg("value").alias("_m"), F.stddev_pop("value").alias("_s"))
    return flat.join(by, "dim", "left").where(~fine | (F.abs(F.col("value") - F.col("_m")) > spread * F.col("_s"))).select(*keys, "dim", "value")


def contiguity(frames: DataFrame, keys: list[str]) -> DataFrame:
    """Episodes whose frame_index is not 0..n-1 without gaps or repeats."""
    g = frames.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct("frame_index").alias("d"), F.min("frame_index").alias("lo"), F.max("frame_index").alias("hi"))
    return g.withColumn("contiguous", (F.col("lo") == 0) & (F.col("hi") - F.col("lo") + 1 == F.col("n")) & (F.col("n") == F.col("d")))


def segment_bounds(segments: DataFrame, episodes: DataFrame, keys: list[str], frames_col: str) -> DataFrame:
    """Each segment with its flags: inverted, outside, overlap with and gap before the one ahead of it."""
    w = Window.partitionBy(*keys).orderBy("start_frame", "segment_index")
    last = F.lag("end_frame").over(w)
    s = segments.join(episodes.select(*keys, F.col(frames_col).alias("_t")), keys)
    return s.select(*keys, "segment_index", (F.col("start_frame") > F.col("end_frame")).alias("inverted"), (F.col("end_frame") >= F.col("_t")).alias("outside"), F.coalesce(F.col("start_frame") <= last, F.lit(False)).alias("overlap"), F.greatest(F.lit(0), F.coalesce(F.col("start_frame") - last - 1, F.col("start_frame"))).alias("gap"))


def canonical_names(rows: DataFrame, name: str, vocabulary: DataFrame) -> DataFrame:
    """rows with the canonical name of each alias, null for unknown ones; vocabulary: canonical, aliases."""
    flat = vocabulary.select("canonical", F.explode(F.array_union(F.array("canonical"), F.col("aliases"))).alias(name)).distinct()
    return rows.join(flat, name, "left")


def dimension_errors(frames: DataFrame, keys: list[str], vector: str, width: int) -> DataFrame:
    return frames.groupBy(*keys).agg(F.count_if(F.size(vector) != width).alias("wrong"), F.count("*").alias("n"))


def provenance(rows: DataFrame, columns: list[str]) -> DataFrame:
    """name, missing, total of each column."""
    each = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).isNull().cast("int").alias("m")) for c in columns])
    return rows.select(F.explode(each).alias("e")).groupBy(F.col("e.name").alias("name")).agg(F.sum("e.m").alias("missing"), F.count("*").alias("total"))


def status_regressions(rows: DataFrame, keys: list[str], order: str, status: str) -> DataFrame:
    """Rows whose status ranks below the one before."""
    rank = reduce(lambda c, kv: c.when(F.col(status) == kv[1], kv[0]), enumerate(STATUS_ORDER), F.when(F.lit(False), -1))
    w = Window.partitionBy(*keys).orderBy(order)
    return rows.withColumn("_r", rank).withColumn("_p", F.lag("_r").over(w)).where("_r < _p").drop("_r", "_p")


def answer_shape(answers: DataFrame, keys: list[str], per_window: int) -> DataFrame:
    """Whether labels are one more than transitions, and these ascend within the window."""
    t = F.col("transitions")
    return answers.select(*keys, (F.size("labels") == F.size(t) + 1).alias("counts_fit"), (F.array_sort(t) == t).alias("ascending"), F.forall(t, lambda x: (x >= 0) & (x < per_window)).alias("in_range"))
