"""Episode and dataset aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def vector_stats(frames: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """keys, dim, min, max, mean, std (population) of each dimension, in double. Partial aggregates keep the exploded rows out of the shuffle."""
    rows = frames.select(*keys, F.posexplode(F.col(vector).cast("array<double>")).alias("dim", "x"))
    return rows.groupBy(*keys, "dim").agg(F.min("x").alias("min"), F.max("x").alias("max"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"))


def as_vectors(stats: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key with arrays in order of dimensions."""
    rows = F.array_sort(F.collect_list(F.struct("dim", "min", "max", "mean", "std")))
    return stats.groupBy(*keys).agg(rows.alias("r")).select(*keys, *[F.col(f"r.{m}").alias(f"state_{m}") for m in ("min", "max", "mean", "std")])


def totals(episodes: DataFrame, frames_col: str) -> DataFrame:
    return episodes.agg(F.count("*").alias("num_episodes"), F.coalesce(F.sum(frames_col), F.lit(0)).alias("num_frames"))


def ordinals(rows: DataFrame, name: str) -> DataFrame:
    """Distinct values in binary order, numbered from 0. The unpartitioned order is over distinct values only."""
    return rows.select(name).where(F.col(name).isNotNull()).distinct().select((F.row_number().over(Window.orderBy(name)) - 1).cast("string").alias("id"), name)


def boolean_mode(rows: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """The more frequent value; false on a tie."""
    return rows.groupBy(*keys).agg((F.count_if(F.col(flag)) > F.count_if(~F.col(flag))).alias(flag))


def dimensions(frames: DataFrame, state: str, action: str) -> DataFrame:
    return frames.agg(F.first(F.size(state)).alias("state_dim"), F.first(F.size(action)).alias("action_dim"))


def source_files(frames: DataFrame, keys: list[str], name: str) -> DataFrame:
    return frames.groupBy(*keys).agg(F.array_sort(F.collect_set(name)).alias("files"))


def progress(samples: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    marked = samples.select(*keys).distinct().join(done.select(*keys).distinct().withColumn("_d", F.lit(1)), keys, "left")
    return marked.agg(F.count("*").alias("total"), F.count("_d").alias("done"), (F.count("*") - F.count("_d")).alias("left"))


def retries(attempts: DataFrame, task: str, most: int) -> DataFrame:
    return attempts.groupBy(task).agg(F.count("*").alias("attempts")).withColumn("exhausted", F.col("attempts") > most)
