"""Upserts and interval updates, and their staged writing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def replace_episodes(old: DataFrame, new: DataFrame, key: str = "episode_index") -> DataFrame:
    """old without the episodes of new, and new; a missing key is -1."""
    keyed = lambda d: d.withColumn(key, F.coalesce(key, F.lit(-1)))
    old, new = keyed(old), keyed(new)
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def update_intervals(frames: DataFrame, segments: DataFrame, keys: list[str], column: str, value: str, at: str = "frame_index", create: bool = False) -> DataFrame:
    """frames with column set by the last of the inclusive intervals that hold each frame; other frames keep theirs.

    With create a missing column is made, empty, behind subtask or at the end.
    """
    if column not in frames.columns:
        if not create:
            return frames
        cols = list(frames.columns)
        k = cols.index("subtask") + 1 if "subtask" in cols else len(cols)
        frames = frames.withColumn(column, F.lit("")).select(*[f"`{c}`" for c in [*cols[:k], column, *cols[k:]]])
    if at not in frames.columns:
        return frames
    listed = segments.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("segment_index", "start_frame", "end_frame", F.col(value).alias("v")))).alias("_s"))
    held = F.filter("_s", lambda s: (s["start_frame"] <= F.col(f"`{at}`")) & (F.col(f"`{at}`") <= s["end_frame"]))
    new = F.try_element_at(held, F.lit(-1))["v"]
    order = [F.col(f"`{c}`") if c != column else F.coalesce(new, F.col(f"`{c}`")).alias(c) for c in frames.columns]
    return frames.join(listed, keys, "left").select(*order)


def without_done(samples: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return samples.join(done.select(*keys).distinct(), keys, "left_anti")


def staged_write(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replaces the table at path, also where df reads it: written beside it, then renamed."""
    spark: SparkSession = df.sparkSession
    stage, old = f"{path}.{uuid.uuid4().hex}", f"{path}.{uuid.uuid4().hex}.old"
    writer = df.write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(stage)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = fs.exists(hadoop(path))
    if there and not fs.rename(hadoop(path), hadoop(old)):
        fs.delete(hadoop(stage), True)
        raise OSError(f"{path} could not be set aside; it is as it was")
    if not fs.rename(hadoop(stage), hadoop(path)):
        back = not there or fs.rename(hadoop(old), hadoop(path))
        raise OSError(f"{stage} could not be moved to {path}; " + ("the old table is back" if back else f"the old table is at {old}"))
    if there:
        fs.delete(hadoop(old), True)


def mark_done(samples: DataFrame, path: str, keys: list[str]) -> None:
    """Adds finished samples to the table at path, which without_done leaves out; marking twice is harmless."""
    samples.select(*keys).distinct().write.mode("append").parquet(path)
