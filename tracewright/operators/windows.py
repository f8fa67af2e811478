"""Frame windows: planning, sampling, subtask-aligned windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.scalar import fps_or_default

WINDOW_SEC, STEP_SEC, FRAMES = 16.0, 8.0, 16


def frame_ids(start: Column, end: Column, n: int) -> Column:
    """n evenly spread frames from start to end, truncated; the last is end."""
    if n <= 1:
        return F.array(start.cast("int"))
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.when(i == n - 1, end).otherwise(i * ((end - start) / F.lit(float(n - 1))) + start).cast("int"))


def sample_frame_ids(start: Column, end: Column, n: int) -> Column:
    """n frames rounded half-even; the middle for one; start again and again for an empty span."""
    spread = F.transform(F.sequence(F.lit(0), F.lit(max(n, 2) - 1)), lambda i: F.bround(start + (end - start) * i / F.lit(float(max(n, 2) - 1))).cast("int"))
    middle = F.array(F.expr("1").cast("int") * F.floor((start + end) / 2).cast("int"))
    return F.when(end <= start, F.array_repeat(start.cast("int"), max(1, n))).otherwise(middle if n <= 1 else spread)


def build_windows(episodes: DataFrame, keys: list[str], frames_col: str, fps_col: str, window_sec: float = WINDOW_SEC, step_sec: float = STEP_SEC, per_window: int = FRAMES) -> DataFrame:
    """keys, nframes, fps, window_id, start_frame, end_frame, frame_ids: overlapping windows of each episode.

    The first window always counts; a later one if it holds half a window at least. end - start never rises from one
    window to the next, so a filter does what stopping at the first short window would.
    """
    e = episodes.select(*keys, F.col(frames_col).cast("int").alias("nframes"), fps_or_default(F.col(fps_col)).alias("fps")).where("nframes > 0")
    length = F.greatest(F.lit(1), F.bround(window_sec * F.col("fps")).cast("int"))
    step = F.greatest(F.lit(1), F.bround(step_sec * F.col("fps")).cast("int"))
    e = e.withColumns({"_l": length, "_s": step})
    w = e.withColumn("window_id", F.explode(F.expr("sequence(0, (nframes - 1) div _s)").cast("array<int>")))
    w = w.withColumn("start_frame", (F.col("window_id") * F.col("_s")).cast("int"))
    w = w.withColumn("end_frame", F.least(F.col("nframes") - 1, F.col("start_frame") + F.col("_l") - 1))
    w = w.where("window_id = 0 or end_frame - start_frame >= _l div 2")
    return w.withColumn("frame_ids", frame_ids(F.col("start_frame"), F.col("end_frame"), per_window)).drop("_l", "_s")


def aligned_windows(segments: DataFrame, keys: list[str], per_window: int = FRAMES) -> DataFrame:
    """The segments themselves as windows; a window's id is its segment's index."""
    return segments.select(*keys, F.col("segment_index").cast("int").alias("window_id"), "start_frame", "end_frame", sample_frame_ids(F.col("start_frame"), F.col("end_frame"), per_window).alias("frame_ids"))


def pending(windows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Windows without a result."""
    return windows.join(done, [*keys, "window_id"], "left_anti")


def complete(windows: DataFrame, results: DataFrame, keys: list[str]) -> DataFrame:
    """keys of the samples that have as many different results as windows."""
    planned = windows.groupBy(*keys).agg(F.count("*").alias("planned"))
    got = results.groupBy(*keys).agg(F.count_distinct("window_id").alias("got"))
    return planned.join(got, keys).where("got >= planned").select(*keys, "planned", "got")


def last_results(results: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last written result of each window."""
    cols = [c for c in results.columns if c not in (*keys, "window_id")]
    return results.groupBy(*keys, "window_id").agg(F.max_by(F.struct(*cols), order).alias("r")).select(*keys, "window_id", "r.*")
