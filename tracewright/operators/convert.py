"""Raw episodes to the canonical tables, as one lazy plan for each source."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions import scalar as S

from .segments import label_frames, placeholder_segments


def frames_from_arrays(episodes: DataFrame, fps: int, labels: list[str] = S.ALOHA_LABELS) -> DataFrame:
    """Frames of episodes given as arrays; episodes: episode_index, state, action (array of arrays), task, success, robot_type, source_dataset.

    Episodes whose state and action differ in length are left out: see unequal_episodes.
    """
    e = episodes.where(F.size("state") == F.size("action")).withColumn("num_frames", F.size("state"))
    rows = e.select("episode_index", "task", "success", "robot_type", "source_dataset", "num_frames", F.posexplode(F.arrays_zip("state", "action")).alias("frame_index", "v"))
    rows = rows.select("episode_index", F.col("frame_index").cast("long").alias("frame_index"), S.timestamp(F.col("frame_index"), fps).alias("timestamp"), F.col("v.state").alias("observation.state"), F.col("v.action").alias("action"), "task", "robot_type", "source_dataset", F.lit("joint").alias("control_mode"), S.quality(F.col("success")).alias("quality"), S.speed_bin(F.col("num_frames")).alias("speed_bin"), S.mistake(F.col("success")).alias("mistake"), "success", F.lit("real").alias("domain"), S.future_frame(F.col("frame_index"), fps, F.col("num_frames")).cast("long").alias("subgoal.real_future.cam_high.frame_index"))
    return label_frames(rows, placeholder_segments(e, ["episode_index"], "num_frames", labels), ["episode_index"])


def unequal_episodes(episodes: DataFrame) -> DataFrame:
    return episodes.where(F.size("state") != F.size("action")).select("episode_index", F.size("state").alias("states"), F.size("action").alias("actions"))


def episodes_table(frames: DataFrame, fps: int) -> DataFrame:
    g = frames.groupBy("episode_index").agg(F.count("*").alias("num_frames"), *[F.first(c).alias(c) for c in ("task", "robot_type", "source_dataset", "control_mode", "success")])
    return g.withColumns({"fps": F.lit(fps), "duration_sec": F.col("num_frames") / fps, "speed_bin": S.speed_bin(F.col("num_frames")), "quality": S.quality(F.col("success")), "mistake": ~F.col("success"), "parquet_path": F.concat(F.lit("data/"), F.col("source_dataset"), F.lit("/chunk-000/"), S.episode_name(F.col("episode_index")), F.lit(".parquet"))})


def local_frames(raw: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """raw with frame_index numbered from 0 in order, and the episode's number of frames as T."""
    w = Window.partitionBy(*keys)
    return raw.withColumn("source_frame_index", F.col("frame_index")).withColumn("frame_index", F.row_number().over(w.orderBy(*order)) - 1).withColumn("T", F.count("*").over(w))


def renumber(episodes: DataFrame, order: list[str], start: int = 0) -> DataFrame:
    """Episodes numbered 0.. in scan order; the unpartitioned order is over one row for each episode."""
    return episodes.withColumn("episode_index", F.row_number().over(Window.orderBy(*order)) - 1 + start)


def droid_frames(raw: DataFrame, fps: int = 15, merge_files: bool = False) -> DataFrame:
    """Frames of raw rows with file_index, episode_index, frame_index, timestamp, and vectors whole or in parts.

    An episode that spans two files is two episodes, unless merge_files. The source timestamp only orders rows.
    """
    keys = ["episode_index"] if merge_files else ["file_index", "episode_index"]
    vectors = raw.withColumns({"_state": S.pick_state(raw.columns), "_action": S.pick_action(raw.columns)})
    return local_frames(vectors, keys, ["timestamp", "frame_index"]).withColumn("timestamp", F.col("frame_index") / fps)


def droid_tasks(raw: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first instruction that is not blank, and whether more frames call the episode successful than not."""
    text = F.trim("language_instruction")
    task = F.min_by(F.when(text != "", text), F.when(text != "", F.struct(*order)))
    return raw.groupBy(*keys).agg(F.coalesce(task, F.lit(S.DROID_DEFAULT_TASK)).alias("task"), (F.count_if("is_episode_successful") > F.count_if(~F.col("is_episode_successful"))).alias("success"))
