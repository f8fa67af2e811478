"""Canonical tables of the episode model, as schema strings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Enumerations.
CONTROL_MODES = ["joint", "ee", "unknown"]
DOMAINS = ["real", "sim"]
CAMERAS = ["cam_high", "cam_left_wrist", "cam_right_wrist", "cam_low"]

FRAMES = (
    "episode_index BIGINT, frame_index BIGINT, timestamp DOUBLE, `observation.state` ARRAY<FLOAT>, action ARRAY<FLOAT>, "
    "`observation.qvel` ARRAY<FLOAT>, `observation.effort` ARRAY<FLOAT>, action_relative ARRAY<FLOAT>, task STRING, subtask STRING, "
    "robot_type STRING, source_dataset STRING, control_mode STRING, quality INT, speed_bin INT, mistake BOOLEAN, success BOOLEAN, domain STRING"
)
EPISODES = (
    "episode_index BIGINT, source_file STRING, parquet_path STRING, task STRING, robot_type STRING, control_mode STRING, num_frames BIGINT, "
    "fps INT, duration_sec DOUBLE, speed_bin INT, quality INT, success BOOLEAN, mistake BOOLEAN, source_dataset STRING, video_paths MAP<STRING,STRING>"
)
SEGMENTS = ("episode_index BIGINT, segment_index BIGINT, start_frame BIGINT, end_frame BIGINT, task STRING, subtask STRING, annotation_status STRING")
MEMORY = (
    "episode_index BIGINT, segment_index BIGINT, start_frame BIGINT, end_frame BIGINT, start_timestamp DOUBLE, end_timestamp DOUBLE, task STRING, "
    "summary STRING, change_event_type ARRAY<STRING>, evidence_start_frame BIGINT, evidence_end_frame BIGINT, annotation_status STRING"
)
WINDOW_RESULTS = ("task_id STRING, window_id INT, vlm_json STRING")
HUMAN_VIDEO = (
    "sample_id STRING, video_index BIGINT, clip_index BIGINT, frame_index BIGINT, timestamp DOUBLE, video STRUCT<path: STRING, frame_index: BIGINT>, camera_view STRING, task STRING, "
    "subtask STRING, narration STRING, action_verb STRING, target_object STRING, objects ARRAY<STRING>, caption STRING, scene_type STRING, source_dataset STRING, source_url STRING, annotation_status STRING"
)
WEB_MULTIMODAL = (
    "sample_id STRING, modality STRING, task_type STRING, image STRUCT<path: STRING>, video STRUCT<path: STRING, frame_index: BIGINT>, question STRING, answer STRING, caption STRING, "
    "object_boxes ARRAY<STRUCT<object: STRING, bbox: ARRAY<DOUBLE>>>, attributes MAP<STRING,STRING>, objects ARRAY<STRING>, task STRING, subtask STRING, source_dataset STRING, source_url STRING, annotation_status STRING"
)
SOURCES = ("name STRING, robot_type STRING, fps INT, control_mode STRING, aliases ARRAY<STRING>")

# What the five kinds of records must have, and which values columns may take.
REQUIRED = {
    "robot_episode": ["episode_index", "frame_index", "timestamp", "observation.state", "action", "task", "subtask", "robot_type", "control_mode", "quality", "speed_bin", "mistake", "success", "source_dataset"],
    "segment_annotation": ["episode_index", "segment_index", "start_frame", "end_frame", "task", "subtask", "annotation_status"],
    "memory_segment": ["episode_index", "segment_index", "start_frame", "end_frame", "task", "summary", "annotation_status"],
    "human_video": ["sample_id", "video_index", "clip_index", "frame_index", "timestamp", "video.path", "camera_view", "task", "source_dataset"],
    "web_multimodal": ["sample_id", "modality", "task_type", "source_dataset"],
}
ALLOWED = {
    "robot_episode": {"control_mode": CONTROL_MODES, "domain": DOMAINS},
    "segment_annotation": {"annotation_status": ["auto_placeholder", "vlm_pseudo", "human_labeled", "reviewed", "approved"]},
    "memory_segment": {"annotation_status": ["auto", "vlm_pseudo", "human_labeled", "human_verified", "reviewed", "approved"]},
    "human_video": {"camera_view": ["egocentric", "third_person"], "annotation_status": ["auto", "vlm_pseudo", "human_labeled", "reviewed", "approved"]},
    "web_multimodal": {
        "modality": ["image", "video", "text", "image_text", "video_text"],
        "task_type": ["vqa", "captioning", "object_localization", "attribute_prediction", "video_captioning", "text_instruction"],
        "annotation_status": ["auto", "vlm_pseudo", "human_labeled", "reviewed", "approved"],
    },
}
RANGES = {"robot_episode": {"quality": (1, 5)}}
RECORDS = {"robot_episode": FRAMES, "segment_annotation": SEGMENTS, "memory_segment": MEMORY, "human_video": HUMAN_VIDEO, "web_multimodal": WEB_MULTIMODAL}


def fields(schema: str) -> list[tuple[str, str]]:
    """(name, type) of the columns of one of the schemas above."""
    out, depth, at = [], 0, 0
    for k, c in enumerate(schema + ","):
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            name, _, kind = schema[at:k].strip().partition(" ")
            out.append((name.strip("`"), kind))
            at = k + 1
    return out


def conform(df: DataFrame, schema: str) -> DataFrame:
    """df with the schema's columns and types; absent ones are null, others follow."""
    known = fields(schema)
    cols = [(F.col(f"`{n}`") if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in known]
    return df.select(*cols, *[F.col(f"`{c}`") for c in df.columns if c not in dict(known)])
