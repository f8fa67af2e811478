"""Native file sources: episode Parquet, JSON lines, window results, discovery of videos."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed value: the source of episodes that no list names.
UNLISTED = "RMBench"


def droid_parquet(spark: SparkSession, root: str) -> DataFrame:
    """Rows of data/chunk-000/file-*.parquet with file_index, the number at the end of the file's stem."""
    df = spark.read.parquet(f"{root}/data/chunk-000/file-*.parquet")
    if missing := {"episode_index", "frame_index", "timestamp"} - set(df.columns):
        raise KeyError(", ".join(sorted(missing)))
    return df.withColumn("file_index", F.regexp_extract(F.col("_metadata.file_name"), r"-(\d+)\.parquet$", 1).cast("int"))


def dataset_fps(spark: SparkSession, root: str, default: int = 15) -> int:
    row = spark.read.option("multiLine", True).json(f"{root}/meta/info.json")
    return int(row.select("fps").first()[0] or default) if "fps" in row.columns else default


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite", order: list[str] | None = None) -> None:
    """JSON lines, with order sorted by it across files and in them."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    rows.write.mode(mode).option("ignoreNullFields", "false").json(path)


def json_object(df: DataFrame, key: str, value) -> DataFrame:
    """One row, json: an object of value (a column) by key, sorted by key. For vocabularies and statistics: the object is one value."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).cast("string").alias("key"), value.alias("value"))))
    return df.agg(F.to_json(F.map_from_entries(entries), {"ignoreNullFields": "false"}).alias("json"))


def write_json_object(df: DataFrame, path: str, key: str, value) -> None:
    """The object as one file, indented by two spaces."""
    text = json.dumps(json.loads(json_object(df, key, value).first()[0]), indent=2, ensure_ascii=False)
    spark = df.sparkSession
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def episode_path(source: str, episode: int) -> str:
    return f"data/{source}/chunk-000/episode_{episode:06d}.parquet"


def _episode_writer(root: str):
    """For mapInArrow over frames sorted by source_dataset and episode_index: writes one file an episode, gives its row of the listing. A file is written beside its place and moved there, so a repeated task replaces it whole."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs as filesystems

        fs, base = filesystems.FileSystem.from_uri(root)
        now = out = stage = None
        rows = 0

        def closed():
            out.close()
            fs.move(stage, f"{base}/{episode_path(*now)}")
            return pa.RecordBatch.from_pydict({"source_dataset": [now[0]], "episode_index": pa.array([now[1]], pa.int64()), "parquet_path": [episode_path(*now)], "num_frames": pa.array([rows], pa.int64())})

        for batch in batches:
            keys = list(zip(batch.column("source_dataset").to_pylist(), batch.column("episode_index").to_pylist()))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                if keys[i] != now:
                    if out:
                        yield closed()
                    now, rows = keys[i], 0
                    place = f"{base}/{episode_path(*now)}"
                    fs.create_dir(place.rsplit("/", 1)[0], recursive=True)
                    stage = f"{place}.{uuid.uuid4().hex}.tmp"
                    out = pq.ParquetWriter(stage, batch.schema, filesystem=fs)
                out.write_batch(batch.slice(i, j - i))
                rows += j - i
        if out:
            yield closed()

    return run


def write_episodes(frames: DataFrame, root: str) -> DataFrame:
    """One Parquet file for each episode at the path that episodes_table records, frames in order; gives (source_dataset, episode_index, parquet_path, num_frames). root: a URI all executors share. Runs when the listing is read."""
    rows = frames.repartition("source_dataset", "episode_index").sortWithinPartitions("source_dataset", "episode_index", "frame_index")
    return rows.mapInArrow(_episode_writer(root), "source_dataset string, episode_index long, parquet_path string, num_frames long")


def episode_files(spark: SparkSession, root: str) -> DataFrame:
    """path, episode_index of all files data/**/episode_NNNNNN.parquet below root; contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "episode_*.parquet").load(f"{root}/data").select("path")
    return listed.select("path", F.regexp_extract("path", r"/episode_(\d+)\.parquet$", 1).cast("bigint").alias("episode_index")).where("episode_index is not null")


def resolve_episode_paths(episodes: DataFrame, found: DataFrame) -> DataFrame:
    """episode_index, path: the file at the episode's recorded parquet_path where found has it, else the first found of the episode, else null. found: see episode_files."""
    by = found.groupBy("episode_index").agg(F.min("path").alias("_first"), F.collect_set("path").alias("_paths"))
    at = F.element_at(F.array_sort(F.filter("_paths", lambda p: F.endswith(p, F.concat(F.lit("/"), F.col("parquet_path"))))), 1)
    return episodes.join(by, "episode_index", "left").select("episode_index", F.coalesce(F.when(F.size(F.filter("_paths", lambda p: F.endswith(p, F.concat(F.lit("/"), F.col("parquet_path"))))) > 0, at), "_first").alias("path"))


def episodes_from_segments(segments: DataFrame) -> DataFrame:
    """episode_index, num_frames, source_dataset, fps: the episodes that segments name, for roots without a list of episodes; the frame rate is not known."""
    held = segments.where("episode_index >= 0")
    return held.groupBy("episode_index").agg((F.max("end_frame") + 1).alias("num_frames")).select("episode_index", "num_frames", F.lit(UNLISTED).alias("source_dataset"), F.lit(None).cast("int").alias("fps"))


def sample_folders(spark: SparkSession, root: str, pattern: str = "Frame_*.mp4") -> DataFrame:
    """sample_id, video: each folder directly below root and its first video by name."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path")
    return listed.groupBy(F.element_at(F.split("path", "/"), -2).alias("sample_id")).agg(F.min("path").alias("video"))


def with_metadata(samples: DataFrame, episodes: DataFrame) -> DataFrame:
    """samples with the columns of their episode, looked up by sample_id (episode_NNNNNN); samples without one stay with nulls."""
    named = episodes.withColumn("sample_id", F.format_string("episode_%06d", "episode_index"))
    return samples.join(named.drop(*[c for c in samples.columns if c != "sample_id"]), "sample_id", "left")


def window_results(spark: SparkSession, path: str) -> DataFrame:
    """task_id, window_id, vlm (VARIANT) of every line that parses and has a window_id; other lines are skipped."""
    v = spark.read.text(path).select(F.try_parse_json("value").alias("v"))
    return v.select(F.try_variant_get("v", "$.task_id", "string").alias("task_id"), F.try_variant_get("v", "$.window_id", "int").alias("window_id"), F.try_variant_get("v", "$.vlm_json", "variant").alias("vlm")).where("window_id is not null")


def files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """path, index of the files below root in order of path; contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path")
    return listed.withColumn("index", F.row_number().over(Window.orderBy("path")) - 1)


def candidate_videos(videos: DataFrame, key: str, path: str = "path") -> DataFrame:
    """Videos whose name holds key; all of them for auto or where none does."""
    if key == "auto":
        return videos
    name = F.element_at(F.split(path, "/"), -1)
    hit = videos.withColumn("_hit", F.contains(name, F.lit(key)))
    some = hit.agg(F.coalesce(F.bool_or("_hit"), F.lit(False)).alias("_some"))
    return hit.join(F.broadcast(some)).where("_hit or not _some").drop("_hit", "_some")


def resolve_videos(episodes: DataFrame, first_rows: DataFrame, ordinal: DataFrame, key: str) -> DataFrame:
    """episode_index, video: the recorded path of key, else of the episode's first row, else the video of its ordinal; null where none."""
    joined = episodes.join(first_rows.withColumnRenamed("path", "_first"), "episode_index", "left").join(ordinal.withColumnRenamed("path", "_nth"), "episode_index", "left")
    return joined.select("episode_index", F.coalesce(F.try_element_at("video_paths", F.lit(key)), "_first", "_nth").alias("video"))


def segments_by_sample(segments: DataFrame) -> DataFrame:
    """sample_id, segments in order; negative and missing episodes are left out."""
    held = segments.where("episode_index >= 0")
    return held.groupBy(F.format_string("episode_%06d", "episode_index").alias("sample_id")).agg(F.array_sort(F.collect_list(F.struct("start_frame", "segment_index", "end_frame", "subtask"))).alias("segments"))


def parse_datasets(text: str) -> list[tuple[str, str]]:
    """(root, subset) of "root:subset;path", a path without subset being its own."""
    out = []
    for part in filter(None, map(str.strip, text.split(";"))):
        m = re.fullmatch(r"(.+):([^:/\\]+)", part)
        out.append((m[1], m[2]) if m else (part.rsplit("/", 1)[0], part.rsplit("/", 1)[-1]))
    return out
