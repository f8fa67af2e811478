"""Every registered query of the episode engine, with its SQL.

The driver's tables stand in for episode data: events are frames of a user's episode, documents are long episodes of
n_chars frames at 25 a second, embeddings are state vectors, conversations are annotated segments, labels are success
flags, parts and nations are vocabularies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.functions import scalar as S
from tracewright.operators import annotate, convert, segments, stats, validate, windows, writeback
from tracewright.sources import files

FPS = 25
EP = ["episode_index"]

_QUERIES: dict = {}
_ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---- stand-ins


def frames(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "events").select(F.col("user_id").alias("episode_index"), "event_id", "ts", "event_type", "value", "props", F.lit(0).alias("frame_index"))
    return convert.local_frames(raw, EP, ["ts", "event_id"]).drop("source_frame_index")


FRAMES = "frames AS (SELECT user_id AS episode_index, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_index, count(*) OVER (PARTITION BY user_id) AS T, event_type, value, props FROM events)"
EPISODES = "episodes AS (SELECT episode_index, any_value(T) AS T FROM frames GROUP BY 1)"


def quarter_sql(source: str, labels: list[str], key: str = "episode_index") -> str:
    cuts = ["0", "trunc(T * 0.25::DOUBLE)::BIGINT", "trunc(T * 0.5::DOUBLE)::BIGINT", "trunc(T * 0.75::DOUBLE)::BIGINT", "T"]
    rows = " UNION ALL ".join(f"SELECT {key}, {k} AS o, {a} AS s, {b} - 1 AS e, '{x}' AS subtask FROM {source}" for k, (a, b, x) in enumerate(zip(cuts, cuts[1:], labels)))
    return f"quarters AS (SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY o) - 1 AS segment_index, s AS start_frame, e AS end_frame, subtask FROM ({rows}) WHERE e >= s)"


QUARTERS = quarter_sql("episodes", S.ALOHA_LABELS)


def long_episodes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").alias("episode_index"), F.col("n_chars").alias("T"), F.lit(float(FPS)).alias("fps"), "lang", "source")


def annotated(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, d, "conversations").select("conv_id", "turn", "role", "text", F.length("text").alias("n"))
    end = F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return c.select(F.col("conv_id").alias("episode_index"), F.col("turn").alias("segment_index"), (end - F.col("n")).alias("start_frame"), (end - 1).alias("end_frame"), F.col("role").alias("subtask"), F.col("text").alias("summary"))


ANNOTATED = "annotated AS (SELECT conv_id AS episode_index, turn AS segment_index, (sum(length(text)) OVER w - length(text))::BIGINT AS start_frame, (sum(length(text)) OVER w - 1)::BIGINT AS end_frame, role AS subtask, text AS summary FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING))"


def planned(spark: SparkSession, d: str) -> DataFrame:
    return windows.build_windows(long_episodes(spark, d), EP, "T", "fps")


PLANNED = f"""planned AS (SELECT episode_index, n AS nframes, window_id, s AS start_frame, e AS end_frame, lang, source,
  list_transform(range(16), lambda i: CASE WHEN i = 15 THEN e ELSE trunc(i * ((e - s) / 15.0::DOUBLE) + s)::INT END) AS frame_ids
  FROM (SELECT doc_id AS episode_index, n_chars::INT AS n, lang, source, k::INT AS window_id, (k * 200)::INT AS s, least(n_chars - 1, k * 200 + 399)::INT AS e
        FROM documents, unnest(range(0, (n_chars - 1) // 200 + 1)) AS u(k) WHERE n_chars > 0)
  WHERE window_id = 0 OR e - s >= 200)"""


def answers(spark: SparkSession, d: str) -> DataFrame:
    p = planned(spark, d).join(long_episodes(spark, d).select("episode_index", "lang", "source"), "episode_index")
    t = F.array(((F.col("window_id") * 5 + F.col("episode_index")) % 16).cast("int"))
    return p.select("episode_index", "window_id", t.alias("transitions"), F.array("lang", "source").alias("labels"), F.array(F.array("lang", F.lit("cut")), F.array(F.lit(" "), F.lit("end"))).alias("events"))


ANSWERS = "answers AS (SELECT *, ((window_id * 5 + episode_index) % 16)::INT AS t FROM planned)"
CUTS = "cuts AS (SELECT episode_index, nframes, frame_ids[t + 1] AS frame, 0.5 - 0.5 * cos(2 * pi() * (t + 1) / 17) AS weight FROM answers)"
CLUSTERS = """clusters AS (SELECT episode_index, floor(sum(frame * weight) / sum(weight) + 1e-9)::INT AS cut FROM
  (SELECT *, sum(far) OVER (PARTITION BY episode_index ORDER BY frame ROWS UNBOUNDED PRECEDING) AS c FROM
    (SELECT *, CASE WHEN frame - lag(frame) OVER (PARTITION BY episode_index ORDER BY frame) < 62.5 THEN 0 ELSE 1 END AS far FROM cuts)) GROUP BY episode_index, c)"""
VOTES = """votes AS (SELECT episode_index, frame_ids[k + 1] AS frame, window_id, k, CASE WHEN t = 0 OR k < t THEN lang ELSE source END AS label,
  CASE WHEN t = 0 OR k < t THEN [lang, 'cut'] ELSE ['end'] END AS events, nframes FROM answers, unnest(range(16)) AS u(k) WHERE frame_ids[k + 1] < nframes)"""
SPANS = """spans AS (SELECT episode_index, s AS start_frame, e AS end_frame, trunc((e - s) * 0.2::DOUBLE)::INT AS m FROM
  (SELECT episode_index, p AS s, lead(p) OVER (PARTITION BY episode_index ORDER BY p) AS e FROM
    (SELECT DISTINCT episode_index, unnest([0, nframes]) AS p FROM planned UNION SELECT episode_index, cut FROM clusters)) WHERE e - s >= 20)"""
PICKED = """held AS (SELECT s.*, v.frame, v.window_id, v.k, v.label, v.events, v.frame BETWEEN s.start_frame + m AND s.end_frame - m AS core FROM spans s JOIN votes v USING (episode_index) WHERE v.frame BETWEEN s.start_frame AND s.end_frame),
used AS (SELECT * FROM (SELECT *, bool_or(core) OVER (PARTITION BY episode_index, start_frame) AS inner_any FROM held WHERE core OR frame < end_frame) WHERE core = inner_any),
counted AS (SELECT episode_index, start_frame, end_frame, label, count(*) AS n, min((frame::BIGINT * 100000 + window_id) * 16 + k) AS first FROM used GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY episode_index ORDER BY start_frame) - 1 AS seg_id FROM (SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY episode_index, start_frame ORDER BY n DESC, first) = 1))"""
FUSED = f"WITH {PLANNED}, {ANSWERS}, {CUTS}, {CLUSTERS}, {VOTES}, {SPANS}, {PICKED}"


# ---- frames and scalars


@query(f"WITH {FRAMES}, {EPISODES}, {QUARTERS} SELECT f.episode_index, q.subtask, count(*) AS n_frames, max(least(f.frame_index + 50, f.T - 1)) AS last_subgoal, round(sum(f.value), 6) AS total FROM frames f JOIN quarters q ON q.episode_index = f.episode_index AND f.frame_index BETWEEN q.start_frame AND q.end_frame GROUP BY 1, 2")
def flagship(spark, d):
    """Frames, quarters, labels and look-ahead of each episode."""
    f = frames(spark, d)
    eps = f.groupBy(*EP).agg(F.first("T").alias("T"))
    f = segments.label_frames(f, segments.placeholder_segments(eps, EP, "T"), EP)
    return f.groupBy("episode_index", "subtask").agg(F.count("*").alias("n_frames"), F.max(S.future_frame(F.col("frame_index"), FPS, F.col("T"))).alias("last_subgoal"), F.round(F.sum("value"), 6).alias("total"))


@query(f"WITH {FRAMES} SELECT episode_index, frame_index, frame_index / 25.0::DOUBLE AS timestamp, T, least(frame_index + 50, T - 1) AS subgoal, format('episode_{{:06d}}', episode_index) AS sample_id FROM frames")
def a1_p2_p5_frames(spark, d):
    f = frames(spark, d)
    return f.select("episode_index", F.col("frame_index").cast("long").alias("frame_index"), S.timestamp(F.col("frame_index"), FPS).alias("timestamp"), "T", S.future_frame(F.col("frame_index"), FPS, F.col("T")).cast("long").alias("subgoal"), S.episode_name(F.col("episode_index")).alias("sample_id"))


@query("SELECT doc_id AS episode_index, (round_even(n_chars / 500.0::DOUBLE, 0) * 500)::INT AS speed_bin, n_chars / 25.0::DOUBLE AS duration_sec, format('episode_{:06d}_cam_high.mp4', doc_id) AS video FROM documents")
def p3_p7_p16_episode_meta(spark, d):
    e = long_episodes(spark, d)
    return e.select("episode_index", S.speed_bin(F.col("T")).alias("speed_bin"), (F.col("T") / F.lit(25.0)).alias("duration_sec"), S.camera_file(F.col("episode_index"), "cam_high").alias("video"))


@query("SELECT doc_id, CASE WHEN quality = 1 THEN 5 ELSE 2 END AS quality, quality <> 1 AS mistake FROM labels")
def p4_quality(spark, d):
    ok = F.col("quality") == 1
    return table(spark, d, "labels").select("doc_id", S.quality(ok).alias("quality"), S.mistake(ok).alias("mistake"))


@query("SELECT p_partkey, regexp_replace(p_name || '/' || p_brand, '[^\\p{L}\\p{N}_-]', '_', 'g') AS safe, CASE WHEN length(p_type || '  ' || p_name) - 1 <= 12 THEN p_type || ' ' || p_name ELSE left(p_type || ' ' || p_name, 9) || '...' END AS short FROM part")
def p8_p25_names(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", S.sanitize(F.concat_ws("/", "p_name", "p_brand")).alias("safe"), S.shorten(F.concat("p_type", F.lit("  "), "p_name"), 12).alias("short"))


@query("SELECT n_nationkey, replace(lower(r_name), '_', ' ') AS by_path, CASE WHEN n_nationkey % 3 = 0 THEN 'aloha manipulation task' ELSE replace(lower(n_name), '_', ' ') END AS by_parent FROM nation JOIN region ON n_regionkey = r_regionkey")
def p9a_task_from_path(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    deep = F.concat(F.lower("r_name"), F.lit("_demos_1000_steps/train/"), F.col("n_nationkey").cast("string"), F.lit(".hdf5"))
    blank = F.when(F.col("n_nationkey") % 3 == 0, F.lit("_demos_x/train/a.h5")).otherwise(F.concat(F.lower("n_name"), F.lit("_demos_5/x/y.h5")))
    return n.select("n_nationkey", S.task_from_path(deep).alias("by_path"), S.task_from_path(blank).alias("by_parent"))


@query("SELECT n_nationkey, CASE n_name WHEN 'FRANCE' THEN 'uncap pen' WHEN 'CHINA' THEN 'fold shirt' ELSE coalesce(nullif(trim(replace(n_name, '_', ' ')), ''), 'task') END AS task FROM nation")
def p9b_task_from_root(spark, d):
    root = F.concat(F.lit("aloha_"), F.col("n_name"), F.lit("_raw"))
    known = {"FRANCE": "uncap pen", "CHINA": "fold shirt"}
    return table(spark, d, "nation").select("n_nationkey", S.task_from_root([root, F.col("n_name"), F.lit("data")], known, "task").alias("task"))


@query("SELECT doc_id, coalesce(nullif(trim(split_part(text, chr(10), 2)), ''), nullif(trim(split_part(text, chr(10), 3)), ''), nullif(trim(lang), ''), 'none') AS task FROM documents")
def p9c_p10_p11_task_from_record(spark, d):
    t = table(spark, d, "documents").select("doc_id", "lang", F.split("text", "\n").alias("x"))
    second = lambda k: F.array_compact(F.array(F.get("x", F.lit(k))))
    return t.select("doc_id", S.override(S.task_from_instructions([second(1), second(2), F.array("lang")], F.lit("none")), None).alias("task"))


@query(f"WITH {FRAMES} SELECT episode_index, coalesce(arg_min(trim(event_type), frame_index) FILTER (WHERE event_type <> 'error'), 'droid manipulation task') AS task, count(*) FILTER (WHERE value > 50) > count(*) FILTER (WHERE NOT value > 50) AS success FROM frames GROUP BY 1")
def p9d_g4_droid_tasks(spark, d):
    f = frames(spark, d).withColumns({"language_instruction": F.when(F.col("event_type") != "error", F.col("event_type")).otherwise(" "), "is_episode_successful": F.col("value") > 50})
    return convert.droid_tasks(f, EP, ["frame_index"])


@query("SELECT vec_id, embedding[1:14]::DOUBLE[] AS row0, embedding[15:28]::DOUBLE[] AS row1, len(embedding) // 14 AS full_rows, len(embedding) % 16 = 0 AS fits_16 FROM embeddings")
def p12_p13_p14_vectors(spark, d):
    e = table(spark, d, "embeddings").withColumnsRenamed({"embedding": "action.joint_position"}).withColumn("action.gripper_position", F.array().cast("array<float>"))
    e = e.withColumn("v", S.pick_action(e.columns))
    rows = S.reshape(F.slice("v", 1, 56), 14)
    return e.select("vec_id", F.get(rows, 0).cast("array<double>").alias("row0"), F.get(rows, 1).cast("array<double>").alias("row1"), F.expr("cast(size(v) div 14 as bigint)").alias("full_rows"), S.reshape(F.col("v"), 16).isNotNull().alias("fits_16"))


@query("SELECT doc_id, trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS task, 'fold the shirt' AS given, lang AS kept FROM documents")
def p10_p11_decoded_and_given_tasks(spark, d):
    t = table(spark, d, "documents")
    broken = F.concat(F.unhex(F.lit("FF20")), F.encode(F.coalesce("text", F.lit("")), "utf-8"), F.unhex(F.lit("0AC3")))
    return t.select("doc_id", S.decode_text(broken).alias("task"), S.override(F.col("lang"), " fold the shirt ").alias("given"), S.override(F.col("lang"), "  ").alias("kept"))


@query("SELECT conv_id, CASE WHEN conv_id % 2 = 0 THEN list(turn ORDER BY turn)::DOUBLE[] ELSE list(0.0::DOUBLE ORDER BY turn) END AS reward, list(1.0::DOUBLE ORDER BY turn) AS discount FROM conversations GROUP BY conv_id")
def p14_default_arrays(spark, d):
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.col("turn").cast("double"))).alias("turns"))
    given = F.when(F.col("conv_id") % 2 == 0, F.col("turns"))
    return c.select("conv_id", S.array_or(given, F.lit(0.0), F.size("turns")).alias("reward"), S.array_or(F.lit(None).cast("array<double>"), F.lit(1.0), F.size("turns")).alias("discount"))


@query(f"WITH {FRAMES} SELECT episode_index, frame_index, format('videos/episode_{{:06d}}_cam_high.mp4', episode_index) AS high, frame_index AS high_frame, CASE WHEN episode_index % 2 = 0 THEN format('videos/episode_{{:06d}}_cam_left_wrist.mp4', episode_index) END AS left_wrist, CASE WHEN episode_index % 2 = 0 THEN frame_index END AS left_frame FROM frames")
def p6_video_pointers(spark, d):
    cams = ["cam_high", "cam_left_wrist"]
    name = lambda c: F.concat(F.lit("videos/"), S.camera_file(F.col("episode_index"), c))
    held = F.array_compact(F.array(*[F.when(F.lit(c == "cam_high") | (F.col("episode_index") % 2 == 0), F.struct(F.lit(c).alias("key"), name(c).alias("value"))) for c in cams]))
    f = frames(spark, d).withColumn("video_paths", F.map_from_entries(held))
    f = f.withColumns(S.video_pointers(cams, "video_paths", F.col("frame_index")))
    return f.select("episode_index", F.col("frame_index").cast("long").alias("frame_index"), F.col("`video.cam_high.path`").alias("high"), F.col("`video.cam_high.frame_index`").alias("high_frame"), F.col("`video.cam_left_wrist.path`").alias("left_wrist"), F.col("`video.cam_left_wrist.frame_index`").alias("left_frame"))


@query("SELECT conv_id, last(turn % 2 = 1 ORDER BY turn) AS success, count(*) AS n FROM conversations GROUP BY 1")
def p15_success(spark, d):
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", (F.col("turn") % 2 == 1).alias("t")))).alias("x"))
    return c.select("conv_id", S.last_terminal(F.col("x.t")).alias("success"), F.size("x").cast("long").alias("n"))


@query("SELECT event_id, (props::JSON->>'$.k')::INT AS k, false AS empty FROM events")
def p18_p19_p20_json(spark, d):
    e = table(spark, d, "events")
    fenced = F.concat(F.lit("Sure.\n```json\n{\"subtask\": "), F.col("props"), F.lit("}\n``` Done"))
    v = S.extract_json(F.when(F.col("event_id") % 2 == 0, fenced).otherwise(F.col("props")))
    inner = S.payload(v, "subtask")
    return e.select("event_id", F.try_variant_get(inner, "$.k", "int").alias("k"), S.is_empty_answer(inner).alias("empty"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 END AS n FROM events")
def p21_remote_answers(spark, d):
    k = F.col("event_id") % 4
    raw = F.when(k == 0, F.lit('{"transitions": [1]}')).when(k == 1, F.lit('{"vlm_json": {"transitions": [1, 2]}}')).when(k == 2, F.lit('{"text": "x {\\"transitions\\": [1, 2, 3]} y"}')).otherwise(F.lit("{}"))
    v = S.normalised_answer(F.parse_json(raw))
    return table(spark, d, "events").select("event_id", F.size(F.try_variant_get(v, "$.transitions", "array<int>")).alias("n")).withColumn("n", F.when(F.col("n") >= 0, F.col("n")))


@query(f"WITH {ANNOTATED} SELECT episode_index, string_agg(format('- frames {{}}-{{}}: {{}}', start_frame, end_frame, subtask), chr(10) ORDER BY segment_index) AS context FROM annotated GROUP BY 1")
def p22_context(spark, d):
    a = annotated(spark, d).groupBy(*EP).agg(F.array_sort(F.collect_list(F.struct("segment_index", "start_frame", "end_frame", "subtask"))).alias("s"))
    return a.select("episode_index", S.subtask_context(F.col("s")).alias("context"))


@query(f"WITH {ANNOTATED}, t AS (SELECT episode_index, max(end_frame) + 1 AS n FROM annotated GROUP BY 1) SELECT episode_index, segment_index, 10 + trunc(600 * least(greatest(start_frame, 0), n - 1) / greatest(1, n - 1)::DOUBLE)::INT AS sx, greatest(12 + trunc(600 * least(greatest(start_frame, 0), n - 1) / greatest(1, n - 1)::DOUBLE)::INT, 10 + trunc(600 * least(greatest(end_frame, 0), n - 1) / greatest(1, n - 1)::DOUBLE)::INT) AS ex, segment_index % 7 AS colour FROM annotated JOIN t USING (episode_index)")
def p24_timeline(spark, d):
    a = annotated(spark, d)
    a = a.withColumn("n", F.max("end_frame").over(Window.partitionBy(*EP)) + 1)
    return a.select("episode_index", "segment_index", *[v.alias(k) for k, v in S.timeline(F.col("start_frame"), F.col("end_frame"), F.col("n"), F.col("segment_index"), 10, 600).items()])


@query(f"WITH {ANNOTATED} SELECT episode_index, segment_index, greatest(start_frame, end_frame - 1) AS last_frame, start_frame / 25.0::DOUBLE AS start_timestamp, greatest(start_frame, end_frame - 1) / 25.0::DOUBLE AS end_timestamp, CASE WHEN segment_index % 3 = 0 THEN ['memory_updated'] ELSE [subtask] END AS tags FROM annotated")
def p26_p27_p28_records(spark, d):
    a = annotated(spark, d)
    last = S.inclusive_end(F.col("start_frame"), F.col("end_frame"))
    tags = F.array(F.when(F.col("segment_index") % 3 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), "subtask")))
    return a.select("episode_index", "segment_index", last.alias("last_frame"), (F.col("start_frame") / F.lit(25.0)).alias("start_timestamp"), (last / F.lit(25.0)).alias("end_timestamp"), S.event_tags(tags).alias("tags"))


# ---- windows and segments


@query(f"WITH {PLANNED} SELECT episode_index, window_id, start_frame, end_frame, frame_ids FROM planned")
def w1_w2_windows(spark, d):
    return planned(spark, d).select("episode_index", "window_id", "start_frame", "end_frame", "frame_ids")


@query(f"WITH {ANNOTATED} SELECT episode_index, segment_index::INT AS window_id, CASE WHEN end_frame <= start_frame THEN list_transform(range(8), lambda i: start_frame::INT) ELSE list_transform(range(8), lambda i: round_even(start_frame + (end_frame - start_frame) * i / 7.0::DOUBLE, 0)::INT) END AS frame_ids FROM annotated")
def w3_w4_aligned_windows(spark, d):
    return windows.aligned_windows(annotated(spark, d), EP, 8).select("episode_index", "window_id", "frame_ids")


@query("WITH e AS (SELECT doc_id AS episode_index, n_chars AS T FROM documents), " + quarter_sql("e", S.BIPLAY_LABELS) + " SELECT * FROM quarters")
def w5_placeholder_segments(spark, d):
    return segments.placeholder_segments(long_episodes(spark, d), EP, "T", S.BIPLAY_LABELS).withColumn("segment_index", F.col("segment_index").cast("long"))


@query(f"WITH {PLANNED}, {ANSWERS}, {CUTS} SELECT episode_index, frame, round(weight, 9) AS weight FROM cuts")
def w6_w7_cuts(spark, d):
    a = planned(spark, d).join(answers(spark, d), ["episode_index", "window_id"])
    return segments.raw_cuts(a, EP, 16).select("episode_index", "frame", F.round("weight", 9).alias("weight"))


@query(f"WITH {PLANNED}, {ANSWERS}, {CUTS}, {CLUSTERS} SELECT * FROM clusters")
def w8_g6_a4_clusters(spark, d):
    a = planned(spark, d).join(answers(spark, d), ["episode_index", "window_id"])
    return segments.cluster_cuts(segments.raw_cuts(a, EP, 16), EP)


@query(f"WITH {PLANNED}, {ANSWERS}, {VOTES} SELECT episode_index, frame, window_id, k::INT AS k, label FROM votes")
def w9_w10_a5_votes(spark, d):
    a = planned(spark, d).join(answers(spark, d), ["episode_index", "window_id"])
    return segments.votes(a, EP).select("episode_index", "frame", "window_id", "k", "label")


@query(f"{FUSED} SELECT episode_index, seg_id, start_frame, end_frame, label FROM best")
def w11_w15_g5_a6_segments(spark, d):
    return segments.fuse_windows(planned(spark, d), answers(spark, d), EP).withColumn("seg_id", F.col("seg_id").cast("long"))


@query(f"""{FUSED}, ev AS (SELECT episode_index, start_frame, event, count(*) AS n, min(((frame::BIGINT * 100000 + window_id) * 16 + k) * 4 + p) AS first FROM (SELECT episode_index, start_frame, frame, window_id, k, unnest(events) AS event, generate_subscripts(events, 1) AS p FROM used) GROUP BY ALL),
top AS (SELECT episode_index, start_frame, list(event ORDER BY n DESC, first)[1:4] AS events FROM ev GROUP BY ALL)
SELECT b.episode_index, b.seg_id, b.start_frame, b.end_frame, b.label, top.events FROM best b JOIN top USING (episode_index, start_frame)""")
def w14_w16_memory_segments(spark, d):
    return segments.fuse_windows(planned(spark, d), answers(spark, d), EP, memory=True).withColumn("seg_id", F.col("seg_id").cast("long"))


@query("WITH e AS (SELECT doc_id AS episode_index, n_chars FROM documents) SELECT episode_index, count(*) AS windows, sum(n) AS cuts FROM (SELECT episode_index, 1 AS n FROM e, unnest(range(0, (n_chars - 1) // 200 + 1)) AS u(k) WHERE k = 0 OR least(n_chars - 1, k * 200 + 399) - k * 200 >= 200) GROUP BY 1")
def f2_dummy_backend(spark, d):
    a = annotate.dummy_answers(planned(spark, d))
    return a.groupBy(*EP).agg(F.count("*").alias("windows"), F.sum(F.size("transitions")).alias("cuts"))


# ---- joins


@query(f"WITH {FRAMES}, {EPISODES}, {QUARTERS} SELECT f.episode_index, f.frame_index, q.subtask FROM frames f JOIN quarters q ON q.episode_index = f.episode_index AND f.frame_index BETWEEN q.start_frame AND q.end_frame")
def j1_a8_label_frames(spark, d):
    f = frames(spark, d)
    s = segments.placeholder_segments(f.groupBy(*EP).agg(F.first("T").alias("T")), EP, "T")
    return segments.label_frames(f, s, EP).select("episode_index", F.col("frame_index").cast("long").alias("frame_index"), "subtask")


@query(f"WITH {FRAMES}, {EPISODES}, {QUARTERS} SELECT f.episode_index, f.frame_index, q.subtask FROM frames f LEFT JOIN quarters q ON q.episode_index = f.episode_index AND f.frame_index BETWEEN q.start_frame AND q.end_frame AND q.segment_index <> 1")
def j4_active_record(spark, d):
    f = frames(spark, d)
    s = segments.placeholder_segments(f.groupBy(*EP).agg(F.first("T").alias("T")), EP, "T").where("segment_index <> 1")
    return segments.label_frames(f, s, EP, fallback=False).select("episode_index", F.col("frame_index").cast("long").alias("frame_index"), "subtask")


@query(f"WITH {PLANNED}, {ANNOTATED} SELECT p.episode_index, p.window_id, list(a.segment_index ORDER BY a.segment_index) AS hit FROM planned p JOIN annotated a ON a.episode_index = p.episode_index AND a.start_frame <= p.end_frame AND a.end_frame >= p.start_frame GROUP BY ALL")
def j2_overlapping_segments(spark, d):
    o = segments.overlapping(planned(spark, d), annotated(spark, d), EP)
    return o.select("episode_index", "window_id", F.col("segments.segment_index").alias("hit"))


@query(f"""WITH {ANNOTATED}, sub AS (SELECT *, row_number() OVER (PARTITION BY episode_index ORDER BY start_frame, segment_index) - 1 AS o, (start_frame + end_frame) // 2 AS mid FROM annotated),
mem AS (SELECT *, row_number() OVER (PARTITION BY episode_index ORDER BY start_frame, segment_index) - 1 AS o, count(*) OVER (PARTITION BY episode_index) AS n FROM annotated WHERE segment_index % 2 = 0),
hit AS (SELECT s.episode_index, s.o, arg_min(m.summary, m.start_frame) AS summary FROM sub s JOIN mem m ON s.episode_index = m.episode_index AND s.mid BETWEEN m.start_frame AND m.end_frame GROUP BY ALL)
SELECT s.episode_index, s.o AS segment_index, coalesce(h.summary, m.summary) AS summary FROM sub s JOIN mem m ON m.episode_index = s.episode_index AND m.o = least(s.o, m.n - 1) LEFT JOIN hit h ON h.episode_index = s.episode_index AND h.o = s.o""")
def j3_align_memory(spark, d):
    a = annotated(spark, d)
    out = segments.align_memory(a, a.where("segment_index % 2 = 0"), EP)
    return out.select("episode_index", F.col("segment_index").cast("long").alias("segment_index"), "summary")


@query(f"WITH {PLANNED} SELECT episode_index, window_id FROM planned WHERE window_id % 3 <> 0")
def j6_u3_pending_windows(spark, d):
    p = planned(spark, d)
    return windows.pending(p, p.where("window_id % 3 = 0"), EP).select("episode_index", "window_id")


@query("SELECT format('episode_{:06d}', conv_id) AS sample_id, conv_id, d.lang, d.source FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN documents d ON doc_id = conv_id")
def j7_metadata_join(spark, d):
    samples = table(spark, d, "conversations").select("conv_id").distinct().withColumn("sample_id", S.episode_name(F.col("conv_id")))
    return files.with_metadata(samples, long_episodes(spark, d)).select("sample_id", "conv_id", "lang", "source")


@query(f"WITH {ANNOTATED} SELECT episode_index, segment_index::INT AS window_id, subtask AS target_subtask FROM annotated")
def j9_target_subtask(spark, d):
    a = annotated(spark, d)
    w = windows.aligned_windows(a, EP, 4)
    t = a.select("episode_index", F.col("segment_index").cast("int").alias("window_id"), F.col("subtask").alias("target_subtask"))
    return w.join(t, ["episode_index", "window_id"]).select("episode_index", "window_id", "target_subtask")


@query(f"WITH {PLANNED} SELECT episode_index, count(*) AS planned, count(*) FILTER (WHERE episode_index % 3 <> 0 OR window_id > 0) AS got FROM planned GROUP BY 1 HAVING planned = got")
def j8_j10_complete(spark, d):
    p = planned(spark, d)
    got = p.where("episode_index % 3 <> 0 or window_id > 0").select("episode_index", "window_id")
    return windows.complete(p, got.union(got), EP)


@query("SELECT p_partkey, CASE WHEN p_type IN (SELECT DISTINCT p_type FROM part WHERE p_size <= 50) THEN lower(p_type) END AS canonical FROM part")
def j11_v4_vocabulary(spark, d):
    p = table(spark, d, "part")
    vocabulary = p.groupBy(F.lower("p_type").alias("canonical")).agg(F.collect_set("p_type").alias("aliases"))
    return validate.canonical_names(p.select("p_partkey", F.col("p_type").alias("task")), "task", vocabulary).select("p_partkey", "canonical")


# ---- aggregates


@query("SELECT label AS episode_index, (i - 1)::INT AS dim, round(min(x), 6) AS min, round(max(x), 6) AS max, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY ALL")
def g1_vector_stats(spark, d):
    e = table(spark, d, "embeddings").withColumnRenamed("label", "episode_index")
    s = stats.vector_stats(e, EP, "embedding")
    return s.select("episode_index", "dim", *[F.round(c, 6).alias(c) for c in ("min", "max", "mean", "std")])


@query("SELECT count(*) AS num_episodes, sum(n_chars)::BIGINT AS num_frames FROM documents")
def g2_totals(spark, d):
    return stats.totals(long_episodes(spark, d), "T")


@query("SELECT (row_number() OVER (ORDER BY p_type) - 1)::VARCHAR AS id, p_type FROM (SELECT DISTINCT p_type FROM part)")
def g3_task_ordinals(spark, d):
    return stats.ordinals(table(spark, d, "part"), "p_type")


@query("SELECT user_id, event_type AS last_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_id % 7 ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def g7_last_write_wins(spark, d):
    e = table(spark, d, "events").select("user_id", (F.col("event_id") % 7).alias("window_id"), "event_id", "event_type")
    return windows.last_results(e, ["user_id"], "event_id").select("user_id", F.col("event_type").alias("last_type"), "event_id")


@query(f"WITH {ANNOTATED} SELECT format('episode_{{:06d}}', episode_index) AS sample_id, list(subtask ORDER BY start_frame, segment_index) AS subtasks FROM annotated GROUP BY ALL")
def g8_s16_segments_by_sample(spark, d):
    return files.segments_by_sample(annotated(spark, d)).select("sample_id", F.col("segments.subtask").alias("subtasks"))


@query("SELECT count(*) AS total, count(l.doc_id) AS done, count(*) - count(l.doc_id) AS \"left\" FROM documents d LEFT JOIN labels l USING (doc_id)")
def g9_progress(spark, d):
    return stats.progress(table(spark, d, "documents"), table(spark, d, "labels"), ["doc_id"])


@query("SELECT user_id, count(*) AS attempts, count(*) > 60 AS exhausted FROM events GROUP BY 1")
def g10_retries(spark, d):
    return stats.retries(table(spark, d, "events"), "user_id", 60)


@query("SELECT l_orderkey, list(DISTINCT l_linestatus ORDER BY l_linestatus) AS files FROM lineitem GROUP BY 1")
def g11_source_files(spark, d):
    return stats.source_files(table(spark, d, "lineitem"), ["l_orderkey"], "l_linestatus")


@query("SELECT max(len(embedding))::INT AS state_dim, max(len(embedding))::INT AS action_dim FROM embeddings")
def g12_dimensions(spark, d):
    return stats.dimensions(table(spark, d, "embeddings"), "embedding", "embedding")


# ---- order, sets, write-back


@query("SELECT row_number() OVER (ORDER BY url, page_id) - 1 AS episode_index, page_id FROM pages QUALIFY episode_index BETWEEN 10 AND 99")
def a2_l1_l3_l4_renumber(spark, d):
    p = convert.renumber(table(spark, d, "pages").select("page_id", "url"), ["url", "page_id"])
    return p.where("episode_index >= 10 and episode_index < 100").select(F.col("episode_index").cast("long").alias("episode_index"), "page_id")


@query(f"WITH {ANNOTATED} SELECT episode_index, segment_index, subtask FROM annotated WHERE episode_index % 5 <> 0 UNION ALL SELECT episode_index, segment_index, 'new' FROM annotated WHERE episode_index % 5 = 0 AND segment_index < 2")
def k5_u1_replace_episodes(spark, d):
    a = annotated(spark, d).select("episode_index", "segment_index", "subtask")
    new = a.where("episode_index % 5 = 0 and segment_index < 2").withColumn("subtask", F.lit("new"))
    return writeback.replace_episodes(a, new)


@query(f"WITH {FRAMES} SELECT episode_index, frame_index, CASE WHEN frame_index BETWEEN 5 AND 12 THEN 'second' WHEN frame_index BETWEEN 2 AND 7 THEN 'first' ELSE event_type END AS subtask, CASE WHEN frame_index BETWEEN 5 AND 12 THEN 'second' WHEN frame_index BETWEEN 2 AND 7 THEN 'first' ELSE '' END AS summary FROM frames")
def k6_k7_j5_update_intervals(spark, d):
    f = frames(spark, d).select("episode_index", F.col("frame_index").cast("long").alias("frame_index"), F.col("event_type").alias("subtask"))
    parts = [(0, 2, 7, "first"), (1, 5, 12, "second")]
    s = f.select("episode_index").distinct().select("*", F.inline(F.array(*[F.struct(F.lit(i).alias("segment_index"), F.lit(a).alias("start_frame"), F.lit(b).alias("end_frame"), F.lit(x).alias("v")) for i, a, b, x in parts])))
    out = writeback.update_intervals(f, s, EP, "summary", "v", create=True)
    return writeback.update_intervals(out, s, EP, "subtask", "v").select("episode_index", "frame_index", "subtask", "summary")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def k8_k9_resume(spark, d):
    return writeback.without_done(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), ["doc_id"])


@query(f"WITH {PLANNED} SELECT episode_index, window_id, list_sort(list_distinct(list_concat(frame_ids, [0]))) AS ids FROM planned")
def u2_u4_distinct_frames(spark, d):
    return planned(spark, d).select("episode_index", "window_id", F.array_sort(F.array_union("frame_ids", F.array(F.lit(0)))).alias("ids"))


# ---- validation


@query("SELECT doc_id, rule FROM (SELECT doc_id, 'quality' AS rule FROM labels WHERE NOT quality BETWEEN 1 AND 5 UNION ALL SELECT doc_id, 'clean' FROM labels WHERE toxic <> 0)")
def v1_required_and_ranges(spark, d):
    return validate.violations(table(spark, d, "labels"), ["doc_id"], {"quality": F.col("quality").between(1, 5), "clean": F.col("toxic") == 0, "id": F.col("doc_id").isNotNull()})


@query("SELECT page_id::VARCHAR AS sample_id, 'text' AS modality, url AS source_url, regexp_replace(html, '[^\\p{L}\\p{N}_-]', '_', 'g') AS title FROM pages")
def v1_web_records(spark, d):
    p = table(spark, d, "pages")
    return p.select(F.col("page_id").cast("string").alias("sample_id"), F.lit("text").alias("modality"), F.col("url").alias("source_url"), S.sanitize(F.col("html")).alias("title"))


def rules_sql(source: str, keys: str, rules: dict[str, str]) -> str:
    """SQL of the rows of source that break rules, given as conditions of breaking."""
    return " UNION ALL ".join(f"SELECT {keys}, '{name}' AS rule FROM ({source}) WHERE {broken}" for name, broken in rules.items())


@query(f"WITH {FRAMES}, r AS (SELECT episode_index, frame_index, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS subtask, CASE WHEN event_type = 'view' THEN 'odd' ELSE 'joint' END AS control_mode, floor(value)::BIGINT % 7 AS quality FROM frames) " + rules_sql("SELECT * FROM r", "episode_index, frame_index", {"subtask: missing": "subtask IS NULL", "control_mode: value": "control_mode = 'odd'", "quality: missing": "quality IS NULL", "quality: value": "quality NOT BETWEEN 1 AND 5", "success: missing": "true", "domain: type": "true"}))
def v1_robot_episode(spark, d):
    f = frames(spark, d)
    vector = F.array(F.lit(0.0).cast("float"))
    rows = f.select("episode_index", F.col("frame_index").cast("long").alias("frame_index"), S.timestamp(F.col("frame_index"), FPS).alias("timestamp"), vector.alias("observation.state"), vector.alias("action"), F.lit("t").alias("task"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("subtask"), F.lit("aloha").alias("robot_type"), F.when(F.col("event_type") == "view", "odd").otherwise("joint").alias("control_mode"), (F.floor("value") % 7).cast("int").alias("quality"), F.lit(500).alias("speed_bin"), F.lit(False).alias("mistake"), F.lit("droid").alias("source_dataset"), F.lit(1).alias("domain"))
    return validate.schema_violations(rows, "robot_episode", ["episode_index", "frame_index"])


@query(f"WITH {ANNOTATED} " + rules_sql("SELECT * FROM annotated", "episode_index, segment_index", {"task: missing": "segment_index = 0", "annotation_status: value": "subtask = 'user'"}))
def v1_segment_annotation(spark, d):
    a = annotated(spark, d).withColumns({"task": F.when(F.col("segment_index") > 0, "t"), "annotation_status": F.when(F.col("subtask") == "user", "auto").otherwise("reviewed")})
    return validate.schema_violations(a, "segment_annotation", ["episode_index", "segment_index"])


@query(f"WITH {ANNOTATED} " + rules_sql("SELECT * FROM annotated", "episode_index, segment_index", {"task: missing": "true", "summary: missing": "subtask = 'assistant'", "annotation_status: value": "subtask = 'user'", "change_event_type: type": "true"}))
def v1_memory_segment(spark, d):
    a = annotated(spark, d).withColumns({"summary": F.when(F.col("subtask") != "assistant", F.col("summary")), "annotation_status": F.when(F.col("subtask") == "user", "auto_placeholder").otherwise("human_verified"), "change_event_type": F.lit("text")})
    return validate.schema_violations(a, "memory_segment", ["episode_index", "segment_index"])


@query(rules_sql("SELECT doc_id::VARCHAR AS sample_id, * FROM documents", "sample_id", {"camera_view: value": "lang NOT IN ('en', 'de')", "video.path: missing": "n_chars > 2000", "source_dataset: missing": "true"}))
def v1_human_video(spark, d):
    t = table(spark, d, "documents")
    video = F.struct(F.when(F.col("n_chars") <= 2000, F.concat(F.col("doc_id").cast("string"), F.lit(".mp4"))).alias("path"), F.lit(0).cast("long").alias("frame_index"))
    view = F.when(F.col("lang") == "en", "egocentric").when(F.col("lang") == "de", "third_person").otherwise(F.col("lang"))
    rows = t.select(F.col("doc_id").cast("string").alias("sample_id"), *[F.lit(0).alias(c) for c in ("video_index", "clip_index", "frame_index", "timestamp")], video.alias("video"), view.alias("camera_view"), F.lit("t").alias("task"))
    return validate.schema_violations(rows, "human_video", ["sample_id"])


@query(rules_sql("SELECT page_id::VARCHAR AS sample_id, page_id FROM pages", "sample_id", {"modality: value": "page_id % 3 = 1", "task_type: missing": "page_id % 5 = 0", "task_type: value": "page_id % 5 = 1"}))
def v1_web_multimodal(spark, d):
    k = F.col("page_id")
    rows = table(spark, d, "pages").select(k.cast("string").alias("sample_id"), F.when(k % 3 == 1, "sound").otherwise("image_text").alias("modality"), F.when(k % 5 == 1, "guess").when(k % 5 > 1, "vqa").alias("task_type"), F.lit("web").alias("source_dataset"), F.col("url").alias("source_url"))
    return validate.schema_violations(rows, "web_multimodal", ["sample_id"])


@query("WITH f AS (SELECT vec_id, unnest(range(len(embedding))) AS dim, unnest(embedding)::DOUBLE AS value FROM embeddings), s AS (SELECT dim, avg(value) AS m, stddev_pop(value) AS s FROM f GROUP BY dim) SELECT vec_id, dim::INT AS dim, value FROM f JOIN s USING (dim) WHERE abs(value - m) > 3 * s")
def v5_value_outliers(spark, d):
    return validate.outliers(table(spark, d, "embeddings"), ["vec_id"], "embedding", 3.0)


@query("SELECT '{' || string_agg(to_json(doc_id::VARCHAR)::VARCHAR || ':' || to_json(lang)::VARCHAR, ',' ORDER BY doc_id::VARCHAR) || '}' AS json FROM documents")
def k3_json_object(spark, d):
    return files.json_object(table(spark, d, "documents").select("doc_id", "lang"), "doc_id", F.col("lang"))


@query(f"WITH {ANNOTATED} SELECT episode_index, max(end_frame) + 1 AS num_frames, 'RMBench' AS source_dataset, NULL::INT AS fps FROM annotated GROUP BY 1")
def s15_unlisted_episodes(spark, d):
    return files.episodes_from_segments(annotated(spark, d))


@query("SELECT doc_id AS episode_index, CASE WHEN doc_id % 3 = 2 THEN NULL WHEN doc_id % 3 = 1 THEN format('file:/r/data/other/episode_{:06d}.parquet', doc_id) ELSE format('file:/r/data/{}/chunk-000/episode_{:06d}.parquet', source, doc_id) END AS path FROM documents")
def s17_episode_paths(spark, d):
    t = table(spark, d, "documents").select(F.col("doc_id").alias("episode_index"), "source")
    name = F.concat(S.episode_name(F.col("episode_index")), F.lit(".parquet"))
    recorded = F.concat(F.lit("data/"), F.col("source"), F.lit("/chunk-000/"), name)
    other = t.where("episode_index % 3 <> 2").select("episode_index", F.concat(F.lit("file:/r/data/other/"), name).alias("path"))
    own = t.where("episode_index % 3 = 0").select("episode_index", F.concat(F.lit("file:/r/"), recorded).alias("path"))
    return files.resolve_episode_paths(t.withColumn("parquet_path", recorded), own.union(other))


@query("WITH f AS (SELECT conv_id AS episode_index, turn AS frame_index FROM conversations WHERE NOT (conv_id % 7 = 0 AND turn = 1)) SELECT episode_index, count(*) AS n, count(DISTINCT frame_index) AS d, min(frame_index) AS lo, max(frame_index) AS hi, min(frame_index) = 0 AND max(frame_index) + 1 = count(*) AND count(*) = count(DISTINCT frame_index) AS contiguous FROM f GROUP BY 1")
def v2_contiguity(spark, d):
    c = table(spark, d, "conversations").where("not (conv_id % 7 = 0 and turn = 1)")
    return validate.contiguity(c.select(F.col("conv_id").alias("episode_index"), F.col("turn").alias("frame_index")), EP)


@query(f"WITH {ANNOTATED}, s AS (SELECT * FROM annotated WHERE segment_index % 4 <> 2), t AS (SELECT episode_index, max(end_frame) AS T FROM annotated GROUP BY 1), l AS (SELECT s.*, T, lag(end_frame) OVER (PARTITION BY s.episode_index ORDER BY start_frame, segment_index) AS p FROM s JOIN t USING (episode_index)) SELECT episode_index, segment_index, start_frame > end_frame AS inverted, end_frame >= T AS outside, coalesce(start_frame <= p, false) AS overlap, greatest(0, coalesce(start_frame - p - 1, start_frame)) AS gap FROM l")
def v3_a7_segment_bounds(spark, d):
    a = annotated(spark, d)
    return validate.segment_bounds(a.where("segment_index % 4 <> 2"), a.groupBy(*EP).agg(F.max("end_frame").alias("T")), EP, "T")


@query("SELECT label AS episode_index, count(*) FILTER (WHERE len(embedding) <> 64) AS wrong, count(*) AS n FROM embeddings GROUP BY 1")
def v5_dimensions(spark, d):
    return validate.dimension_errors(table(spark, d, "embeddings").withColumnRenamed("label", "episode_index"), EP, "embedding", 64)


@query("SELECT name, missing, total FROM (SELECT 'quality' AS name, count(*) - count(quality) AS missing, count(*) AS total FROM documents LEFT JOIN labels USING (doc_id) UNION ALL SELECT 'lang', count(*) - count(lang), count(*) FROM documents)")
def v6_provenance(spark, d):
    j = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id", "left")
    return validate.provenance(j, ["quality", "lang"])


@query("SELECT conv_id, turn FROM (SELECT *, CASE WHEN role = 'system' THEN 0 WHEN role = 'user' THEN 1 ELSE 2 END AS r, lag(CASE WHEN role = 'system' THEN 0 WHEN role = 'user' THEN 1 ELSE 2 END) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations) WHERE r < p")
def v7_status_regressions(spark, d):
    state = F.when(F.col("role") == "system", "auto_placeholder").when(F.col("role") == "user", "auto").otherwise("vlm_pseudo")
    c = table(spark, d, "conversations").withColumn("status", state)
    return validate.status_regressions(c, ["conv_id"], "turn", "status").select("conv_id", "turn")


@query(f"WITH {PLANNED}, {ANSWERS} SELECT episode_index, window_id, true AS counts_fit, true AS ascending, true AS in_range FROM answers")
def v8_answer_shape(spark, d):
    return validate.answer_shape(answers(spark, d), ["episode_index", "window_id"], 16)


def queries():
    return dict(_QUERIES)


def oracles():
    return dict(_ORACLES)
