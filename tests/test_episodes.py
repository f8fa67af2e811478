"""Golden values, property tests against plain Python, sources, back ends and streaming."""

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewright import config, schemas
from tracewright.functions import scalar as S
from tracewright.operators import annotate, convert, segments, stats, validate, windows, writeback
from tracewright.sources import binary, files
from tracewright.streaming.finalise import finalise_stream, finalised


@pytest.mark.parametrize("t,fps,speed,seconds,cuts", [
    (1500, 25, 1500, 60.0, [(0, 374), (375, 749), (750, 1124), (1125, 1499)]),
    (300, 25, 500, 12.0, [(0, 74), (75, 149), (150, 224), (225, 299)]),
    (71, 25, 0, 2.84, [(0, 16), (17, 34), (35, 52), (53, 70)]),
    (167, 15, 0, 167 / 15, [(0, 40), (41, 82), (83, 124), (125, 166)]),
    (266, 15, 500, 266 / 15, [(0, 65), (66, 132), (133, 198), (199, 265)]),
    (411, 15, 500, 27.4, [(0, 101), (102, 204), (205, 307), (308, 410)]),
])
def test_golden(spark, t, fps, speed, seconds, cuts):
    e = spark.createDataFrame([(1, t)], "episode_index long, T long")
    assert e.select(S.speed_bin(F.col("T")), F.col("T") / fps).first() == (speed, seconds)
    got = segments.placeholder_segments(e, ["episode_index"], "T").orderBy("segment_index").collect()
    assert [(r.start_frame, r.end_frame) for r in got] == cuts


def test_half_even(spark):
    rows = spark.createDataFrame([(250,), (750,), (1250,)], "T long").select(S.speed_bin(F.col("T"))).collect()
    assert [r[0] for r in rows] == [0, 1000, 1000]


def plain_windows(fps, n, per=16):
    out, length, step = [], max(1, round(16.0 * fps)), max(1, round(8.0 * fps))
    for s in range(0, n, step):
        e = min(n - 1, s + length - 1)
        if s > 0 and e - s < length // 2:
            break
        out.append((s, e, np.clip(np.linspace(s, e, per).astype(int), 0, n - 1).tolist()))
    return out


def test_windows_against_numpy(spark):
    cases = [(n, fps) for n in (1, 2, 15, 16, 100, 399, 400, 401, 777, 4501) for fps in (25.0, 15.0, 29.97, 0.5)]
    e = spark.createDataFrame([(k, n, fps) for k, (n, fps) in enumerate(cases)], "id int, n int, fps double")
    got = {}
    for r in windows.build_windows(e, ["id"], "n", "fps").orderBy("id", "window_id").collect():
        got.setdefault(r.id, []).append((r.start_frame, r.end_frame, r.frame_ids))
    assert got == {k: plain_windows(fps, n) for k, (n, fps) in enumerate(cases)}
    assert windows.build_windows(spark.createDataFrame([(1, 0, 25.0)], "id int, n int, fps double"), ["id"], "n", "fps").count() == 0


def plain_segments(wins, by, fps, n, per=16):
    cuts, votes, hann = [], [[] for _ in range(n)], np.hanning(per + 2)[1:-1]
    for w, (_, _, ids) in enumerate(wins):
        if w not in by:
            continue
        ts, labels = by[w]
        cuts += [(ids[t], hann[t]) for t in ts if 0 <= t < len(ids)]
        b = sorted({0, len(ids), *[t for t in ts if 0 <= t < len(ids)]})
        for i, (lo, hi) in enumerate(zip(b, b[1:])):
            if i < len(labels) and labels[i].strip() and labels[i].strip().lower() != "unknown":
                for k in range(lo, hi):
                    votes[ids[k]].append(labels[i].strip())
    points, now = {0, n}, []
    for c in sorted(cuts, key=lambda c: c[0]):
        if now and c[0] - now[-1][0] >= max(1.0, 2.5 * fps):
            points.add(int(np.average([x[0] for x in now], weights=[x[1] for x in now]) + 1e-9))
            now = []
        now.append(c)
    if now:
        points.add(int(np.average([x[0] for x in now], weights=[x[1] for x in now]) + 1e-9))
    p, out = sorted(points), []
    for s, e in zip(p, p[1:]):
        if e - s < max(1, int(0.8 * fps)):
            continue
        m = int((e - s) * 0.2)
        found = [v for f in range(s + m, min(n, e - m + 1)) for v in votes[f]] or [v for f in range(s, e) for v in votes[f]]
        if found:
            best = max(dict.fromkeys(found), key=found.count)
            out.append((len(out), s, e, best))
    return out


def test_fused_segments_against_plain_python(spark):
    rng = np.random.default_rng(5)
    eps, results, want = [], [], {}
    for k in range(25):
        n, fps = int(rng.integers(1, 3000)), float(rng.choice([3.0, 15.0, 25.0]))
        wins, by = plain_windows(fps, n), {}
        for w in range(len(wins)):
            if rng.random() < 0.9:
                by[w] = ([int(x) for x in rng.integers(-1, 18, rng.integers(0, 4))], [str(rng.choice(["a", "b ", "unknown", "", "c"])) for _ in range(rng.integers(0, 5))])
                results.append((k, w, *by[w]))
        eps.append((k, n, fps))
        want[k] = plain_segments(wins, by, fps, n)
    plan = windows.build_windows(spark.createDataFrame(eps, "id int, n int, fps double"), ["id"], "n", "fps")
    got = {k: [] for k in want}
    for r in segments.fuse_windows(plan, spark.createDataFrame(results, "id int, window_id int, transitions array<int>, labels array<string>"), ["id"]).orderBy("id", "seg_id").collect():
        got[r.id].append((r.seg_id, r.start_frame, r.end_frame, r.label))
    assert got == want


def test_dummy_backend_end_to_end(spark):
    e = spark.createDataFrame([(1, 900, 25.0), (2, 5, 25.0)], "sample_id int, n int, fps double")
    plan = windows.build_windows(e, ["sample_id"], "n", "fps")
    asked = plan.withColumn("prompt", annotate.prompt(F.size("frame_ids"), ["subtask"], "coarse"))
    done = annotate.annotate(asked, annotate.Dummy, ["sample_id"]).cache()
    assert {r.status for r in done.collect()} == {"done"}
    native = annotate.dummy_answers(plan).select("sample_id", "window_id", "transitions", "labels")
    a, b = (segments.fuse_windows(plan, x, ["sample_id"]).orderBy("sample_id", "seg_id").collect() for x in (native, annotate.parsed_answers(done, ["sample_id"])))
    assert a == b and len(a) > 1


def test_retries_are_bounded(spark):
    plan = spark.createDataFrame([(1, 0, [1], "p")], "sample_id int, window_id int, frame_ids array<int>, prompt string")
    row = annotate.annotate(plan, lambda: annotate.Remote(lambda r: (500, {})), ["sample_id"], tries=4).first()
    assert (row.attempts, row.status) == (4, "failed")


def test_json_is_lenient(spark):
    texts = ['{"a": 1}', "```json\n{\"a\": 1}\n```", "well {\"a\": 1} so", "nothing", "[1]", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(S.extract_json(F.col("t")).alias("v"))
    assert [r[0] for r in df.select(F.try_variant_get("v", "$.a", "int")).collect()] == [1, 1, 1, None, None, None]
    assert [r[0] for r in df.select(S.is_empty_answer(F.col("v"))).collect()] == [False, False, False, True, True, True]


def tfrecord(features):
    def varint(n):
        out = b""
        while n > 127:
            out += bytes([n & 127 | 128])
            n >>= 7
        return out + bytes([n])

    def field(k, v):
        return varint(k << 3 | 2) + varint(len(v)) + v

    entries = b""
    for name, (kind, values) in features.items():
        body = {1: lambda: b"".join(field(1, v) for v in values), 2: lambda: field(1, struct.pack(f"<{len(values)}f", *values)), 3: lambda: field(1, b"".join(map(varint, values)))}[kind]()
        entries += field(1, field(1, name.encode()) + field(2, field(kind, body)))
    data = field(1, entries)
    return struct.pack("<Q", len(data)) + b"\0" * 4 + data + b"\0" * 4


def test_tfrecord_source(spark, tmp_path):
    (tmp_path / "1.0.0").mkdir()
    one = tfrecord({"steps/observation/state": (2, [0.5] * 28), "steps/action": (2, [1.0] * 28), "steps/is_terminal": (3, [0, 1]), "steps/language_instruction": (1, [b" pick "])})
    (tmp_path / "1.0.0" / "x.tfrecord-00000-of-00001").write_bytes(one * 2)
    rows = binary.tfrecord_episodes(spark, str(tmp_path)).withColumn("task", S.task_from_instructions([F.get("instructions", F.lit(k)) for k in range(3)], F.lit("none"))).withColumn("rows", S.reshape(F.col("state"), 14)).orderBy("record").collect()
    assert len(rows) == 2 and rows[0].task == "pick" and len(rows[0].rows) == 2 and rows[0].is_terminal == [False, True]


def test_mp4_header():
    def box(kind, body):
        return struct.pack(">I4s", 8 + len(body), kind) + body

    mdhd = box(b"mdhd", b"\0" * 12 + struct.pack(">II", 1000, 4000))
    stbl = box(b"stbl", box(b"stsz", b"\0" * 4 + struct.pack(">II", 0, 100)))
    trak = box(b"trak", box(b"mdia", mdhd + box(b"hdlr", b"\0" * 8 + b"vide" + b"\0" * 12) + box(b"minf", stbl)))
    assert binary.mp4_info(box(b"ftyp", b"isom") + box(b"moov", trak)) == (25.0, 100)
    assert binary.mp4_info(b"junk") is None


def test_droid_files(spark, tmp_path):
    rows = [(0, i, i / 15, [float(i)] * 8, [0.0] * 8) for i in range(4)]
    df = spark.createDataFrame(rows, "episode_index long, frame_index long, timestamp double, `observation.state` array<float>, action array<float>")
    for k, part in enumerate((df.where("frame_index < 3"), df.where("frame_index >= 3"))):
        part.coalesce(1).toPandas().to_parquet((tmp_path / f"file-00{k}.parquet"))
    root = tmp_path / "r" / "data" / "chunk-000"
    root.mkdir(parents=True)
    for k in range(2):
        (tmp_path / f"file-00{k}.parquet").rename(root / f"file-00{k}.parquet")
    raw = files.droid_parquet(spark, str(tmp_path / "r"))
    got = convert.droid_frames(raw).orderBy("file_index", "frame_index").collect()
    assert [(r.file_index, r.frame_index, r.T) for r in got] == [(0, 0, 3), (0, 1, 3), (0, 2, 3), (1, 0, 1)]
    assert convert.droid_frames(raw, merge_files=True).agg(F.max("frame_index")).first()[0] == 3


def test_json_lines_and_results(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0, 0, 5, "t", "é", None)], schemas.SEGMENTS)
    files.write_json_lines(rows, str(tmp_path / "s"))
    assert files.json_lines(spark, str(tmp_path / "s"), schemas.SEGMENTS).collect() == rows.collect()
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "w.jsonl").write_text('{"task_id": "a_w0", "window_id": 0, "vlm_json": {"transitions": [1]}}\nnot json\n{"task_id": "x"}\n')
    assert [r.window_id for r in files.window_results(spark, str(tmp_path / "w")).collect()] == [0]


def test_conversion_tables(spark):
    e = spark.createDataFrame([(0, [[0.0] * 2] * 8, [[1.0] * 2] * 8, "t", True, "r", "s"), (1, [[0.0]], [], "t", False, "r", "s")], "episode_index int, state array<array<float>>, action array<array<float>>, task string, success boolean, robot_type string, source_dataset string")
    f = convert.frames_from_arrays(e, 2)
    assert f.count() == 8 and convert.unequal_episodes(e).count() == 1
    assert f.where("frame_index = 7").select("subtask", "quality").first() == ("finish the task", 5)
    ep = convert.episodes_table(f, 2).first()
    assert (ep.num_frames, ep.duration_sec, ep.parquet_path) == (8, 4.0, "data/s/chunk-000/episode_000000.parquet")
    s = stats.as_vectors(stats.vector_stats(f, ["episode_index"], "action"), ["episode_index"]).first()
    assert s.state_mean == [1.0, 1.0] and s.state_std == [0.0, 0.0]


def test_staged_write_over_its_own_input(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    writeback.staged_write(spark.read.parquet(path).where("id > 2"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [3, 4]


def test_streaming_finalises_once(spark, tmp_path):
    e = spark.createDataFrame([("a", 900, 25.0), ("b", 900, 25.0)], "sample_id string, n int, fps double")
    plan = windows.build_windows(e, ["sample_id"], "n", "fps").cache()
    answers = annotate.dummy_answers(plan).select("sample_id", "window_id", "transitions", "labels", F.monotonically_increasing_id().alias("seq"))
    part = answers.where("sample_id = 'a' or window_id = 0")
    part.write.parquet(str(tmp_path / "in"))
    where = [str(tmp_path / x) for x in ("in", "store", "out", "check")]
    for _ in range(2):
        finalise_stream(spark, plan, *where).awaitTermination()
    assert {r.sample_id for r in finalised(spark, where[2]).collect()} == {"a"}
    answers.where("sample_id = 'b'").write.mode("append").parquet(where[0])
    finalise_stream(spark, plan, *where).awaitTermination()
    assert {r.sample_id for r in finalised(spark, where[2]).collect()} == {"a", "b"}


def test_validation(spark):
    rows = spark.createDataFrame([(1, 9, None), (2, 3, "x")], "id int, quality int, task string")
    rules = {"range": F.col("quality").between(1, 5), "task": F.col("task").isNotNull()}
    assert sorted(map(tuple, validate.violations(rows, ["id"], rules).collect())) == [(1, "range"), (1, "task")]


def test_settings():
    s = config.Settings(mode="object_switch", targets=["Subtask", "subtask"], level="info")
    assert (s.mode, s.targets, s.level) == ("coarse", ["subtask"], "INFO")
    with pytest.raises(ValueError):
        config.Settings(targets=["x"])
    assert files.parse_datasets("/a/b:c;/d/e") == [("/a/b", "c"), ("/d", "e")]
    assert json.loads("{}") == {}


def test_staged_write_keeps_the_old_table_where_renaming_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    tmp_path.chmod(0o755)
    (tmp_path / "t.other").mkdir()
    writeback.staged_write(spark.read.parquet(path).where("id > 0"), path)
    assert spark.read.parquet(path).count() == 2
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t", "t.other"]


def test_done_markers(spark, tmp_path):
    path = str(tmp_path / "done")
    samples = spark.createDataFrame([("a",), ("b",), ("c",)], "sample_id string")
    writeback.mark_done(samples.where("sample_id = 'a'"), path, ["sample_id"])
    writeback.mark_done(samples.where("sample_id <> 'c'"), path, ["sample_id"])
    assert [r.sample_id for r in writeback.without_done(samples, spark.read.parquet(path), ["sample_id"]).collect()] == ["c"]


def test_episode_files_where_the_table_records_them(spark, tmp_path):
    rows = [(s, e, f, float(f)) for s, e, n in (("aloha", 0, 3), ("aloha", 7, 2), ("droid", 0, 4)) for f in reversed(range(n))]
    frames = spark.createDataFrame(rows, "source_dataset string, episode_index long, frame_index long, value double")
    root = f"file://{tmp_path}"
    listing = files.write_episodes(frames, root).collect()
    assert sorted((r.source_dataset, r.episode_index, r.num_frames) for r in listing) == [("aloha", 0, 3), ("aloha", 7, 2), ("droid", 0, 4)]
    import pyarrow.parquet as pq

    for r in listing:
        assert pq.ParquetFile(tmp_path / r.parquet_path).read().column("frame_index").to_pylist() == list(range(r.num_frames))
    assert not list(tmp_path.rglob("*.tmp"))
    found = files.episode_files(spark, root)
    episodes = spark.createDataFrame([(0, "data/droid/chunk-000/episode_000000.parquet"), (7, "gone"), (9, None)], "episode_index long, parquet_path string")
    got = {r.episode_index: r.path and r.path.split("/data/")[1] for r in files.resolve_episode_paths(episodes, found).collect()}
    assert got == {0: "droid/chunk-000/episode_000000.parquet", 7: "aloha/chunk-000/episode_000007.parquet", 9: None}


def test_json_files(spark, tmp_path):
    import json

    tasks = spark.createDataFrame([(1, "é pen"), (0, "cup"), (2, None)], "k int, task string")
    files.write_json_object(tasks, str(tmp_path / "meta" / "tasks.json"), "k", F.col("task"))
    text = (tmp_path / "meta" / "tasks.json").read_text()
    assert json.loads(text) == {"0": "cup", "1": "é pen", "2": None} and text.startswith('{\n  "0": "cup"')
    segments = spark.createDataFrame([(e, s) for e in (2, 0, 1) for s in (1, 0)], "episode_index long, segment_index long").repartition(4)
    files.write_json_lines(segments, str(tmp_path / "segments"), order=["episode_index", "segment_index"])
    lines = [json.loads(x) for p in sorted((tmp_path / "segments").glob("part-*")) for x in p.read_text().splitlines()]
    assert [(x["episode_index"], x["segment_index"]) for x in lines] == [(e, s) for e in range(3) for s in range(2)]


def test_video_headers_without_pixels(spark, tmp_path):
    import struct

    box = lambda kind, body: struct.pack(">I4s", len(body) + 8, kind) + body
    mdhd = box(b"mdhd", bytes(12) + struct.pack(">II", 1000, 4000) + bytes(4))
    hdlr = box(b"hdlr", bytes(8) + b"vide" + bytes(12))
    stbl = box(b"stbl", box(b"stsz", bytes(8) + struct.pack(">I", 100)))
    tracks = box(b"moov", box(b"trak", box(b"mdia", mdhd + hdlr + box(b"minf", stbl))))
    folder = tmp_path / "s1"
    folder.mkdir()
    (folder / "Frame_b.mp4").write_bytes(box(b"ftyp", b"isom") + struct.pack(">I4sQ", 1, b"mdat", 16 + 500_000) + bytes(500_000) + tracks)
    (folder / "Frame_a.mp4").write_bytes(b"junk")
    got = {r.path.rsplit("/", 1)[1]: (r.fps, r.nframes) for r in binary.video_info(spark, str(tmp_path)).collect()}
    assert got == {"Frame_b.mp4": (25.0, 100), "Frame_a.mp4": (30.0, 0)}
    assert [(r.sample_id, r.video.rsplit("/", 1)[1]) for r in files.sample_folders(spark, str(tmp_path)).collect()] == [("s1", "Frame_a.mp4")]


def test_settings_in_sections(tmp_path):
    s = config.Settings(targets="memory, subtask", level="critical")
    assert s.targets == ["memory", "subtask"] and s.level == "CRITICAL"
    yaml = pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text(yaml.safe_dump({"run": {"mode": "fine", "tries": 3}, "windowing": {"step_sec": 4.0}, "tries": 2}))
    s = config.Settings.load(str(tmp_path / "c.yaml"))
    assert (s.mode, s.tries, s.step_sec) == ("fine", 2, 4.0)


def test_outliers_are_not_finite_or_far(spark):
    rows = [(k, [1.0 + k % 3, 2.0]) for k in range(200)] + [(500, [float("nan"), 2.0]), (501, [1000.0, 2.0])]
    assert sorted(r.episode_index for r in validate.outliers(spark.createDataFrame(rows, "episode_index long, v array<double>"), ["episode_index"], "v").collect()) == [500, 501]
