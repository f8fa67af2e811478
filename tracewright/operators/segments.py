"""Segmentation: placeholder cuts, weighted cut clustering, label votes, and joins of frames and intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.scalar import ALOHA_LABELS, DEFAULT_EVENT, event_tags


def placeholder_segments(episodes: DataFrame, keys: list[str], frames_col: str, labels: list[str] = ALOHA_LABELS) -> DataFrame:
    """Quarters of each episode as inclusive intervals, empty ones left out, numbered densely."""
    t = F.col(frames_col)
    cuts = [F.lit(0).cast("long"), *[(t * q).cast("long") for q in (0.25, 0.5, 0.75)], t.cast("long")]
    each = F.array(*[F.struct(a.alias("start_frame"), (b - 1).alias("end_frame"), F.lit(x).alias("subtask")) for a, b, x in zip(cuts, cuts[1:], labels)])
    held = F.filter(each, lambda s: s["end_frame"] >= s["start_frame"])
    return episodes.select(*keys, F.posexplode(held).alias("segment_index", "s")).select(*keys, "segment_index", "s.*")


def label_frames(frames: DataFrame, segments: DataFrame, keys: list[str], fallback: bool = True) -> DataFrame:
    """frames with the subtask of the first interval that holds each, else, with fallback, that of the last segment.

    An equi-join on the episode's segments as one sorted array: no range join, and frames stay where they are.
    """
    listed = segments.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("segment_index", "start_frame", "end_frame", "subtask"))).alias("_segs"))
    hit = F.get(F.filter("_segs", lambda s: (s["start_frame"] <= F.col("frame_index")) & (F.col("frame_index") <= s["end_frame"])), 0)["subtask"]
    last = F.coalesce(F.try_element_at("_segs", F.lit(-1))["subtask"], F.lit("unknown subtask"))
    return frames.join(listed, keys, "left").withColumn("subtask", F.coalesce(hit, last) if fallback else hit).drop("_segs")


def overlapping(windows: DataFrame, segments: DataFrame, keys: list[str]) -> DataFrame:
    """Each window with the segments that overlap it, in order."""
    s = segments.select(*keys, "segment_index", F.col("start_frame").alias("s_start"), F.col("end_frame").alias("s_end"), "subtask")
    both = windows.join(s, keys).where("s_start <= end_frame and s_end >= start_frame")
    return both.groupBy(*keys, "window_id").agg(F.array_sort(F.collect_list(F.struct("segment_index", F.col("s_start").alias("start_frame"), F.col("s_end").alias("end_frame"), "subtask"))).alias("segments"))


def align_memory(subtasks: DataFrame, memory: DataFrame, keys: list[str]) -> DataFrame:
    """Each subtask with the first memory that holds its middle frame, else the one of its ordinal, clamped to the last; segment_index is the ordinal."""
    order = Window.partitionBy(*keys).orderBy("start_frame", "segment_index")
    sub = subtasks.select(*keys, "start_frame", "end_frame", "subtask", (F.row_number().over(order) - 1).alias("ordinal"))
    mem = memory.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("start_frame", "segment_index", "end_frame", "summary"))).alias("_m"))
    middle = F.floor((F.col("start_frame") + F.col("end_frame")) / 2)
    hit = F.get(F.filter("_m", lambda m: (m["start_frame"] <= middle) & (middle <= m["end_frame"])), 0)["summary"]
    spare = F.get(F.col("_m"), F.least(F.col("ordinal"), F.size("_m") - 1))["summary"]
    return sub.join(mem, keys).select(*keys, F.col("ordinal").alias("segment_index"), "start_frame", "end_frame", "subtask", F.coalesce(hit, spare).alias("summary"))


def hann(i: Column, n: int) -> Column:
    return 0.5 - 0.5 * F.cos(2 * F.pi() * (i + 1) / F.lit(n + 1))


def raw_cuts(answers: DataFrame, keys: list[str], per_window: int) -> DataFrame:
    """keys, fps, nframes, frame, weight of every valid transition; answers: keys, window_id, frame_ids, transitions (array of int, null elements skipped)."""
    t = answers.select(*keys, "fps", "nframes", "frame_ids", F.explode("transitions").alias("i")).where("i >= 0 and i < size(frame_ids)")
    edge = F.least(F.col("i"), F.size("frame_ids") - 1 - F.col("i"))
    weight = F.when(F.size("frame_ids") == per_window, hann(F.col("i"), per_window)).otherwise(F.when(edge > 2, 1.0).otherwise(0.5))
    return t.select(*keys, "fps", "nframes", F.get("frame_ids", F.col("i")).alias("frame"), weight.alias("weight"))


def cluster_cuts(cuts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, cut: cuts nearer than 2.5 seconds to the one before are one cluster, whose weighted mean is truncated to a frame (with a guard of 1e-9, as sums may differ in the last bit)."""
    w = Window.partitionBy(*keys).orderBy("frame")
    gap = F.greatest(F.lit(1.0), 2.5 * F.col("fps"))
    far = F.coalesce((F.col("frame") - F.lag("frame").over(w) >= gap).cast("int"), F.lit(1))
    numbered = cuts.withColumn("_far", far).withColumn("_c", F.sum("_far").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    mean = F.when(F.sum("weight") > 1e-9, F.sum(F.col("frame") * F.col("weight")) / F.sum("weight")).otherwise(F.avg("frame"))
    return numbered.groupBy(*keys, "_c").agg(F.floor(mean + 1e-9).cast("int").alias("cut")).drop("_c")


def votes(answers: DataFrame, keys: list[str], drop_unknown: bool = True) -> DataFrame:
    """keys, frame, window_id, k, label, events: one vote of each sampled frame of a labelled span.

    answers also has labels (array of string) and may have events (array of arrays). The i-th label belongs to the
    i-th span between sorted distinct boundaries.
    """
    size = F.size("frame_ids")
    valid = F.filter("transitions", lambda t: (t >= 0) & (t < size))
    bounds = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0)), valid, F.array(size))))
    events = F.col("events") if "events" in answers.columns else F.lit(None).cast("array<array<string>>")
    spans = answers.select(*keys, "window_id", "frame_ids", "nframes", "labels", events.alias("events"), bounds.alias("b"))
    spans = spans.select("*", F.posexplode(F.slice(F.col("b"), F.lit(1), F.size("b") - 1)).alias("n", "lo")).withColumn("hi", F.get("b", F.col("n") + 1))
    spans = spans.withColumn("label", F.trim(F.get("labels", F.col("n")))).where("label <> ''")
    if drop_unknown:
        spans = spans.where(F.lower("label") != "unknown")
    spans = spans.withColumn("events", event_tags(F.get("events", F.col("n"))))
    out = spans.select(*keys, "window_id", "nframes", "label", "events", "lo", F.posexplode(F.slice(F.col("frame_ids"), F.col("lo") + 1, F.col("hi") - F.col("lo"))).alias("_o", "frame"))
    return out.where("frame < nframes").select(*keys, "frame", "window_id", (F.col("lo") + F.col("_o")).alias("k"), "label", "events")


def cut_spans(episodes: DataFrame, clusters: DataFrame, keys: list[str]) -> DataFrame:
    """keys, fps, nframes, start_frame, end_frame (exclusive): spans between 0, the clusters and the end; those under 0.8 seconds are left out, not merged."""
    base = episodes.select(*keys, "fps", "nframes").where("nframes > 0")
    found = clusters.groupBy(*keys).agg(F.collect_set("cut").alias("cuts"))
    points = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0)), F.coalesce("cuts", F.array().cast("array<int>")), F.array(F.col("nframes")))))
    spans = base.join(found, keys, "left").select(*keys, "fps", "nframes", points.alias("p"))
    spans = spans.select(*keys, "fps", "nframes", "p", F.posexplode(F.slice(F.col("p"), F.lit(1), F.size("p") - 1)).alias("_i", "start_frame")).withColumn("end_frame", F.get("p", F.col("_i") + 1))
    least = F.greatest(F.lit(1), (0.8 * F.col("fps")).cast("int"))
    return spans.where(F.col("end_frame") - F.col("start_frame") >= least).select(*keys, "fps", "nframes", "start_frame", "end_frame")


def vote_labels(spans: DataFrame, voted: DataFrame, keys: list[str], with_events: bool = False) -> DataFrame:
    """keys, seg_id, start_frame, end_frame, label (and the four most frequent events): each span's most frequent label.

    Votes of the span's inner part count, both its ends included; without any, all of the span's. Of equally frequent
    labels the first in order of (frame, window, place) wins. Spans without a vote are dropped; seg_id is dense.
    """
    margin = ((F.col("end_frame") - F.col("start_frame")) * 0.2).cast("int")
    s = spans.withColumns({"lo": F.col("start_frame") + margin, "hi": F.col("end_frame") - margin})
    both = s.join(voted, keys).where("frame >= start_frame and frame <= end_frame")
    inner = F.col("frame").between(F.col("lo"), F.col("hi"))
    both = both.withColumn("inner", inner).where(inner | (F.col("frame") < F.col("end_frame")))
    span = [*keys, "start_frame", "end_frame"]
    any_inner = F.max("inner").over(Window.partitionBy(*span))
    both = both.withColumn("_any", any_inner).where("inner = _any")
    counted = both.groupBy(*span, "label").agg(F.count("*").alias("n"), F.min(F.struct("frame", "window_id", "k")).alias("first"))
    best = counted.groupBy(*span).agg(F.min(F.struct((-F.col("n")).alias("n"), "first", "label")).alias("best")).select(*span, F.col("best.label").alias("label"))
    if with_events:
        e = both.select(*span, "frame", "window_id", "k", F.posexplode("events").alias("p", "event"))
        e = e.groupBy(*span, "event").agg(F.count("*").alias("n"), F.min(F.struct("frame", "window_id", "k", "p")).alias("first"))
        top = e.groupBy(*span).agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "first", "event"))), 1, 4).alias("t")).select(*span, F.col("t.event").alias("events"))
        best = best.join(top, span, "left").withColumn("events", F.coalesce("events", F.array(F.lit(DEFAULT_EVENT))))
    return best.select(*keys, (F.row_number().over(Window.partitionBy(*keys).orderBy("start_frame")) - 1).alias("seg_id"), "start_frame", "end_frame", "label", *(["events"] if with_events else []))


def fuse_windows(windows: DataFrame, results: DataFrame, keys: list[str], per_window: int = 16, memory: bool = False) -> DataFrame:
    """Segments of every sample from its windows' answers; results: keys, window_id, transitions, labels (and events with memory)."""
    answers = windows.join(results, [*keys, "window_id"])
    episodes = windows.groupBy(*keys).agg(F.first("fps").alias("fps"), F.first("nframes").alias("nframes"))
    spans = cut_spans(episodes, cluster_cuts(raw_cuts(answers, keys, per_window), keys), keys)
    return vote_labels(spans, votes(answers, keys, drop_unknown=not memory), keys, with_events=memory)
