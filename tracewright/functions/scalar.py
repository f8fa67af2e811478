"""Column functions of the episode model: all run inside Spark's generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names, labels and texts that results must carry.
ALOHA_LABELS = ["approach the target object", "grasp or manipulate the object", "move toward the target location", "finish the task"]
BIPLAY_LABELS = ["approach the object", "grasp or establish contact", "perform the main manipulation", "finish the task"]
ALOHA_DEFAULT_TASK = "aloha manipulation task"
DROID_DEFAULT_TASK = "droid manipulation task"
DEFAULT_EVENT = "memory_updated"
DEFAULT_FPS = 30.0


def fps_or_default(fps: Column) -> Column:
    """Null, NaN and near-zero rates are 30 frames a second."""
    return F.when(fps.isNull() | F.isnan(fps.cast("double")) | (F.abs(fps) < 1e-6), F.lit(DEFAULT_FPS)).otherwise(fps.cast("double"))


def timestamp(frame: Column, fps: Column | float) -> Column:
    return frame / (F.lit(fps) if not isinstance(fps, Column) else fps)


def speed_bin(frames: Column, width: int = 500) -> Column:
    """Half-even multiple of width."""
    return (F.bround(frames / F.lit(width)) * width).cast("int")


def quality(success: Column) -> Column:
    return F.when(success, 5).otherwise(2)


def mistake(success: Column) -> Column:
    return ~success


def future_frame(frame: Column, fps: int, total: Column) -> Column:
    """Two seconds ahead, clamped to the last frame."""
    return F.least(frame + 2 * fps, total - 1)


def episode_name(index: Column) -> Column:
    return F.format_string("episode_%06d", index)


def camera_file(index: Column, camera: str) -> Column:
    return F.format_string(f"episode_%06d_{camera}.mp4", index)


def sanitize(name: Column) -> Column:
    return F.regexp_replace(name, r"[^\p{L}\p{N}_-]", "_")


def task_from_path(path: Column) -> Column:
    """First folder of a relative path of three parts or more, else the file's grandparent; without _demos_ and what follows, underscores as spaces."""
    parts = F.split(path, "/")
    folder = F.when(F.size(parts) >= 3, F.get(parts, 0)).otherwise(F.coalesce(F.get(parts, F.size(parts) - 3), F.lit("")))
    text = F.trim(F.replace(F.regexp_replace(folder, r"_demos_.*$", ""), F.lit("_"), F.lit(" ")))
    return F.when(text == "", F.lit(ALOHA_DEFAULT_TASK)).otherwise(text)


def task_from_root(names: list[Column], known: dict[str, str], default: str) -> Column:
    """The first known name of root, parent and grandparent; else the root's name without its common affixes."""
    table = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    bare = F.trim(F.replace(F.replace(F.replace(F.replace(names[0], F.lit("_raw"), F.lit("")), F.lit("_dataset"), F.lit("")), F.lit("aloha_"), F.lit("")), F.lit("_"), F.lit(" ")))
    return F.coalesce(*[F.get(F.array(F.try_element_at(table, n)), 0) for n in names], F.when(bare != "", bare), F.lit(default))


def task_from_instructions(arrays: list[Column], *rest: Column) -> Column:
    """The first text that is not blank over the arrays in turn, else the further choices."""
    return F.coalesce(*[F.get(F.filter(F.transform(a, lambda x: F.trim(x)), lambda x: x != ""), 0) for a in arrays], *rest)


def override(value: Column, given: str | None) -> Column:
    return F.lit(given.strip()) if given and given.strip() else value


def reshape(flat: Column, width: int) -> Column:
    """Rows of width values; null where the length is no multiple."""
    rows = F.size(flat) / width
    return F.when((F.size(flat) > 0) & (F.size(flat) % width == 0), F.transform(F.sequence(F.lit(0), rows.cast("int") - 1), lambda i: F.slice(flat, i * width + 1, width)))


def array_or(value: Column, default: Column, length: Column) -> Column:
    return F.coalesce(value, F.array_repeat(default, length))


def last_terminal(flags: Column) -> Column:
    """An episode's success: its last is_terminal, true for none."""
    return F.coalesce(F.try_element_at(flags, F.lit(-1)), F.lit(True))


def pick_state(columns: list[str], stem: str = "observation.state", spare: str | None = None) -> Column:
    """The whole vector, else joint and gripper parts one after the other, else the spare column."""
    if stem in columns:
        return F.col(f"`{stem}`").cast("array<float>")
    joint, gripper = f"{stem}.joint_position", f"{stem}.gripper_position"
    if joint in columns and gripper in columns:
        return F.concat(F.col(f"`{joint}`").cast("array<float>"), F.col(f"`{gripper}`").cast("array<float>"))
    if spare and spare in columns:
        return F.col(f"`{spare}`").cast("array<float>")
    raise KeyError(stem)


def pick_action(columns: list[str]) -> Column:
    return pick_state(columns, "action", "action.original")


def shorten(text: Column, most: Column | int) -> Column:
    """White space collapsed; a longer text ends in ..."""
    most = most if isinstance(most, Column) else F.lit(most)
    flat = F.regexp_replace(F.regexp_replace(text, r"\s+", " "), r"^ | $", "")
    return F.when(F.length(flat) <= most, flat).otherwise(F.concat(F.substring(flat, F.lit(1), F.greatest(F.lit(0), most - 3)), F.lit("...")))


def inclusive_end(start: Column, end: Column) -> Column:
    return F.greatest(start, end - 1)


def event_tags(tags: Column) -> Column:
    """Trimmed tags without blanks; the default where none is left."""
    clean = F.filter(F.transform(tags, lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.coalesce(F.size(clean), F.lit(0)) <= 0, F.array(F.lit(DEFAULT_EVENT))).otherwise(clean)


def extract_json(text: Column) -> Column:
    """The JSON object of a model's answer as VARIANT: fences off; else from the first { to the last }; else an empty object."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(text, r"```(json)?", ""), "```", ""))
    inner = F.nullif(F.regexp_extract(bare, r"(?s)\{.*\}", 0), F.lit(""))
    return F.coalesce(F.try_parse_json(bare), F.try_parse_json(inner), F.parse_json(F.lit("{}")))


def is_empty_answer(v: Column) -> Column:
    """Not an object, or one without keys."""
    return F.coalesce(~F.schema_of_variant(v).startswith("OBJECT") | (F.to_json(v) == "{}"), F.lit(True))


def payload(v: Column, key: str) -> Column:
    """The object under key if there is one, else the whole."""
    inner = F.try_variant_get(v, f"$.{key}", "variant")
    return F.when(F.coalesce(F.schema_of_variant(inner).startswith("OBJECT"), F.lit(False)), inner).otherwise(v)


def normalised_answer(v: Column) -> Column:
    """A remote answer: itself with transitions or instructions, else its vlm_json, else its text parsed, else empty."""
    has = F.try_variant_get(v, "$.transitions", "variant").isNotNull() | F.try_variant_get(v, "$.instructions", "variant").isNotNull() | F.try_variant_get(v, "$.subtask", "variant").isNotNull() | F.try_variant_get(v, "$.memory", "variant").isNotNull()
    nested, text = F.try_variant_get(v, "$.vlm_json", "variant"), F.try_variant_get(v, "$.text", "string")
    return F.when(has, v).when(nested.isNotNull(), nested).when(text.isNotNull(), extract_json(text)).otherwise(F.parse_json(F.lit("{}")))


def subtask_context(segments: Column) -> Column:
    """A line for each segment, empty without."""
    lines = F.array_join(F.transform(segments, lambda s: F.format_string("- frames %d-%d: %s", s["start_frame"], s["end_frame"], s["subtask"])), "\n")
    return F.when(F.size(segments) > 0, lines).otherwise(F.lit(""))


def timeline(start: Column, end: Column, total: Column, ordinal: Column, x0: int, width: int) -> dict[str, Column]:
    """Pixel columns and palette index of a segment's bar."""

    def at(frame: Column) -> Column:
        span = F.greatest(F.lit(1), total - 1)
        return x0 + (width * F.least(F.greatest(frame, F.lit(0)), total - 1) / span).cast("int")

    left = at(start)
    return {"sx": left, "ex": F.greatest(left + 2, at(end)), "colour": ordinal % 7}


def decode_text(raw: Column) -> Column:
    """Bytes as text without what is not UTF-8 and without white space at the ends; null stays null."""
    text = F.when(F.is_valid_utf8(raw.cast("string")), raw.cast("string")).otherwise(F.replace(F.make_valid_utf8(raw.cast("string")), F.lit("\ufffd"), F.lit("")))
    return F.btrim(text, F.lit(" \t\n\x0b\f\r"))


def video_pointers(cameras: list[str], paths: str, frame: Column) -> dict[str, Column]:
    """video.<camera>.path and video.<camera>.frame_index of each camera; a camera without a path has neither."""
    out = {}
    for cam in cameras:
        path = F.try_element_at(F.col(paths), F.lit(cam))
        out |= {f"video.{cam}.path": path, f"video.{cam}.frame_index": F.when(path.isNotNull(), frame.cast("bigint"))}
    return out
