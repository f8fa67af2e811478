"""Binary sources in Python: TFRecord examples and MP4 headers; HDF5 where h5py exists."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        shift += 7
        if b < 128:
            return n, at


def _message(data: bytes) -> Iterator[tuple[int, int, bytes | int]]:
    """(field, wire type, value) of a protocol buffer message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            if kind == 2:
                size, at = _varint(data, at)
            else:
                size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        yield tag >> 3, kind, value


def records(data: bytes) -> Iterator[bytes]:
    """The payloads of a TFRecord file: u64 length, u32 checksum, payload, u32 checksum."""
    at = 0
    while at + 12 <= len(data):
        (size,) = struct.unpack_from("<Q", data, at)
        if at + 16 + size > len(data):
            raise ValueError("truncated record")
        yield data[at + 12 : at + 12 + size]
        at += 16 + size


def example(data: bytes) -> dict[str, list]:
    """The features of a serialised Example: lists of bytes, floats or integers."""
    out: dict[str, list] = {}
    for _, _, features in _message(data):
        for _, _, entry in _message(features):
            parts = {k: v for k, _, v in _message(entry)}
            values: list = []
            for kind, _, body in _message(parts.get(2, b"")):
                for _, wire, v in _message(body):
                    if kind == 1:
                        values.append(v)
                    elif kind == 2:
                        values += struct.unpack(f"<{len(v) // 4}f", v)
                    elif wire == 0:
                        values.append(v - (1 << 64) if v >= 1 << 63 else v)
                    else:
                        at = 0
                        while at < len(v):
                            n, at = _varint(v, at)
                            values.append(n - (1 << 64) if n >= 1 << 63 else n)
            out[parts[1].decode()] = values
    return out


def _episodes(batches):
    names = {"state": "steps/observation/state", "action": "steps/action", "reward": "steps/reward", "discount": "steps/discount"}
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            for k, raw in enumerate(records(content.as_py())):
                e = example(raw)
                cols = {"path": [path], "record": [k]} | {n: [e.get(f)] for n, f in names.items()}
                cols["is_terminal"] = [[bool(x) for x in e["steps/is_terminal"]] if "steps/is_terminal" in e else None]
                cols["instructions"] = [[[x.decode("utf-8", "ignore") for x in e.get(f"steps/{n}_instruction", [])] for n in ("language", "global", "clip")]]
                cols["file_path"] = [(e.get("episode_metadata/file_path") or [b""])[0].decode("utf-8", "ignore")]
                floats = pa.list_(pa.float32())
                kinds = [pa.string(), pa.int32(), floats, floats, floats, floats, pa.list_(pa.bool_()), pa.list_(pa.list_(pa.string())), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols.values(), kinds)], names=list(cols))


def tfrecord_episodes(spark: SparkSession, root: str, version: str = "1.0.0") -> DataFrame:
    """One row for each record of <root>/<version>/*.tfrecord-*, with flat arrays; a task holds one shard."""
    shards = spark.read.format("binaryFile").option("pathGlobFilter", "*.tfrecord-*").load(f"{root}/{version}").select("path", "content")
    return shards.mapInArrow(_episodes, "path string, record int, state array<float>, action array<float>, reward array<float>, discount array<float>, is_terminal array<boolean>, instructions array<array<string>>, file_path string")


def _boxes(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    while at + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, at)
        head = 8
        if size == 1:
            (size,) = struct.unpack_from(">Q", data, at + 8)
            head = 16
        size = size or end - at
        if size < head:
            return
        yield kind, at + head, min(end, at + size)
        at += size


def mp4_info(data: bytes) -> tuple[float, int] | None:
    """(frames a second, frames) of the first track with video samples, from its time scale, duration and sample table."""
    for kind, a, b in _boxes(data, 0, len(data)):
        if kind != b"moov":
            continue
        for trak, ta, tb in _boxes(data, a, b):
            if trak != b"trak":
                continue
            scale = samples = length = 0
            video = False
            todo = [(ta, tb)]
            while todo:
                for box, x, y in _boxes(data, *todo.pop()):
                    if box in (b"mdia", b"minf", b"stbl"):
                        todo.append((x, y))
                    elif box == b"mdhd":
                        scale, length = struct.unpack_from(">IQ" if data[x] else ">II", data, x + (20 if data[x] else 12))
                    elif box == b"hdlr":
                        video = data[x + 8 : x + 12] == b"vide"
                    elif box == b"stsz":
                        (samples,) = struct.unpack_from(">I", data, x + 8)
            if video:
                return (samples * scale / length if length else 0.0), samples
    return None


def moov(f, size: int) -> bytes:
    """The one box of an mp4 that has its tracks, found by its neighbours' sizes: pixels are not read."""
    at = 0
    while at + 8 <= size:
        f.seek(at)
        head = f.read(16)
        length, kind = struct.unpack_from(">I4s", head)
        if length == 1 and len(head) == 16:
            (length,) = struct.unpack_from(">Q", head, 8)
        length = length or size - at
        if length < 8:
            return b""
        if kind == b"moov":
            f.seek(at)
            return f.read(length)
        at += length
    return b""


def _infos(batches):
    from pyarrow import fs as filesystems

    for batch in batches:
        got = []
        for path in batch.column(0).to_pylist():
            fs, at = filesystems.FileSystem.from_uri(path)
            with fs.open_input_file(at) as f:
                got.append(mp4_info(moov(f, f.size())))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([g and g[0] for g in got], pa.float64()), pa.array([g and g[1] for g in got], pa.int64())], names=["path", "fps", "nframes"])


def video_info(spark: SparkSession, root: str) -> DataFrame:
    """path, fps (30 where it is not known), nframes of every mp4 below root; unreadable ones have no frames. Files are listed without their contents, and tasks read headers only."""
    from tracewright.functions.scalar import fps_or_default

    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.mp4").load(root).select(F.regexp_replace("path", "^file:/+", "file:///").alias("path"))
    return found.mapInArrow(_infos, "path string, fps double, nframes long").select("path", fps_or_default(F.col("fps")).alias("fps"), F.coalesce("nframes", F.lit(0)).alias("nframes"))


def hdf5_episodes(spark: SparkSession, root: str) -> DataFrame:
    """path, state, action (arrays of arrays) of every HDF5 file; needs h5py."""
    import io

    import h5py

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                with h5py.File(io.BytesIO(content.as_py())) as f:
                    state, action = (f[k][()].astype("float32") for k in ("observations/qpos", "action"))
                if len(state) != len(action):
                    raise ValueError(f"{path}: {len(state)} states and {len(action)} actions")
                kind = pa.list_(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([state.tolist()], kind), pa.array([action.tolist()], kind)], names=["path", "state", "action"])

    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{hdf5,h5}").load(root).select("path", "content")
    return found.mapInArrow(run, "path string, state array<array<float>>, action array<array<float>>")
