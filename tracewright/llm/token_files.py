"""Token ids of whole documents in sorted-string-table shards, and reading them back."""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, arrow_limits, shuffle_partitions
from .sstable import Reader, Writer, int_key, key_int
from .tokens import encoder


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def shard_writer(folder: str, tokenizer: str, end_id: int):
    """For mapInArrow over a partition of (id, text) sorted by id: writes one shard, gives its manifest row.

    A shard's name is its own for each attempt: a repeated or lost task leaves a file that no manifest row names.
    """

    def run(batches):
        fs, path = _filesystem(folder)
        name = f"{uuid.uuid4().hex}.sst"
        texts, writer, out, first, last = encoder(tokenizer).texts, None, None, None, None
        for batch in batches:
            for key, got in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                if writer is None:
                    fs.create_dir(path, recursive=True)
                    out = fs.open_output_stream(f"{path}/{name}")
                    writer = Writer(out)
                ids = np.append(got, np.uint32(end_id))
                wide = ids.max() > 0xFFFF
                last = int_key(key)
                first = first if first is not None else last
                writer.add(last, (b"\4" + ids.astype("<u4").tobytes()) if wide else (b"\2" + ids.astype("<u2").tobytes()), len(ids))
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "entries": pa.array([writer.entries]), "n_ids": pa.array([writer.units]), "first_key": pa.array([first], pa.binary()), "last_key": pa.array([last], pa.binary())})

    return run


def value_ids(value: bytes) -> np.ndarray:
    return np.frombuffer(value, "<u4" if value[0] == 4 else "<u2", offset=1).astype(np.uint32)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """Encodes every whole text, appends end_id, and writes shards in ascending order of id; returns the manifest.

    folder: a URI all executors share. Manifest: (path, entries, n_ids, first_key, last_key), one row for each shard;
    shards' key ranges ascend and do not overlap, but for rows of one id, which all lie in one shard. Ids are integers
    or null (first). Rows of one id are all written, in order of their texts. Null texts are empty: the end id alone.
    Texts, not ids, are shuffled: ranges are sampled without encoding twice.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "tokens")
    arrow_limits(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(shuffle_partitions(spark), "id").sortWithinPartitions("id", "text")
    return scratch.table(dealt.mapInArrow(shard_writer(folder, tokenizer, end_id), "path string, entries long, n_ids long, first_key binary, last_key binary"), "manifest")


def shard_reader(digest: bool):
    """For mapInArrow over (path, base): (doc_id, start, n_tokens, ids_crc32 or ids) of every document of the shards."""

    def run(batches):
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, at = _filesystem(path)
                with fs.open_input_file(at) as f:
                    keys, starts, sizes, out = [], [], [], []
                    for key, value in Reader(f, f.size()):
                        ids = value_ids(value)
                        keys.append(key_int(key))
                        starts.append(base)
                        sizes.append(len(ids))
                        out.append(zlib.crc32(ids.astype("<u4").tobytes()) if digest else ids.tolist())
                        base += len(ids)
                        if len(keys) >= (10_000 if digest else 200):
                            yield _rows(keys, starts, sizes, out, digest)
                            keys, starts, sizes, out = [], [], [], []
                    if keys:
                        yield _rows(keys, starts, sizes, out, digest)

    return run


def _rows(keys, starts, sizes, out, digest):
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys, starts, sizes)] + [pa.array(out, pa.int64() if digest else pa.list_(pa.int64()))], names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])


def read_tokens(spark: SparkSession, manifest: DataFrame, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids, or ids_crc32 with digest) from the shards; start: ids of all documents before, in order of ids.

    The running total is over one row for each shard.
    """
    base = F.coalesce(F.sum("n_ids").over(Window.orderBy("first_key", "path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = manifest.select("path", base.alias("base")).repartition(shuffle_partitions(spark), "path")
    return shards.mapInArrow(shard_reader(digest), f"doc_id long, start long, n_tokens long, {'ids_crc32 long' if digest else 'ids array<long>'}")


def lookup(manifest: DataFrame, key: int | None) -> np.ndarray | None:
    """The ids of one document: its shard by key range, its block by the sparse index, its entry by binary search."""
    want = int_key(key)
    row = manifest.where((F.col("first_key") <= F.lit(want)) & (F.col("last_key") >= F.lit(want))).select("path").first()
    if row is None:
        return None
    fs, at = _filesystem(row.path)
    with fs.open_input_file(at) as f:
        value = Reader(f, f.size()).get(want)
    return None if value is None else value_ids(value)
