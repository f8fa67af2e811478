"""Line dedup: range-partitioned hashes with a secondary sort, streamed; per-document keep bitmaps as the result."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytesx import FOLDED, WORD, buffers, segment_hashes, slices
from .common import Scratch, shuffle_partitions

#: What a streamed row says: a line to drop; a line of a key that may go on in another partition; such a key's part.
DROP, OPEN, PART = 1, 0, 2
#: Rows of one key that a partition's stream holds before it hands them on as OPEN.
HELD = 100_000


def line_keys(min_chars: int):
    """For mapInArrow over (id, tkey, text): (h, id, tkey, pos) of every line with a key of at least min_chars code points."""

    def run(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            rows, hashes, places = [], [], []
            for i, j in slices(offsets):
                at, text = offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]]
                feed = np.flatnonzero(text == 10)
                # A line starts at a document's start and after each feed; it ends at a feed or at the document's end.
                doc_of_feed = np.searchsorted(at, feed, "right") - 1
                starts = np.concatenate([at[:-1], feed + 1])
                doc = np.concatenate([np.arange(j - i), doc_of_feed])
                order = np.lexsort((starts, doc))
                starts, doc = starts[order], doc[order]
                ends = np.empty_like(starts)
                last = np.append(doc[1:] != doc[:-1], True)
                ends[:-1] = starts[1:] - 1
                ends[last] = at[doc[last] + 1]
                head = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
                pos = np.arange(len(doc)) - np.repeat(head, np.diff(np.append(head, len(doc))))
                words = np.flatnonzero(WORD[text])
                lo, hi = np.searchsorted(words, starts), np.searchsorted(words, ends)
                full = np.flatnonzero(hi > lo)
                if len(full) == 0:
                    continue
                s, e = words[lo[full]], words[hi[full] - 1] + 1
                if min_chars > 1:
                    chars = np.append(0, np.cumsum((text & 0xC0) != 0x80))
                    long = chars[e] - chars[s] >= min_chars
                    full, s, e = full[long], s[long], e[long]
                hashes.append(segment_hashes(FOLDED[text], s, e))
                rows.append(doc[full] + i)
                places.append(pos[full])
            if rows:
                of = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(hashes).view(np.int64)), batch.column(0).take(of), batch.column(1).take(of), pa.array(np.concatenate(places).astype(np.int64))],
                    names=["h", "id", "tkey", "pos"],
                )

    return run


def repeated(min_docs: int, keep_first: bool):
    """For mapInArrow over a partition sorted by (h, id, tkey, pos): rows (kind, h, n, id, tkey, pos).

    The partition's first and last key may go on next door: their rows come as OPEN, and one PART row tells their
    documents here and their first line. So does a key of more than HELD rows, so that what is held stays bounded.
    """

    def run(batches):
        first = held = None  # the partition's first key; rows of the key that is still open
        docs, hot, start = 0, False, None

        def out(kind, rows, n=None):
            m = rows.num_rows
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, kind, np.int8)), rows.column(0), pa.array(np.full(m, n or 0, np.int64)), *rows.columns[1:4]],
                names=["kind", "h", "n", "id", "tkey", "pos"],
            )

        def closed(last):
            nonlocal held
            edge = last or start_h == first
            if edge:
                if held:
                    yield out(OPEN, merged(held))
                yield out(PART, start, docs)
            elif hot and held:
                yield out(DROP, merged(held).slice(1 if keep_first and not flushed else 0))
            held = []

        def merged(parts):
            return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

        start_h, flushed, end = None, False, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            h = batch.column(0).to_numpy(zero_copy_only=False)
            new_h = np.append(True, h[1:] != h[:-1])
            new_h[0] = start_h is None or h[0] != start_h
            new_doc = np.ones(n, bool)
            same = np.ones(n - 1, bool)
            for k in (1, 2):
                # null ids sort first and equal each other
                col = batch.column(k)
                codes = col.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                same &= codes[1:] == codes[:-1]
            new_doc[1:] = ~same
            new_doc[0] = end is None or (batch.column(1)[0].as_py(), batch.column(2)[0].as_py()) != end
            new_doc |= new_h
            end = (batch.column(1)[n - 1].as_py(), batch.column(2)[n - 1].as_py())
            at = np.flatnonzero(new_h)
            seen = np.append(0, np.cumsum(new_doc))
            # What goes on from the batch before.
            upto = int(at[0]) if len(at) else n
            if upto:
                docs += int(seen[upto])
                held.append(batch.slice(0, upto))
                hot = hot or docs >= min_docs
                if sum(x.num_rows for x in held) > HELD:
                    yield out(OPEN, merged(held))
                    held, flushed = [], True
            if len(at) == 0:
                continue
            if start_h is not None:
                if flushed:
                    yield from closed(True)
                else:
                    yield from closed(False)
            # Keys that begin and end within this batch.
            stops = np.append(at[1:], n)
            count = seen[stops] - seen[at]
            if first is None:
                first = h[0]
                if len(at) > 1:
                    yield out(OPEN, batch.slice(0, int(stops[0])))
                    yield out(PART, batch.slice(0, 1), int(count[0]))
            inner = slice(0, len(at) - 1)
            drop = np.repeat(count[inner] >= min_docs, (stops - at)[inner]) if len(at) > 1 else np.zeros(0, bool)
            if len(drop):
                base = int(at[0])
                if h[base] == first:
                    drop[: int(stops[0]) - base] = False
                if keep_first:
                    drop[at[inner] - base] = False
                if drop.any():
                    yield out(DROP, batch.slice(base, len(drop)).filter(pa.array(drop)))
            k = int(at[-1])
            start_h, start, docs, flushed = h[k], batch.slice(k, 1), int(count[-1]), False
            held, hot = [batch.slice(k, n - k)], docs >= min_docs
        if start_h is not None:
            yield from closed(True)

    return run


def bitmaps(batches):
    """For mapInArrow over (id, tkey, drops): (id, tkey, keep). keep is a compressed bitmap, a set bit for each line that stays, up to the last dropped line; later lines stay."""
    for batch in batches:
        keep = []
        for d in batch.column(2).to_pylist():
            bits = np.ones(max(d) + 1, bool)
            bits[d] = False
            keep.append(zlib.compress(np.packbits(bits).tobytes() + len(bits).to_bytes(8, "little"), 1))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keep, pa.binary())], names=["id", "tkey", "keep"])


def unpack(keep: bytes) -> np.ndarray:
    raw = zlib.decompress(keep)
    return np.unpackbits(np.frombuffer(raw[:-8], np.uint8), count=int.from_bytes(raw[-8:], "little")).astype(bool)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, tkey, text): rows with one id and different texts stay apart by tkey."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("tkey"), text.alias("text"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 2, min_chars: int = 1, keep_first: bool = False, scratch: Scratch | None = None) -> DataFrame:
    """(id, tkey, keep) for each document that loses lines; see bitmaps and unpack.

    A line's key is the line without [\\x20\\x09-\\x0D] at its ends, A-Z lower-cased. Keys of at least min_chars code
    points found in at least min_docs documents lose their lines: all of them, or with keep_first all but the first
    in order of document and position. Only (hash, document, position) is shuffled, dealt by ranges of (hash,
    document), so a line of a third of all documents spreads over many partitions; the two keys at a partition's ends
    (and those of more than HELD rows) need its neighbours, and are settled by a join with one row for each of them.

    Rows equal in id and text count as one document. Keys are compared by 64-bit hashes: a key below min_docs would
    have to collide with a frequent one to be lost.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "lines")
    kind = dict(docs.select(F.col(id_col).alias("id")).dtypes)["id"]
    rows = scratch.table(keyed(docs, id_col, text_col).mapInArrow(line_keys(min_chars), f"h long, id {kind}, tkey long, pos long"), "keys")
    dealt = rows.repartitionByRange(shuffle_partitions(spark), "h", "id", "tkey").sortWithinPartitions("h", "id", "tkey", "pos")
    told = scratch.table(dealt.mapInArrow(repeated(min_docs, keep_first), f"kind byte, h long, n long, id {kind}, tkey long, pos long"), "told")
    scratch.drop("keys")
    parts = told.where(F.col("kind") == PART).groupBy("h").agg(F.sum("n").alias("n"), F.min(F.struct("id", "tkey", "pos")).alias("first")).where(F.col("n") >= min_docs)
    wide = told.where(F.col("kind") == OPEN).drop("n").join(parts, "h")
    if keep_first:
        wide = wide.where(~F.struct("id", "tkey", "pos").eqNullSafe(F.col("first")))
    drops = told.where(F.col("kind") == DROP).select("id", "tkey", "pos").union(wide.select("id", "tkey", "pos"))
    lists = drops.groupBy("id", "tkey").agg(F.collect_set("pos").alias("drops"))
    return lists.mapInArrow(bitmaps, f"id {kind}, tkey long, keep binary")


def stripped(with_text: bool):
    """For mapInArrow over (id, text, keep): (id, n_lines, n_dropped, kept_sha256 or text)."""

    def run(batches):
        for batch in batches:
            n, dropped, kept = [], [], []
            for text, keep in zip(batch.column(1), batch.column(2)):
                lines = (text.as_py() or "").split("\n")
                n.append(len(lines))
                if keep.is_valid:
                    bits = unpack(keep.as_py())
                    lines = [x for x, k in zip(lines, bits) if k] + lines[len(bits) :]
                dropped.append(n[-1] - len(lines))
                left = "\n".join(lines)
                kept.append(left if with_text else hashlib.sha256(left.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string()), *batch.columns[3:]],
                names=["id", "n_lines", "n_dropped", "kept", *batch.schema.names[3:]],
            )

    return run


def drop_lines(docs: DataFrame, keeps: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """(id, n_lines, n_dropped, text) of every row of docs without its dropped lines, or kept_sha256 in place of text, and then docs' other columns.

    A null or empty text is one empty line. A document of which no line stays has an empty text.
    """
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias("_")).alias("rest"))
    base = base.withColumn("tkey", F.xxhash64("text"))
    keeps = keeps.select(F.col("id").alias("kid"), F.col("tkey").alias("kkey"), "keep")
    both = base.join(keeps, (F.col("tkey") == F.col("kkey")) & F.col("id").eqNullSafe(F.col("kid")), "left")
    cols = ["id", "text", "keep"] + (["rest"] if with_text else [])
    both = both.select(*cols)
    types = dict(both.dtypes)
    name = "text" if with_text else "kept_sha256"
    out = both.mapInArrow(stripped(with_text), f"id {types['id']}, n_lines long, n_dropped long, kept string" + (f", rest {types['rest']}" if with_text else ""))
    extra = [F.col(f"rest.`{c}`").alias(c) for c in others if c not in ("n_lines", "n_dropped")] if with_text else []
    return out.select(F.col("id").alias(id_col), "n_lines", "n_dropped", F.col("kept").alias(name if name != "text" else text_col), *extra)
