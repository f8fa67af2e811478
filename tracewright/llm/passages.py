"""Repeated passages by prefix-free parsing: rolling-hash triggers, a dictionary of phrases, its sorted contexts.

A trigger is the position of the least rolling hash of GRAM bytes within a window of `length` bytes, the leftmost of
equals. It depends on the window's bytes alone, so equal windows have equal triggers at equal offsets, and every
window has one: unlike with hash-modulo triggers, no text goes without. A phrase is the text of all consecutive
windows of one trigger; neighbouring phrases overlap by length - 1 bytes, so every window lies in exactly one phrase,
and no phrase is a proper prefix of another one with the same trigger offset.

The parse, sorted by trigger and phrase, is the order of the corpus by phrases: equal phrases are neighbours there. The
dictionary's phrases of one trigger are sorted twice, by what stands right of the trigger and by what stands left of it
read backwards. Neighbours' longest common prefixes name the contexts of every length, and two windows are equal just
when the names of their left and right parts are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytesx import VALUES, buffers, mix, powers
from .common import Scratch, shuffle_partitions
from .lines import keyed

#: Bytes under a trigger's rolling hash.
GRAM = 64
#: Phrases of one trigger that are sorted in one task. Triggers with more (a short passage in very many texts) are settled by hashes of their windows, which spread.
FORMS = 4096
#: Bytes of phrases that are sorted together; those of one trigger always are.
TOGETHER = 4 << 20
#: Bytes of a document, or of documents together, that are parsed at a time. Phrases may be cut there: see repeated_spans.
PIECE = 1 << 19
_INVERSE = pow(int(powers(2)[1]), -1, 2**64)
_inverse = np.ones(1, np.uint64)


def _inverses(n: int) -> np.ndarray:
    global _inverse
    if len(_inverse) < n:
        table = np.full(n, _INVERSE, np.uint64)
        table[0] = 1
        _inverse = np.cumprod(table, dtype=np.uint64)
    return _inverse


class Hashes:
    """Hashes of any segment of a stretch of bytes, from prefix sums."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(VALUES[text] * powers(n)[:n], dtype=np.uint64, out=self.sums[1:])
        self.back = _inverses(max(n, 2 * PIECE))

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        lengths = np.asarray(ends - starts).astype(np.uint64)
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts] + lengths * np.uint64(0xD6E8FEB86659FD93))

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - 1 - k + 1
        return mix((self.sums[k:] - self.sums[:n]) * self.back[:n])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours, by running minima of blocks from both sides."""
    n = len(values) - width + 1
    size = -(-len(values) // width) * width
    padded = np.full(size, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def pieces(offsets: np.ndarray, length: int):
    """(first document, end document, first byte, last byte + 1, first byte of the piece's first window) of pieces of at most PIECE bytes, or of a part of one long document; parts overlap by length - 1 bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE, "right")) - 1)
        j = min(j, n)
        if j == i + 1 and offsets[j] - offsets[i] > 2 * PIECE:
            for a in range(int(offsets[i]), int(offsets[j]), PIECE):
                yield i, j, a, min(int(offsets[j]), a + PIECE + length - 1)
                if a + PIECE + length - 1 >= offsets[j]:
                    break
        else:
            yield i, j, int(offsets[i]), int(offsets[j])
        i = j


def parse(text: np.ndarray, at: np.ndarray, length: int):
    """Phrases of a piece: (document, trigger hash, offset of the trigger, first window, last window, phrase hash). at: the documents' offsets within text."""
    n = len(text)
    if n < length:
        return None
    h = Hashes(text)
    # 40 bits of hash, then the position: the least is the leftmost of the least hashes.
    keys = (h.grams(GRAM) >> np.uint64(24) << np.uint64(24)) | np.arange(n - GRAM + 1, dtype=np.uint64)
    least = sliding_least(keys, length - GRAM + 1)
    windows = np.arange(n - length + 1)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))[: n - length + 1]
    whole = windows + length <= at[doc + 1]
    windows, doc, least = windows[whole], doc[whole], least[whole]
    if len(windows) == 0:
        return None
    new = np.append(True, (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]))
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(windows)) - 1
    first, last, doc = windows[head], windows[tail], doc[head]
    trigger = (least[head] & np.uint64(0xFFFFFF)).astype(np.int64)
    return doc, h.of(trigger, trigger + GRAM), trigger - first, first, last, h.of(first, last + length)


def phrases(length: int):
    """For mapInArrow over (id, tkey, text): (g, x, id, tkey, place). g: hash of trigger; x: hash of the phrase's bytes and the trigger's place in it; place: see placed."""

    def run(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            for i, j, a, b in pieces(offsets, length):
                got = parse(data[a:b], np.clip(offsets[i : j + 1], a, b) - a, length)
                if got is None:
                    continue
                doc, g, off, first, last, x = got
                of = pa.array(doc + i)
                place = (first + a - offsets[i + doc]) << 32 | off << 16 | (last - first)
                cols = [pa.array(g.view(np.int64)), pa.array(mix(x + off.astype(np.uint64)).view(np.int64)), batch.column(0).take(of), batch.column(1).take(of), pa.array(place)]
                yield pa.RecordBatch.from_arrays(cols, names=["g", "x", "id", "tkey", "place"])

    return run


def placed(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window of a phrase, bytes in it before the trigger, windows after the first."""
    return place >> 32, place >> 16 & 0xFFFF, place & 0xFFFF


def neighbours(batches):
    """For mapInArrow over a partition of (g, x, id, tkey, place) sorted by g and x: (sure, asked, g, id, tkey, place) of rows that share their trigger with another.

    sure: the phrase occurs twice, so all its windows do. asked: a phrase beside a different one of its trigger, to be
    compared. Each phrase of a trigger with several is asked once or twice in a partition. The partition's first and
    last rows, whose neighbours are elsewhere, are asked too; if such a phrase occurs twice, both rows are in the
    dictionary and equal there.
    """

    def judged(rows: pa.RecordBatch, before, behind):
        """Rows between `before` and `behind`: (g, x) of neighbours, or None where unknown."""
        n = rows.num_rows
        g, x = (np.concatenate([[b[k] if b else 0] for b in (before,)] + [rows.column(k).to_numpy()] + [[b[k] if b else 0] for b in (behind,)]) for k in (0, 1))
        same_g = g[1:] == g[:-1]
        same_x = same_g & (x[1:] == x[:-1])
        other = same_g & ~same_x
        for at, side in ((0, before), (n, behind)):
            if side is None:
                same_x[at], other[at] = False, True
        sure, asked = same_x[1:] | same_x[:-1], other[1:] | other[:-1]
        held = np.flatnonzero(sure | asked)
        g = pa.array(g[1:-1][held], mask=~asked[held])
        of = pa.array(held)
        return pa.RecordBatch.from_arrays([pa.array(sure[held]), pa.array(asked[held]), g, *(rows.column(k).take(of) for k in (2, 3, 4))], names=["sure", "asked", "g", "id", "tkey", "place"])

    before, held = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        held = batch.slice(batch.num_rows - 1)
        rows = batch.slice(0, batch.num_rows - 1)
        if rows.num_rows:
            yield judged(rows, before, tuple(held.column(k)[0].as_py() for k in (0, 1)))
            before = tuple(rows.column(k)[rows.num_rows - 1].as_py() for k in (0, 1))
    if held is not None:
        yield judged(held, before, None)


def _each(batch: pa.RecordBatch):
    """(row, its text's bytes, its asked phrases' trigger, place, sure, hot) of (id, tkey, text, asked)."""
    data, offsets = buffers(batch.column(2))
    for row in range(batch.num_rows):
        asked = batch.column(3)[row].values
        g, place, sure, hot = (asked.field(k).to_numpy(zero_copy_only=False) for k in range(4))
        order = np.argsort(place, kind="stable")
        yield row, data[offsets[row] : offsets[row + 1]], g[order], place[order], sure[order], hot[order]


def dictionary(length: int):
    """For mapInArrow over (id, tkey, text, asked): (g, id, tkey, place, sure, phrase): phrases that are not hot with their bytes."""

    def run(batches):
        for batch in batches:
            for row, text, g, place, sure, hot in _each(batch):
                cold = ~hot
                first, _, more = placed(place[cold])
                bytes_ = [text[a : a + m + length].tobytes() for a, m in zip(first.tolist(), more.tolist())]
                of = pa.array(np.full(len(first), row))
                yield pa.RecordBatch.from_arrays([pa.array(g[cold]), batch.column(0).take(of), batch.column(1).take(of), pa.array(place[cold]), pa.array(sure[cold]), pa.array(bytes_, pa.binary())], names=["g", "id", "tkey", "place", "sure", "phrase"])

    return run


def _context(data: np.ndarray, at: np.ndarray, sizes: np.ndarray, step: int, width: int) -> np.ndarray:
    """(phrases, width): the bytes from `at` on, forwards or backwards, filled up with zeros."""
    inside = np.arange(width) < sizes[:, None]
    return np.where(inside, data[np.where(inside, at[:, None] + step * np.arange(width), 0)], 0).astype(np.uint8)


def _sorted_common(g: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by trigger and context, and how many bytes each has in common with the one before it (-1: another trigger)."""
    keys = np.concatenate([g.astype(">u8")[:, None].view(np.uint8).reshape(len(g), 8), context], axis=1)
    order = np.argsort(np.ascontiguousarray(keys).view(f"S{keys.shape[1]}").ravel(), kind="stable")
    differ = keys[order[1:]] != keys[order[:-1]]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), keys.shape[1]) - 8
    return order, np.append(-1, np.maximum(common, -1))


def repeated_windows(g: np.ndarray, off: np.ndarray, more: np.ndarray, data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, window): windows that another phrase of the same trigger has too. off: bytes before the trigger; more: windows after the first.

    Phrases are sorted by trigger and the context on either side of it. A window of l bytes before the trigger equals
    another one just when their l bytes on the left and length - l on the right are equal: when no common prefix
    between the two is shorter in either order.
    """
    n, most = len(g), length - GRAM
    left_order, left = _sorted_common(g, _context(data, offsets[:-1] + off - 1, off, -1, most))
    right_order, right = _sorted_common(g, _context(data, offsets[:-1] + off, np.diff(offsets) - off, 1, length))
    phrase, window = [], []
    for before in range(most + 1):
        there = np.flatnonzero((off >= before) & (off - more <= before))
        if len(there) < 2:
            continue
        names = np.empty((2, n), np.int64)
        names[0, left_order] = np.cumsum(left < before)
        names[1, right_order] = np.cumsum(right < length - before)
        key = names[0, there] * (n + 1) + names[1, there]
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        twice = there[order[np.append(same, False) | np.append(False, same)]]
        phrase.append(twice)
        window.append(off[twice] - before)
    return (np.concatenate(phrase), np.concatenate(window)) if phrase else (np.zeros(0, np.int64),) * 2


def compared(length: int):
    """For mapInArrow over a partition of (g, id, tkey, place, sure, phrase) sorted by g: (id, tkey, first, last): spans of repeated windows of phrases that are not sure."""

    def settled(rows: pa.RecordBatch):
        g, place = rows.column(0).to_numpy().view(np.uint64), rows.column(3).to_numpy()
        first, off, more = placed(place)
        data, offsets = buffers(rows.column(5))
        phrase, window = repeated_windows(g, off, more, data, offsets, length)
        unsure = ~rows.column(4).to_numpy(zero_copy_only=False)[phrase]
        at = np.sort(phrase[unsure] << 32 | window[unsure])
        head = np.flatnonzero(np.append(True, at[1:] != at[:-1] + 1)) if len(at) else np.zeros(0, np.int64)
        tail = np.append(head[1:], len(at)) - 1 if len(at) else head
        of = at[head] >> 32
        starts, ends = (first[of] + (at[k] & 0xFFFF) for k in (head, tail))
        of = pa.array(of)
        return pa.RecordBatch.from_arrays([rows.column(1).take(of), rows.column(2).take(of), pa.array(starts.astype(np.int32)), pa.array(ends.astype(np.int32))], names=["id", "tkey", "first", "last"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size >= TOGETHER:
                rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                g = rows.column(0).to_numpy()
                cut = int(np.searchsorted(g, g[-1], "left"))  # the last trigger's may go on
                if cut:
                    yield settled(rows.slice(0, cut))
                held = [rows.slice(cut)]
                size = sum(b.nbytes for b in held)
        if held:
            yield settled(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return run


def suffixes(length: int):
    """For mapInArrow over (id, tkey, text, asked): (s, id, tkey, first): the windows of hot phrases. s: hash of the window's bytes and its trigger."""

    def run(batches):
        for batch in batches:
            for row, text, g, place, _, hot in _each(batch):
                g, (first, _, more) = g[hot], placed(place[hot])
                i = 0
                while i < len(first):
                    # phrases that fit into one stretch
                    last = first + more
                    j = max(i + 1, int(np.searchsorted(last, first[i] + PIECE, "right")))
                    a = int(first[i])
                    h = Hashes(text[a : int(last[i:j].max()) + length])
                    sizes = more[i:j] + 1
                    starts = np.repeat(first[i:j] - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(int(sizes.sum()))
                    s = mix(h.of(starts - a, starts - a + length) + np.repeat(g[i:j].view(np.uint64), sizes))
                    of = pa.array(np.full(len(starts), row))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(s.view(np.int64)), batch.column(0).take(of), batch.column(1).take(of), pa.array(starts.astype(np.int32))], names=["s", "id", "tkey", "first"]
                    )
                    i = j

    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, scratch: Scratch | None = None) -> DataFrame:
    """(id, tkey, spans array<struct<first, last>>): starts of `length`-byte windows that occur at another place too.

    1. Parse: every document gives its phrases; only hashes are shuffled, dealt by ranges of (trigger, phrase, place),
       so that a passage of a third of all documents spreads over many partitions, and sorted there.
    2. A phrase beside an equal one repeats with all its windows. A trigger with one occurrence has no repeated window.
    3. Different phrases of one trigger (where a repeated passage begins, ends or differs) are the dictionary: their
       bytes are sorted by left and right context, see repeated_windows. Triggers of over FORMS phrases give the hashes
       of their windows instead, counted with a partial aggregate: the same result, without one group in one task.

    Long documents are parsed in pieces that overlap by length - 1 bytes: each window lies in one piece, and a phrase
    that is cut is only another phrase of its trigger. Phrases in step 2 and windows of hot triggers are compared by
    64-bit hashes within one trigger, itself a 64-bit hash: with n phrases of one trigger a wrong removal has a chance
    of n ** 2 / 2 ** 65. Step 3 compares bytes.
    """
    if not GRAM <= length <= 2**15:
        raise ValueError(f"length is from {GRAM} to {2**15}")
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "passages")
    kind = dict(docs.select(F.col(id_col).alias("id")).dtypes)["id"]
    read = keyed(docs, id_col, text_col)
    parsed = scratch.table(read.where(F.octet_length("text") >= length).mapInArrow(phrases(length), f"g long, x long, id {kind}, tkey long, place long"), "parse")
    order = parsed.repartitionByRange(shuffle_partitions(spark), "g", "x", "tkey", "place").sortWithinPartitions("g", "x")
    met = scratch.table(order.mapInArrow(neighbours, f"sure boolean, asked boolean, g long, id {kind}, tkey long, place long"), "met")
    scratch.drop("parse")
    scratch.release()
    asked = met.where("asked").select("g", "place", "sure", "id", "tkey")
    crowded = asked.groupBy("g").agg(F.count("*").alias("forms")).where(F.col("forms") > FORMS).select("g", F.lit(True).alias("hot"))
    any_hot = not crowded.isEmpty()
    asked = asked.join(crowded, "g", "left") if any_hot else asked.withColumn("hot", F.lit(False))
    asked = asked.select("id", "tkey", F.struct("g", "place", "sure", F.coalesce("hot", F.lit(False)).alias("hot")).alias("one"))
    asked = asked.groupBy(F.col("id").alias("kid"), F.col("tkey").alias("kkey")).agg(F.collect_list("one").alias("asked"))
    with_text = asked.join(read.dropDuplicates(["id", "tkey"]), (F.col("tkey") == F.col("kkey")) & F.col("id").eqNullSafe(F.col("kid"))).select("id", "tkey", "text", "asked")
    if any_hot:
        with_text = scratch.table(with_text, "asked")
    words = with_text.mapInArrow(dictionary(length), f"g long, id {kind}, tkey long, place long, sure boolean, phrase binary")
    spans = words.repartition(shuffle_partitions(spark), "g").sortWithinPartitions("g").mapInArrow(compared(length), f"id {kind}, tkey long, first int, last int")
    if any_hot:
        hot = with_text.where(F.exists("asked", lambda a: a["hot"])).mapInArrow(suffixes(length), f"s long, id {kind}, tkey long, first int")
        common = hot.groupBy("s").agg(F.count("*").alias("n")).where("n > 1").select("s")
        spans = spans.union(hot.join(common, "s", "left_semi").select("id", "tkey", "first", F.col("first").alias("last")))
    # Written before the last join, so that the shuffles up to here can go.
    spans = scratch.table(spans, "partly")
    scratch.release()
    first = F.shiftright("place", 32).cast("int")
    sure = met.where("sure").select("id", "tkey", first.alias("first"), (first + F.col("place").bitwiseAND(0xFFFF).cast("int")).alias("last"))
    out = scratch.table(sure.union(spans).groupBy("id", "tkey").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("spans")), "spans")
    for name in ("met", "asked", "partly"):
        scratch.drop(name)
    scratch.release()
    return out


def covered(spans: pa.Scalar, length: int, n: int) -> np.ndarray:
    """Which of n bytes lie in one of the windows that start at spans."""
    diff = np.zeros(n + 1, np.int64)
    if spans.is_valid:
        s = spans.values
        np.add.at(diff, s.field(0).to_numpy(zero_copy_only=False), 1)
        np.add.at(diff, s.field(1).to_numpy(zero_copy_only=False) + length, -1)
    return np.cumsum(diff)[:n] > 0


def cut(length: int, digest: bool):
    """For mapInArrow over (id, text, spans): (id, n_bytes, n_removed, n_spans, kept_sha256 or kept bytes)."""

    def run(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            n, removed, runs, kept = [], [], [], []
            for row in range(batch.num_rows):
                text = data[offsets[row] : offsets[row + 1]]
                gone = covered(batch.column(2)[row], length, len(text))
                n.append(len(text))
                removed.append(int(gone.sum()))
                runs.append(int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) > 0 and gone[0]))
                left = text[~gone].tobytes()
                kept.append(hashlib.sha256(left).hexdigest() if digest else left)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, removed, runs)), pa.array(kept, pa.string() if digest else pa.binary())],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return run


def drop_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, digest: bool = False, scratch: Scratch | None = None) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept or kept_sha256) of every row of docs.

    Removed is each byte of the UTF-8 text covered by a string of `length` bytes that also starts anywhere else in the
    input, in the same document too; matches never cross documents. The rest may cut a character, hence bytes.
    Null and empty texts have no bytes. Repeated rows are documents of their own and repeat each other, with one id
    too. Other columns are not used.
    """
    spans = repeated_spans(docs, id_col, text_col, length, scratch).select(F.col("id").alias("kid"), F.col("tkey").alias("kkey"), "spans")
    read = keyed(docs, id_col, text_col)
    both = read.join(spans, (F.col("tkey") == F.col("kkey")) & F.col("id").eqNullSafe(F.col("kid")), "left").select("id", "text", "spans")
    kind = dict(both.dtypes)["id"]
    name = "kept_sha256" if digest else "kept"
    out = both.mapInArrow(cut(length, digest), f"id {kind}, n_bytes long, n_removed long, n_spans long, kept {'string' if digest else 'binary'}")
    return out.withColumnsRenamed({"id": id_col, "kept": name})
