"""Best-fit packing with a swap-based local search, over counts of equal lengths."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, shuffle_partitions
from .tokens import encoder

#: Parts, at least, that one length's pieces are ranked in, so that no task ranks all pieces of a common length.
SALTS = 64
#: Bins that the local search looks at, a millisecond or two each.
TRIES = 5_000


def best_fit(counts: dict[int, int], capacity: int) -> list[list]:
    """[pattern, bins] pairs: best-fit decreasing over counts of equal sizes. A pattern is a tuple of sizes.

    Equal sizes are placed together: the open bins of least room that take a size are filled with it one after the
    other, just as best fit would item by item. Each size adds a few patterns at most, so the patterns are bounded by
    the capacity, not by the number of pieces.
    """
    open_bins: dict[int, list[list]] = defaultdict(list)
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room = min((r for r, groups in open_bins.items() if r >= size and groups), default=None)
            pattern, bins = open_bins[room].pop() if room is not None else ((), left)
            each = (capacity if room is None else room) // size
            full = min(bins, left // each)
            rest = left - full * each if full < bins and left - full * each < each else 0
            if full:
                open_bins[(capacity - sum(pattern)) - each * size].append([pattern + (size,) * each, full])
            if rest:
                open_bins[(capacity - sum(pattern)) - rest * size].append([pattern + (size,) * rest, 1])
            if room is not None and bins - full - (rest > 0) > 0:
                open_bins[room].append([pattern, bins - full - (rest > 0)])
            left -= full * each + rest
    return [g for groups in open_bins.values() for g in groups]


def _options(pattern: tuple, takes: bool) -> dict[int, tuple]:
    """What a bin can give (one or two items) or, with takes, get rid of (none, one or two), by size. A bin has at most sqrt(2 * capacity) different sizes, so these are a few hundred."""
    n = Counter(pattern)
    sizes = sorted(n)
    out = {a + b: (a, b) for i, a in enumerate(sizes) for b in sizes[i:] if a != b or n[a] > 1}
    out |= {a: (a,) for a in sizes}
    return ({0: ()} | out) if takes else out


class _Bins:
    """Underfull patterns by what they can get rid of and their room."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.there = np.zeros((capacity + 1, capacity + 1), np.int32)
        self.at: dict[tuple[int, int], dict[tuple, tuple]] = defaultdict(dict)
        self.count: Counter = Counter()

    def put(self, pattern: tuple, n: int) -> None:
        room = self.capacity - sum(pattern)
        known = pattern in self.count
        self.count[pattern] += n
        if room and known != bool(self.count[pattern]):
            for size, items in _options(pattern, True).items():
                if known:
                    del self.at[size, room][pattern]
                    self.there[size, room] -= 1
                else:
                    self.at[size, room][pattern] = items
                    self.there[size, room] += 1
        if not self.count[pattern]:
            del self.count[pattern]

    def best(self, low: tuple):
        """(fuller bin, out of low, into low) of the exchange that brings most from low to a bin at least as full within its room, or None."""
        room = self.capacity - sum(low)
        single = self.count[low] == 1
        if single:  # it is no partner of its own
            self.put(low, -1)
        widest = np.where(self.there[:, : room + 1] > 0, np.arange(room + 1), 0).max(axis=1)
        gives = _options(low, False)
        found = None
        if gives:
            size = np.array(sorted(gives))
            gain = size[:, None] - np.arange(self.capacity + 1)
            gain[(gain > widest) | (gain <= 0)] = 0
            g, h = np.unravel_index(int(gain.argmax()), gain.shape)
            if gain[g, h]:
                high, into = min(self.at[int(h), int(widest[h])].items())
                found = high, gives[int(size[g])], into
        if single:
            self.put(low, 1)
        return found


def swap_search(groups: list[list], capacity: int, tries: int = TRIES) -> list[list]:
    """Raises the sum of squared fills by moves and exchanges of one or two items from emptier to fuller bins, until the bins are as few as the total allows, no exchange is left, or `tries` bins were looked at.

    Bins of one pattern are exchanged together. Bins are gone through from the emptiest on, again and again while a
    round finds something. A look costs a table of capacity ** 2 at most, so `tries` bounds the driver's time whatever
    the input's size; every state on the way is a valid packing.
    """
    bins = _Bins(capacity)
    for pattern, n in groups:
        bins.put(tuple(sorted(pattern, reverse=True)), n)
    count = bins.count
    total = sum(sum(p) * n for p, n in count.items())
    excess = sum(count.values()) - -(-total // capacity)

    def without(p: tuple, items: tuple) -> list:
        out = list(p)
        for x in items:
            out.remove(x)
        return out

    moved = True
    while moved and excess > 0:
        moved = False
        for low in sorted((p for p in count if sum(p) < capacity), key=lambda p: (sum(p), p)):
            while low in count and excess > 0 and tries > 0:
                tries -= 1
                step = bins.best(low)
                if not step:
                    break
                high, out, into = step
                n = count[low] // 2 if low == high else min(count[low], count[high])
                bins.put(low, -n)
                bins.put(high, -n)
                a = tuple(sorted(without(low, out) + list(into), reverse=True))
                bins.put(tuple(sorted(without(high, into) + list(out), reverse=True)), n)
                if a:
                    bins.put(a, n)
                else:
                    excess -= n
                moved = True
        if tries <= 0:
            break
    return [[p, n] for p, n in sorted(count.items(), reverse=True)]


def slots(groups: list[list]) -> tuple[dict[str, np.ndarray], int]:
    """Where the k-th piece of a size goes: arrays size, rank (of the first piece), sequence (of that piece), offset, sorted by size and rank; and the number of sequences."""
    used, rows, base = Counter(), [], 0
    for pattern, n in groups:
        offset = 0
        for size in pattern:
            rows.append((size, used[size], base, offset))
            used[size] += n
            offset += size
        base += n
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return {k: table[:, i].copy() for i, k in enumerate(("size", "rank", "sequence", "offset"))}, base


def cut_pieces(tokenizer: str, end_id: int, capacity: int):
    """For mapInArrow over (id, text): (id, piece, start, length, ids_crc32). A text of over `capacity` ids is cut; its first piece takes what is left over from whole ones."""

    def run(batches):
        texts = encoder(tokenizer).texts
        for batch in batches:
            rows, cols = [], [[], [], [], []]
            for row, got in enumerate(texts(batch.column(1))):
                ids = np.append(got, np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append(row)
                    for col, v in zip(cols, (k, a, b - a, zlib.crc32(ids[a:b].tobytes()))):
                        col.append(v)
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, kinds))], names=["id", "piece", "start", "length", "ids_crc32"])

    return run


def placed(table: dict[str, np.ndarray]):
    """For mapInArrow over (id, piece, start, length, ids_crc32, rank): the same with sequence_id and offset instead of rank."""

    def run(batches):
        key = table["size"] << 44 | table["rank"]
        for batch in batches:
            rank = batch.column(5).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(key, batch.column(3).to_numpy(zero_copy_only=False) << 44 | rank, "right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(table["sequence"][at] + rank - table["rank"][at]), pa.array(table["offset"][at])], names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) for each piece of each row of docs.

    A row's ids (null text: none) and end_id are one piece, or, if over capacity, pieces of capacity ids after a first
    piece of what is left over. Pieces fill sequences of at most capacity ids without gaps. Only the counts of the
    capacity - 1 shorter lengths reach the driver, whatever the input's size; there best fit and the swap search pack
    all of them at once, and the k-th piece of a length takes its k-th place. Pieces of one length are ranked in
    parts by hash, as many as there are shuffle partitions, so no task holds them all. Repeated rows are packed each. An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "packing")
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(read.dtypes)["id"]
    shape = f"id {kind}, piece int, start long, length long, ids_crc32 long"
    cut = scratch.table(read.mapInArrow(cut_pieces(tokenizer, end_id, capacity), shape), "pieces")
    salts = max(SALTS, shuffle_partitions(spark))
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("id", "ids_crc32"), F.lit(salts)).cast("int"))
    short = salted.where(F.col("length") < capacity)
    by = scratch.table(short.groupBy("length", "salt").agg(F.count("*").alias("n")), "counts")
    counts = {r.length: r.n for r in by.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity - 1 rows at most
    table, sequences = slots(swap_search(best_fit(counts, capacity), capacity))
    before = by.select(F.col("length").alias("s_length"), F.col("salt").alias("s_salt"), F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    ranked = short.withColumn("rank", F.row_number().over(Window.partitionBy("length", "salt").orderBy("id", "piece", "ids_crc32")) - 1)
    ranked = ranked.join(before, (F.col("length") == F.col("s_length")) & (F.col("salt") == F.col("s_salt")))
    ranked = ranked.select("id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))
    fitted = ranked.mapInArrow(placed(table), f"{shape}, sequence_id long, offset long")
    whole = cut.where(F.col("length") == capacity).select("*", (F.lit(sequences) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return fitted.union(whole).withColumnRenamed("id", id_col)


def piece_ids(tokenizer: str, end_id: int, capacity: int):
    """For mapInArrow over (id, text): (id, piece, ids)."""

    def run(batches):
        texts = encoder(tokenizer).texts
        for batch in batches:
            for row, got in enumerate(texts(batch.column(1))):
                ids = np.append(got, np.uint32(end_id)).astype(np.int32)
                first = len(ids) % capacity or capacity
                parts = np.split(ids, range(first, len(ids), capacity))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([row] * len(parts))), pa.array(range(len(parts)), pa.int32()), pa.array([p.tolist() for p in parts], pa.list_(pa.int32()))], names=["id", "piece", "ids"])

    return run


def packed_sequences(docs: DataFrame, places: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(sequence_id, ids, lengths): the sequences that pack() laid out. Ids must be unique here. A group is one sequence, so capacity bounds it."""
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    ids = read.mapInArrow(piece_ids(tokenizer, end_id, capacity), f"id {dict(read.dtypes)['id']}, piece int, ids array<int>")
    at = places.select(F.col(id_col).alias("p_id"), F.col("piece").alias("p_piece"), "sequence_id", "offset")
    both = ids.join(at, F.col("id").eqNullSafe(F.col("p_id")) & (F.col("piece") == F.col("p_piece")))
    parts = both.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.transform("parts", lambda p: F.size(p["ids"])).alias("lengths"))
