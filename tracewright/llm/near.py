"""MinHash near-duplicate search: universal hash minima, banding, signature check, exact check, connected components."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytesx import FOLDED, WORD, buffers, mix, runs, segment_hashes, slices
from .common import Scratch
from .graph import components

#: Chance that a pair exactly at the threshold shares one band's rows: few false companions, and not too many bands.
SHARED = 0.27
#: Chance that a pair exactly at the threshold shares no band.
MISS = 1e-6
#: Members of a bucket that are held against all others of the bucket in one round; the rest wait for the next round.
BLOCK = 1024
#: Likely partners by agreement that an asked row is verified with in one round; where more are left, the next round takes the next figure.
PARTNERS = (4, 64, 2**31 - 1)
#: Members of a bucket that meet in one task; a larger bucket is dealt to several, each of which has the block.
DEALT = 1000
#: Bits of a set's parity sketch.
PARITY = 1024
#: Elements of a set whose minima are taken at a time.
CHUNK = 4096


def rows_for(num: int, den: int) -> int:
    return max(1, round(math.log(SHARED) / math.log(min(num / den, 0.999))))


def bands_for(num: int, den: int, rows: int) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - min(num / den, 0.999) ** rows))


def shingle_sets(column: pa.Array, words: int):
    """The distinct word shingles of each text as sorted 64-bit hashes, in order of the rows.

    Words are [^\\x20\\x09-\\x0D]+ with A-Z lower-cased. A text of fewer words is one shingle; one without words, or null, has none.
    """
    data, offsets = buffers(column)
    for i, j in slices(offsets):
        at = offsets[i : j + 1] - offsets[i]
        text = data[offsets[i] : offsets[j]]
        starts, ends = runs(WORD[text], at)
        each = segment_hashes(FOLDED[text], starts, ends)
        first = np.searchsorted(starts, at)
        n = len(each)
        grams = np.zeros(n, np.uint64)
        for k in range(words):
            grams[: n - k] = grams[: n - k] * np.uint64(0xA24BAED4963EE407) + each[k:] if k < n else grams[: n - k]
        grams = mix(grams)
        for d in range(j - i):
            a, b = int(first[d]), int(first[d + 1])
            if b - a >= words:
                yield np.unique(grams[a : b - words + 1])
            elif b > a:
                h = b - a
                for w in each[a:b].tolist():
                    h = (h * 0x9FB21C651E98DF25 + w) % 2**64
                yield mix(np.array([h], np.uint64))
            else:
                yield each[:0]


class Minima:
    """Minima of universal hash functions (a * x + b) mod 2 ** 32, a odd, over a set of well-mixed integers."""

    def __init__(self, k: int):
        rng = np.random.Generator(np.random.PCG64(7_919))
        self.a = (rng.integers(0, 2**31, k, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.b = rng.integers(0, 2**32, k, dtype=np.uint32)[:, None]

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out = None
        for i in range(0, len(hashes), CHUNK):
            x = (hashes[i : i + CHUNK] >> np.uint64(32)).astype(np.uint32)
            least = (x[None, :] * self.a + self.b).min(axis=1)
            out = least if out is None else np.minimum(out, least)
        return out


def packed(sig: np.ndarray) -> np.ndarray:
    """The lowest 4 bits of each value, two to a byte; an odd last one has a byte of its own."""
    low = (sig & np.uint32(15)).astype(np.uint8)
    if low.shape[1] % 2:
        low = np.pad(low, ((0, 0), (0, 1)))
    return low[:, ::2] | low[:, 1::2] << 4


def parities(s: np.ndarray) -> np.ndarray:
    """For each of PARITY cells, whether it has an odd number of the set's elements. Two sets' sketches differ in no more bits than the sets have elements of their own."""
    return np.packbits(np.bincount((s & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY).astype(np.uint8) & 1)


class Signatures:
    """A column of signatures: n, the set's size; bits, its parity sketch; low, 4 bits of each of k minima."""

    def __init__(self, column: pa.Array, k: int):
        raw = buffers(column)[0].reshape(len(column), -1)
        self.n = np.ascontiguousarray(raw[:, :8]).view(np.int64)[:, 0]
        self.bits = np.ascontiguousarray(raw[:, 8 : 8 + PARITY // 8]).view(np.uint64)
        low = raw[:, 8 + PARITY // 8 :]
        self.low = np.stack([low & 15, low >> 4], axis=2).reshape(len(column), -1)[:, :k]


def possible(n_a, n_b, bits_a: np.ndarray, bits_b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether sets may be linked by their sizes and parity sketches; where not, they surely are not: den * intersection >= num * union means that at most (den - num) / (den + num) of n_a + n_b elements are in one set only."""
    apart = np.maximum(np.bitwise_count(bits_a ^ bits_b).sum(axis=1, dtype=np.int64), np.abs(n_a - n_b))
    return (den + num) * apart <= (den - num) * (n_a + n_b)


def least_agreement(threshold: float, k: int) -> float:
    """Of k minima, those that a pair at the threshold has in common but for five standard errors, so that hardly a true link is lost."""
    return (threshold - 5 * math.sqrt(threshold * (1 - threshold) / k)) * k


SIGNED = "n_shingles long, fp1 long, fp2 long, keys array<long>, sig binary"


def signer(words: int, rows: int, bands: int):
    """For mapInArrow over (id, text): (id, n_shingles, fp1, fp2, keys, sig). fp1 and fp2 are a 128-bit mark of the set; keys has one bucket for each band; sig has the set's size, its parity sketch and 4 bits of each minimum."""

    def run(batches):
        minima = Minima(rows * bands)
        weights = mix(np.arange(1, rows + 1, dtype=np.uint64))
        salt = mix(np.arange(1000, 1000 + bands, dtype=np.uint64))
        for batch in batches:
            n, fp1, fp2, sigs, bits = [], [], [], [], []
            for s in shingle_sets(batch.column(1), words):
                n.append(len(s))
                bits.append(parities(s))
                fp1.append(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                fp2.append(mix(s ^ np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64))
                sigs.append(minima.of(s) if len(s) else np.zeros(rows * bands, np.uint32))
            m = len(n)
            sig = np.stack(sigs) if m else np.zeros((0, rows * bands), np.uint32)
            keys = mix((sig.reshape(m, bands, rows).astype(np.uint64) * weights).sum(axis=2, dtype=np.uint64) ^ salt)
            count = np.array(n, np.int64)
            flat = keys[count > 0].reshape(-1).view(np.int64)
            ends = np.cumsum(np.append(0, np.where(count > 0, bands, 0))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(count),
                    pa.array(np.array(fp1, np.uint64).view(np.int64)),
                    pa.array(np.array(fp2, np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    pa.array([c.tobytes() + b.tobytes() + r.tobytes() for c, b, r in zip(count, bits, packed(sig))], pa.binary()),
                ],
                names=["id", "n_shingles", "fp1", "fp2", "keys", "sig"],
            )

    return run


def agreeing(num: int, den: int, k: int):
    """For mapInArrow over (a, b, sig_a, sig_b): the pairs that may be linked and whose minima agree often enough."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = Signatures(batch.column(2), k), Signatures(batch.column(3), k)
                good = (a.low == b.low).sum(axis=1) >= least_agreement(num / den, k)
                yield batch.select([0, 1]).filter(pa.array(good & possible(a.n, b.n, a.bits, b.bits, num, den)))

    return run


def alike(num: int, den: int, k: int, limit: int):
    """For mapInArrow over (key, salt, role, id, c, sig), sorted by key, salt and role: (hub, other, score) of asked rows (role 0) and members (role 1) of a bucket in different components that may be linked and whose minima agree often enough.

    A bucket's asked rows, BLOCK at most, are held while its members stream by. Each brings its `limit` partners of
    highest agreement; where more are likely, a row (hub, hub, -1) says so.
    """

    def run(batches):
        least = least_agreement(num / den, k)
        at, ids, comps, sigs, best, cut = None, [], [], [], [], []

        def flush():
            rows = [(hub, other, score) for hub, heap in zip(ids, best) for score, _, other in heap] + [(hub, hub, -1) for hub, c in zip(ids, cut) if c]
            return [list(c) for c in zip(*rows)] if rows else [[], [], []]

        kind, count = None, 0
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            kind = batch.column(3).type
            out: list[list] = [[], [], []]
            key, salt, role, c = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 4))
            own = batch.column(3).to_pylist()
            sig = Signatures(batch.column(5), k)
            cuts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])))
            for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), m]):
                if (key[i], salt[i]) != at:
                    for col, more in zip(out, flush()):
                        col += more
                    at, ids, comps, sigs, best, cut = (key[i], salt[i]), [], [], [], [], []
                split = i + int(np.searchsorted(role[i:j], 1))
                if split > i:
                    ids += own[i:split]
                    comps += c[i:split].tolist()
                    best += [[] for _ in range(split - i)]
                    cut += [False] * (split - i)
                    mine = (sig.n[i:split], sig.bits[i:split], sig.low[i:split])
                    sigs = [np.concatenate(x) for x in zip(sigs, mine)] if sigs else list(mine)
                for x in range(split, j, 256):
                    y = min(j, x + 256)
                    for h, comp in enumerate(comps):
                        good = np.flatnonzero((c[x:y] != comp) & possible(sigs[0][h], sig.n[x:y], sigs[1][h], sig.bits[x:y], num, den))
                        score = (sig.low[x:y][good] == sigs[2][h]).sum(axis=1)
                        for g, v in zip(good[score >= least].tolist(), score[score >= least].tolist()):
                            count += 1
                            if len(best[h]) < limit:
                                heapq.heappush(best[h], (v, count, own[x + g]))
                            else:
                                heapq.heappushpop(best[h], (v, count, own[x + g]))
                                cut[h] = True
            yield scored(out, kind)
        if kind is not None:
            yield scored(flush(), kind)

    return run


def scored(cols: list[list], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (kind, kind, pa.int32()))], names=["hub", "other", "score"])


def linked(words: int, num: int, den: int):
    """For mapInArrow over (a, b, text_a, text_b): pairs with den * intersection >= num * union of the full sets."""

    def run(batches):
        last, own = None, None
        for batch in batches:
            ids, texts, keep = batch.column(0).to_pylist(), batch.column(2), []
            for row, other in enumerate(shingle_sets(batch.column(3), words)):
                if own is None or ids[row] != last:
                    last, own = ids[row], next(shingle_sets(texts.slice(row, 1), words))
                common = len(np.intersect1d(own, other, assume_unique=True))
                keep.append(bool(common) and den * common >= num * (len(own) + len(other) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80, den: int = 100, scratch: Scratch | None = None) -> DataFrame:
    """One row for each row of docs: id, n_shingles, component_id (least id that it reaches over links), kept.

    Two texts are linked when den * |A and B| >= num * |A or B| for their sets of word shingles. Texts with one set
    are one class, found by a 128-bit mark of the set; only the least id of a class goes on, so copies are never
    expanded into pairs. Classes meet in band buckets. First every class is held against two of its buckets' least
    classes: the one met in most buckets and the least of all. In the rounds that follow, of each bucket that has
    classes of several components, those outside its largest component, up to BLOCK of them, are held against all of
    the bucket in other components. Signatures are compared as a bucket's rows stream by (parity sketches bound the
    number of elements in one set only, minima estimate the similarity), so only likely pairs are made, the PARTNERS best of each row first; they are confirmed on full sets. Rounds end when every pair of a bucket
    was held together or is connected: no cap drops a pair. Joins whose both sides grow with the input are merge
    joins at every size.

    Null texts and texts without words have no shingles and are linked with nothing: component_id is their own id.
    Rows of one id are one node; repeated rows come back as often as they are in docs. A null id takes part in its
    class: component_id is the class's component, or null without another id. Other columns of docs are not used.
    The order of rows is not defined. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "near")
    kind = dict(docs.select(F.col(id_col).alias("id")).dtypes)["id"]
    rows = rows_for(num, den)
    bands = bands_for(num, den, rows)
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = scratch.table(read.mapInArrow(signer(words, rows, bands), f"id {kind}, {SIGNED}"), "signed")
    full = signed.where("n_shingles > 0 and id is not null")
    classes = scratch.table(signed.where("n_shingles > 0").groupBy("fp1", "fp2").agg(F.min("id").alias("rep")), "classes")
    members = full.select("id", "fp1", "fp2", "keys").join(classes.withColumnRenamed("rep", "id").hint("merge"), ["fp1", "fp2", "id"]).select("id", F.explode("keys").alias("key"))
    members = scratch.table(members, "members")
    buckets = members.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("top"), F.count("*").alias("n")).where("hub < top").select("key", "hub", (F.lit(1) + F.col("n") / DEALT).cast("int").alias("salts"))
    live = scratch.table(members.join(buckets.hint("merge"), "key"), "live-0")
    scratch.drop("members")
    scratch.release()
    tested = scratch.table(_first(live, full, num, den, rows * bands, kind), "pairs-0")
    live = live.drop("hub")
    edges = _verify(tested, read, words, num, den, kind, scratch, 0)
    comp = components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")), scratch, "cc0")
    k = step = 0
    block = left = None
    while True:
        k += 1
        parts = live.join(comp.select(F.col("node").alias("id"), "component").hint("merge"), "id", "left").select("key", "id", "salts", F.coalesce("component", "id").alias("c"))
        sizes = parts.groupBy("key", "c").agg(F.count("*").alias("n"))
        split = sizes.groupBy("key").agg(F.count("*").alias("parts"), F.sum("n").alias("all"), F.max(F.struct("n", "c")).alias("most")).where("parts > 1").select("key", F.col("most.c").alias("largest"), (F.col("all") - F.col("most.n")).alias("others"))
        parts = scratch.table(parts.join(split.hint("merge"), "key"), f"parts-{k}")
        most = parts.agg(F.max("others")).first()[0]
        if not most:
            break
        if step == 0:
            # All pairs of different components are held together in this round, unless a bucket has more to ask than a block.
            asked, large = parts.where("c <> largest"), most > BLOCK
            if large:
                asked = asked.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("id"))).where(F.col("rank") <= BLOCK)
            asked = block = scratch.table(asked.select("key", "id", "salts", "c"), f"asked-{k}")
            held = parts
        else:
            # Of a block's rows only those with likely partners left are asked again: any pair not yet verified has one of them.
            asked = parts.join(block.select("key", "id").hint("merge"), ["key", "id"], "left_semi").join(left.hint("merge"), "id", "left_semi")
            asked = scratch.table(asked.select("key", "id", "salts", "c"), f"again-{k}")
            held = parts.join(asked.select("key").distinct().hint("merge"), "key", "left_semi")
        met = _likely(held, asked, full, num, den, rows * bands, PARTNERS[step], kind)
        met = scratch.table(met.withColumn("rank", F.row_number().over(Window.partitionBy("hub").orderBy(F.desc("score"), "other"))), f"met-{k}")
        left = scratch.table(met.where((F.col("score") < 0) | (F.col("rank") > PARTNERS[step])).select(F.col("hub").alias("id")).distinct(), f"left-{k}")
        pairs = met.where((F.col("score") >= 0) & (F.col("rank") <= PARTNERS[step])).select(F.least("hub", "other").alias("a"), F.greatest("hub", "other").alias("b")).distinct()
        pairs = scratch.table(pairs.join(tested.hint("merge"), ["a", "b"], "left_anti"), f"pairs-{k}")
        scratch.drop(f"met-{k}")
        found = _verify(pairs, read, words, num, den, kind, scratch, k)
        edges, tested = edges.union(found), tested.union(pairs)
        if not found.isEmpty():
            comp = components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")), scratch, f"cc{k}")
        if not left.isEmpty():
            step += 1
            live = parts.select("key", "id", "salts")
        elif large:
            step = 0
            live = scratch.table(parts.select("key", "id", "salts").join(block.select("key", "id").hint("merge"), ["key", "id"], "left_anti"), f"live-{k}")
        else:
            break
        if k > 1:
            scratch.drop(f"parts-{k - 1}")
        scratch.release()
    of = classes.join(comp.select(F.col("node").alias("rep"), "component"), "rep", "left").select("fp1", "fp2", F.coalesce("component", "rep").alias("component"))
    out = signed.select("id", "n_shingles", "fp1", "fp2").join(of, ["fp1", "fp2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def _first(live: DataFrame, full: DataFrame, num: int, den: int, k: int, kind: str) -> DataFrame:
    """Likely pairs (a, b) of each class and two of its buckets' least classes, whatever the number of its buckets."""
    met = live.where("id <> hub").groupBy("id", "hub").agg(F.count("*").alias("n"))
    two = met.groupBy("id").agg(F.max(F.struct("n", "hub")).alias("most"), F.min("hub").alias("least"))
    two = two.select(F.explode(F.array_distinct(F.array("most.hub", "least"))).alias("a"), F.col("id").alias("b"))
    sigs = full.select("id", "sig")
    for side in ("a", "b"):
        two = two.join(sigs.select(F.col("id").alias(side), F.col("sig").alias(f"sig_{side}")).hint("merge"), side)
    return two.select("a", "b", "sig_a", "sig_b").mapInArrow(agreeing(num, den, k), f"a {kind}, b {kind}").distinct()


def _likely(parts: DataFrame, asked: DataFrame, full: DataFrame, num: int, den: int, k: int, limit: int, kind: str) -> DataFrame:
    """Likely (hub, other, score) of asked rows and members of their buckets. Asked rows go to each of a large bucket's tasks."""
    to = asked.select("key", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).cast("byte").alias("role"), "id", F.xxhash64("c").alias("c"))
    by = parts.select("key", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int").alias("salt"), F.lit(1).cast("byte").alias("role"), "id", F.xxhash64("c").alias("c"))
    met = to.union(by).join(full.select("id", "sig").hint("merge"), "id").select("key", "salt", "role", "id", "c", "sig")
    dealt = met.repartition("key", "salt").sortWithinPartitions("key", "salt", "role")
    return dealt.mapInArrow(alike(num, den, k, limit), f"hub {kind}, other {kind}, score int").distinct()


def _verify(pairs: DataFrame, read: DataFrame, words: int, num: int, den: int, kind: str, scratch: Scratch, k: int) -> DataFrame:
    """The pairs (a, b) that are linked by their full sets. Only texts that are in a pair are joined."""
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    texts = scratch.table(read.join(wanted, "id", "left_semi"), f"texts-{k}")
    with_b = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    full = with_b.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b")
    found = scratch.table(full.mapInArrow(linked(words, num, den), f"a {kind}, b {kind}"), f"found-{k}")
    scratch.drop(f"texts-{k}")
    scratch.release()
    return found
