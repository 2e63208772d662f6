"""Exact n-gram Jaccard self-join by vertical partitioning.

A text's set holds the 64-bit hashes of its distinct word n-grams (fewer words: the whole
sequence as one).  The global n-gram order is that of the hashes.  Equal sets count as one,
known by a signature of their members; ids are joined back at the end.

Candidates.  Two sets of sizes a and b with similarity t or more differ in at most
``h = (1 - t) / (1 + t) * (a + b)`` n-grams.  Cut the order into ``h + 1 + slack`` fragments:
then more than ``slack`` fragments agree.  Sizes fall in classes of ratio t; a set is cut
once for its own class and once for the next, as its partners are in the same or a
neighbouring class.  Sets that agree in a fragment share a key.

Fragments that many unrelated sets share give no key: each set leaves out its ``slack``
commonest fragments (those strictly commoner than the next one).  How common a fragment is
depends on its content alone: empty ones come first, then those whose rarest n-gram is the
most frequent, then the shortest.  So of two near sets the one with the lower limit leaves
out at most ``slack`` agreeing fragments, another one agrees, and the other set keeps it
too: no pair is lost, whatever the frequencies are.  They come from counts per partition,
of which the largest ``HOT_GRAMS`` are kept.

Counting.  Sets that share keys form clusters.  A cluster, in the order of set sizes, is
dealt into blocks of bounded size; blocks whose sizes are too far apart to hold a link are
never paired.  The order of n-grams is cut into ``FRAGMENTS`` parts, and every pair of blocks
and fragment is one task's group: it counts the overlaps of all pairs of sets within that
fragment.  The partial counts, one matrix a group, are then summed per pair of sets.  Only
links, as a forest, and the number of links per set leave that step, so a cluster of
thousands of near copies does not turn into a row per pair.

Each chunk of a partition gives a key once, so a key that a third of all texts share arrives as
one entry per chunk.  Keys are sent by bucket, packed, without the bits that the bucket says,
and with 32 bits of the signature; a key or signature taken for another one only adds a
candidate, which counting drops, and sets that have those 32 bits in common are candidates of
each other, so nothing is lost by it.  Texts are never shuffled as long as the hashes of those
picked are at most ``shared.AMONG_ROWS``.

Edge cases: null and empty texts have an empty set and link with nothing; ids may be of any
type that Spark can order and stand on several different texts; null ids keep their row,
their component is the least id of the others; repeated rows stay as rows; very long texts
are blocks of their own, cut into fragments; an empty table gives no rows; other columns are
not read.  Equality of 64-bit hashes stands for equality of n-grams, and of ids with
their texts, that of 64-bit signatures for equality of sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components
from tidemark.llm.shared import among, bounded_batches, col, cut, fresh, small_enough, split_join
from tidemark.llm.words import chained, hashed, mix, slices

BLOCK_SETS = 512
BLOCK_TOKENS = 400_000
#: Signatures that may be broadcast to pick the sets of clusters: 8 bytes each, so under 20 MB.
BROADCAST_SETS = 1_000_000
#: Keys gathered in a worker before they are reduced and sent.
HELD_KEYS = 1_000_000
#: Keys that one bucket gets, and the fewest buckets.
BUCKET_KEYS = 400_000
LEAST_BUCKETS = 256
#: Bytes of a key that are sent.
KEY_BYTES = 5
#: n-grams whose counts are kept and broadcast, 16 bytes each; others count as rare.
HOT_GRAMS = 200_000
#: n-grams in fewer sets of a partition are not counted.
LEAST_SETS = 4
#: n-grams gathered in a worker before they are counted.
COUNTED_GRAMS = 2_000_000
#: Parts of the global order in which overlaps are counted, each by a task of its own.
FRAGMENTS = 4
#: Cells of the incidence matrix that is multiplied at once.
CELLS = 2 << 20


def sets_of(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], np.ndarray]]:
    """Slices of the batches with their rows' sorted hash sets and signatures (0: an empty set)."""
    for batch in slices(batches):
        hashes, starts = hashed(batch.column("text"))
        windows, found = chained(hashes, n), []
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            own = windows[a : b - n + 1] if b - a >= n else chained(hashes[a:b], b - a) if b > a else windows[:0]
            found.append(np.unique(own))
        yield batch, found, np.fromiter(map(signature, found), np.int64, len(found))


def signature(found: np.ndarray) -> int:
    """A hash of a set: of its size and the sums of two mixes of its members."""
    if not len(found):
        return 0
    parts = np.array([len(found), mix(found).sum(), mix(found ^ np.uint64(0x5DEECE66D)).sum()], np.uint64)
    return int(chained(parts, 3).view(np.int64)[0]) or 1


@dataclass(frozen=True)
class Rule:
    """Word n-grams of length ``n``; sets link when 100 * overlap >= percent * union."""

    n: int
    percent: int

    def size_class(self, size: int) -> int:
        return int(math.log(size) / math.log(100 / self.percent) + 1e-9)

    def cuts(self, group: int) -> tuple[int, int]:
        """Fragments and slack for sets of a class and the one below."""
        largest = math.floor((100 / self.percent) ** (group + 1) + 1e-6)
        differ = (100 - self.percent) * 2 * largest // (100 + self.percent)
        slack = 1 + differ // 12 if self.percent >= 88 else 4 + differ // 8  # about nine n-grams a fragment, or four
        return differ + 1 + slack, slack

    def keys(self, found: np.ndarray, times: np.ndarray) -> np.ndarray:
        """The keys of a set; ``times``: how common each n-gram is."""
        size = len(found)
        if not size or (100 - self.percent) * (size + size * 100 // self.percent) < 100 + self.percent:
            return found[:0]  # no different set is near enough
        out, spread_out, own = [], mix(found), self.size_class(size)
        for group in (own, own + 1):
            parts, slack = self.cuts(group)
            part = ((found >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            starts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1])
            sums, names = np.add.reduceat(spread_out, starts), part[starts]
            spare = slack - (parts - len(starts))  # empty fragments are the commonest
            if spare >= 0:
                common = np.minimum.reduceat(times, starts) * 64 + np.maximum(0, 63 - np.diff(np.append(starts, size)))
                limit = np.partition(common, len(common) - 1 - spare)[len(common) - 1 - spare]
                sums, names = sums[common <= limit], names[common <= limit]
            else:
                empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), names)
                sums, names = np.concatenate([sums, np.zeros(len(empty), np.uint64)]), np.concatenate([names, empty])
            out.append(mix(sums + mix(names + np.uint64(group << 40))))
        return np.concatenate(out)

    def linked(self, overlap: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """``sizes``: the sum of both sets' sizes."""
        overlap, sizes = overlap.astype(np.int64), sizes.astype(np.int64)
        return (overlap * (100 + self.percent) >= self.percent * sizes) & (overlap > 0)

    def apart(self, low: Column, high: Column) -> Column:
        """Whether sets of these two sizes, the second at least as large, cannot link."""
        return low * 100 < high * self.percent


def _reduced(keys: list[np.ndarray], ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each key once with its least set, and a key of its own for every set found to share one."""
    key, own = np.concatenate(keys), np.concatenate(ids)
    order = np.lexsort((own, key))
    key, own = key[order], own[order]
    first = np.concatenate([[True], key[1:] != key[:-1]])
    least = own[np.flatnonzero(first)][np.cumsum(first) - 1]
    pairs = np.unique(np.stack([least[own != least], own[own != least]]), axis=1)
    pair = mix(mix(pairs[0].view(np.uint64)) + pairs[1].view(np.uint64))
    return np.concatenate([key[first], pair, pair]), np.concatenate([own[first], pairs[0], pairs[1]])


def _planes(numbers: np.ndarray, size: int) -> bytes:
    """The ``size`` lower bytes of 64-bit numbers, byte plane by byte plane, so that shuffles compress them."""
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def _unplaned(data: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(data) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8).reshape(size, -1).T
    return out.view("<u8").ravel()


SENT = "bucket int, keys binary, owners binary"
SHORT = np.uint64((1 << 32) - 1)


def _sent(keys: list[np.ndarray], ids: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """The reduced keys of a chunk as rows of SENT, owners by the lower half of their signature."""
    key, own = _reduced(keys, ids)
    own = own.view(np.uint64) & SHORT
    bucket = ((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    order = np.argsort((bucket << np.uint64(32)) | own)
    key, own, bucket = key[order], own[order], bucket[order]
    starts = np.flatnonzero(np.append(True, np.diff(bucket) != 0)) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(bucket))
    steps = lambda x: np.diff(x.astype(np.int64), prepend=0)
    columns = [
        pa.array(bucket[starts].astype(np.int32)),
        pa.array([_planes(key[a:b], KEY_BYTES) for a, b in zip(starts, ends, strict=True)], pa.binary()),
        pa.array([_planes(steps(own[a:b]), 4) for a, b in zip(starts, ends, strict=True)], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "keys", "owners"])


def _bucket_edges(table: pa.Table) -> pa.Table:
    """Rows (a, b): of one bucket, halves of signatures that share a key, and the least half that has it."""
    rows = table.to_pylist()
    key = np.concatenate([np.zeros(0, np.uint64), *(_unplaned(r["keys"], KEY_BYTES) for r in rows)])
    own = np.concatenate([np.zeros(0, np.uint64), *(np.cumsum(_unplaned(r["owners"], 4)) for r in rows)]).astype(np.int64)
    order = np.lexsort((own, key))
    key, own = key[order], own[order]
    first = np.append(True, key[1:] != key[:-1])[: len(key)]
    least = own[np.flatnonzero(first)][np.cumsum(first) - 1]
    some = own != least
    pairs = np.unique(np.stack([own[some], least[some]]), axis=1)
    return pa.table({"a": pairs[0], "b": pairs[1]})


def _frequent(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """n-grams in LEAST_SETS of the sets or more, and in how many they are."""
    gram, times = np.unique(np.concatenate([*parts, np.zeros(0, np.uint64)]), return_counts=True)
    return gram[times >= LEAST_SETS].view(np.int64), times[times >= LEAST_SETS]


def _candidate_edges(narrow: DataFrame, rule: Rule, hot: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows (s, hub): a set and one with which it shares a key; sets linked so are all those that share keys with each other."""
    rows = hot.groupBy("gram").agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "gram").limit(HOT_GRAMS).toArrow()
    gram, times = rows.column("gram").to_numpy().view(np.uint64), rows.column("times").to_numpy()
    order = np.argsort(gram)
    table = narrow.sparkSession.sparkContext.broadcast((gram[order], times[order]))
    grams = classes.agg(F.sum("n")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, grams * 6 * (100 - rule.percent) // (100 + rule.percent) // BUCKET_KEYS)  # at most about six keys for each n-gram that may differ

    def commonness(own: np.ndarray) -> np.ndarray:
        gram, times = table.value
        if not len(gram):
            return np.zeros(len(own), np.int64)
        at = np.minimum(np.searchsorted(gram, own), len(gram) - 1)
        return np.where(gram[at] == own, times[at], 0)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owners, held, seen = [], [], 0, {0}
        for _, found, marks in sets_of(batches, rule.n):
            for mark, own in zip(marks.tolist(), found, strict=True):
                if mark in seen:
                    continue  # a copy of a set of this chunk, or an empty one
                seen.add(mark)
                k = rule.keys(own, commonness(own))
                if len(k):
                    keys.append(k)
                    owners.append(np.full(len(k), mark, np.int64))
                    held += len(k)
            if held >= HELD_KEYS:
                yield _sent(keys, owners, buckets)
                keys, owners, held, seen = [], [], 0, {0}
        if held:
            yield _sent(keys, owners, buckets)

    edges = cut(narrow.mapInArrow(keyed, SENT).groupBy("bucket").applyInArrow(_bucket_edges, "a long, b long").distinct())
    half = F.col("s").bitwiseAND(int(SHORT))
    named = cut(classes.groupBy(half.alias("half")).agg(F.min("s").alias("hub"), F.count(F.lit(1)).alias("sets")))
    of = lambda end, name: named.select(F.col("half").alias(end), F.col("hub").alias(name))
    shared = edges.join(of("a", "s"), "a").join(of("b", "hub"), "b").select("s", "hub")
    twins = classes.select("s", half.alias("half")).join(named.where("sets > 1"), "half").where("s <> hub").select("s", "hub")
    return shared.union(twins)


def _overlaps(flat: np.ndarray, row: np.ndarray, rows: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Overlap of each set of ``a`` with each of ``b`` (row numbers) in one fragment; no sum reaches 2^24, so float32 is exact."""
    names, at, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[at] > 1
    column = np.cumsum(times > 1) - 1
    at, row = column[at[shared]], row[shared]
    total, width = int((times > 1).sum()), max(64, CELLS // max(rows, 1))
    out = np.zeros((len(a), len(b)), np.int32)
    order = np.argsort(at, kind="stable")
    at, row = at[order], row[order]
    for first in range(0, total, width):
        lo, hi = np.searchsorted(at, [first, first + width])
        part = np.zeros((rows, min(width, total - first)), np.float32)
        part[row[lo:hi], at[lo:hi] - first] = 1
        out += (part[a] @ part[b].T).astype(np.int32)
    return out


PARTIAL = "root long, low int, high int, fragment int, left binary, right binary, counts binary"


def _partial(key: tuple, table: pa.Table) -> pa.Table:
    """The overlaps of all pairs of a pair of blocks in one fragment: both blocks' signatures in order, and a matrix of counts."""
    once = np.unique(table.column("s").to_numpy(), return_index=True)[1]  # sets that several partitions had
    table = table.take(pa.array(once))
    block, sets = table.column("block").to_numpy(), table.column("part").combine_chunks()
    flat = sets.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(block)), np.diff(sets.offsets.to_numpy()))
    low, high = key[1].as_py(), key[2].as_py()
    a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
    marks = table.column("s").to_numpy()
    counts = _overlaps(flat, row, len(block), a, b)
    columns = [[k.as_py()] for k in key] + [[x.tobytes()] for x in (marks[a], marks[b], counts)]
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in PARTIAL.split(", ")])


def _summed(rule: Rule, key: tuple, partial: pa.Table, sizes: pa.Table) -> pa.Table:
    """Links of a pair of blocks from the sum of its fragments' counts: rows (s, other, links); ``other`` leads to the set's component."""
    rows = partial.to_pylist()
    a, b = (np.frombuffer(rows[0][c], np.int64) for c in ("left", "right"))
    total = np.zeros((len(a), len(b)), np.int64)
    for r in rows:
        total += np.frombuffer(r["counts"], np.int32).reshape(total.shape)
    known = sizes.column("s").to_numpy()
    order = np.argsort(known)
    at = [order[np.searchsorted(known, x, sorter=order)] for x in (a, b)]
    (na, nb), (wa, wb) = ([sizes.column(c).to_numpy()[i] for i in at] for c in ("n", "weight"))
    near = rule.linked(total, na[:, None] + nb[None, :])
    same = key[1].as_py() == key[2].as_py()
    if same:
        np.fill_diagonal(near, False)
    names, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = np.nonzero(near)
    links = np.zeros(len(names), np.int64)
    ia, ib = place[: len(a)], place[len(a) :]
    np.add.at(links, ia[x], wb[y])
    if not same:
        np.add.at(links, ib[y], wa[x])
    up = np.arange(len(names))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    for i, j in zip(ia[x].tolist(), ib[y].tolist(), strict=True):
        i, j = root(i), root(j)
        if i != j:
            up[max(i, j)] = min(i, j)
    has = np.flatnonzero(links)
    other = names[[root(i) for i in has.tolist()]] if len(has) else names[:0]
    return pa.table({"s": names[has], "other": other, "links": links[has]})


def _blocks(members: DataFrame, rule: Rule) -> DataFrame:
    """Rows (root, s, n, weight, block, low, high): ``members`` once for each pair of blocks that they are compared in.

    A block takes a run of the cluster's sizes; sets of one size that fall to several blocks
    are spread by hash.
    """
    extent = members.groupBy("root").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_TOKENS)).cast("int").alias("blocks"))
    extent = cut(extent)
    own = ["root", "s", "n", "weight", "block"]
    one = members.join(extent.where("blocks = 1").select("root"), "root").withColumn("block", F.lit(0)).select(*own, F.lit(0).alias("low"), F.lit(0).alias("high"))
    large = extent.where("blocks > 1")
    if large.isEmpty():
        return one
    rows = members.join(large, "root")
    sizes = cut(rows.groupBy("root", "n").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("grams")))
    upto = Window.partitionBy("root").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("root")
    # A set's place is the mean of its places by number and by n-grams, so that both are bounded in a block.
    place = lambda c: (F.coalesce(F.sum(c).over(upto), F.lit(0)) / F.sum(c).over(whole), F.col(c) / F.sum(c).over(whole))
    (sets, sets_in), (grams, grams_in) = place("sets"), place("grams")
    sizes = sizes.select("root", "n", ((sets + grams) / 2).alias("from"), ((sets_in + grams_in) / 2).alias("share"))
    spot = F.col("from") + F.col("share") * (F.pmod(F.xxhash64("s"), F.lit(1 << 20)) / float(1 << 20))
    blocks = F.col("blocks") * 2  # the mean lets a block hold twice what either alone would
    dealt = rows.join(sizes, ["root", "n"]).withColumn("block", F.least(blocks - 1, F.floor(spot * blocks)).cast("int")).select(*own)
    dealt = cut(dealt)
    spans = cut(dealt.groupBy("root", "block").agg(F.min("n").alias("least"), F.max("n").alias("most")))
    low = spans.select("root", F.col("block").alias("low"), F.col("most").alias("low_most"))
    high = spans.select("root", F.col("block").alias("high"), F.col("least").alias("high_least"))
    pairs = low.join(high, "root").where((F.col("low") == F.col("high")) | ((F.col("low") < F.col("high")) & ~rule.apart(F.col("low_most"), F.col("high_least"))))
    ends = cut(pairs.select("root", "low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("block")))
    return one.unionByName(dealt.join(ends, ["root", "block"]).select(*own, "low", "high"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, percent: int = 90) -> DataFrame:
    """One row per text: id, n_shingles, component_id (least linked id) and n_links (texts directly linked)."""
    found = _labelled(docs, id_col, text_col, n, percent)
    return found.select(F.col("id").alias(id_col), "n_shingles", "component_id", "n_links")


def _labelled(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> DataFrame:
    """The rows of :func:`near_duplicates` with the column ``id``, and a hash of the text, ``print``."""
    rule = Rule(n, percent)
    text = F.coalesce(col(text_col), F.lit(""))
    narrow = bounded_batches(docs).select(col(id_col).alias("id"), F.xxhash64(text).alias("print"), text.alias("text"))
    kind = narrow.schema["id"].dataType
    names = ["id", "print", "n", "s", "times"]

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, id_type = [], 0, None
        for batch, found, marks in sets_of(batches, n):
            id_type = batch.column("id").type
            held += found
            size += sum(map(len, found))
            if size >= COUNTED_GRAMS:
                yield counted(held, id_type)
                held, size = [], 0
            sizes = pa.array([len(s) for s in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("print"), sizes, pa.array(marks), pa.nulls(len(found), pa.int64())], names)
        if held:
            yield counted(held, id_type)

    def counted(held: list[np.ndarray], id_type: pa.DataType) -> pa.RecordBatch:
        """Counts of n-grams in the form of the profile's rows: n is -1, s the n-gram."""
        gram, times = _frequent(held)
        none = pa.nulls(len(gram), pa.int64())
        return pa.RecordBatch.from_arrays([pa.nulls(len(gram), id_type), none, pa.array(np.full(len(gram), -1)), pa.array(gram), pa.array(times)], names)

    schema = T.StructType([T.StructField("id", kind), *[T.StructField(c, T.LongType()) for c in names[1:]]])
    profiled = cut(narrow.mapInArrow(profile, schema))
    texts, hot = profiled.where("n >= 0").drop("times"), profiled.where("n = -1").select(F.col("s").alias("gram"), "times")
    some = texts.where("n > 0")
    classes = cut(some.groupBy("s").agg(F.max("n").alias("n"), F.min("id").alias("least"), F.min("print").alias("print"), F.count(F.lit(1)).alias("weight")))

    clusters = components(cut(_candidate_edges(narrow, rule, hot, classes)).select(F.col("s").alias("a"), F.col("hub").alias("b")))
    members = cut(clusters.withColumnRenamed("id", "s").join(classes.select("s", "n", "weight", "print"), "s"))
    compared = cut(_blocks(members.drop("print"), rule))
    wanted = members.select("print")
    if small_enough(wanted, BROADCAST_SETS):
        candidates = narrow.join(F.broadcast(wanted), "print", "left_semi")
    elif (picked := among(F.col("print"), wanted)) is not None:
        candidates = narrow.where(picked)
    else:
        candidates = narrow.join(wanted, "print", "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each set once a chunk, cut at the bounds of the fragments of the global order."""
        seen: set[int] = set()
        bounds = np.array([(f << 64) // FRAGMENTS for f in range(1, FRAGMENTS)], np.uint64)
        for _, found, marks in sets_of(batches, n):
            new = [i for i, mark in enumerate(marks.tolist()) if mark not in seen and not seen.add(mark)]
            if not new:
                continue
            flat = np.concatenate([found[i] for i in new])
            ends = np.concatenate([np.append(np.searchsorted(found[i], bounds), len(found[i])) for i in new]).reshape(-1, FRAGMENTS)
            lengths = np.diff(ends, axis=1, prepend=0)
            parts = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(lengths.ravel())]).astype(np.int32), pa.array(flat.view(np.int64)))
            order = np.tile(np.arange(FRAGMENTS, dtype=np.int32), len(new))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(marks[new], FRAGMENTS)), pa.array(order), parts], ["s", "fragment", "part"])
            if len(seen) > HELD_KEYS:
                seen = set()

    chosen = candidates.mapInArrow(sets, "s long, fragment int, part array<long>")
    groups = compared.select("root", "low", "high", "s", "block").join(chosen, "s")
    pair = ["root", "low", "high"]
    partial = groups.groupBy(*pair, "fragment").applyInArrow(_partial, PARTIAL)
    sizes = compared.select(*pair, "s", "n", "weight")
    summed = partial.groupBy(*pair).cogroup(sizes.groupBy(*pair))
    links = cut(summed.applyInArrow(lambda key, left, right: _summed(rule, key, left, right), "s long, other long, links long"))

    joined = components(links.select(F.col("s").alias("a"), F.col("other").alias("b"))).withColumnRenamed("id", "s")
    label = joined.join(classes.select("s", "least"), "s")
    label = label.join(label.groupBy("root").agg(F.min("least").alias("component")), "root").select("s", "component")
    total = links.groupBy("s").agg(F.sum("links").alias("links"))
    known = cut(classes.select("s", "least", "weight").join(label, "s", "left").join(total, "s", "left"))
    linked = split_join(some, known, "s", "weight").select(
        "id", "print", F.col("n").alias("n_shingles"), F.coalesce("component", "least", "id").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    empty = texts.where("n = 0").select("id", "print", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return linked.unionByName(empty)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without those whose component has a smaller id.

    Rows that repeat a kept id with a text of the same component all stay, as do rows with a null id.
    """
    found = _labelled(docs.select(col(id_col).alias("id"), col(text_col).alias("text")), "id", "text", n, percent)
    gone = cut(found.where("component_id < id").select("id", "print").distinct())
    text = F.xxhash64(F.coalesce(col(text_col), F.lit("")))
    listed = among(F.xxhash64(col(id_col), text), gone.select(F.xxhash64("id", "print")))
    if listed is not None:
        return docs.where(col(id_col).isNull() | ~listed)
    names = {c: fresh(docs, c) for c in ("id", "print")}
    gone = gone.select(*[F.col(c).alias(v) for c, v in names.items()])
    return docs.join(gone, (col(id_col) == F.col(names["id"])) & (text == F.col(names["print"])), "left_anti")
