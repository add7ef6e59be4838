"""N-gram Jaccard join with count vectors.

A text is the set of its 5-word shingles, hashed to 64 bits. Texts with equal sets are one class. Shingles are dealt into
``GROUPS`` groups by hash, and the counts per group are the class's point: the overlap of two sets is at most the sum of
the smaller coordinates, and 0.75 similarity needs an overlap of 3/7 of both sizes. Points are packed into tree leaves
with the largest coordinates and smallest size of their members, so a pair of leaves is bounded like a pair of points.

One tree over a whole corpus prunes nothing (its boxes overlap in so many dimensions), so trees are built over exact
groups: two sets that are similar enough share a shingle among the first quarter of each in one fixed order (rare
ones first), and each such shingle has a tree over the classes that hold it.

1. Classes, sizes and points of all texts, and the counts of all shingles in a sketch of fixed size, which makes the order: a
   shingle in a fuller cell comes later, whatever the size of the corpus. Any fixed order gives the same links.
2. Shingles that stand in the first quarter of more than one text, and the classes there.
3. Every class of such a group is compared with one of its members: close groups, like thousands of near copies, become one
   component without comparing all their pairs.
4. What is left are pairs of different components in one group, and of groups with the same classes one is enough. Trees rule out
   most classes; those that remain get finer points and meet again, and only the pairs that these allow leave the group and are
   verified. Groups of more than ``TILE`` classes are split into tiles, and pairs of tiles are tasks of their own.

Every pair that may be similar is either verified or inside one component already, so no link is lost. Sets are only
gathered for classes with a surviving pair.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .graph import components
from .tables import held, partitions, small_batches, table

SIZE = 5
GROUPS = 128
CELL_BITS = 22  # of a shingle's hash: the cell in which it is counted
BLOCK = 1 << 16  # cells that are summed together
TILE = 1024
LEAF = 32
LEADS = 4  # members that a group of classes is compared with, if its shingles are shared by all
FILTER_BITS = 26
FINE_BITS = 11
FINE = 1 << FINE_BITS
MIXERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class Hashes(dict):
    """Word to 64-bit hash, kept for words seen before."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


class Shingler:
    """Texts to sorted distinct shingle hashes."""

    def __init__(self, size: int = SIZE):
        self.size, self.known = size, Hashes()

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII blanks only
        if len(words) < self.size:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64) if words else np.zeros(0, np.uint64)
        h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        n = len(h) - self.size + 1
        s = h[:n] * MIXERS[0]
        for j in range(1, self.size):
            s += h[j : j + n] * MIXERS[j]
        s ^= s >> np.uint64(33)
        s *= np.uint64(0xFF51AFD7ED558CCD)
        s ^= s >> np.uint64(33)
        s.sort()
        return s if n < 2 or (s[1:] != s[:-1]).all() else s[np.concatenate([[True], s[1:] != s[:-1]])]


def class_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def point(shingles: np.ndarray) -> bytes:
    """Counts per group as 16-bit numbers; all at their largest, which bounds nothing, where one does not fit."""
    counts = np.bincount((shingles >> np.uint64(57)).astype(np.int64), minlength=GROUPS)
    return (counts if counts.max() < 65535 else np.full(GROUPS, 65535)).astype("<u2").tobytes()


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """(id, th, n, cls, point) per row of (id, t, th); cls is null without words. Then, per task, its counts of shingles by
    cell: rows with block and cells."""

    def rows_of(batch, sets):
        n, empty = pa.array([len(s) for s in sets], pa.int64()), [None] * len(sets)
        return pa.RecordBatch.from_arrays([
            batch["id"], batch["th"], n, pa.array([class_of(s) if len(s) else None for s in sets], pa.int64()),
            pa.array([point(s) if len(s) else None for s in sets], pa.binary()), pa.array(empty, pa.int32()), pa.array(empty, pa.binary())], names=names)

    names = ["id", "th", "n", "cls", "point", "block", "cells"]
    kind = docs.schema["id"].dataType.simpleString()

    def sign(batches):
        shingler, cells, id_type = Shingler(), np.zeros(1 << CELL_BITS, np.int64), None
        for batch in batches:
            id_type = batch.schema.field("id").type
            sets = [shingler(t) for t in batch["t"].to_pylist()]
            cells += np.bincount((np.concatenate([np.zeros(0, np.uint64), *sets]) >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=len(cells))
            yield rows_of(batch, sets)
        for block in range(0, len(cells) if id_type is not None else 0, BLOCK):
            own = cells[block : block + BLOCK]
            if own.any():
                yield pa.RecordBatch.from_arrays([
                    pa.nulls(1, id_type), *(pa.nulls(1, pa.int64()) for _ in range(3)), pa.nulls(1, pa.binary()), pa.array([block // BLOCK], pa.int32()),
                    pa.array([pa.compress(own.astype("<i8").tobytes(), "zstd", asbytes=True)], pa.binary())], names=names)

    return docs.mapInArrow(sign, f"id {kind}, th bigint, n bigint, cls bigint, point binary, block int, cells binary")


def frequency_levels(blocks: DataFrame) -> np.ndarray:
    """By cell how full it is, on a scale of eighths of a doubling; one byte per cell, however large the corpus is."""

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(pa.decompress(x.as_buffer(), BLOCK * 8, "zstd"), "<i8") for x in group["cells"])
        return pa.table({"block": group["block"].slice(0, 1), "cells": pa.array([np.minimum(8 * np.log2(total + 1), 255).astype(np.uint8).tobytes()], pa.binary())})

    level = np.zeros(1 << CELL_BITS, np.uint8)
    for r in blocks.select("block", "cells").groupBy("block").applyInArrow(add, "block int, cells binary").collect():
        level[r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(r.cells, np.uint8)
    return level


def in_filter(words: np.ndarray | None, values: np.ndarray) -> np.ndarray:
    """Whether the filter may hold the values (64-bit hashes)."""
    if words is None:
        return np.ones(len(values), bool)
    cell = values.astype(np.uint64) & np.uint64((1 << FILTER_BITS) - 1)
    return (words[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63))) & np.uint64(1) == 1


def hash_filter(values: DataFrame, name: str) -> np.ndarray:
    """One bit per residue of the values: 8 MB however many there are. Other values that pass are sorted out by joins."""
    cell = F.col(name).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    bit = F.expr(f"shiftleft(1L, cast(`{name}` & 63 as int))")
    got = values.select(F.shiftright(cell, 6).alias("at"), bit.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    words[got["at"].to_numpy()] = got["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return words


def first_quarters(docs: DataFrame, level: np.ndarray, wanted: np.ndarray | None = None) -> DataFrame:
    """(s, cls): the shingles among which a similar set must have one of its own first ones; once per class and batch."""

    def emit(batches) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            seen, keys, classes = set(), [], []
            for text in batch["t"].to_pylist():
                s = shingler(text)
                n = len(s)
                if not n or (c := class_of(s)) in seen:
                    continue
                seen.add(c)
                s = s[np.argsort(level[(s >> np.uint64(64 - CELL_BITS)).astype(np.int64)], kind="stable")]
                s = s[: n - (3 * n + 3) // 4 + 1]
                s = s[in_filter(wanted, s)]
                keys.append(signed(s))
                classes.append(np.full(len(s), c, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(classes))], names=["s", "cls"])

    return docs.mapInArrow(emit, "s bigint, cls bigint")


def in_pairs(pairs: DataFrame) -> DataFrame:
    """(cls): the classes that stand in the pairs (a, b)."""
    return pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()


def per_class(docs: DataFrame, wanted: DataFrame, classes: DataFrame, value: Callable[[np.ndarray], bytes], name: str) -> DataFrame:
    """(cls, name) of the wanted classes, one row per class: the value of its shingles. Only texts with the hash of a wanted class are shingled."""
    texts = hash_filter(classes.join(wanted, "cls", "left_semi").select("th"), "th")

    def emit(batches):
        shingler, seen = Shingler(), set()
        for batch in batches:
            found, values = [], []
            at = np.flatnonzero(in_filter(texts, batch["th"].to_numpy()))
            for th, text in zip(batch["th"].take(pa.array(at)).to_pylist(), batch["t"].take(pa.array(at)).to_pylist()):
                if th in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(th)
                s = shingler(text)
                if len(s):
                    found.append(class_of(s))
                    values.append(value(s))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(values, pa.binary())], names=["cls", name])

    found = docs.mapInArrow(emit, f"cls bigint, {name} binary").join(wanted, "cls", "left_semi")
    return found.groupBy("cls").agg(F.first(name).alias(name))


def shingle_sets(docs: DataFrame, pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, shingles) of the classes in the pairs (a, b), one row per class."""
    return per_class(docs, in_pairs(pairs), classes, np.ndarray.tobytes, "shingles")


def may_link(overlap: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Whether an overlap of at most this many shingles can make 0.75: 7 * overlap >= 3 * (a + b)."""
    return 7 * overlap >= 3 * (size_a + size_b)


def bounded(pairs: DataFrame, classes: DataFrame, groups: int = GROUPS, kind: str = "<u2") -> DataFrame:
    """The pairs (a, b) whose points, of so many groups, allow a link."""
    a = classes.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("point").alias("pa"))
    b = classes.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("point").alias("pb"))

    def bound(batches):
        for batch in batches:
            p, q = (np.frombuffer(b"".join(batch[c].to_pylist()), kind).reshape(-1, groups) for c in ("pa", "pb"))
            ok = may_link(np.minimum(p, q).sum(axis=1, dtype=np.int64), batch["na"].to_numpy(), batch["nb"].to_numpy())
            ok |= (p[:, 0] == np.iinfo(kind).max) & (q[:, 0] == np.iinfo(kind).max)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return pairs.join(b, "b").join(a, "a").select("a", "b", "na", "nb", "pa", "pb").mapInArrow(bound, "a bigint, b bigint")


def fine_point(shingles: np.ndarray) -> bytes:
    """Counts per one of ``FINE`` groups as bytes, which tell long texts apart; all at 255, which bounds nothing, where one does not fit."""
    counts = np.bincount((shingles >> np.uint64(64 - FINE_BITS)).astype(np.int64), minlength=FINE)
    return (counts if counts.max() < 255 else np.full(FINE, 255)).astype(np.uint8).tobytes()


def fine_points(sets: DataFrame) -> DataFrame:
    """(cls, n, point) with fine points."""

    def count(batches):
        for batch in batches:
            each = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch["shingles"]]
            points = [fine_point(s) for s in each]
            yield pa.RecordBatch.from_arrays([batch["cls"], pa.array([len(s) for s in each], pa.int64()), pa.array(points, pa.binary())], names=["cls", "n", "point"])

    return sets.mapInArrow(count, "cls bigint, n bigint, point binary")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link: 100 * intersection >= 75 * union."""
    a = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb"))

    def verify(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch["sa"], batch["sb"]):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = int((y[at] == x).sum())
                keep.append(100 * both >= 75 * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(b, "b").join(a, "a").select("a", "b", "sa", "sb").mapInArrow(verify, "a bigint, b bigint")


def tree_pairs(n: np.ndarray, points: np.ndarray, comp: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (i, j) of different components that the bounds allow; only pairs across the sides if there are two."""
    order = np.lexsort((n, comp, side))
    n, points, comp, side = n[order], points[order].astype(np.int64), comp[order], side[order]
    points[points == 65535] = 1 << 40
    starts = np.arange(0, len(n), LEAF)
    box = np.maximum.reduceat(points, starts)
    least, most = np.minimum.reduceat(n, starts), np.maximum.reduceat(n, starts)
    low, high = np.minimum.reduceat(comp, starts), np.maximum.reduceat(comp, starts)
    two = side[0] != side[-1]
    for i, a in enumerate(starts):
        rest = slice(i, None)
        ok = may_link(np.minimum(box[rest], box[i]).sum(axis=1), least[rest], least[i])
        ok &= (4 * most[rest] >= 3 * least[i]) & (4 * most[i] >= 3 * least[rest])
        ok &= ~((low[rest] == high[rest]) & (low[i] == high[i]) & (low[rest] == low[i]))
        for j in np.flatnonzero(ok) + i:
            b = starts[j]
            x, y = slice(a, a + LEAF), slice(b, b + LEAF)
            pair = may_link(np.minimum(points[x, None], points[None, y]).sum(axis=2), n[x, None], n[None, y]) & (comp[x, None] != comp[None, y])
            if two:
                pair &= side[x, None] != side[None, y]
            p, q = np.nonzero(pair)
            p, q = p + a, q + b
            keep = p < q
            if keep.any():
                yield order[p[keep]], order[q[keep]]


def mixed_groups(groups: DataFrame) -> DataFrame:
    """(s, size) of the groups (s, cls, comp) that may hold pairs of different components; of groups with the same classes, one.

    Groups of two have no pair left: one of the two was the member that the other was compared with.
    """
    same = ["size", "least", "most", "mix"]
    members = [F.count("*").alias("size"), F.min("cls").alias("least"), F.max("cls").alias("most"), F.bit_xor(F.xxhash64("cls")).alias("mix")]
    mixed = groups.groupBy("s").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), *members).where("lo < hi and size > 2")
    return mixed.groupBy(*same).agg(F.min("s").alias("s")).select("s", "size")


BY = ("s", "t1", "t2")  # a group, or a pair of its tiles
MARKS = [f"m{k}" for k in range(8)]  # of a class: its smallest group of each kind of groups
MEMBER = "s bigint, t1 int, t2 int, tile int, cls bigint, comp bigint, n bigint, " + "".join(f"{m} bigint, " for m in MARKS)
Pairs = Iterator[tuple[np.ndarray, np.ndarray]]


def tiled(groups: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows (s, cls, comp) of groups that may hold pairs, once for each pair of tiles in which they stand, with n, marks and point."""
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    rows = held(groups.join(mixed_groups(groups).select("s", tiles.alias("tiles")), "s"), "mixed")
    kind = F.pmod(F.xxhash64("s"), F.lit(len(MARKS)))
    marks = rows.groupBy("cls").agg(*[F.min(F.when(kind == k, F.col("s"))).alias(m) for k, m in enumerate(MARKS)])
    marks = marks.select("cls", *[F.coalesce(m, F.lit((1 << 63) - 1)).alias(m) for m in MARKS])
    rows = rows.join(marks.join(classes.select("cls", "n", "point"), "cls"), "cls")
    tile = F.pmod(F.xxhash64("cls"), F.col("tiles")).cast("int")
    # Each tile meets itself and every other one; a pair of tiles is named by both.
    rows = rows.withColumn("tile", tile).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.withColumn("t1", F.least("tile", "other")).withColumn("t2", F.greatest("tile", "other"))
    return rows.select(*BY, "tile", "cls", "comp", "n", *MARKS, "point")


def meeting(rows: DataFrame, found: Callable[[pa.Table, Pairs], pa.Table], schema: str) -> DataFrame:
    """found(rows of some whole groups, their pairs of row numbers that trees over the points allow), for all rows of tiled.

    Near copies share many groups. Classes with a common mark meet in that group too, so groups after it leave their pair to
    it; nothing comes before the first group that two classes share, so there they are paired.
    """

    def join(batches):
        rest = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = pa.concat_tables([rest, now]).combine_chunks() if rest is not None else now
            key = [now[c].to_numpy() for c in BY]
            new = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in key])) + 1
            cut = int(new[-1]) if len(new) else 0  # the last group may go on in the next batch
            if cut:
                yield from found(now.slice(0, cut), pairs_of(now.slice(0, cut), np.concatenate([[0], new]))).to_batches()
            rest = now.slice(cut)
        if rest is not None and rest.num_rows:
            yield from found(rest, pairs_of(rest, np.array([0, rest.num_rows]))).to_batches()

    def pairs_of(table: pa.Table, edges: np.ndarray) -> Pairs:
        s, marks = table["s"].to_numpy(), np.stack([table[m].to_numpy() for m in MARKS], axis=1)
        for i, j in allowed(table, edges):
            for at in range(0, len(i), 8192):
                p, q = i[at : at + 8192], j[at : at + 8192]
                here = ~((marks[p] == marks[q]) & (marks[p] < s[p, None])).any(axis=1)
                yield p[here], q[here]

    def allowed(table: pa.Table, edges: np.ndarray) -> Pairs:
        comp, n, tile = (table[c].to_numpy() for c in ("comp", "n", "tile"))
        points = np.frombuffer(b"".join(table["point"].to_pylist()), "<u2").reshape(-1, GROUPS)
        small = np.zeros(table.num_rows, np.int64)  # number of the group, for groups of at most a leaf
        for g, (x, y) in enumerate(zip(edges[:-1], edges[1:]), 1):
            if y - x <= LEAF:
                small[x:y] = g
                continue
            for i, j in tree_pairs(n[x:y], points[x:y], comp[x:y], tile[x:y]):
                yield i + x, j + x
        for step in range(1, LEAF):  # groups of one leaf: all at once, each row with the step-th row after it
            i = np.flatnonzero((small[:-step] > 0) & (small[:-step] == small[step:]) & (comp[:-step] != comp[step:]))
            if not (small[:-step] == small[step:])[small[:-step] > 0].any():
                break
            for at in range(0, len(i), 8192):
                p, q = i[at : at + 8192], i[at : at + 8192] + step
                ok = may_link(np.minimum(points[p], points[q]).sum(axis=1, dtype=np.int64), n[p], n[q])
                ok |= (points[p, 0] == 65535) & (points[q, 0] == 65535)
                yield p[ok], q[ok]

    return rows.repartition(partitions(rows.sparkSession), *BY).sortWithinPartitions(*BY).mapInArrow(join, schema)


def with_partner(groups: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``tiled`` that the points allow a pair with another row of their group: at most as many as came in."""

    def rows_of(table: pa.Table, pairs: Pairs) -> pa.Table:
        used = np.zeros(table.num_rows, bool)
        for i, j in pairs:
            used[i] = used[j] = True
        return table.filter(pa.array(used))

    return meeting(tiled(groups, classes), rows_of, MEMBER + "point binary")


def left_over(partners: DataFrame, fine: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components in a group that the points of the rows and the fine points (cls, fine) allow."""

    def rows_of(table: pa.Table, pairs: Pairs) -> pa.Table:
        cls, n = table["cls"].to_numpy(), table["n"].to_numpy()
        points = np.frombuffer(b"".join(table["fine"].to_pylist()), np.uint8).reshape(-1, FINE)
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for p, q in pairs:
            for at in range(0, len(p), 1024):
                i, j = p[at : at + 1024], q[at : at + 1024]
                ok = may_link(np.minimum(points[i], points[j]).sum(axis=1, dtype=np.int64), n[i], n[j])
                ok |= (points[i, 0] == 255) & (points[j, 0] == 255)
                a.append(cls[i[ok]]), b.append(cls[j[ok]])
        a, b = np.concatenate(a), np.concatenate(b)
        pair = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pa.table([pair[:, 0], pair[:, 1]], names=["a", "b"])

    return meeting(partners.join(fine, "cls").select(*partners.columns, "fine"), rows_of, "a bigint, b bigint").distinct()


def similar(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, n_shingles and component_id, the smallest key that links reach (its own without words or links).

    A null text counts as empty. A null key is never a component's name unless all keys of the component are null.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("t"), F.xxhash64(F.col(text)).alias("th"))
    signed_rows = held(signatures(rows), "signatures")
    level = frequency_levels(signed_rows.where("block is not null"))
    signed_rows = signed_rows.where("block is null")
    classes = signed_rows.where("cls is not null").groupBy("cls").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("point").alias("point"), F.min("th").alias("th"))
    classes = held(classes, "classes")

    shared = held(first_quarters(rows, level).groupBy("s").agg(F.count("*").alias("k")).where("k > 1").select("s"), "shared")
    groups = first_quarters(rows, level, hash_filter(shared, "s")).join(shared, "s", "left_semi")
    groups = held(groups.distinct(), "groups")

    # One member per shingle: the smallest under one of LEADS masks, chosen by the shingle, so that groups of much the same
    # classes share their members and a class has few of them.
    mask = F.xxhash64(F.pmod("s", F.lit(LEADS)))
    lead = groups.withColumn("mask", mask).groupBy("s", "mask").agg(F.min(F.expr("cls ^ mask")).alias("m")).select("s", F.expr("m ^ mask").alias("b0"))
    stars = groups.join(lead, "s").where("cls <> b0").select(F.least("cls", "b0").alias("a"), F.greatest("cls", "b0").alias("b")).distinct()
    stars = held(bounded(stars, classes), "stars")
    sets = held(shingle_sets(rows, stars, classes), "sets")
    links = held(verified(held(bounded(stars, fine_points(sets), FINE, "u1"), "pairs"), sets), "links")
    comps = components(links)
    grouped = groups.join(comps.withColumnRenamed("id", "cls"), "cls", "left").select("s", "cls", F.coalesce("component", "cls").alias("comp"))
    partners = held(with_partner(grouped, classes), "partners")
    if not partners.isEmpty():
        fine = per_class(rows, partners.select("cls").distinct(), classes, fine_point, "fine")
        rest = held(left_over(partners, fine), "rest")
        more = verified(rest, held(shingle_sets(rows, rest, classes), "sets"))
        comps = components(links.union(held(more, "links")))

    named = classes.select("cls", "id").join(comps.withColumnRenamed("id", "cls"), "cls", "left").withColumn("comp", F.coalesce("component", "cls"))
    smallest = named.groupBy("comp").agg(F.min("id").alias("smallest"))
    named = held(named.join(smallest, "comp").select("cls", F.col("smallest")), "names")
    out = signed_rows.select("id", "n", "cls").join(named, "cls", "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("smallest")).alias("component_id"))


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar(table(spark, folder, "documents"))


def near_copies_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id; of rows that share it, one.

    Documents without words are in no group and stay, and so do rows without a doc_id.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    k = names[docs.columns.index("doc_id")]
    t = names[docs.columns.index("text")]
    found = similar(docs).where("component_id = doc_id").select(F.col("doc_id").alias("k")).distinct()
    rows = docs.toDF(*names)
    kept = rows.join(found, rows[k] == found["k"], "left_semi")
    first = F.row_number().over(Window.partitionBy(k).orderBy(t))
    kept = kept.withColumn("first", first).where("first = 1").drop("first")
    return kept.unionByName(rows.where(F.col(k).isNull())).toDF(*docs.columns)
