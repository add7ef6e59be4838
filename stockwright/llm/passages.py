"""Repeated passages removed, by a suffix sort that compares hashes.

A window is a string of ``length`` bytes inside one text. A byte goes when a window over it also starts earlier, in a text
of smaller key or before in the same text. Equal windows must meet in one task without sending every window:

* Each window is named by one of its short grams, the least in a fixed order of grams (its anchor; the leftmost of equal
  ones). Equal windows have the same anchor at the same place. Consecutive windows with one anchor travel as one piece of
  text, to the part of the anchor's hash. The order puts grams that are frequent in the whole corpus last, so that a
  passage that stands in very many texts does not draw their different surroundings into one part; the frequencies
  only choose anchors, the result is the same with any.
* A task cuts its rows into chunks of bounded size. Of equal pieces in a chunk only the first is sent; the others are
  known to be repeats. A part does the same for equal pieces of all chunks.
* What is left in a part are different pieces around one anchor. They are sorted as suffixes that start at the anchor, and
  once more leftwards from it, by a mergesort. Two suffixes are compared by binary search for their common extension:
  prefix polynomial hashes tell in one step whether so many bytes are equal. Neighbours in the sorted order are then
  compared byte by byte; where a collision has misled the sort, it is done again with another base.
* A window with x bytes before its anchor is a repeat when an earlier piece shares x bytes to the left and the rest to
  the right. Sorted neighbours with their common lengths give both as class numbers.

The covered ranges go back to the chunk and are merged. A null text counts as empty. Keys are whole numbers; a null key
comes after all others, and rows that share a key count in the order in which they are read (of equal rows one stays,
whichever it is). Rows must come in the same order if a task runs again, as they do from files. Texts shorter than a window
stay whole.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import partitions, small_batches, table
from .words import binaries

LENGTH = 100
GRAM = 20
CHUNK = 4_000_000  # bytes; a longer text is a chunk of its own, and its windows are sent in blocks of so many
PART = 12_000_000  # bytes that a part gets, about
SLICE = 1 << 20  # positions looked at together
CELLS = 1 << 20  # counters of grams
SHARE = 2.0**-17  # of all positions: grams from here on are frequent
LAST = (1 << 63) - 1  # the order of a null key
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xAEF17502108EF2D9)
BYTE = np.random.default_rng(11).integers(1, 1 << 63, 256, np.uint64)  # a number for each byte
SENT = "part bigint, chunk bigint, key binary, doc binary, start binary, anchor binary, windows binary, data binary, n bigint, bytes bigint"
FOUND = "chunk bigint, kind int, doc binary, start binary, stop binary, data binary, n bigint"
RANGES, TEXT = 0, 1


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Grams:
    """Hashes of all grams in a stretch of bytes, equal for equal grams."""

    def __init__(self, gram: int, base: int = BASES[0]):
        self.gram, self.base = gram, base
        self.up = self.down = np.zeros(0, np.uint64)

    def __call__(self, data: np.ndarray) -> np.ndarray:
        if len(self.up) < len(data):
            self.up, self.down = powers(self.base, len(data)), powers(pow(self.base, -1, 1 << 64), len(data))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE[data] * self.up[: len(data)], dtype=np.uint64)])
        return mixed((sums[self.gram :] - sums[: -self.gram]) * self.down[: len(data) - self.gram + 1])


def packed(x: np.ndarray | bytes) -> bytes:
    return pa.compress(x if isinstance(x, bytes) else np.ascontiguousarray(x).tobytes(), "zstd", asbytes=True)


def steps(x: np.ndarray) -> bytes:
    """Numbers in order, as compressed differences."""
    return packed(np.diff(x, prepend=x.dtype.type(0)))


def numbers(data: bytes, n: int, kind, summed: bool = False) -> np.ndarray:
    out = np.frombuffer(pa.decompress(data, n * np.dtype(kind).itemsize, "zstd"), kind)
    return np.cumsum(out, dtype=kind) if summed else out


def chunks(batches, size: int) -> Iterator[tuple[int, list, list[bytes]]]:
    """(chunk, keys, texts) of consecutive rows, sorted by key; the chunk's number has its partition in it."""
    number, keys, texts, held = -1, [], [], 0

    def cut():
        order = sorted(range(len(keys)), key=lambda i: (keys[i] is None, keys[i]))
        return number, [keys[i] for i in order], [texts[i] for i in order]

    for batch in batches:
        if number < 0 and batch.num_rows:
            number = batch["__part"][0].as_py() << 24
        for key, raw in zip(batch["k"].to_pylist(), batch["t"]):
            text = raw.as_py() or b""
            if held and held + len(text) > size:
                yield cut()
                number, keys, texts, held = number + 1, [], [], 0
            keys.append(key)
            texts.append(text)
            held += len(text) + 1
    if keys:
        yield cut()


def stretches(data: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first window, bytes of the windows) over the whole chunk, in slices."""
    room = SLICE - length
    for a in range(0, max(len(data) - length + 1, 0), room):
        yield a, data[a : a + room + length - 1]


def gram_cells(rows: DataFrame, length: int, gram: int, chunk: int) -> tuple[np.ndarray, int]:
    """By cell the class of frequency of its grams, 0 to 7, and the bytes of all texts.

    A chunk reports the cells that hold their share in it, or more; so a count comes out short by that share at most.
    """

    def count(batches):
        grams = Grams(gram)
        for _, _, texts in chunks(batches, chunk):
            data = np.frombuffer(b"".join(texts), np.uint8)
            cells = np.zeros(CELLS, np.int64)
            for _, own in stretches(data, length):
                cells += np.bincount(grams(own) >> np.uint64(44), minlength=CELLS)
            at = np.flatnonzero(cells >= max(4, int(len(data) * SHARE * 2)))
            columns = [np.append(at, -1), np.append(cells[at], len(data))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cell", "n"])

    found = rows.mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # CELLS rows at most
    total = sum(r.n for r in found if r.cell < 0)
    level = np.zeros(CELLS, np.uint8)
    for r in found:
        if r.cell >= 0:
            level[r.cell] = min(7, max(0, 1 + int(np.log2(max(r.n / (total * SHARE), 0.5)))))
    return level, total


def pieces(data: np.ndarray, ends: np.ndarray, level: np.ndarray, grams: Grams, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(first window, last window, anchor, anchor's hash) of the pieces of a chunk, slice by slice."""
    span = length - grams.gram + 1
    for at, own in stretches(data, length):
        names = grams(own)
        least = (level[names >> np.uint64(44)].astype(np.uint64) << np.uint64(61)) | (names >> np.uint64(23) << np.uint64(20)) | np.arange(len(names), dtype=np.uint64)
        wide = 1
        while wide * 2 <= span:
            least, wide = np.minimum(least[:-wide], least[wide:]), wide * 2
        if wide < span:
            least = np.minimum(least[: wide - span], least[span - wide :])
        anchor = (least & np.uint64(SLICE - 1)).astype(np.int64)
        n = len(own) - length + 1
        windows = np.arange(at, at + n)
        fits = windows + length <= ends[np.searchsorted(ends, windows, "right")]
        new = np.ones(n + 1, bool)
        new[1:-1] = (anchor[1:n] != anchor[: n - 1]) | (fits[1:] != fits[:-1])
        cut = np.flatnonzero(new)
        first, last = cut[:-1], cut[1:] - 1
        ok = fits[first]
        first, last = first[ok], last[ok]
        yield first + at, last + at, anchor[first] + at, names[anchor[first]]


def explode(rows: DataFrame, level: np.ndarray, parts: int, length: int, gram: int, chunk: int) -> DataFrame:
    """The rows of SENT: the different pieces of each chunk by part, and a chunk's own repeats as a part below 0 of its own."""

    def row(part, number, found, keys, firsts, data, total):
        doc, first, last, anchor = found
        text = b"".join(data[a : b + length] for a, b in zip(first.tolist(), last.tolist())) if part >= 0 else b""
        return (part, number, steps(keys[doc]), steps(doc), steps(first - firsts[doc]), packed((anchor - first).astype(np.uint16)), packed((last - first + 1).astype(np.uint32)),
                packed(text), len(doc), len(text) if part >= 0 else total)

    def batch_of(out):
        types = [pa.int64(), pa.int64(), *[pa.binary()] * 6, pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[f.split()[0] for f in SENT.split(", ")])

    def cut(batches):
        grams = Grams(gram)
        for number, keys, texts in chunks(batches, chunk):
            data = b"".join(texts)
            ends = np.cumsum([len(t) for t in texts])
            firsts, keys = ends - [len(t) for t in texts], np.array([LAST if k is None else k for k in keys], np.int64)
            block, known, seen = [], {}, 0

            def flush():
                doc, first, last, anchor, name, new = (np.concatenate(c) for c in zip(*block))
                own = (doc, first, last, anchor)
                again = np.flatnonzero(~new)
                out = [row(-1 - number, number, [c[again] for c in own], keys, firsts, data, len(data))]
                new = np.flatnonzero(new)
                part = (name[new] % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                edges = np.flatnonzero(np.diff(part[order], prepend=-1, append=parts))
                for a, b in zip(edges[:-1], edges[1:]):
                    at = new[order[a:b]]
                    out.append(row(int(part[order[a]]), number, [c[at] for c in own], keys, firsts, data, len(data)))
                    if len(out) == 64:
                        yield batch_of(out)
                        out = []
                if out:
                    yield batch_of(out)

            for first, last, anchor, name in pieces(np.frombuffer(data, np.uint8), ends, level, grams, length):
                new = np.zeros(len(first), bool)
                for i, (a, b) in enumerate(zip(first.tolist(), last.tolist())):
                    piece = data[a : b + length]
                    if piece not in known:
                        known[piece] = new[i] = True
                block.append((np.searchsorted(ends, first, "right"), first, last, anchor, name, new))
                seen += SLICE
                if seen >= chunk + SLICE:
                    yield from flush()
                    block, known, seen = [], {}, 0
            if block:
                yield from flush()

    return rows.mapInArrow(cut, SENT)


class Suffixes:
    """Pieces with their anchors, compared rightwards or leftwards from the anchor by hashes of prefixes."""

    def __init__(self, data: np.ndarray, start: np.ndarray, anchor: np.ndarray, size: np.ndarray, base: int):
        widest = int(size.max(initial=0)) + 1
        place = np.arange(len(data)) - np.repeat(start, size)
        self.data, self.at = data, start + anchor
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE[data] * powers(base, widest)[place], dtype=np.uint64)])
        self.down = powers(pow(base, -1, 1 << 64), widest)
        self.anchor, self.right, self.left = anchor, size - anchor, anchor

    def names(self, gram: int) -> np.ndarray:
        return (self.sums[self.at + gram] - self.sums[self.at]) * self.down[self.anchor]

    def equal(self, p: np.ndarray, q: np.ndarray, n: np.ndarray, leftwards: bool) -> np.ndarray:
        back = n if leftwards else 0
        part = lambda i: (self.sums[self.at[i] - back + n] - self.sums[self.at[i] - back]) * self.down[self.anchor[i] - back]
        return part(p) == part(q)

    def common(self, p: np.ndarray, q: np.ndarray, leftwards: bool) -> np.ndarray:
        """How many bytes the suffixes of the pieces p and q share, by binary search."""
        size = self.left if leftwards else self.right
        most, out = np.minimum(size[p], size[q]), np.zeros(len(p), np.int64)
        step = 1 << int(most.max(initial=0)).bit_length() >> 1
        while step:
            at = np.flatnonzero(out + step <= most)
            at = at[self.equal(p[at], q[at], out[at] + step, leftwards)]
            out[at] += step
            step >>= 1
        return out

    def before(self, p: np.ndarray, q: np.ndarray, leftwards: bool, same: np.ndarray | bool = False) -> np.ndarray:
        """Whether the suffix of p comes before that of q; same: the answer for equal ones."""
        size, n = self.left if leftwards else self.right, self.common(p, q, leftwards)
        out = np.where(size[p] == size[q], same, size[p] < size[q])
        at = np.flatnonzero(n < np.minimum(size[p], size[q]))
        if len(at):
            step = -1 - n[at] if leftwards else n[at]
            out[at] = self.data[self.at[p[at]] + step] < self.data[self.at[q[at]] + step]
        return out

    def verified(self, p: np.ndarray, q: np.ndarray, n: np.ndarray, leftwards: bool) -> bool:
        """Whether p and q share just n bytes and p does not come after q, byte by byte."""
        size = self.left if leftwards else self.right
        sign, shift = (-1, -1) if leftwards else (1, 0)
        for k in range(int(n.max(initial=0))):
            at = np.flatnonzero(n > k)
            if (self.data[self.at[p[at]] + sign * k + shift] != self.data[self.at[q[at]] + sign * k + shift]).any():
                return False
        at = np.flatnonzero(n < np.minimum(size[p], size[q]))
        k = sign * n[at] + shift
        ends = np.flatnonzero(n == np.minimum(size[p], size[q]))
        return bool((self.data[self.at[p[at]] + k] < self.data[self.at[q[at]] + k]).all() and (size[p[ends]] <= size[q[ends]]).all())


def merge_sorted(order: np.ndarray, first: np.ndarray, size: np.ndarray, before: Callable) -> np.ndarray:
    """Each group sorted by a bottom-up mergesort. order: members, group after group; first, size: of each member's group."""
    order = order.copy()
    width = 1
    while width < int(size.max(initial=0)):
        at = np.flatnonzero(size > width)
        k = at - first[at]
        run = k // width
        lo = np.minimum((run ^ 1) * width, size[at])
        start, hi = lo.copy(), np.minimum(lo + width, size[at])
        while (open_ := np.flatnonzero(lo < hi)).size:  # how many of the other run come before
            mid = (lo[open_] + hi[open_]) >> 1
            mine, other = order[at[open_]], order[first[at[open_]] + mid]
            ahead = before(other, mine, run[open_] % 2 == 1)
            lo[open_] = np.where(ahead, mid + 1, lo[open_])
            hi[open_] = np.where(ahead, hi[open_], mid)
        merged = order.copy()
        merged[first[at] + (run & ~1) * width + (k - run * width) + (lo - start)] = order[at]
        order, width = merged, width * 2
    return order


def sorted_classes(s: Suffixes, order: np.ndarray, first: np.ndarray, size: np.ndarray, leftwards: bool) -> tuple[np.ndarray, np.ndarray] | None:
    """The sorted members and how much each shares with the one before (-1 at the start of a group); None: a collision."""
    out = merge_sorted(order, first, size, lambda p, q, same: s.before(p, q, leftwards, same))
    shared = np.full(len(out), -1, np.int64)
    at = np.flatnonzero(np.arange(len(out)) > first)
    shared[at] = s.common(out[at - 1], out[at], leftwards)
    return (out, shared) if s.verified(out[at - 1], out[at], shared[at], leftwards) else None


def repeats(data: bytes, anchor: np.ndarray, windows: np.ndarray, length: int, gram: int, bases: tuple[int, ...] = BASES) -> tuple[np.ndarray, np.ndarray]:
    """(whole, some): pieces equal to an earlier one, and by piece and bytes before the anchor the windows that an earlier
    piece has too. The pieces come in the order of the texts."""
    size = windows + length - 1
    start = np.cumsum(size) - size
    known, whole = {}, np.zeros(len(size), bool)
    for i, (a, n) in enumerate(zip(start.tolist(), size.tolist())):
        if known.setdefault(data[a : a + n], i) != i:
            whole[i] = True
    some = np.zeros((len(size), length - gram + 1), bool)
    raw = np.frombuffer(data, np.uint8)
    for base in bases:
        s = Suffixes(raw, start, anchor, size, base)
        _, group = np.unique(s.names(gram), return_inverse=True)
        members = np.flatnonzero(~whole)
        count = np.bincount(group[members], minlength=1)
        members = members[count[group[members]] > 1]
        if not len(members):
            return whole, some
        order = members[np.argsort(group[members], kind="stable")]
        first = np.searchsorted(group[order], group[order])
        n = count[group[order]]
        both = [sorted_classes(s, order, first, n, leftwards) for leftwards in (False, True)]
        if all(both):
            break
    else:
        raise RuntimeError("collisions with every base")
    (right, shared_right), (left, shared_left) = both
    of_right, of_left = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
    for x in range(length - gram + 1):
        of_right[right] = np.cumsum(shared_right < length - x)
        of_left[left] = np.cumsum(shared_left < x)
        at = members[(anchor[members] >= x) & (anchor[members] - windows[members] < x)]
        if len(at):
            _, earliest, back = np.unique(of_right[at] * (len(right) + 1) + of_left[at], return_index=True, return_inverse=True)
            some[at[earliest[back] != np.arange(len(at))], x] = True
    return whole, some


def sort_parts(sent: DataFrame, length: int, gram: int) -> DataFrame:
    """The covered ranges of FOUND, from the pieces of each part."""

    def ranges(chunk, doc, start, stop):
        out = []
        order = np.lexsort((start, doc, chunk))
        chunk, doc, start, stop = chunk[order], doc[order], start[order], stop[order]
        edges = np.flatnonzero(np.diff(chunk, prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:]):
            out.append((int(chunk[a]), RANGES, steps(doc[a:b]), steps(start[a:b]), packed((stop - start)[a:b]), None, b - a))
        return out

    def solved(rows):
        """The ranges of one part."""
        n = [r["n"] for r in rows]
        column = lambda name, kind, summed=False: np.concatenate([numbers(r[name], m, kind, summed) for r, m in zip(rows, n)]).astype(np.int64)
        key, doc, start = (column(c, np.int64, True) for c in ("key", "doc", "start"))
        anchor, windows, chunk = column("anchor", np.uint16), column("windows", np.uint32), np.repeat([r["chunk"] for r in rows], n)
        text = b"".join(pa.decompress(r["data"], r["bytes"], "zstd", asbytes=True) for r in rows)
        order = np.lexsort((start, doc, chunk, key))
        size = windows + length - 1
        at = np.cumsum(size) - size
        text = b"".join(text[a : a + k] for a, k in zip(at[order].tolist(), size[order].tolist()))
        key, doc, start, anchor, windows, chunk = (c[order] for c in (key, doc, start, anchor, windows, chunk))
        whole, some = repeats(text, anchor, windows, length, gram)
        piece, x = np.nonzero(some)  # consecutive windows of a piece end up as one range
        new = np.flatnonzero(np.diff(piece, prepend=-1) | (np.diff(x, prepend=-2) != 1))
        last = np.append(new[1:], len(piece))[: len(new)] - 1
        own = piece[new]
        own_start, own_stop = start[own] + anchor[own] - x[last], start[own] + anchor[own] - x[new] + length
        all_of = np.flatnonzero(whole)
        return ranges(np.concatenate([chunk[all_of], chunk[own]]), np.concatenate([doc[all_of], doc[own]]), np.concatenate([start[all_of], own_start]),
                      np.concatenate([start[all_of] + windows[all_of] + length - 1, own_stop]))

    def batch_of(out):
        types = [pa.int64(), pa.int32(), *[pa.binary()] * 4, pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[f.split()[0] for f in FOUND.split(", ")])

    def sort(batches):
        part, rows = None, []
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["part"] != part and rows:
                    out += solved(rows)
                    rows = []
                part = r["part"]
                if part >= 0:
                    rows.append(r)
                else:
                    m = r["n"]
                    doc, start, windows = numbers(r["doc"], m, np.int64, True), numbers(r["start"], m, np.int64, True), numbers(r["windows"], m, np.uint32).astype(np.int64)
                    out.append((r["chunk"], RANGES, steps(doc), steps(start), packed(windows + length - 1), None, m))
            if out:
                yield batch_of(out)
        if rows and (out := solved(rows)):
            yield batch_of(out)

    return sent.mapInArrow(sort, FOUND)


def texts_of(rows: DataFrame, chunk: int) -> DataFrame:
    """The rows of FOUND with the texts of each chunk."""

    def pack(batches):
        for number, keys, texts in chunks(batches, chunk):
            sizes = np.array([len(t) for t in texts], np.int64)
            has = np.array([k is not None for k in keys])
            head = packed(np.concatenate([sizes, np.array([k or 0 for k in keys], np.int64), has.astype(np.int64)]))
            data = b"".join(texts)
            columns = [[number], [TEXT], [head], [None], [None], [packed(data)], [len(keys)]]
            types = [pa.int64(), pa.int32(), *[pa.binary()] * 4, pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[f.split()[0] for f in FOUND.split(", ")])

    return rows.mapInArrow(pack, FOUND)


def assemble(group: pa.Table) -> pa.Table:
    """Key, n_bytes, n_removed, spans and kept bytes of a chunk's texts."""
    head, ranges = None, []
    for r in group.to_pylist():
        if r["kind"] == TEXT:
            head = r
        else:
            doc, start, size = numbers(r["doc"], r["n"], np.int64, True), numbers(r["start"], r["n"], np.int64, True), numbers(r["stop"], r["n"], np.int64)
            ranges.append((doc, start, start + size))
    if head is None:
        raise RuntimeError("ranges without their chunk: the input changed between two runs of a task")
    sizes, keys, has = numbers(head["doc"], 3 * head["n"], np.int64).reshape(3, -1)
    ends = np.cumsum(sizes)
    firsts, total = ends - sizes, int(sizes.sum())
    text = np.frombuffer(pa.decompress(head["data"], total, "zstd"), np.uint8)
    doc, start, stop = (np.concatenate(c) for c in zip(*ranges)) if ranges else np.zeros((3, 0), np.int64)
    if (start >= sizes[doc]).any() or (stop > sizes[doc]).any():
        raise RuntimeError("ranges beyond their text: the input changed between two runs of a task")
    change = np.bincount(firsts[doc] + start, minlength=total + 1) - np.bincount(firsts[doc] + stop, minlength=total + 1)
    gone = np.cumsum(change[:-1]) > 0
    up, down = gone.copy(), gone.copy()
    up[1:] &= ~gone[:-1]
    down[:-1] &= ~gone[1:]
    border = ends[(ends > 0) & (ends < total)]
    up[border] |= gone[border]
    down[border - 1] |= gone[border - 1]
    up, down = np.flatnonzero(up), np.flatnonzero(down) + 1
    doc = np.searchsorted(ends, up, "right")
    n_spans = np.bincount(doc, minlength=len(sizes))
    removed = np.concatenate([[0], np.cumsum(gone)])
    n_removed = removed[ends] - removed[firsts]
    spans = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_spans)]).astype(np.int32)),
                                     pa.StructArray.from_arrays([pa.array(up - firsts[doc]), pa.array(down - firsts[doc])], names=["start", "stop"]))
    return pa.table([pa.array(keys, mask=has == 0), pa.array(sizes), pa.array(n_removed), spans, binaries(text[~gone], sizes - n_removed)],
                    names=["key", "n_bytes", "n_removed", "spans", "kept"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, chunk: int = CHUNK, part: int = PART) -> DataFrame:
    """key, n_bytes, n_removed, spans (start and stop of the removed runs, in bytes) and kept (the bytes left) per row."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(key).cast("bigint").alias("k"), F.col(text).cast("binary").alias("t"), F.spark_partition_id().alias("__part"))
    level, total = gram_cells(rows, length, gram, chunk)
    many = partitions(spark)
    parts = max(2 * many, 4 * total // part)  # pieces overlap: they hold each byte about three times
    sent = explode(rows, level, parts, length, gram, chunk)
    met = sent.repartition(max(many, parts // 4), "part").sortWithinPartitions("part", "chunk")
    found = sort_parts(met, length, gram).union(texts_of(rows, chunk))
    out = found.groupBy("chunk").applyInArrow(assemble, "key bigint, n_bytes bigint, n_removed bigint, spans array<struct<start: bigint, stop: bigint>>, kept binary")
    return out.withColumn("key", F.col("key").cast(docs.schema[key].dataType)).withColumnRenamed("key", key)


def op12_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
