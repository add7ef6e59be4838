"""Language-model scores with a probabilistic suffix tree.

Tokens are lower-case words and one end per text; one start stands before each text. The tree's states are contexts of up
to ``DEPTH`` tokens, of all words. A context is a candidate when it occurs ``MIN_COUNT`` times, however large the corpus
is, and is retained when its next-word distribution diverges from that of its suffix: tokens times divergence must
exceed ``GAIN`` nats for each next word seen. The root is the smoothed word distribution, with one place for all unknown
words; the distribution of a state is smoothed with that of its longest retained suffix, and a token is scored by the
longest retained suffix of what stands before it.

The tree grows with the corpus, and no n-gram is sent by itself. All contexts of a token end with the word before it, so
each token is sent once, with the three words before it, to the part of that word: this subtree of the tree is counted,
tested and applied there, and what goes back is a sum per text and part. Words are sent as short codes, frequent ones first,
from which their counts can be read; a word that cannot be in a candidate is sent as none.

A context that many tokens follow would make a part too large. Such heavy contexts are found first (``look``); their next
words are counted per chunk and dealt by the next word, whatever the context, and a token behind a heavy context is sent by
the shortest context that is not heavy. A chunk is the texts of one task up to ``CHUNK`` tokens. Words meet by a 64-bit hash.
"""
from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .tables import fold, held, partitions, small_batches, table
from .words import met, pack, unpack

DEPTH = 3
MIN_COUNT = 2
GAIN = 3.0
PRIOR = 8.0  # tokens' worth of the suffix's distribution in a state
FLUSH = 400_000
CHUNK = 1_000_000  # tokens; a longer text is a chunk of its own
HEAVY = 0.25  # a context is heavy when it has this share of an average part's tokens
AT_ONCE = 1_000_000  # tokens of a part that are counted at once, but for those of one context
HEADS = 1 << 15  # a word with at least one in so many tokens gets one of the shortest codes
TURN = np.uint64(0x9E3779B97F4A7C15)
START, END = (xxhash.xxh64_intdigest(b) for b in (b" ", b"\n"))
START_KEY = START - (START >> 63 << 64)  # as a signed number
ROWS = "to bigint, kind int, chunk bigint, v bigint, x double, data binary"
ANSWERS, CONTENT, TOKENS, SUMS, TOTALS, STEP, HEAD, NEXT = range(8)
NONE, ONCE = 0, 1  # codes: of no use in any candidate; a next word that occurs once in all texts


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII blanks only


class Hashes(dict):
    """Word to its hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > FLUSH:
            self.clear()
        out = self[word] = xxhash.xxh64_intdigest(word)
        return out

    def tokens(self, text: str | None) -> np.ndarray:
        """The start, the words and the end."""
        words = words_of(text)
        out = np.empty(len(words) + 2, np.uint64)
        out[0], out[-1] = START, END
        out[1:-1] = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        return out


def places(lengths: np.ndarray) -> np.ndarray:
    """The place of each token in its text."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)


def grams(tokens: np.ndarray) -> list[np.ndarray]:
    """By length from 1 to DEPTH + 1, the n-gram that ends at each token; it is one only where the text has as many."""
    out = [tokens]
    for _ in range(DEPTH):
        longer = np.zeros_like(tokens)
        longer[1:] = out[-1][:-1] * TURN + tokens[1:]
        out.append(longer)
    return out


def gram_counts(texts: DataFrame) -> DataFrame:
    """(m, key, prefix, suffix, n) of the n-grams of m tokens over all rows of (t)."""

    def batches_of(each: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        place, found = places(np.array([len(x) for x in each])), grams(np.concatenate(each))
        for m, keys in enumerate(found, 1):
            at = np.flatnonzero(place >= m - 1)
            key, first, n = np.unique(keys[at], return_index=True, return_counts=True)
            at = at[first]
            prefix, suffix = (found[m - 2][at - 1], found[m - 2][at]) if m > 1 else (np.zeros_like(key), np.zeros_like(key))
            columns = [np.full(len(key), m, np.int32), key.view(np.int64), prefix.view(np.int64), suffix.view(np.int64), n.astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["m", "key", "prefix", "suffix", "n"])

    def count(batches):
        hashes, each, size = Hashes(), [], 0
        for batch in batches:
            for text in batch["t"].to_pylist():
                each.append(hashes.tokens(text))
                size += len(each[-1])
                if size > FLUSH:
                    yield from batches_of(each)
                    each, size = [], 0
        if each:
            yield from batches_of(each)

    small_batches(texts.sparkSession)
    found = texts.mapInArrow(count, "m int, key bigint, prefix bigint, suffix bigint, n bigint")
    return found.groupBy("m", "key", "prefix", "suffix").agg(F.sum("n").alias("n"))


def retained(counts: DataFrame, tokens: int, depth: int = DEPTH, gain: float = GAIN, min_count: int = MIN_COUNT) -> DataFrame:
    """(ctx, above_ctx, total): the contexts that diverge from their suffix, with that suffix and their tokens."""
    known = counts.where((F.col("m") <= depth) & (F.col("n") >= min_count)).select("m", F.col("key").alias("ctx"), F.col("suffix").alias("above_ctx"), F.col("n").alias("total"))
    above = known.where(F.col("m") < depth).select(F.col("ctx").alias("above_ctx"), F.col("total").alias("above"))
    known = known.join(above, "above_ctx", "left").where("m = 1 or above is not null")
    known = known.select("ctx", "above_ctx", "total", F.when(F.col("m") == 1, F.lit(tokens)).otherwise(F.col("above")).alias("above"))
    shorter = counts.where(F.col("m") <= depth).select(F.col("key").alias("suffix"), F.col("n").alias("less"))
    longer = counts.where(F.col("m").between(2, depth + 1)).select(F.col("prefix").alias("ctx"), "suffix", "n")
    both = longer.join(known, "ctx").join(shorter, "suffix")
    nats = F.sum(F.col("n") * F.log((F.col("n") / F.col("total")) / (F.col("less") / F.col("above"))))
    test = both.groupBy("ctx", "above_ctx", "total").agg(nats.alias("nats"), F.count("*").alias("seen"))
    return test.where(F.col("nats") > gain * F.col("seen")).select("ctx", "above_ctx", "total")


def squeeze(*columns: np.ndarray) -> bytes:
    """Columns of numbers from 0 on, byte plane by byte plane, each compressed by itself."""
    out = []
    for c in columns:
        c = np.ascontiguousarray(c, np.uint64)
        width = (int(c.max()).bit_length() + 7) // 8 if len(c) else 0
        planes = [np.ascontiguousarray(c.view(np.uint8)[i::8]) for i in range(width)]
        planes = [(p, pa.compress(p, "zstd", asbytes=True)) for p in planes]
        out.append(np.array([len(c), width, *(len(z) if len(z) < len(p) else len(p) for p, z in planes)], np.uint32).tobytes())
        out += [z if len(z) < len(p) else p.tobytes() for p, z in planes]
    return b"".join(out)


def spread(data, number: int) -> list[np.ndarray]:
    """The columns again, as int64."""
    at, out, data = 0, [], memoryview(data)
    for _ in range(number):
        n, width = np.frombuffer(data, np.uint32, 2, at).tolist()
        sizes = np.frombuffer(data, np.uint32, width, at + 8).tolist()
        at += 8 + 4 * width
        column = np.zeros(n, np.int64)
        for i, size in enumerate(sizes):
            plane = data[at : at + size]
            column.view(np.uint8)[i::8] = np.frombuffer(plane if size == n else pa.decompress(plane, n, "zstd"), np.uint8)
            at += size
        out.append(column)
    return out


def rows_of(*found: tuple) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names=["to", "kind", "chunk", "v", "x", "data"])


@dataclass
class Chunk:
    """Texts as slots of the chunk's words; the first two slots are the start and the end."""

    number: int
    slots: dict = field(default_factory=dict)
    texts: list = field(default_factory=list)
    keys: list = field(default_factory=list)
    learn: list = field(default_factory=list)
    size: int = 0

    def __post_init__(self):
        self.slots = defaultdict(None, {b" ": 0, b"\n": 1})
        self.slots.default_factory = self.slots.__len__

    def add(self, words: list[bytes], learn: bool, keys: pa.RecordBatch) -> None:
        out = np.empty(len(words) + 2, np.int32)
        out[0], out[-1] = 0, 1
        out[1:-1] = np.fromiter(map(self.slots.__getitem__, words), np.int32, len(words))
        self.texts.append(out)
        self.learn.append(learn)
        self.keys.append(keys)
        self.size += len(out)

    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        """The slots and the texts' lengths."""
        return np.concatenate(self.texts), np.array([len(t) for t in self.texts])

    def hashes(self) -> np.ndarray:
        """Each slot's hash."""
        return np.fromiter(map(xxhash.xxh64_intdigest, self.slots), np.uint64, len(self.slots))


def chunked(sources: list[DataFrame], do: Callable[[Chunk], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What do gives for each chunk of the sources' rows: (c0, c1, ..., t, learn)."""

    def of(first: int, names: list[str]):
        def run(batches):
            own, number = None, 0
            for batch in batches:
                if not batch.num_rows:
                    continue
                own = own or Chunk(first + (batch["__part"][0].as_py() << 24))
                keys = batch.select(names)
                for i, (text, learn) in enumerate(zip(batch["t"], batch["learn"].to_pylist())):
                    words = words_of(text.as_py())
                    if own.texts and own.size + len(words) + 2 > CHUNK:
                        yield from do(own)
                        own = Chunk(own.number + 1)
                    own.add(words, learn, keys.slice(i, 1))
            if own:
                yield from do(own)

        return run

    out = None
    for i, rows in enumerate(sources):
        small_batches(rows.sparkSession)
        # The partition's number within this scan: a task's own number shifts where two scans are united.
        found = rows.withColumn("__part", F.spark_partition_id()).mapInArrow(of(i << 55, [c for c in rows.columns if c not in ("t", "learn")]), schema)
        out = found if out is None else out.union(found)
    return out


@dataclass
class Heavy:
    """The heavy contexts by length: sorted keys, and for each its suffix's place among those one shorter."""

    keys: list[np.ndarray]
    above: list[np.ndarray]

    def places_of(self, m: int, keys: np.ndarray) -> np.ndarray:
        """The place of each key among the heavy contexts of m tokens, or -1."""
        own = self.keys[m - 1]
        if not len(own):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
        return np.where(own[at] == keys, at, -1)

    def before(self, flat: np.ndarray, place: np.ndarray, of_slot: np.ndarray) -> list[np.ndarray]:
        """By length, the heavy context in front of each token, or -1. of_slot: a slot's place among the heavy words."""
        out, ends = [], of_slot[flat]
        word = self.keys[0]
        for m in range(1, DEPTH + 1):
            if not len(self.keys[m - 1]):
                out.append(np.full(len(flat), -1, np.int64))
                continue
            if m > 1:
                at = np.flatnonzero((ends >= 0) & (place >= m - 1))
                key = np.zeros(len(at), np.uint64)
                for back in range(m - 1, -1, -1):
                    own = of_slot[flat[at - back]]
                    known = own >= 0
                    at, key, own = at[known], key[known], own[known]
                    key = key * TURN + word[own]
                ends = np.full(len(flat), -1, np.int64)
                ends[at] = self.places_of(m, key)
            out.append(np.where(place >= m, np.concatenate([[-1], ends[:-1]]), -1))
        return out


def look(sources: list[DataFrame], depth: int) -> tuple[Heavy, int]:
    """The contexts that more than a share of all tokens follow, and the tokens to learn from.

    A chunk reports those with a quarter of that share of its own tokens: what is heavy is so in at least one chunk, and
    chunks that do not report it lose a quarter at most.
    """
    share = HEAVY / partitions(sources[0].sparkSession)

    def report(own: Chunk) -> Iterator[pa.RecordBatch]:
        flat, lengths = own.flat()
        place = places(lengths)
        least = max(1, share / 4 * len(flat))
        tokens = int((lengths - 1).sum())
        found = [(0, 0, 0, tokens), (-1, 0, 0, int((lengths - 1)[np.array(own.learn)].sum()))]
        n = np.bincount(flat, minlength=len(own.slots))
        n[1] = 0  # nothing follows the end
        many, hashes = n >= least, np.zeros(len(n), np.uint64)
        words = list(own.slots)
        for i in np.flatnonzero(many):
            hashes[i] = xxhash.xxh64_intdigest(words[i])
        signed = hashes.view(np.int64)
        found += [(1, int(signed[i]), 0, int(n[i])) for i in np.flatnonzero(many)]
        at, key, suffix = np.flatnonzero(many[flat]), hashes[flat], None
        for m in range(2, depth + 1):
            at = at[place[at] >= m - 1]
            at = at[many[flat[at - m + 1]]]
            key = np.zeros(len(at), np.uint64)
            for back in range(m - 1, -1, -1):
                if back == m - 2:
                    suffix = np.zeros(len(at), np.uint64)
                key = key * TURN + hashes[flat[at - back]]
                if back < m - 1:
                    suffix = suffix * TURN + hashes[flat[at - back]]
            keys, first, back_to, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            found += [(m, int(keys.view(np.int64)[i]), int(suffix.view(np.int64)[first[i]]), int(n[i])) for i in np.flatnonzero(n >= least)]
            at = at[(n >= least)[back_to]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["m", "key", "suffix", "n"])

    reports = chunked(sources, report, "m bigint, key bigint, suffix bigint, n bigint").groupBy("m", "key", "suffix").agg(F.sum("n").alias("n"))
    reports = held(reports, "heavy")
    totals = {r.m: r.n for r in reports.where("m < 1").collect()}
    found = reports.where((F.col("m") > 0) & (F.col("n") >= max(1.0, 0.75 * share * totals.get(0, 0)))).collect()
    keys, above = [], []
    for m in range(1, DEPTH + 1):
        own = sorted((r.key & (1 << 64) - 1, r.suffix & (1 << 64) - 1) for r in found if r.m == m)
        suffix = np.array([s for _, s in own], np.uint64)
        above.append(np.searchsorted(keys[-1], suffix) if m > 1 else np.zeros(len(own), np.int64))
        keys.append(np.array([k for k, _ in own], np.uint64))
    return Heavy(keys, above), totals.get(-1, 0)


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Parts by ranges of the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def next_words(before: list[np.ndarray], rank: np.ndarray, heavy: Heavy) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length of the heavy context: the tokens behind one, their distinct pairs of next word and context, and each token's pair."""
    out = []
    for m, own in enumerate(before):
        at = np.flatnonzero(own >= 0)
        out.append((at, *np.unique(rank[at] * max(1, len(heavy.keys[m])) + own[at], return_inverse=True)))
    return out


@dataclass
class Model:
    rows: DataFrame  # (c0, c1, ..., t, learn) as given
    sources: list[DataFrame]
    answers: DataFrame  # for each chunk, its words' counts and codes, and those of next words of heavy contexts
    heavy: Heavy
    rules: tuple[int, float, int]
    tokens: int  # N
    distinct: int  # V
    texts: int  # training texts, which is how often the end occurs
    codes: "Codes"
    kept: list[np.ndarray]  # by length, whether each heavy context is retained
    totals: list[np.ndarray]
    given: tuple = (None, None)  # the rows and their text column, as given to train

    @property
    def logs(self) -> Iterator[np.ndarray]:
        """For each state, the root first, log10 of the probabilities of all known words, the end and the unknown word.

        Collects the tree, which it makes as a table: for small ones, to look at.
        """
        counts = gram_counts(self.rows.where("learn").select("t")).cache()
        n = {r.key: r.n for r in counts.collect()}
        suffix = {r.key: r.suffix for r in counts.collect()}
        states = {r.ctx: r for r in retained(counts, self.tokens, *self.rules).collect()}
        words = np.array([r.key for r in counts.where((F.col("m") == 1) & (F.col("key") != START_KEY)).collect()], np.int64)
        root = np.append([n[int(w)] for w in words], 0.0) + 0.1
        root /= self.tokens + 0.1 * (self.distinct + 1)

        def row(ctx: int, above: int) -> np.ndarray:
            longer = np.uint64(ctx & (1 << 64) - 1) * np.ones(1, np.uint64) * TURN + words.view(np.uint64)
            seen = np.append([n.get(int(k), 0) for k in longer.view(np.int64)], 0.0)
            return (seen + PRIOR * chain(above)) / (n[ctx] + PRIOR)

        def chain(ctx: int) -> np.ndarray:
            while ctx and ctx not in states:
                ctx = suffix.get(ctx, 0)
            return row(ctx, states[ctx].above_ctx) if ctx else root

        yield np.log10(root)
        for ctx in states:
            yield np.log10(chain(ctx))


@dataclass
class Codes:
    """Words as short numbers that tell their counts: from 2 on by count, the frequent ones first, then (count, place) in steps."""

    least: int  # count of a word with a code of its own
    heads: dict  # (count, place) to code
    head_counts: np.ndarray  # by code
    counts: np.ndarray  # of the steps
    offsets: np.ndarray

    def of(self, c: np.ndarray, place: np.ndarray) -> np.ndarray:
        out = np.zeros(len(c), np.int64)
        low = np.flatnonzero((place > 0) & (c < self.least))
        if len(low):
            out[low] = self.offsets[np.searchsorted(-self.counts, -c[low])] + place[low]
        for i in np.flatnonzero((place > 0) & (c >= self.least)):
            out[i] = self.heads[int(c[i]), int(place[i])]
        return out

    def count(self, code: np.ndarray) -> np.ndarray:
        out = self.head_counts[np.minimum(code, len(self.head_counts) - 1)]
        low = np.flatnonzero(code >= len(self.head_counts))
        if len(low):
            out[low] = self.counts[np.searchsorted(self.offsets, code[low], "left") - 1]
        return out


def learned(sources: list[DataFrame], rows: DataFrame, depth: int, gain: float, min_count: int) -> Model:
    """Counts words, finds the heavy contexts, and counts and tests these."""
    spark = rows.sparkSession
    parts = partitions(spark)
    heavy, tokens = look(sources, depth)
    least = max(2, -(-tokens // HEADS))

    def ask(own: Chunk) -> Iterator[pa.RecordBatch]:
        (flat, lengths), hashes = own.flat(), own.hashes()
        learn, order = np.repeat(np.array(own.learn), lengths), np.argsort(hashes)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        edges = np.searchsorted(part_of(hashes[order], parts), np.arange(parts + 1))
        n = np.bincount(flat, weights=learn, minlength=len(order)).astype(np.int64)[order]
        more = np.bincount(flat, weights=~learn, minlength=len(order)).astype(np.int64)[order]
        before = heavy.before(flat, places(lengths), heavy.places_of(1, hashes))
        pairs = [(keys, np.bincount(to, weights=learn[at], minlength=len(keys)).astype(np.int64), max(1, len(heavy.keys[m])))
                 for m, (at, keys, to) in enumerate(next_words(before, rank[flat], heavy))]
        own_hashes, out = hashes[order], []
        for p in np.flatnonzero(np.diff(edges)):
            a, b = edges[p], edges[p + 1]
            columns = [np.diff(own_hashes[a:b], prepend=np.uint64(0)), n[a:b], more[a:b]]
            for keys, times, width in pairs:
                i, j = np.searchsorted(keys, [a * width, b * width])
                columns += [keys[i:j] // width - a, keys[i:j] % width, times[i:j]]
            out.append((int(p), ANSWERS, own.number, 0, 0.0, squeeze(*columns)))
        yield rows_of(*out)

    def part_answers(part: int, chunks: list[int], blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        content = [spread(b, 3 + 3 * DEPTH) for b in blobs]
        sizes = [len(c[0]) for c in content]
        words, to = np.unique(np.concatenate([np.cumsum(c[0].view(np.uint64)) for c in content]), return_inverse=True)
        add = lambda at, v, n: np.bincount(at, weights=v, minlength=n).astype(np.int64)
        join = lambda i: np.concatenate([c[i] for c in content])
        n = add(to, join(1), len(words))
        every = n + add(to, join(2), len(words))
        named = (n > 0) & ((every > 1) | (min_count < 2))
        at = np.flatnonzero(named)
        at = at[np.argsort(n[at], kind="stable")]
        place = np.zeros(len(words), np.int64)
        steps, first = np.unique(n[at], return_index=True)
        place[at] = 1 + (np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))) * parts + part
        start = words == np.uint64(START)
        stats = [(0, TOTALS, 0, int(n[~start].sum()), 0.0, None), (0, TOTALS, 1, int((n[~start] > 0).sum()), 0.0, None), (0, TOTALS, 2, int(n[start].sum()), 0.0, None)]
        lasts = place[at][np.append(first[1:], len(at)) - 1] if len(at) else place[:0]
        stats += [(0, STEP, int(c), int(x), 0.0, None) for c, x in zip(steps, lasts) if c < least]
        stats += [(0, HEAD, int(n[i]), int(place[i]), 0.0, None) for i in at[n[at] >= least]]
        starts = np.cumsum([0, *sizes])
        below, found = (np.arange(len(words)), n), []  # (word, suffix) pairs and their counts, one shorter
        for m in range(DEPTH):
            width = max(1, len(heavy.keys[m]))
            word = np.concatenate([to[s + c[3 + 3 * m]] for s, c in zip(starts, content)])
            keys, back = np.unique(word * width + join(4 + 3 * m), return_inverse=True)
            times = add(back, join(5 + 3 * m), len(keys))
            found.append(times[back])
            own, word, seen = keys % width, keys // width, times > 0
            if seen.any():
                wide = max(1, len(heavy.keys[m - 1])) if m else 1
                less = below[1][np.searchsorted(below[0], word * wide + heavy.above[m][own])] if m else n[word]
                nats = np.bincount(own[seen], weights=times[seen] * np.log(times[seen] / less[seen]), minlength=width)
                total, number = add(own, times, width), add(own[seen], np.ones(int(seen.sum())), width)
                stats += [(int(number[j]), NEXT + m, int(j), int(total[j]), float(nats[j]), None) for j in np.flatnonzero(number)]
            below = keys, times
        yield rows_of(*stats)
        cuts = [np.cumsum([0, *(len(c[3 + 3 * m]) for c in content)]) for m in range(DEPTH)]
        for i, chunk in enumerate(chunks):
            own = to[starts[i] : starts[i + 1]]
            yield rows_of((0, ANSWERS, chunk, part, 0.0, squeeze(n[own], place[own], *(f[c[i] : c[i + 1]] for f, c in zip(found, cuts)))))

    answers = held(met(chunked(sources, ask, ROWS)).mapInArrow(by_part(part_answers, ANSWERS), ROWS), "answers")
    stats = answers.where(F.col("kind") >= TOTALS).groupBy("kind", "chunk", F.when(F.col("kind") == HEAD, F.col("v")).alias("place"))
    stats = stats.agg(F.sum("v").alias("v"), F.max("v").alias("last"), F.sum("to").alias("seen"), F.sum("x").alias("nats")).collect()
    total = {r.chunk: r.v for r in stats if r.kind == TOTALS}
    heads = sorted(((r.chunk, r.place) for r in stats if r.kind == HEAD), reverse=True)
    steps = sorted(((r.chunk, r.last) for r in stats if r.kind == STEP), reverse=True)
    offsets = np.cumsum([1 + len(heads), *(x for _, x in steps)])
    codes = Codes(least, {h: 2 + i for i, h in enumerate(heads)}, np.array([0, 1, *(c for c, _ in heads)], np.int64),
                  np.array([c for c, _ in steps], np.int64), offsets[:-1])
    kept, totals = [], []
    for m in range(DEPTH):
        own = {r.chunk: r for r in stats if r.kind == NEXT + m}
        totals.append(np.array([own[j].v if j in own else 0 for j in range(len(heavy.keys[m]))], np.int64))
        kept.append(np.zeros(len(totals[m]), bool))
        for j, r in own.items():
            above = totals[m - 1][heavy.above[m][j]] if m else total[0]
            kept[m][j] = r.v >= min_count and r.nats - r.v * np.log(r.v / above) > gain * r.seen
    return Model(rows, sources, answers, heavy, (depth, gain, min_count), total.get(0, 0), total.get(1, 0), total.get(2, 0), codes, kept, totals)


def by_part(do: Callable[[int, list[int], list[bytes]], Iterator[pa.RecordBatch]], kind: int):
    """Gives do all rows of a part at once, and lets rows of another kind through."""

    def run(batches):
        part, chunks, blobs = None, [], []
        for batch in batches:
            for to, k, chunk, data in zip(*(batch[c].to_pylist() for c in ("to", "kind", "chunk", "data"))):
                if k != kind:
                    yield rows_of((to, k, chunk, -1, 0.0, data))
                    continue
                if to != part and blobs:
                    yield from do(part, chunks, blobs)
                    chunks, blobs = [], []
                part = to
                chunks.append(chunk), blobs.append(data)
        if blobs:
            yield from do(part, chunks, blobs)

    return run


def train(texts: DataFrame, depth: int = DEPTH, gain: float = GAIN, min_count: int = MIN_COUNT, text: str = "t", learn: Column | None = None) -> Model:
    """Learns from the rows, or from those where learn holds; these rows are then scored without being counted again.

    The rows are read more than once and must come in the same order each time, as they do from files.
    """
    columns = [F.col(c).alias(f"c{i}") for i, c in enumerate(texts.columns)]
    rows = texts.select(*columns, F.col(text).alias("t"), (F.lit(True) if learn is None else F.coalesce(learn, F.lit(False))).alias("learn"))
    model = learned([rows], rows, depth, gain, min_count)
    model.given = (texts, text)
    return model


def first_of(near: np.ndarray) -> np.ndarray:
    """The length of the shortest context that is not heavy, from the longest heavy one."""
    return np.where(near > 0, (near - 1) % (DEPTH - 1) + 2, 1)


def subtree(x: list[np.ndarray], word: np.ndarray, flags: np.ndarray, near: np.ndarray, gs: list[np.ndarray], model_of: tuple, rules: tuple) -> np.ndarray:
    """The probability of each token, from all tokens behind the same first context that is not heavy."""
    depth, gain, min_count = rules
    codes, tokens, smooth, kept, totals, shorter = model_of
    learn, c = flags & 1, codes.count(word)
    p = (c + 0.1) / smooth
    less, above = c, np.full(len(c), tokens, np.int64)
    first, j = first_of(near), (near - 1) // (DEPTH - 1)
    behind = []
    for m in reversed(range(depth - 1)):
        deeper = np.flatnonzero(first > m + 2)
        j[deeper] = shorter[m + 1][j[deeper]]
        at = np.flatnonzero(first > m + 1)
        behind.append((m, at, j[at]))
    for m, at, j in reversed(behind):
        less[at], above[at] = gs[m][at], totals[m][j]
        p[at] = np.where(kept[m][j], (gs[m][at] + PRIOR * p[at]) / (totals[m][j] + PRIOR), p[at])
    group = np.zeros(len(c), np.int64)  # contexts by number
    at, below = np.arange(len(c)), np.zeros(len(c), np.int64)
    for m in range(depth):
        at = at[x[m][at] > 0] if m else at
        _, group[at] = np.unique(group[at] << 40 | x[m][at], return_inverse=True)
        own = at[first[at] <= m + 1]
        total = np.bincount(group[own], weights=learn[own], minlength=1 + int(group[at].max(initial=0))).astype(np.int64)
        own = own[total[group[own]] >= min_count]
        at = at[(first[at] > m + 1) | (total[group[at]] >= min_count)]
        keys, to = np.unique(group[own] << 40 | word[own], return_inverse=True)
        times = np.bincount(to, weights=learn[own], minlength=len(keys)).astype(np.int64)
        under, ctx = np.empty(len(keys), np.int64), keys >> 40
        under[to] = less[own]
        once = keys & (1 << 40) - 1 == ONCE  # each a word of its own
        some = (times > 0) & ~once
        nats = np.bincount(ctx[some], weights=times[some] * np.log(times[some] / under[some]), minlength=len(total))
        seen = np.bincount(ctx, weights=np.where(once, times, some), minlength=len(total))
        over = np.ones(len(total))
        over[group[own]] = above[own]
        nats = nats - total * np.log(np.maximum(total, 1) / over)
        holds = (nats > gain * seen)[group[own]]
        n, all_n = np.where(once, np.minimum(times, 1), times)[to], total[group[own]]
        p[own] = np.where(holds, (n + PRIOR * p[own]) / (all_n + PRIOR), p[own])
        less[own], above[own] = n, all_n
    return p


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """key, the columns to keep, n_tokens, n_known, train_tokens, base_score and score per row. A null text counts as empty."""
    columns = [key, *keep]
    if model.given[0] is docs and model.given[1] == text:
        names = [f"c{docs.columns.index(c)}" for c in columns]
    else:  # other texts: what they ask for is counted with the rows learned from
        names = [f"c{i}" for i in range(len(columns))]
        rows = docs.select(*[F.col(c).alias(n) for n, c in zip(names, columns)], F.col(text).alias("t"), F.lit(False).alias("learn"))
        model = learned([rows, model.rows.where("learn").select("t", "learn")], model.rows, *model.rules)
    spark, parts = docs.sparkSession, partitions(docs.sparkSession)
    asked = 1 << 55  # chunks from this number on are only learned from
    heavy, rules, codes, n_tokens, kept, totals = model.heavy, model.rules, model.codes, model.tokens, model.kept, model.totals
    depth, min_count = rules[0], rules[2]
    smooth = model.tokens + 0.1 * (model.distinct + 1)
    fields = model.sources[0].schema

    def contents(own: Chunk) -> Iterator[pa.RecordBatch]:
        (flat, lengths), hashes = own.flat(), own.hashes()
        often = np.argsort(-np.bincount(flat, minlength=len(hashes)), kind="stable")
        slot = np.empty(len(often), np.int64)
        slot[often] = np.arange(len(often))
        rank = np.empty(len(often), np.int64)
        rank[np.argsort(hashes)] = np.arange(len(often))
        many = heavy.places_of(1, hashes)[often] + 1
        data = squeeze(slot[flat], rank[often], lengths, np.array(own.learn), many)
        keys = b""
        if own.number < asked:
            batch = pa.Table.from_batches(own.keys).select(names).combine_chunks().to_batches()[0]
            keys = pack(**dict(zip(batch.schema.names, batch.columns)))
        yield rows_of((0, CONTENT, own.number, 0, 0.0, pack(d=pa.array([data, keys], pa.binary()))))

    def send(group: pa.Table) -> pa.Table:
        number = group["chunk"][0].as_py()
        answers, head = {}, None
        for kind, part, data in zip(group["kind"].to_pylist(), group["v"].to_pylist(), group["data"]):
            if kind == CONTENT:
                head = [x.as_py() for x in unpack(data.as_buffer())["d"]]
            else:
                answers[part] = spread(data.as_buffer(), 2 + DEPTH)
        if head is None:
            raise RuntimeError("answers for a chunk that is not there: its input changed between two runs of a task")
        flat, rank, lengths, learn, many = spread(head[0], 5)
        answers = [np.concatenate(c) for c in zip(*(answers[p] for p in sorted(answers)))]
        if len(answers[0]) != len(rank):
            raise RuntimeError(f"{len(rank)} words of a chunk were sent, {len(answers[0])} came back: its input changed between two runs of a task")
        c, code = answers[0][rank], codes.of(*answers[:2])[rank]
        place, row = places(lengths), np.repeat(np.arange(len(lengths)), lengths)
        word = np.where((code == NONE) & (c > 0), ONCE, code)[flat]
        ctx = np.where(c >= min_count, code, NONE)[flat]
        x = [np.zeros(len(flat), np.int64) for _ in range(DEPTH)]
        for m in range(min(depth, DEPTH)):
            x[m][m + 1 :] = np.where(place[m + 1 :] > m, ctx[: -m - 1], NONE)
            if m:
                x[m][x[m - 1] == NONE] = NONE
        before, gs = heavy.before(flat, place, many - 1), []
        for (at, keys, to), found in zip(next_words(before, rank[flat], heavy), answers[2:]):
            if len(keys) != len(found):
                raise RuntimeError("next words of a chunk do not fit their answers: its input changed between two runs of a task")
            gs.append(np.zeros(len(flat), np.int64))
            gs[-1][at] = found[to]
        first = np.ones(len(flat), np.int64)
        away = (place > 0) & (x[0] > 0)
        for m in range(DEPTH):
            behind = np.flatnonzero(before[m] >= 0)
            first[behind] = m + 2
            away[behind] = x[m + 1][behind] > 0 if m + 1 < depth else False
        out = []
        index = np.flatnonzero(away)
        where = deal(x, first, index) % np.uint64(parts)
        near = np.zeros(len(flat), np.int64)  # the longest heavy context, which stands for its words
        for m in range(DEPTH - 1):
            behind = np.flatnonzero(before[m] >= 0)
            near[behind] = 1 + before[m][behind] * (DEPTH - 1) + m
            x[m][behind] = NONE
        order = np.argsort(where.astype(np.uint16 if parts < 1 << 16 else np.uint32), kind="stable")
        index, edges = index[order], np.searchsorted(where[order], np.arange(parts + 1))
        flags = learn[row] + 2 * (number < asked)
        for part in np.flatnonzero(np.diff(edges)):
            i = index[edges[part] : edges[part + 1]]
            i = i[np.argsort(first[i], kind="stable")]
            step = np.diff(row[i], prepend=0)
            columns = [*(a[i] for a in x), word[i], step & 0xFFFFFFFF, flags[i], near[i], *(gs[m][i] for m in range(DEPTH - 1))]
            out.append((int(part), TOKENS, number, 0, 0.0, squeeze(*columns)))
        if number < asked:
            base = np.log10((c[flat] + 0.1) / smooth)
            stay = np.flatnonzero(~away & (place > 0))
            p = (c[flat[stay]] + 0.1) / smooth
            for m in range(depth):
                j = before[m][stay]
                at = np.flatnonzero(j >= 0)
                j, g = j[at], gs[m][stay[at]]
                p[at] = np.where(kept[m][j], (g + PRIOR * p[at]) / (totals[m][j] + PRIOR), p[at])
            starts = np.cumsum(lengths) - lengths
            sums = lambda v: np.add.reduceat(np.where(place > 0, v, 0), starts)
            about = pack(n=lengths - 1, known=sums(c[flat] > 0).astype(np.int64), base=sums(base), own=np.bincount(row[stay], weights=np.log10(p), minlength=len(lengths)).astype(np.float64))
            out.append((-1 - number, CONTENT, number, 0, 0.0, pack(d=pa.array([head[1], about], pa.binary()))))
        return pa.Table.from_batches([rows_of(*out)] if out else [], schema=rows_of((0, 0, 0, 0, 0.0, b"")).schema)

    def part_scores(part: int, chunks: list[int], blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        width = 2 * DEPTH + 3
        size = sum(int(np.frombuffer(b, np.uint32, 1)[0]) for b in blobs)
        pieces = -(-size // AT_ONCE)
        ids, sums = [], []
        for piece in range(pieces):
            each = []
            for i, b in enumerate(blobs):
                columns = spread(b, width)
                columns[DEPTH + 1] = (np.cumsum(columns[DEPTH + 1]) & 0xFFFFFFFF) | i << 32
                near = columns[DEPTH + 3]
                first = first_of(near)
                behind = np.flatnonzero(near)
                columns[0][behind] = near[behind] + (1 << 39)  # no word's code
                for m in range(1, DEPTH - 1):
                    columns[m][first > m + 1] = 1
                if pieces > 1:
                    at = np.flatnonzero(deal(columns, first, np.arange(len(first))) // np.uint64(parts) % np.uint64(pieces) == piece)
                    columns = [a[at] for a in columns]
                each.append(columns)
            columns = [np.concatenate(a) for a in zip(*each)]
            del each
            x, word, at, flags = columns[:DEPTH], *columns[DEPTH : DEPTH + 3]
            p = subtree(x, word, flags, columns[DEPTH + 3], columns[DEPTH + 4 :], (codes, n_tokens, smooth, kept, totals, heavy.above), rules)
            own = flags > 1
            found, to = np.unique(at[own], return_inverse=True)
            ids.append(found), sums.append(np.bincount(to, weights=np.log10(p[own]), minlength=len(found)))
        found, to = np.unique(np.concatenate(ids), return_inverse=True)
        sums = np.bincount(to, weights=np.concatenate(sums), minlength=len(found)).astype(np.float64)
        edges = np.searchsorted(found >> 32, np.arange(len(chunks) + 1))
        for i, chunk in enumerate(chunks):
            a, b = edges[i], edges[i + 1]
            if a < b:
                yield rows_of((0, SUMS, chunk, part, 0.0, squeeze(np.diff(found[a:b] & 0xFFFFFFFF, prepend=0), sums[a:b].view(np.uint64))))

    def assemble(group: pa.Table) -> pa.Table:
        sums, head = {}, None
        for kind, part, data in zip(group["kind"].to_pylist(), group["v"].to_pylist(), group["data"].to_pylist()):
            if kind == CONTENT:
                head = [unpack(x.as_buffer()) for x in unpack(data)["d"]]
            else:
                sums[part] = data
        keys, about = head
        n = about["n"].to_numpy()
        total = about["own"].to_numpy().copy()
        for part in sorted(sums):
            steps, own = spread(sums[part], 2)
            total[np.cumsum(steps)] += own.view(np.float64)
        return pa.table([*(keys[c] for c in names), pa.array(n), about["known"], pa.array(np.full(len(n), n_tokens, np.int64)), about["base"], pa.array(total)],
                        names=[*names, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = ", ".join([*(f"{n} {fields[n].dataType.simpleString()}" for n in names), "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"])
    answers = model.answers.where(F.col("kind") == ANSWERS)
    sent = chunked(model.sources, contents, ROWS).union(answers).groupBy("chunk").applyInArrow(send, ROWS)
    out = met(sent).mapInArrow(by_part(part_scores, TOKENS), ROWS).groupBy("chunk").applyInArrow(assemble, schema)
    return out.toDF(*columns, *out.columns[len(names):])


def deal(x: list[np.ndarray], first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A number of the shortest context that is not heavy, in front of each token of at."""
    out = x[0][at].astype(np.uint64) * TURN
    for m in range(1, DEPTH):
        deep = np.flatnonzero(first[at] > m)
        out[deep] = (out[deep] ^ out[deep] >> np.uint64(29)) * TURN + x[m][at[deep]].astype(np.uint64)
    out = (out ^ out >> np.uint64(32)) * TURN
    return out >> np.uint64(20)


def op3_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", (fold("doc_id", 10) == 0).alias("held_out"))
    model = train(docs, text="text", learn=~F.col("held_out"))
    return score(docs, model, keep=("held_out",))
