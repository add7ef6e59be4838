"""Cross-tokenizer alignment: which ids of one tokenizer stand for the same bytes as which ids of another.

Both tokenizers encode a text; where tokens of both end at one byte, the text is cut into groups, and every token of the
one side in a group is linked with every token of the other. A pair of ids counts the texts that hold it linked.

First pass: tasks cut their rows into chunks. Where no token of either side can cross a single space between words (the
vocabularies tell), texts are sequences of segments, and each distinct segment of a chunk is encoded and aligned once; a
text with a segment that does not come back byte by byte is encoded as a whole. The sequences, the segments' ids and the
chunk's distinct pairs with their counts, dealt by the first id, are written as a table. A part then has all pairs of its
ids. It builds a minimal perfect hash of its distinct pairs, level by level: pairs alone in a cell of the level's bit array
are placed, the others go on to the next array. Count vectors indexed by the hash are dense; blocks of chunks are summed into one each, and these by a tree. Every
index is verified against the key stored there. The part answers each chunk with the counts of its pairs, and marks those
that no pair of the same first id exceeds. Second pass: the chunk's ids are aligned again, the counts looked up, and
both summed and joined over each text's segments.

Texts that are null or empty, or that a tokenizer does not give back byte by byte (with the leading space), have no tokens.
Repeated rows count as texts of their own; keys are only carried. A vocabulary is of fixed size, so all pairs of an id are.
"""
from __future__ import annotations

import json
import os
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import held, partitions, small_batches, table
from .words import NO_PART, ROW, TEXTS, WORDS, gathered, met, pack, rows, unpack

CHUNK = 4_000_000  # characters; a longer text is a chunk of its own
TOGETHER = 8192  # texts given to a tokenizer at once
REMEMBERED = 250_000  # segments whose ids a task keeps from chunk to chunk
LARGE = 1 << 16  # links of one group; beyond, equal ids of the group are linked once, with their number
BLOCK = 64  # rows summed into one dense vector
VOCABULARIES = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: visible ones themselves, the others from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """A byte-level tokenizer from its JSON file; it gets the text behind a space.

    ASCII texts go to a quicker encoder of the same ranks, if the file's merges come in the order of their ids. (Other
    texts do not: which characters count as letters may differ between the two libraries.)
    """

    def __init__(self, data: bytes):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(data.decode())
        self.tokenizer.encode_special_tokens = True
        self.cut_at_spaces = type(self.tokenizer.pre_tokenizer).__name__ == "ByteLevel" and self.tokenizer.pre_tokenizer.use_regex and self.tokenizer.normalizer is None
        letters = byte_letters()
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.tokens = [bytes(letters[c] for c in name) for name in names]
        ids, model = self.tokenizer.get_vocab(with_added_tokens=False), json.loads(data)["model"]
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        self.quick = None
        if self.cut_at_spaces and not model.get("ignore_merges") and [ids.get(m) for m in merges] == list(range(256, 256 + len(merges))):
            ranks = {self.tokens[i]: i for i in range(256 + len(merges))}
            self.quick = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        out = [self.quick.encode_ordinary(" " + t) if t.isascii() else None for t in texts] if self.quick else [None] * len(texts)
        left = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(left, self.tokenizer.encode_batch_fast([" " + texts[i] for i in left], add_special_tokens=False)):
            out[i] = e.ids
        return out


class Pieces:
    """A sentence-piece model from its file; it adds the space itself."""

    def __init__(self, data: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        names = [(i, self.model.id_to_piece(i)) for i in range(self.model.get_piece_size())]
        self.cut_at_spaces = not any("▁" in name.lstrip("▁") for _, name in names)
        self.tokens = [bytes([int(name[3:-1], 16)]) if self.model.is_byte(i) else name.replace("▁", " ").encode() for i, name in names]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def tokenizer(name: str, data: bytes) -> ByteLevel | Pieces:
    return ByteLevel(data) if name.endswith(".json") else Pieces(data)


class Bytes:
    """The bytes of a tokenizer's ids."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[gathered(self.start[ids], self.size[ids])]


def segments(text: str) -> list[str]:
    """The text cut at single spaces between other characters, where no token of either tokenizer can cross."""
    return re.split(r"(?<=\S) (?=\S)", text)


def encoded(texts: list[str], sides: tuple, of: tuple[Bytes, Bytes]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Both sides' ids, one text after the other, their numbers per text, and whether both give back the text's bytes."""
    flat, n, fine = ([], []), ([], []), []
    for at in range(0, len(texts), TOGETHER):
        block = texts[at : at + TOGETHER]
        want = [b" " + t.encode() for t in block]
        length = np.array([len(w) for w in want])
        ok = np.ones(len(block), bool)
        for s, (side, table_) in enumerate(zip(sides, of)):
            ids = side.encode(block)
            n[s].append(np.array([len(x) for x in ids], np.int64))
            flat[s].append(np.fromiter(chain.from_iterable(ids), np.int64, int(n[s][-1].sum())))
            ends = np.concatenate([[0], np.cumsum(table_.size[flat[s][-1]])])
            edges = np.concatenate([[0], np.cumsum(n[s][-1])])
            long_enough = ends[edges[1:]] - ends[edges[:-1]] == length
            same = table_.joined(flat[s][-1][np.repeat(long_enough, n[s][-1])]) == np.frombuffer(b"".join(w for w, o in zip(want, long_enough) if o), np.uint8)
            wrong = np.bincount(np.repeat(np.flatnonzero(long_enough), length[long_enough])[~same], minlength=len(block))
            ok &= long_enough & (wrong == 0)
        fine.append(ok)
    return [np.concatenate([np.zeros(0, np.int64), *x]) for x in flat], [np.concatenate([np.zeros(0, np.int64), *x]) for x in n], np.concatenate([np.zeros(0, bool), *fine])


class Encoder:
    """The segments a task has met, each encoded once; forgotten when they become many."""

    def __init__(self, sides: tuple, of: tuple[Bytes, Bytes]):
        self.sides, self.of = sides, of
        self.cut = segments if all(side.cut_at_spaces for side in sides) else lambda text: [text]
        self.forget()

    def forget(self) -> None:
        self.slots: dict[str, int] = defaultdict()
        self.slots.default_factory = self.slots.__len__
        self.flat, self.n, self.ok = [np.zeros(0, np.int32)] * 2, [np.zeros(0, np.int32)] * 2, np.zeros(0, bool)

    def __call__(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Each text's segments by number, and of all numbers what ``encoded`` gives."""
        if len(self.slots) > REMEMBERED:
            self.forget()
        each = [np.fromiter(map(self.slots.__getitem__, self.cut(t)), np.int64) if t else np.zeros(0, np.int64) for t in texts]
        flat, n, ok = encoded(list(islice(self.slots, len(self.ok), None)), self.sides, self.of)
        self.flat, self.n = [np.concatenate([x, y.astype(np.int32)]) for x, y in zip(self.flat, flat)], [np.concatenate([x, y.astype(np.int32)]) for x, y in zip(self.n, n)]
        self.ok = np.concatenate([self.ok, ok])
        return each, self.flat, self.n, self.ok


class Segments:
    """A chunk's texts as sequences of its distinct segments, with both sides' ids of each segment."""

    def __init__(self, texts: list[str | None], encoder: Encoder):
        each, flat, n, ok = encoder(texts)
        slots = len(ok)
        broken = [i for i, own in enumerate(each) if not ok[own].all()]
        if broken:  # a text that is not given back piece by piece is tried as a whole
            more, more_n, whole_ok = encoded([texts[i] for i in broken], encoder.sides, encoder.of)
            for k, i in enumerate(broken):
                each[i] = np.array([slots + k] if whole_ok[k] else [], np.int64)
            flat, n = [np.concatenate(x) for x in zip(flat, more)], [np.concatenate(x) for x in zip(n, more_n)]
        self.lengths = np.array([len(own) for own in each], np.int64)
        used, place, often = np.unique(np.concatenate(each), return_inverse=True, return_counts=True)
        order = np.argsort(-often, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.places, used = rank[place], used[order]
        n = [m.astype(np.int64) for m in n]
        self.ids = [x[gathered((np.cumsum(m) - m)[used], m[used])].astype(np.int64) for x, m in zip(flat, n)]
        self.sizes = [m[used] for m in n]


class Alignment:
    """Groups and links of a chunk's texts: the ids of both sides, one text after the other, and their numbers per text."""

    def __init__(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, of: tuple[Bytes, Bytes]):
        self.a, self.b, self.n_a, self.n_b, self.room = a, b, n_a, n_b, len(of[1].size)
        end_a, end_b = np.cumsum(of[0].size[a]), np.cumsum(of[1].size[b])
        common = end_a[np.isin(end_a, end_b, assume_unique=True)] if len(end_a) else end_a
        self.group_a, self.group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        self.in_a, self.in_b = (np.bincount(g, minlength=len(common)) for g in (self.group_a, self.group_b))
        self.from_a, self.from_b = np.cumsum(self.in_a) - self.in_a, np.cumsum(self.in_b) - self.in_b
        self.text_of = np.repeat(np.arange(len(n_a)), n_a)[self.from_a] if len(common) else np.zeros(0, np.int64)
        self.n_groups = np.bincount(self.text_of, minlength=len(n_a))
        self.n_links = self.per_text(self.in_a * self.in_b)

    def per_text(self, of_groups: np.ndarray) -> np.ndarray:
        edges = np.searchsorted(self.text_of, np.arange(len(self.n_a) + 1))
        return np.diff(np.concatenate([[0], np.cumsum(of_groups)])[edges])

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, times) of all links."""
        large = self.in_a * self.in_b > LARGE
        own = np.flatnonzero(~large[self.group_a])
        group = self.group_a[own]
        times = self.in_b[group]
        found = [(np.repeat(self.text_of[group], times), np.repeat(self.a[own], times) * self.room + self.b[gathered(self.from_b[group], times)], np.ones(int(times.sum()), np.int64))]
        for g in np.flatnonzero(large):
            a, at = np.unique(self.a[self.from_a[g] :][: self.in_a[g]], return_counts=True)
            b, bt = np.unique(self.b[self.from_b[g] :][: self.in_b[g]], return_counts=True)
            found.append((np.full(len(a) * len(b), self.text_of[g]), (a[:, None] * self.room + b).ravel(), (at[:, None] * bt).ravel()))
        text, pair, times = (np.concatenate(c) for c in zip(*found))
        return text, pair, times

    def written(self, names: tuple[list[str], list[str]]) -> list[str]:
        """Each text's groups as a1,a2|b1;a3|b2,b3. names: by id with a comma and with the closing sign, in turn."""
        last_a, last_b = (np.diff(g, append=-1) != 0 for g in (self.group_a, self.group_b))
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[np.arange(len(self.a)) + self.from_b[self.group_a]] = self.a * 2 + last_a
        code[np.arange(len(self.b)) + (self.from_a + self.in_a)[self.group_b]] = len(names[0]) + self.b * 2 + last_b
        all_names = [*names[0], *names[1]]
        ends = np.cumsum(self.n_a + self.n_b)
        return ["".join(map(all_names.__getitem__, code[a:b].tolist()))[:-1] for a, b in zip((ends - self.n_a - self.n_b).tolist(), ends.tolist())]


class PerfectHash:
    """Distinct keys to 0, 1, 2, ... without gaps; keys that were not among them go anywhere, so verify."""

    def __init__(self, keys: np.ndarray, load: float = 1.5):
        self.levels, rest = [], keys
        while len(rest):
            cells = max(16, int(load * len(rest)))
            at = self.cell(rest, len(self.levels), cells)
            alone = np.bincount(at, minlength=cells) == 1
            self.levels.append(alone)
            rest = rest[~alone[at]]
        counted = np.cumsum([int(x.sum()) for x in self.levels])
        self.ranks = [np.cumsum(x) - 1 + (n - int(x.sum())) for x, n in zip(self.levels, counted)]

    @staticmethod
    def cell(keys: np.ndarray, level: int, cells: int) -> np.ndarray:
        x = keys.astype(np.uint64) + np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(cells)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out, open_ = np.zeros(len(keys), np.int64), np.arange(len(keys))
        for level, (alone, rank) in enumerate(zip(self.levels, self.ranks)):
            at = self.cell(keys[open_], level, len(alone))
            hit = alone[at]
            out[open_[hit]] = rank[at[hit]]
            open_ = open_[~hit]
        return out


def tree_sum(vectors: Iterator[np.ndarray]) -> np.ndarray:
    """Vectors added two and two; as many are held as the tree has levels."""
    held_back: list[tuple[int, np.ndarray]] = []
    for v in vectors:
        level = 0
        while held_back and held_back[-1][0] == level:
            v, level = held_back.pop()[1] + v, level + 1
        held_back.append((level, v))
    while len(held_back) > 1:
        held_back[-2:] = [(held_back[-2][0], held_back[-2][1] + held_back[-1][1])]
    return held_back[0][1]


class PairCounts:
    """The counts of a part's pairs, found through a perfect hash."""

    def __init__(self, sent: list[bytes], room: int):
        """sent: per chunk its pairs and counts."""
        distinct = np.zeros(0, np.int64)
        for i in range(0, len(sent), BLOCK):
            distinct = distinct_of(np.concatenate([distinct, *(self.read(x)[0] for x in sent[i : i + BLOCK])]))
        self.hash = PerfectHash(distinct)
        self.keys = np.empty(len(distinct), np.int64)
        self.keys[self.hash(distinct)] = distinct

        def blocks():
            for i in range(0, len(sent), BLOCK):
                dense = np.zeros(len(distinct), np.int64)
                for x in sent[i : i + BLOCK]:
                    pair, n = self.read(x)
                    dense[self.index(pair)] += n
                yield dense

        self.counts = tree_sum(blocks())
        first = self.keys // room
        highest = np.zeros(int(first.max()) + 1, np.int64)
        np.maximum.at(highest, first, self.counts)
        self.best = self.counts == highest[first]

    @staticmethod
    def read(data: bytes) -> tuple[np.ndarray, np.ndarray]:
        own = unpack(data)
        return np.cumsum(own["step"].to_numpy().astype(np.int64)), own["n"].to_numpy().astype(np.int64)

    def index(self, pairs: np.ndarray) -> np.ndarray:
        at = self.hash(pairs)
        if (self.keys[at] != pairs).any():
            raise KeyError("a pair that was not counted")
        return at


def fitting(x: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 on in as few bytes as hold the largest."""
    most = int(x.max(initial=0))
    return x.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.int64)


def part_of_ids(ids: np.ndarray, parts: int) -> np.ndarray:
    return ids * 0x9E3779B1 % (1 << 32) % parts


def split_bytes(x: np.ndarray) -> dict[str, np.ndarray]:
    """Low and high bytes apart, which compress better."""
    return {"low": (x & 255).astype(np.uint8), "high": fitting(x >> 8)}


def joined_bytes(columns: dict[str, pa.Array]) -> np.ndarray:
    return columns["low"].to_numpy().astype(np.int64) | columns["high"].to_numpy().astype(np.int64) << 8


def distinct_of(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.diff(x, prepend=x[:1] - 1) != 0]


def texts_with(pair: np.ndarray, segment: np.ndarray, places: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs, and how many texts hold each. pair, segment: all links; places, lengths: the segments of the texts."""
    distinct, index = np.unique(pair, return_inverse=True)
    once = distinct_of(segment * len(distinct) + index)
    segment, index = once // max(len(distinct), 1), once % max(len(distinct), 1)
    n = int(places.max(initial=-1)) + 1
    held_by = distinct_of(np.repeat(np.arange(len(lengths)), lengths) * n + places)
    text, own = held_by // max(n, 1), held_by % max(n, 1)
    start = np.searchsorted(segment, np.arange(n))
    many = np.searchsorted(segment, np.arange(n), "right") - start
    both = distinct_of(np.repeat(text, many[own]) * len(distinct) + index[gathered(start[own], many[own])])
    return distinct, np.bincount(both % max(len(distinct), 1), minlength=len(distinct))


class Aligner:
    """The jobs of both passes for two tokenizers."""

    def __init__(self, paths: tuple[str, str]):
        self.names = [Path(p).name for p in paths]
        self.files = [Path(p).read_bytes() for p in paths]

    def sides(self) -> tuple[tuple, tuple[Bytes, Bytes]]:
        both = tuple(tokenizer(n, f) for n, f in zip(self.names, self.files))
        return both, tuple(Bytes(s.tokens) for s in both)

    def first_pass(self, docs: DataFrame, parts: int, chunk: int) -> DataFrame:
        """The rows of ROW: the pairs of each chunk by part, and its ids."""
        kept = [c for c in docs.columns if c not in ("t", "__part")]

        def cut(batches):
            sides, of = self.sides()
            encoder = Encoder(sides, of)

            def emit():
                found = Segments(texts, encoder)
                segment, pair, _ = Alignment(*found.ids, *found.sizes, of).links()
                pair, count = texts_with(pair, segment, found.places, found.lengths)
                part = part_of_ids(pair // len(of[1].size), parts)
                order = np.argsort(part, kind="stable")
                edges = np.flatnonzero(np.diff(part[order], prepend=-1, append=parts))
                for lo, hi in zip(edges[:-1], edges[1:]):
                    own = order[lo:hi]
                    p = int(part[own[0]])
                    yield rows((p, number, p, WORDS, pack(step=fitting(np.diff(pair[own], prepend=0)), n=fitting(count[own]))))
                columns = pa.Table.from_batches(keys).combine_chunks().to_batches()[0]
                own = pack(**dict(zip(columns.schema.names, columns.columns)), __n=found.lengths)
                sizes = pack(a=fitting(found.sizes[0]), b=fitting(found.sizes[1]))
                yield rows((-1 - number, number, NO_PART, TEXTS, pack(d=pa.array([own, sizes, *(pack(**split_bytes(x)) for x in (found.places, *found.ids))], pa.binary()))))

            number, texts, keys, size = -1, [], [], 0
            for batch in batches:
                if number < 0 and batch.num_rows:
                    number = batch["__part"][0].as_py() << 24
                for i, text in enumerate(batch["t"].to_pylist()):
                    if size and size + len(text or "") > chunk:
                        yield from emit()
                        number, texts, keys, size = number + 1, [], [], 0
                    texts.append(text)
                    keys.append(batch.select(kept).slice(i, 1))
                    size += len(text or "") + 1
            if texts:
                yield from emit()

        return docs.mapInArrow(cut, ROW)

    def counted(self, first: DataFrame, room: int, schema: str, each) -> DataFrame:
        """What each gives for a part's counts and its rows."""

        def count(batches):
            part, sent = None, []
            for batch in batches:
                for r in batch.to_pylist():
                    if r["part"] != part and sent:
                        yield from each(PairCounts([x["data"] for x in sent], room), sent)
                        sent = []
                    part = r["part"]
                    sent.append(r)
            if sent:
                yield from each(PairCounts([x["data"] for x in sent], room), sent)

        return met(first.where(F.col("kind") == WORDS)).mapInArrow(count, schema)

    def second_pass(self, parts: int):
        _, of = self.sides()

        def assemble(group: pa.Table) -> pa.Table:
            room = len(of[1].size)
            names = tuple([f"{i}{sign}" for i in range(len(b.size)) for sign in (",", close)] for b, close in zip(of, "|;"))
            head, answers = None, {}
            for kind, part, data in zip(group["kind"].to_pylist(), group["part"].to_pylist(), group["data"]):
                if kind == TEXTS:
                    head = [unpack(x.as_buffer()) for x in unpack(data.as_buffer())["d"]]
                else:
                    answers[part] = unpack(data.as_buffer())
            keys, places, lengths = head[0], joined_bytes(head[2]), head[0].pop("__n").to_numpy()
            sizes = [head[1][c].to_numpy().astype(np.int64) for c in "ab"]
            found = Alignment(joined_bytes(head[3]), joined_bytes(head[4]), *sizes, of)
            segment, pair, times = found.links()
            distinct, place = np.unique(pair, return_inverse=True)
            part = part_of_ids(distinct // room, parts)
            n, best = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), bool)
            if set(np.flatnonzero(np.bincount(part)).tolist()) != set(answers):
                raise RuntimeError("not every part answered: a chunk's input changed between two runs of a task")
            for p, own in answers.items():
                n[part == p], best[part == p] = own["n"].to_numpy(), own["best"].to_numpy(zero_copy_only=False)
            of_segment = lambda v: np.bincount(segment, v, minlength=len(sizes[0])).astype(np.int64) if len(v) and v.sum() < 1 << 53 else exact(v)

            def exact(v):
                out = np.zeros(len(sizes[0]), np.int64)
                np.add.at(out, segment, v)
                return out

            edges = np.concatenate([[0], np.cumsum(lengths)])
            per_text = lambda v: np.diff(np.concatenate([[0], np.cumsum(v[places])])[edges])
            out = [per_text(v) for v in (*sizes, found.n_groups, found.n_links, of_segment(times * best[place]), of_segment(times * n[place]))]
            written, places = found.written(names), places.tolist()
            groups = [";".join(map(written.__getitem__, places[a:b])) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
            return pa.table([*keys.values(), *map(pa.array, out), pa.array(groups, pa.string())], names=[*keys, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

        return assemble


class Aligned:
    """The alignment of a table's texts: ``texts`` has a row per text, ``pairs`` one per linked pair of ids."""

    def __init__(self, docs: DataFrame, paths: tuple[str, str], key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), chunk: int = CHUNK):
        spark = docs.sparkSession
        small_batches(spark)
        self.columns = [key, *keep]
        rows_in = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(self.columns)], F.col(text).alias("t"), F.spark_partition_id().alias("__part"))
        self.fields = [f"{n} {rows_in.schema[n].dataType.simpleString()}" for n in rows_in.columns[:-2]]
        self.aligner, self.parts = Aligner(paths), 2 * partitions(spark)
        self.room = len(self.aligner.sides()[1][1].size)
        self.first = held(self.aligner.first_pass(rows_in, self.parts, chunk), "aligned")

    def texts(self) -> DataFrame:
        """Key, columns to keep, n_a, n_b, n_groups, n_links, n_best, count_sum and groups, written as a1,a2|b1;a3|b2,b3."""

        def answer(counts, sent):
            for r in sent:
                at = counts.index(counts.read(r["data"])[0])
                yield rows((0, r["chunk"], r["part"], WORDS, pack(n=fitting(counts.counts[at]), best=counts.best[at])))

        answers = self.aligner.counted(self.first, self.room, ROW, answer)
        schema = ", ".join([*self.fields, "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string"])
        out = answers.union(self.first.where(F.col("kind") == TEXTS)).groupBy("chunk").applyInArrow(self.aligner.second_pass(self.parts), schema)
        return out.toDF(*self.columns, *out.columns[len(self.columns) :])

    def pairs(self) -> DataFrame:
        """(a, b, n, best): how many texts hold the pair linked, and whether no other pair of that a is in more."""
        room = self.room

        def listed(counts, sent):
            columns = [counts.keys // room, counts.keys % room, counts.counts, counts.best]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "n", "best"])

        return self.aligner.counted(self.first, room, "a bigint, b bigint, n bigint, best boolean", listed)


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = tuple(public_tokenizers.path(v) for v in VOCABULARIES)
    found = Aligned(table(spark, folder, "documents"), paths).texts()
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))
