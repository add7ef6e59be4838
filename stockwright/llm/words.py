"""The global distinct-word shuffle.

Tasks cut their rows into chunks of bounded size. A chunk's texts are exploded into words with their positions: each
distinct word of the chunk gets a slot (frequent words first), and each text becomes its sequence of slots. Two kinds
of rows leave a chunk: its distinct words, dealt by their hash into ``parts``, and one row with the slot sequences.
All rows of a part meet in one task, where a value is found once for each distinct word, whichever chunks hold it; the
values then go back to their chunk, and are put at the positions of its words.

A word is sent once per chunk, so the most frequent words cost no more than others. Chunks are numbered by partition
and place; the rows must therefore come in the same order if a task runs again, as they do from files. Write other input
to a table first (``tables.held``).
"""
from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tables import partitions, small_batches

CHUNK = 6_000_000  # characters; a longer text is a chunk of its own
ROW = "to bigint, chunk bigint, part int, kind int, data binary"
VALUES, WORDS, TEXTS = 0, 1, 2
NO_PART = -1


def pack(**columns) -> bytes:
    batch = pa.RecordBatch.from_pydict({n: c if isinstance(c, pa.Array) else pa.array(c) for n, c in columns.items()})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(data) -> dict[str, pa.Array]:
    batch = pa.ipc.open_stream(data).read_next_batch()
    return dict(zip(batch.schema.names, batch.columns))


def rows(*found: tuple[int, int, int, int, bytes]) -> pa.RecordBatch:
    to, chunk, part, kind, data = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), pa.array(chunk, pa.int64()), pa.array(part, pa.int32()), pa.array(kind, pa.int32()),
                                       pa.array(data, pa.binary())], names=["to", "chunk", "part", "kind", "data"])


def part_of(word: bytes, parts: int) -> int:
    return zlib.crc32(word) % parts


class Chunk:
    """Texts as slot sequences over the chunk's own distinct words."""

    def __init__(self):
        self.slots: dict = defaultdict()
        self.slots.default_factory = self.slots.__len__
        self.texts: list[np.ndarray] = []
        self.keys: list[pa.RecordBatch] = []
        self.measured: list[float | None] = []
        self.size = 0

    def add(self, keys: pa.RecordBatch, words: Iterable, length: int, measured: float | None = None, bag: bool = False) -> None:
        count = len(words) if isinstance(words, list) else -1
        slots = np.fromiter(map(self.slots.__getitem__, words), np.int32, count)
        self.texts.append(np.sort(slots) if bag else slots)
        self.keys.append(keys)
        self.measured.append(measured)
        self.size += length

    def emit(self, number: int, parts: int, kinds: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
        flat = np.concatenate(self.texts) if self.texts else np.zeros(0, np.int32)
        order = np.argsort(-np.bincount(flat, minlength=len(self.slots)), kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        flat = place[flat]
        words = list(self.slots)
        words = [words[i] if isinstance(words[i], bytes) else words[i].encode("utf-8", "surrogatepass") for i in order]
        part = np.fromiter((part_of(w, parts) for w in words), np.int32, len(words))
        by_part = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[by_part], np.arange(parts + 1))
        for p in range(parts if WORDS in kinds else 0):
            if edges[p] < edges[p + 1]:
                own = [words[i] for i in by_part[edges[p] : edges[p + 1]]]
                yield rows((p, number, p, WORDS, pack(w=pa.array(own, pa.binary()))))
        if TEXTS not in kinds:
            return
        keys = pa.Table.from_batches(self.keys).combine_chunks().to_batches()[0]
        texts = pack(low=(flat & 0xFFFF).astype(np.uint16), high=(flat >> 16).astype(np.uint16))
        about = pack(part=part)
        lengths = {n: c for n, c in zip(keys.schema.names, keys.columns)}
        if self.measured and self.measured[0] is not None:
            lengths["measured"] = pa.array(self.measured, pa.float64())
        own = pack(**lengths, __n=np.array([len(t) for t in self.texts], np.int64))
        yield rows((-1 - number, number, NO_PART, TEXTS, pack(d=pa.array([own, texts, about], pa.binary()))))


def exploded(docs: DataFrame, text: str, keep: list[str], split: Callable[[str], Iterable], parts: int, chunk: int = CHUNK,
             measure: Callable[[Iterable], float] | None = None, bag: bool = False, kinds: tuple[int, ...] = (WORDS, TEXTS)) -> DataFrame:
    """The rows of ROW for all texts; keep: further columns, which come back with each text. A null text counts as empty.

    measure: a number taken from a text's words, which comes back as "measured". bag: the order of words is not needed.
    kinds: which of the two kinds of rows to make; made apart, slot sequences need not go through the shuffle by part.
    """

    def explode(batches):
        number, own = -1, Chunk()
        for batch in batches:
            if number < 0 and batch.num_rows:
                number = batch["__part"][0].as_py() << 24
            keys, texts = batch.select(keep), batch[text]
            for i in range(batch.num_rows):
                t = texts[i].as_py() or ""
                if own.size and own.size + len(t) > chunk:
                    yield from own.emit(number, parts, kinds)
                    number, own = number + 1, Chunk()
                words = split(t)
                own.add(keys.slice(i, 1), words, len(t) + 1, measure(words) if measure else None, bag)
        if own.size:
            yield from own.emit(number, parts, kinds)

    small_batches(docs.sparkSession)
    # The partition's number within this scan: a task's own number shifts where two scans are united.
    return docs.select(*keep, text, F.spark_partition_id().alias("__part")).mapInArrow(explode, ROW)


def met(found: DataFrame) -> DataFrame:
    """The rows of a part side by side, values before words."""
    return found.repartition(partitions(found.sparkSession), "to").sortWithinPartitions("to", "kind", "chunk")


def texts_of(group: pa.Table) -> tuple[dict[str, pa.Array], np.ndarray, np.ndarray, dict[int, dict]]:
    """Of a chunk's rows: the kept columns, words per text, all slots, and by part (slots of the part, values)."""
    kinds, part, data = group["kind"].to_pylist(), group["part"].to_pylist(), group["data"]
    values, head = {}, None
    for i, (k, p) in enumerate(zip(kinds, part)):
        content = unpack(data[i].as_buffer())
        if k == TEXTS:
            head = [unpack(x.as_buffer()) for x in content["d"]]
        else:
            values[p] = content
    keys, slots, about = head
    flat = slots["low"].to_numpy().astype(np.int64) | slots["high"].to_numpy().astype(np.int64) << 16
    of = about["part"].to_numpy()
    by_part = np.argsort(of, kind="stable")
    names, starts = np.unique(of[by_part], return_index=True)
    ends = np.append(starts[1:], len(of))
    if len(names) != len(values):
        raise RuntimeError(f"{len(names)} parts of a chunk's words were sent, {len(values)} came back: its input changed between two runs of a task")
    placed = {int(p): (by_part[a:b], values[int(p)]) for p, a, b in zip(names, starts, ends)}
    lengths = keys.pop("__n").to_numpy()
    return keys, lengths, flat, placed


def gathered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... for each piece, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def binaries(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Consecutive pieces of the bytes, of the given lengths."""
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    if offsets[-1] < 1 << 31:
        return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
    raise ValueError("a chunk's result is over 2 GB")


