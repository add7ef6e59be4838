"""Byte-level BPE: texts to token ids by a table of ranks, and ids back to bytes.

Encoding goes through the global distinct-word shuffle (``words``): texts are exploded into pre-tokens (the matches of the
pattern) with their positions, each distinct pre-token is encoded once, and the ids are joined back and put together
by position. Decoding joins each id to the bytes of its token; the token table is the vocabulary file, of fixed size.
"""
from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession, functions as F

from .mixing import positioned
from .tables import partitions, table
from .words import ROW, TEXTS, WORDS, binaries, exploded, gathered, met, pack, rows, texts_of, unpack

VOCABULARY = "byte_bpe_50k.tiktoken"
LONG = 1_000_000  # characters; longer texts are split match by match instead of into one list


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def pre_tokens(pattern: str):
    found = []  # compiled once per worker

    def split(text: str):
        if not found:
            found.append(regex.compile(pattern))
        return found[0].findall(text) if len(text) < LONG else (m[0] for m in found[0].finditer(text))

    return split


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN, key: str = "doc_id", text: str = "text",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """key, the columns to keep, n_tokens and ids (unsigned 32-bit little-endian numbers). A null text has no tokens."""
    columns = [key, *keep]
    rows_in = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)], F.col(text).alias("t"))
    names = rows_in.columns[:-1]
    parts = 2 * partitions(docs.sparkSession)
    words = met(exploded(rows_in, "t", names, pre_tokens(pattern), parts, kinds=(WORDS,)))
    sequences = exploded(rows_in, "t", names, pre_tokens(pattern), parts, kinds=(TEXTS,))

    def encode_words(batches):
        encoding, known = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), {}
        part = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                if row["part"][0].as_py() != part:
                    part, known = row["part"][0].as_py(), {}
                own_words = unpack(row["data"][0].as_buffer())["w"].to_pylist()
                for w in own_words:
                    if w not in known:
                        known[w] = encoding.encode_ordinary(w.decode())
                ids = [known[w] for w in own_words]
                flat = np.fromiter((x for own in ids for x in own), np.int64)
                data = pack(n=[np.fromiter(map(len, ids), np.int32)], ids=[flat.astype(np.uint16 if flat.max(initial=0) < 65536 else np.uint32)])
                yield rows((0, row["chunk"][0].as_py(), part, row["kind"][0].as_py(), data))

    def assemble(group: pa.Table) -> pa.Table:
        keys, lengths, slots, placed = texts_of(group)
        n_words = sum(len(s) for s, _ in placed.values())
        start, size, pieces, at = np.zeros(n_words, np.int64), np.zeros(n_words, np.int64), [], 0
        for own, values in placed.values():
            n, ids = values["n"][0].values.to_numpy().astype(np.int64), values["ids"][0].values.to_numpy()
            start[own], size[own] = at + np.cumsum(n) - n, n
            pieces.append(ids.astype("<u4"))
            at += len(ids)
        flat = np.concatenate(pieces) if pieces else np.zeros(0, "<u4")
        ids = flat[gathered(start[slots], size[slots])]
        ends = np.concatenate([[0], np.cumsum(size[slots])])
        edges = np.concatenate([[0], np.cumsum(lengths)])
        n = ends[edges[1:]] - ends[edges[:-1]]
        return pa.table([*keys.values(), pa.array(n), binaries(ids.view(np.uint8), n * 4)], names=[*keys, "n_tokens", "ids"])

    fields = [f"{n} {rows_in.schema[n].dataType.simpleString()}" for n in names]
    out = words.mapInArrow(encode_words, ROW).union(sequences).groupBy("chunk").applyInArrow(assemble, ", ".join([*fields, "n_tokens bigint, ids binary"]))
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, columns)], "n_tokens", "ids")


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids", name: str = "decoded") -> DataFrame:
    """All columns, and the bytes of the ids. An id beyond the table is an error."""
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    lengths = np.array([len(t) for t in tokens], np.int64)
    starts, data = np.cumsum(lengths) - lengths, np.frombuffer(b"".join(tokens), np.uint8)
    at = encoded.columns.index(ids)

    def join(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                each = [np.frombuffer(x.as_buffer() or b"", "<u4") for x in part.column(at)]
                flat = np.concatenate(each).astype(np.int64)
                size = lengths[flat]
                ends = np.concatenate([[0], np.cumsum(size)])
                edges = np.concatenate([[0], np.cumsum([len(e) for e in each])])
                out = binaries(data[gathered(starts[flat], size)], ends[edges[1:]] - ends[edges[:-1]])
                yield pa.RecordBatch.from_arrays([*part.columns, out], names=[*(f"c{j}" for j in range(part.num_columns)), "out"])

    renamed = encoded.toDF(*[f"c{i}" for i in range(len(encoded.columns))])
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in renamed.schema), "out binary"])
    return renamed.mapInArrow(join, schema).toDF(*encoded.columns, name)


def digests(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    ranks = load_ranks(public_tokenizers.path(VOCABULARY))
    both = decode(encode(docs, ranks, keep=keep), ranks)
    return both.select("doc_id", *keep, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents"))


def bpe_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document with its position in the mixed order, its number of tokens and the digests of its ids and decoded bytes."""
    return digests(positioned(docs.select("doc_id", "text")), keep=("position",))
