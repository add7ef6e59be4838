"""Repeated passages against a plain set of windows."""
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockwright.llm import passages
from stockwright.llm.tables import held

SCHEMA = "doc_id bigint, text string"


def plain(docs, length):
    """Rows in order of their key, nulls last; rows with equal keys as given."""
    seen, out = set(), []
    for key, text in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        edges = [i for i in range(len(raw) + 1) if (gone[i - 1] if i else 0) != (gone[i] if i < len(raw) else 0)]
        spans = tuple(zip(edges[::2], edges[1::2]))
        out.append((key, len(raw), sum(gone), spans, bytes(c for c, g in zip(raw, gone) if not g)))
    return Counter(out)


def found(df, **how):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, tuple((s.start, s.stop) for s in r.spans), bytes(r.kept)) for r in passages.remove_repeats(df, **how).collect())


def some_texts(seed, letters, n=60):
    draw = random.Random(seed)
    base = ["".join(draw.choices(letters, k=300)) for _ in range(6)]
    for i in range(n):
        parts = [b[(at := draw.randrange(250)) : at + draw.randrange(60)] for b in draw.choices(base, k=5)]
        yield 3 * i + draw.randrange(3), "".join(parts) + "a" * draw.randrange(40)


@pytest.mark.parametrize("letters, length, gram, chunk", [("ab", 12, 4, 300), ("abcdefgh ", 8, 3, 10**6), ("äß漢 x", 20, 7, 500)])
def test_against_plain(spark, letters, length, gram, chunk):
    docs = list(some_texts(length, letters)) + [(900, None), (901, ""), (902, letters), (None, "no key " * 9), (-5, "no key " * 3)]
    random.Random(1).shuffle(docs)
    df = spark.createDataFrame(docs, SCHEMA)
    for name in ("k", "t", "chunk", "part", "kind", "doc", "n_bytes", "kept", "spans", "__part"):
        df = df.withColumn(name, F.lit(1))
    assert found(held(df.repartition(3), "docs"), length=length, gram=gram, chunk=chunk, part=2000) == plain(docs, length)


def test_slices_and_blocks(spark, monkeypatch):
    """Long texts, cut into slices and blocks, next to copies of themselves."""
    draw = random.Random(5)
    long = "".join(draw.choices("abcdef", k=9000))
    docs = [(1, long), (2, "a" * 4000), (3, long[2000:7000] + "x" + long[1:3000]), (4, "ab" * 2000)]
    monkeypatch.setattr(passages, "SLICE", 1 << 10)
    assert found(held(spark.createDataFrame(docs, SCHEMA), "docs"), length=20, gram=6, chunk=1500, part=3000) == plain(docs, 20)


def test_repeated_rows_and_keys(spark):
    draw = random.Random(2)
    text = "".join(draw.choices("abc ", k=200))
    docs = [(7, text)] * 50 + [(8, text[:100] + "tail")] * 20 + [(i, text[40:160]) for i in range(20, 60)]
    assert found(held(spark.createDataFrame(docs, SCHEMA).repartition(5), "docs"), length=30, gram=8, chunk=700) == plain(docs, 30)


def test_empty_table_and_query(spark, tmp_path):
    assert found(spark.createDataFrame([], SCHEMA)) == Counter()
    spark.createDataFrame([(1, "x" * 150), (2, "x" * 99)], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert sorted(map(tuple, passages.op12_suffix_dedup(spark, str(tmp_path)).collect())) == [(1, 150, 149, 1, sha("x")), (2, 99, 0, 0, sha("x" * 99))]


def test_a_collision_is_noticed():
    """With base 1 the hash of a string is that of its letters in any order; the second base sorts it out."""
    data, anchor, windows = b"abXYZWcd" + b"abXYZWdc" + b"abXYZWcd", np.array([2] * 3), np.array([3] * 3)
    s = passages.Suffixes(np.frombuffer(data, np.uint8), np.arange(0, 24, 8), anchor, np.full(3, 8), 1)
    members, first, size = np.arange(2), np.zeros(2, np.int64), np.full(2, 2)
    assert passages.sorted_classes(s, members, first, size, False) is None
    good = passages.repeats(data, anchor, windows, 6, 4, passages.BASES)
    again = passages.repeats(data, anchor, windows, 6, 4, (1, *passages.BASES))
    assert good[0].tolist() == again[0].tolist() == [False, False, True]
    assert good[1].tolist() == again[1].tolist() and good[1][1].tolist() == [False, False, True]
    with pytest.raises(RuntimeError):
        passages.repeats(data, anchor, windows, 6, 4, (1,))


def test_mergesort():
    draw = np.random.default_rng(3)
    sizes = np.array([1, 2, 3, 7, 64, 65, 200])
    value = draw.integers(0, 40, sizes.sum())
    first, size = np.repeat(np.cumsum(sizes) - sizes, sizes), np.repeat(sizes, sizes)
    out = passages.merge_sorted(np.arange(len(value)), first, size, lambda p, q, same: (value[p] < value[q]) | ((value[p] == value[q]) & same))
    assert out.tolist() == np.lexsort((np.arange(len(value)), value, first)).tolist()
