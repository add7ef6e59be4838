"""Importance resampling against plain Python."""
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from stockwright.llm import resampling

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
PLAIN = " ".join(f"word{i % 17}" for i in range(30))
TEXTS = [
    (1, PLAIN), (2, None), (3, ""), (4, "Only THREE words"), (5, "wörd ÄÖ 12-34_x. y " * 6000), (6, "x" * 50_000), (7, PLAIN), (7, PLAIN), (8, PLAIN.upper()),
    (None, PLAIN + " no key"), (9, " \n\t--- "), (10, "one\x00two\x7fthree {four} [five]^six`seven"),
] + [(20 + i, " ".join(f"w{(i * j) % 23}" for j in range(25))) for i in range(120)]
SCHEMA = "doc_id bigint, text string"
TARGET = [("word1 word2 word3 x",), (None,), ("",), ("w1 w2 w3 " * 9,)]


def plain(docs, target, buckets, percent, least):
    def found(text):
        words = WORDS.findall((text or "").translate(LOW))
        return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in (1, 2, 3) for i in range(len(words) - n + 1)]

    each = [found(t) for _, t in docs]
    s, t = (Counter(b for _, f in side for b in f) for side in (each, [found(x) for (x,) in target]))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (all_s + float(buckets)) / ((s[b] + 1.0) * (all_t + float(buckets))))) for b in range(buckets)]
    out = []
    for (i, _), (n, f) in zip(docs, each):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    order = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], math.inf if r[0] is None else r[0]))
    rank = {id(r): k for k, r in enumerate(order[: percent * len(order) // 100], 1)}
    return Counter((r[0], r[2], r[3], r[4], rank.get(id(r))) for r in out)


def collected(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("buckets, percent", [(10_000, 5), (50, 40), (70_000, 100)])
def test_against_plain(spark, buckets, percent):
    docs = spark.createDataFrame(TEXTS, SCHEMA)
    for name in ("n", "bucket", "range", "rank", "weight", "c0", "t", "tie", "n_words"):
        docs = docs.withColumn(name, F.lit(1))
    target = spark.createDataFrame(TARGET, "text string").withColumn("bucket", F.lit(1))
    got = resampling.resample(docs.repartition(3), target, buckets=buckets, percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert collected(got) == plain(TEXTS, TARGET, buckets, percent, 20)


def test_scores_that_are_all_equal(spark):
    """A third of the rows share key and text; ranks stay one each."""
    rows = [(5, PLAIN)] * 40 + [(i, PLAIN) for i in range(100, 180)]
    got = resampling.resample(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(TARGET, "text string"), percent=50)
    assert collected(got) == plain(rows, TARGET, 10_000, 50, 20)
    assert sorted(r["rank"] for r in got.collect() if r["rank"]) == list(range(1, 61))


def test_empty_tables(spark):
    none, target = spark.createDataFrame([], SCHEMA), spark.createDataFrame(TARGET, "text string")
    assert resampling.resample(none, target).count() == 0
    some = spark.createDataFrame(TEXTS[:4], SCHEMA)
    assert collected(resampling.resample(some, none)) == plain(TEXTS[:4], [], 10_000, 5, 20)


def test_text_keys(spark):
    docs = spark.createDataFrame([(str(i), t) for i, t in TEXTS[:2]], "doc_id string, text string")
    assert [r.rank for r in resampling.resample(docs, spark.createDataFrame(TARGET, "text string"), percent=100).orderBy("doc_id").collect()] == [1, None]


def test_pieces(monkeypatch):
    """Features do not change where a text is scanned in pieces."""
    spaced = b" ".join(b"w%d" % (i % 31) for i in range(500))
    scan = lambda: np.concatenate(list(resampling.feature_codes(spaced, regex.compile(resampling.RUNS))))
    whole = scan()
    monkeypatch.setattr(resampling, "FLUSH", 7)
    assert (scan() == whole).all() and len(whole) == 500 + 499 + 498
