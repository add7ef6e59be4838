"""Alignment of two tokenizers against plain Python."""
import base64
import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stockwright.llm import alignment
from stockwright.llm.tables import held

PATHS = tuple(public_tokenizers.path(v) for v in alignment.VOCABULARIES)
SCHEMA = "doc_id bigint, text string"
TEXTS = [
    (1, "The cat sat on the mat.\nIt's 12  o'clock\t\tnow …  "), (2, None), (3, ""), (4, "wörd unbelievable 12 " * 3000), (5, "a" * 5000), (6, "你好 \U0001f600!? ﬁ ①"),
    (7, "Same row, twice."), (7, "Same row, twice."), (None, "no key at all"), (9, "  \n \t "), (10, " "), (11, "<|endoftext|> and <s>plain</s> <unk>"),
    (12, "under▁score"), (13, "x\x00y"), (14, "=" * 900 + " " * 700), (15, "The cat sat."),
]


def plain(docs):
    one, two = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    one.encode_special_tokens = True
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        token = {int(rank): base64.b64decode(t) for t, rank in map(bytes.split, lines)}
    piece = lambda i: bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode()
    each = []
    for key, text in docs:
        groups = []
        if text:
            a, b = one.encode(" " + text, add_special_tokens=False).ids, two.encode(text)
            if b"".join(token[i] for i in a) == b"".join(map(piece, b)) == (" " + text).encode():
                at, ends = [0, 0], ([], [])
                for s, ids in enumerate((a, b)):
                    for i in ids:
                        at[s] += len(token[i] if s == 0 else piece(i))
                        ends[s].append(at[s])
                borders = sorted(set(ends[0]) & set(ends[1]))
                groups = [([i for i, e in zip(a, ends[0]) if lo < e <= hi], [i for i, e in zip(b, ends[1]) if lo < e <= hi]) for lo, hi in zip([0, *borders], borders)] if len(a) < 1000 else slow(a, b, ends, borders)
        each.append((key, groups))
    n = Counter(p for _, groups in each for p in {(x, y) for ga, gb in groups for x in ga for y in gb})
    best = defaultdict(int)
    for (x, _), c in n.items():
        best[x] = max(best[x], c)
    out = []
    for key, groups in each:
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        written = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((key, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links), sum(n[p] == best[p[0]] for p in links),
                    sum(n[p] for p in links), hashlib.sha256(written.encode()).hexdigest() if groups else ""))
    return Counter(out), n, best


def slow(a, b, ends, borders):
    out, i, j = [], 0, 0
    for hi in borders:
        group = ([], [])
        while i < len(a) and ends[0][i] <= hi:
            group[0].append(a[i])
            i += 1
        while j < len(b) and ends[1][j] <= hi:
            group[1].append(b[j])
            j += 1
        out.append(group)
    return out


@pytest.mark.parametrize("chunk, large", [(alignment.CHUNK, alignment.LARGE), (40, 3)])
def test_against_plain(spark, tmp_path, monkeypatch, chunk, large):
    monkeypatch.setattr(alignment, "LARGE", large)
    monkeypatch.setattr(alignment, "CHUNK", chunk)
    docs = spark.createDataFrame(TEXTS, SCHEMA)
    for name in ("c0", "t", "n_a", "groups", "part", "chunk", "kind", "__part", "best"):
        docs = docs.withColumn(name, F.lit(1))
    docs = held(docs.repartition(3), "docs")
    found = alignment.Aligned(docs, PATHS, keep=("groups",), chunk=chunk)
    got = found.texts().toDF("doc_id", "kept", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    want, n, best = plain(TEXTS)
    sha = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    assert Counter(map(tuple, got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", sha).collect())) == want
    assert {((r.a, r.b), r.n, r.best) for r in found.pairs().collect()} == {(p, c, c == best[p[0]]) for p, c in n.items()}
    docs.select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    assert Counter(map(tuple, alignment.op13_alignment(spark, str(tmp_path)).collect())) == want


def test_empty_table(spark):
    found = alignment.Aligned(spark.createDataFrame([], SCHEMA), PATHS)
    assert found.texts().count() == 0 and found.pairs().count() == 0
    nothing = alignment.Aligned(held(spark.createDataFrame([("a", None), ("b", "")], "doc_id string, text string"), "docs"), PATHS)
    assert sorted(map(tuple, nothing.texts().collect())) == [("a", 0, 0, 0, 0, 0, 0, ""), ("b", 0, 0, 0, 0, 0, 0, "")]


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 20_000))
    h = alignment.PerfectHash(keys)
    assert sorted(h(keys).tolist()) == list(range(len(keys)))
    assert len(alignment.PerfectHash(np.zeros(0, np.int64)).levels) == 0


def test_unknown_pairs_are_noticed():
    sent = [alignment.pack(step=np.array([5, 4]), n=np.array([1, 2])), alignment.pack(step=np.array([5]), n=np.array([3]))] * 70
    counts = alignment.PairCounts(sent, 4)
    assert dict(zip(counts.keys.tolist(), counts.counts.tolist())) == {5: 280, 9: 140}
    with pytest.raises(KeyError):
        counts.index(np.array([6]))


def test_tree_sum():
    for n in range(1, 20):
        assert alignment.tree_sum(iter([np.array([i, 1]) for i in range(n)])).tolist() == [n * (n - 1) // 2, n]


def test_quick_encoder():
    """It takes part, and agrees on every entry of the vocabulary and on ASCII texts of all kinds."""
    with open(PATHS[0], "rb") as f:
        side = alignment.ByteLevel(f.read())
    assert side.quick
    draw = np.random.default_rng(3)
    texts = [t.decode() for t in side.tokens if t.isascii()] + ["".join(map(chr, draw.integers(0, 128, 30))) for _ in range(3000)]
    want = [e.ids for e in side.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
    assert side.encode(texts) == want
