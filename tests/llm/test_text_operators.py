"""Tokens, languages, personal data, lines and language-model scores against plain Python on small rows."""
import hashlib
import math
import os
import re
import struct
import zlib
from collections import Counter

import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from stockwright.llm import bpe, language, lines, personal, suffixtree

LONG = "wörd 12 " * 20_000
TEXTS = [
    (1, "The cat sat on the mat.\nIt's 12  o'clock\t\tnow …  "), (2, None), (3, ""), (4, LONG), (5, "x" * 5000), (6, "你好 \U0001f600!?"),
    (7, "one two three\nfour\nfive\nsix"), (7, "one two three\nfour\nfive\nsix"), (8, "A\n\n\nB\n\n\n"), (None, "no key\nat\nall"), (9, "  \n \t "),
]
SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    """The rows with columns whose names clash with the operators' own."""
    path = str(tmp_path_factory.mktemp("docs"))
    df = spark.createDataFrame(TEXTS, SCHEMA)
    for name in ("t", "id", "k", "th", "key", "n", "c0", "c1", "s", "cls", "ids", "part", "kind", "score", "lang_pred", "removed", "at", "word"):
        df = df.withColumn(name, F.lit(1))
    df.repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def multiset(rows):
    return Counter(map(tuple, rows))


def test_bpe(spark, docs, none):
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def want(text):
        ids = plain.encode_ordinary(text or "")
        return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    assert multiset(bpe.digests(docs).collect()) == multiset((i, *want(t)) for i, t in TEXTS)
    assert bpe.digests(none).count() == 0


def test_language(spark, docs, none):
    train = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "fr"), ("x", None)], "text string, lang string")
    learned = language.profiles(train)
    assert sorted(learned) == ["de", "en"]
    got = language.predict(docs, learned, keep=("n",)).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        assert 0 <= r.score <= 1 and r.lang_pred in ("de", "en", "und")
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {2, 3, 9}
    assert language.predict(none, learned).count() == 0
    assert {r.lang_pred for r in language.predict(docs, language.profiles(none.withColumn("lang", F.lit("a")))).collect()} == {"und"}
    kept = language.identify_stage(spark, docs.withColumn("lang", F.lit("en")), "")
    assert kept.columns == [*docs.columns, "lang"] and kept.count() == len(TEXTS) - 3


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    from stockwright.llm.suite import QUERIES
    got = QUERIES["op9_language_id"](spark, "/root/testdata/sf0.01").where("held_out").join(docs, "doc_id")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right > 0.95


def plain_lines(rows):
    """(key, text) -> the text left."""
    wins = lambda t: [(i, "\n".join(w)) for i in range(len(t) - 2) if "".join(w := t[i : i + 3]).strip(" ")]
    first = {}
    order = lambda k: 1 << 63 if k is None else k
    for k, t in rows:
        for _, w in wins((t or "").split("\n")):
            first[w] = min(first.get(w, 1 << 64), order(k))
    out = []
    for k, t in rows:
        if t is None:
            out.append((k, None, 0))
            continue
        ls, seen, gone = t.split("\n"), set(), set()
        for i, w in wins(ls):
            if first[w] < order(k) or w in seen:
                gone |= {i, i + 1, i + 2}
            seen.add(w)
        out.append((k, "\n".join(x for i, x in enumerate(ls) if i not in gone), len(gone)))
    return out


def test_lines(spark, none):
    body = "a\nb\nc\nd\ne"
    rows = [(3, "x\n" + body + "\ny"), (1, body), (2, "a\nb\nc"), (4, "c\nd\n"), (5, "\n".join("pqrpqr")), (6, "  \n\n \n\n"), (7, None), (8, ""), (3, "x\n" + body + "\ny"), (None, body), (9, "r\n" * 3000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("k", F.lit(1)).withColumn("th", F.lit(2)).withColumn("removed", F.lit(3))
    got = lines.without_repeats(df)
    assert got.columns == [*df.columns, "n_removed"]
    assert multiset(got.select("doc_id", "text", "n_removed").collect()) == multiset(plain_lines(rows))
    assert lines.without_repeats(none).count() == 0
    plan = lines.without_repeats(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def luhn(d):
    return sum((v - 9 if (v := int(c) * (1 + i % 2)) > 9 else v) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(d)]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_personal_base(spark, none):
    texts = [
        "é a.b+c@x-y.co.uk, d@e.f%g@h.i j@k. @l.m n@o..p 😀 q@r.s", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.2.3 9.9.9.9.",
        "4111 1111 1111 1111 and 4111-1111-1111-1112 and 4111  1111 12345678901234567890", "+1 (807) 555-5623 +49.89/12 +12 +123456789012345678 ++1 2 3 4 5 6 7 8 9)",
        None, "", "7 " * 30_000 + "a@b.cd", "x@" * 20_000, "+1 555 123 4567 " * 600,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA).withColumn("id", F.lit(1)).withColumn("spans", F.lit(1))
    for r in personal.personal_spans(df).collect():
        assert [tuple(x) for x in r.base] == base_spans(texts[r.doc_id] or ""), texts[r.doc_id]
    assert personal.personal_spans(none).count() == 0


def test_personal_context(spark):
    rows = [(i, f"filler text here reach: +1 555 123 {4000 + i} end the word the") for i in range(8)]
    rows += [(20, "please reach: 555-123-9999 today"), (21, "the 555-123-7777 is a part number"), (22, "twice 555-123-9999 elsewhere"), (23, "clean text")]
    got = {r.doc_id: r.added for r in personal.personal_spans(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [tuple(x) for x in got[20]] == [("phone", 14, 26)]
    assert [tuple(x) for x in got[22]] == [("phone", 6, 18)]
    assert got[21] == got[23] == [] and all(got[i] == [] for i in range(8))


def test_suffix_tree(spark, docs, none):
    rows = [(i, "the big cat sat on the big mat " * 5) for i in range(30)] + [(99, None), (100, "the unseen cat")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("held_out", F.col("doc_id") >= 99)
    model = suffixtree.train(df.where("not held_out").select(F.col("text").alias("t")))
    c = Counter(w for i, t in rows if i < 99 for w in [*t.split(), None])
    n, v = sum(c.values()), len(c)
    got = {r.doc_id: r for r in suffixtree.score(df, model, keep=("held_out",)).collect()}
    for i, t in rows:
        words = [*(t or "").split(), None]
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(c[w] > 0 for w in words), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words), rel_tol=1e-9)
    assert got[0].score > got[0].base_score / 2  # the next word is nearly certain
    # Next-symbol distributions of every state sum to one over the symbols that occur.
    assert all(abs(sum(10.0 ** x for x in row if x > -300) - 1) < 1e-3 for row in model.logs)
    assert suffixtree.score(docs, model).count() == len(TEXTS)
    empty = suffixtree.train(none.select(F.col("text").alias("t")))
    assert {r.base_score for r in suffixtree.score(df, empty).collect()} == {0.0}
    assert suffixtree.score(none, model).count() == 0


def test_personal_context_finds_all(spark):
    """Edges, blanks, many hidden ones behind one cue, a chain of cues, and long tokens."""
    rows = [(i, f"filler text here reach: +1 555 123 {4000 + i} end the word the") for i in range(8)]
    hidden = ["555-123-9999.", "555-123-9998,", "(555-123-9997)", "555 123 9996", '"555.123.9995"!', "(555) 123-9994", "555 123 9993 100 units"]
    rows += [(20 + i, f"please reach: {h} today") for i, h in enumerate(hidden)]
    rows += [(40, "555-123-9999 stands first"), (41, "the 555-123-7777 is a part number"), (42, "reach: 55-66 today")]
    # Each cue is learned only from what the one before it made known.
    for c in range(7):
        rows += [(100 + 10 * c + i, f"now {'reach:' if c == 0 else f'cue{c}'} 555-777-{1000 + 10 * c + i} or cue{c + 1} 555-777-{1000 + 10 * c + i} end") for i in range(6)]
        rows += [(200 + 10 * c + i, f"then cue{c + 1} 555-777-{1000 + 10 * (c + 1) + i} end") for i in range(6)]
    long = "a" * 80 + "_!@localhost"
    rows += [(300 + i, f"mail-to u{i}@ex.org end") for i in range(8)] + [(310, f"mail-to <{long}>, end")]
    texts = dict(rows)
    got = {r.doc_id: [(k, texts[r.doc_id][a:b]) for k, a, b in r.added] for r in personal.personal_spans(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = ["555-123-9999", "555-123-9998", "555-123-9997", "555 123 9996", "555.123.9995", "(555) 123-9994", "555 123 9993"]
    for i, w in enumerate(want):
        assert got[20 + i] == [("phone", w)], w
    assert got[40] == [("phone", "555-123-9999")] and got[41] == got[42] == []
    for c in range(7):
        for i in range(6):
            assert got[200 + 10 * c + i] == [("phone", f"555-777-{1000 + 10 * (c + 1) + i}")], c
    assert got[310] == [("email", long)]


def plain_tree_scores(trained, texts, depth=3, least=2):
    """log10 scores by the longest retained suffix, over all words, with dictionaries."""
    n, following = Counter(), {}
    for t in trained:
        s = ["<", *t.split(), ">"]
        for i in range(len(s)):
            for m in range(1, depth + 2):
                if i - m + 1 >= 0:
                    n[g := tuple(s[i - m + 1 : i + 1])] += 1
                    following.setdefault(g[:-1], Counter())[g[-1]] += 1
    words = {g: k for g, k in n.items() if len(g) == 1 and g != ("<",)}
    total, v = sum(words.values()), len(words)

    def kept(c):
        if n[c] < least or c not in following:
            return False
        above = n[c[1:]] if len(c) > 1 else total
        nats = sum(k * math.log(k / n[c] / (n[(*c[1:], w)] / above)) for w, k in following[c].items())
        return nats > 3.0 * len(following[c])

    def p(c, w):
        if not c:
            return (words.get((w,), 0) + 0.1) / (total + 0.1 * (v + 1))
        return (n[(*c, w)] + 8 * p(c[1:], w)) / (n[c] + 8) if kept(c) else p(c[1:], w)

    out = []
    for t in texts:
        s = ["<", *t.split(), ">"]
        out.append(sum(math.log10(p(tuple(s[max(0, i - depth) : i]), s[i])) for i in range(1, len(s))))
    return out


def test_suffix_tree_rare_words(spark):
    """Words far below a thousandth of the tokens are contexts of their own, and so are two or three of them."""
    many = [(i, " ".join(f"w{(i * 7 + j * j) % 50}" for j in range(80))) for i in range(40)]
    pairs = [(100 + i, f"w{i} key{i % 5} lock{i % 5} bolt{i % 5} w{i + 1}") for i in range(20)]
    rows = [*many, *pairs, (200, "key3 lock3 bolt3"), (201, "key3 bolt1 lock2"), (202, "new key1 lock1 new")]
    df = spark.createDataFrame(rows, SCHEMA)
    model = suffixtree.train(df.where("doc_id < 200").select(F.col("text").alias("t")))
    got = {r.doc_id: r.score for r in suffixtree.score(df, model).collect()}
    want = plain_tree_scores([t for i, t in rows if i < 200], [t for _, t in rows])
    for (i, _), x in zip(rows, want):
        assert math.isclose(got[i], x, rel_tol=1e-9), i
    assert got[200] > got[201] + 3


@pytest.mark.parametrize("heavy, chunk, together", [(0.25, 300, 50), (0.02, 100, 1 << 20), (100.0, 1 << 20, 200)])
def test_suffix_tree_heavy_contexts(spark, monkeypatch, heavy, chunk, together):
    """The same scores whichever contexts are heavy, however texts are cut, for the texts learned from, held out, or of another table."""
    monkeypatch.setattr(suffixtree, "HEAVY", heavy)
    monkeypatch.setattr(suffixtree, "CHUNK", chunk)
    monkeypatch.setattr(suffixtree, "AT_ONCE", together)
    monkeypatch.setattr(suffixtree, "HEADS", 64)
    words = ["the", "of", "the", "and", "the", *(f"w{i}" for i in range(12))]
    rows = [(i, " ".join(words[(i * 5 + j * j * (i % 3 + 1) + j // 7) % len(words)] for j in range(i % 45))) for i in range(70)]
    rows += [(100 + i, "the of the and a copy of the text stands here") for i in range(12)] + [(200, None), (201, ""), (202, "only once"), (203, "new the of the w1 once")]
    rows += [(5, rows[5][1]), (None, "the of no key")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("held_out", F.coalesce(F.col("doc_id") % 4 == 3, F.lit(False))).repartition(3)
    path = str(suffixtree.held(df, "rows-of-test").inputFiles()[0]).rsplit("/", 1)[0]
    df = spark.read.parquet(path)
    trained = [t or "" for i, t in rows if i is None or i % 4 != 3]
    want = Counter((i, round(x, 8)) for (i, _), x in zip(rows, plain_tree_scores(trained, [t or "" for _, t in rows])))
    own = suffixtree.train(df, text="text", learn=~F.col("held_out"))
    assert any(len(k) for k in own.heavy.keys) == (heavy < 1)
    assert Counter((r.doc_id, round(r.score, 8)) for r in suffixtree.score(df, own, keep=("held_out",)).collect()) == want
    other = suffixtree.train(df.where("not held_out").select(F.col("text").alias("t")))
    assert Counter((r.doc_id, round(r.score, 8)) for r in suffixtree.score(df, other).collect()) == want


@pytest.mark.parametrize("depth, least", [(1, 2), (2, 1), (3, 3)])
def test_suffix_tree_rules(spark, monkeypatch, depth, least):
    monkeypatch.setattr(suffixtree, "HEAVY", 0.1)
    rows = [(i, " ".join(f"w{(i * j + j * j) % 11 if j % 5 else i}" for j in range(30))) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = suffixtree.train(df.where("doc_id < 30").select(F.col("text").alias("t")), depth=depth, min_count=least)
    got = {r.doc_id: r.score for r in suffixtree.score(df, model).collect()}
    for (i, _), x in zip(rows, plain_tree_scores([t for i, t in rows if i < 30], [t for _, t in rows], depth, least)):
        assert math.isclose(got[i], x, rel_tol=1e-9), i


def test_suffix_tree_writes_few_bytes(spark, monkeypatch):
    """Hand-over tables hold no row per n-gram: what is written stays below the texts' own size."""
    texts = [" ".join(f"w{(i * 31 + j * j * 7) % 3000}" for j in range(400)) for i in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(2)
    written, held = [], suffixtree.held

    def noted(rows, label):
        out = held(rows, label)
        written.extend(os.path.getsize(f.removeprefix("file://")) for f in out.inputFiles())
        return out

    monkeypatch.setattr(suffixtree, "held", noted)
    model = suffixtree.train(df.select(F.col("text").alias("t")))
    assert suffixtree.score(df, model).count() == len(texts)
    assert 0 < sum(written) < sum(map(len, texts))


def test_fold(spark):
    from stockwright.llm.tables import fold
    got = spark.createDataFrame([(12,), (None,)], "doc_id bigint").select(fold("doc_id", 10)).collect()
    assert [r[0] for r in got] == [zlib.crc32(b"12") % 10, zlib.crc32(b"") % 10]


def plain_profile(text, bundler):
    """The bundle of a text, trigram by trigram."""
    import numpy as np
    codes = [0]
    for ch in text.lower():
        c = ord(ch) if ch.isalpha() else 0
        if c or codes[-1]:
            codes.append(c)
    if codes[-1]:
        codes.append(0)
    out = np.zeros(bundler.dimensions)
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        out += np.roll(bundler.letter(a), 2) * np.roll(bundler.letter(b), 1) * bundler.letter(c)
    return out


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 200_000])
def test_language_pieces(monkeypatch, piece):
    """A bundle is the same wherever a text is cut, and as a plain sum over its trigrams."""
    monkeypatch.setattr(language, "PIECE", piece)
    bundler = language.Bundler(64)
    texts = ["The cat -- sat, ÜBER das  Haus", "", "x", " .. ", "ab", "  ΣΑΣ ΟΔΟΣ i", "don't\n\nstop!!"]
    got = bundler.bundle(texts)
    for text, row in zip(texts, got):
        assert (row == plain_profile(text, bundler)).all(), text


def test_language_plain(spark):
    """Predictions and scores as plain Python makes them, ties and repeated rows included."""
    import numpy as np
    train = [("the cat and the dog ran", "en"), ("a dog is here", "en"), ("der hund und die katze", "de"), ("same text", "aa"), ("same text", "bb"), (None, "fr"), ("no label", None)]
    asked = ["the dog", "die katze und", "same text", "same text", "", None, "123", "Katze DOG"]
    bundler = language.Bundler()
    unit = lambda v: v / np.sqrt((v**2).sum()) if v.any() else v
    sums = {}
    for t, lang in train:
        if t and lang:
            sums[lang] = sums.get(lang, 0) + unit(plain_profile(t, bundler))
    learned = language.profiles(spark.createDataFrame(train, "text string, lang string"))
    got = {r.doc_id: r for r in language.predict(spark.createDataFrame(list(enumerate(asked)), SCHEMA), learned).collect()}
    for i, t in enumerate(asked):
        v = plain_profile(t or "", bundler)
        cosines = {n: float(unit(v) @ unit(p)) for n, p in sums.items()}
        want = max(sorted(cosines), key=lambda n: round(cosines[n], 9)) if v.any() else "und"
        assert got[i].lang_pred == want
        assert math.isclose(got[i].score, min(1.0, max(0.0, cosines[want])) if v.any() else 0.0, abs_tol=1e-5)
