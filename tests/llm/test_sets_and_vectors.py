"""Similarity joins, searches, mixing, archives and the pipeline against plain Python on small rows."""
import hashlib
import math
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stockwright.llm import graph, jaccard, language, mixing, neighbours, suite, topk, warc


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def plain_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (k, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((k, len(sets[i]), min(group) if group and sets[i] else k))
    return out


@pytest.mark.parametrize("tile,frequent", [(1024, 3), (4, 1)])
def test_jaccard(spark, monkeypatch, tile, frequent):
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "LEAF", 4)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    common = " ".join(rng.choices(vocabulary, k=30))
    rows = [(900, None), (901, ""), (902, " \t "), (903, "One two"), (904, "one  TWO"), (905, "one"), (906, "É é"), (907, "é é"), (None, "lonely text without a key at all"), (None, "one two")]
    for g in range(25):
        base = rng.choices(vocabulary, k=rng.choice([6, 20, 60, 200]))
        for c in range(rng.choice([1, 2, 9])):
            text = [w if rng.random() > 0.02 else rng.choice(vocabulary) for w in base]
            rows.append((g * 10 + c, " ".join(text) + (" " + common if g % 3 == 0 else "")))
    rows += [rows[-1], (950, "z " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("id", F.lit(1)).withColumn("cls", F.lit(1)).withColumn("n", F.lit(1))
    got = jaccard.similar(df)
    order = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(plain_components(rows), key=order)
    kept = jaccard.near_copies_stage(spark, df, "")
    want = {k for k, _, c in plain_components(rows) if k is not None and k == c}
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(want)


def test_jaccard_finer_points_before_pairs(spark, monkeypatch):
    """Texts with 0.7 in common link with nothing, and the pairs of such a group do not leave it."""
    rng = random.Random(2)
    common = [f"c{rng.random()}" for _ in range(294)]
    rows = [(i, " ".join(common + [f"u{rng.random()}" for _ in range(62)])) for i in range(12)]
    rows += [(20, rows[0][1] + " and one more"), (21, rows[5][1] + " and two more words")]
    held, counts = jaccard.held, {}

    def counted(df, label):
        out = held(df, label)
        counts.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(jaccard, "held", counted)
    got = sorted(map(tuple, jaccard.similar(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()))
    assert got == sorted(plain_components(rows))
    assert counts.get("rest", [0]) == [0]


def test_jaccard_pairs_leave_one_group(spark, monkeypatch):
    """Classes that share many groups, no two with the same classes: each pair is found, from about one of them."""
    rng = random.Random(3)
    groups = [(s, c, c) for s in rng.sample(range(-(10**15), 10**15), 40) for c in rng.sample(range(40), 30)]
    point = np.full(jaccard.GROUPS, 65535, "<u2").tobytes()
    classes = spark.createDataFrame([(c, 100, bytearray(point)) for c in range(40)], "cls bigint, n bigint, point binary").cache()
    fine = spark.createDataFrame([(c, bytearray(b"\xff" * jaccard.FINE)) for c in range(40)], "cls bigint, fine binary")
    meeting, made = jaccard.meeting, []

    def recorded(*args):
        made.append(meeting(*args))
        return made[-1]

    monkeypatch.setattr(jaccard, "meeting", recorded)
    monkeypatch.setattr(jaccard, "TILE", 16)
    met = jaccard.with_partner(spark.createDataFrame(groups, "s bigint, cls bigint, comp bigint"), classes)
    found = sorted(map(tuple, jaccard.left_over(met, fine).collect()))
    members = {}
    for s, c, _ in groups:
        members.setdefault(s, set()).add(c)
    assert found == sorted({(a, b) for m in members.values() for a in m for b in m if a < b})
    assert met.count() <= made[0].count() <= 3 * len(groups)
    assert made[1].count() <= 2 * len(found)


def test_jaccard_empty(spark):
    assert jaccard.similar(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_tree_bounds():
    rng = np.random.default_rng(1)
    sets = [set(rng.integers(0, 500, 60)) for _ in range(40)]
    sets += [set(list(s)[3:]) | {999} for s in sets[:20]]
    n = np.array([len(s) for s in sets])
    points = np.stack([np.bincount([x % jaccard.GROUPS for x in s], minlength=jaccard.GROUPS) for s in sets])
    pairs = {tuple(sorted(p)) for i, j in jaccard.tree_pairs(n, points, np.arange(len(n)), np.zeros(len(n), int)) for p in zip(i.tolist(), j.tolist())}
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                assert (j, i) in pairs


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (102, 100), (7, 7)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


def vectors(spark, n=700, dim=8):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    x[100:160] = x[100]  # many copies of a query's vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(200, None), (1000, None), (1100, [float("nan")] * dim), (1101, [1.0, None] * (dim // 2)), (1102, [float("inf")] * dim), (None, [1.0] * dim), (300, x[300].tolist())]
    rows[400] = (400, [0.0] * dim)
    return rows, spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("v", F.lit(1)).withColumn("dim", F.lit(1)).withColumn("id", F.lit(2))


def usable(rows):
    return {i: np.array(v, np.float64) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()}


@pytest.mark.parametrize("block", [4096, 90])
def test_topk(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "ROW_BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "STEP", 16)
    rows, df = vectors(spark)
    x = {i: np.floor(1024 * v).astype(np.int64) for i, v in usable(rows).items()}
    want = []
    for q in [i for i in x if i % 100 == 0]:
        best = sorted((-int(x[q] @ v), i) for i, v in x.items() if i != q)[:10]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, topk.top_k(df).collect())) == sorted(want)


def test_topk_small(spark):
    df = spark.createDataFrame([(0, [1.0]), (100, [2.0]), (5, [1.0, 2.0])], "vec_id bigint, embedding array<float>")
    assert sorted(map(tuple, topk.top_k(df).collect())) == [(0, 1, 100, 2 * 1024 * 1024), (100, 1, 0, 2 * 1024 * 1024)]
    assert topk.top_k(df.limit(0)).count() == 0


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ROW_BLOCK", 64)
    monkeypatch.setattr(neighbours, "LEAF_ROWS", 16)
    rows, df = vectors(spark)
    x = {i: v for i, v in usable(rows).items() if v.any()}
    got = {}
    for r in neighbours.search(df).collect():
        assert r.vec_id != r.query_id and r.score == pytest.approx(np.sqrt(((x[r.query_id] - x[r.vec_id]) ** 2).sum()), rel=1e-12)
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    queries = [i for i in x if i % 100 == 0]
    assert sorted(got) == sorted(queries) and 400 not in got
    hits = 0
    for q in queries:
        best = [i for _, i in sorted((np.sqrt(((x[q] - v) ** 2).sum()), i) for i, v in x.items() if i != q)[:10]]
        hits += len(set(best) & {i for _, i in got[q]})
        assert [r for r, _ in sorted(got[q])] == list(range(1, len(got[q]) + 1))
    assert hits >= 0.9 * 10 * len(queries)
    assert [i for _, i in sorted(got[100])][:9] == list(range(101, 110))
    assert neighbours.search(df.limit(0)).count() == 0


def test_neighbours_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    x = usable([tuple(r) for r in rows.collect()])
    ids, m = np.array(list(x)), np.stack(list(x.values()))
    got = {}
    for r in suite.QUERIES["op8_ann"](spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = n = 0
    for q in [i for i in x if i % 100 == 0]:
        d = ((m - x[q]) ** 2).sum(axis=1)
        best = [i for i in ids[np.lexsort((ids, d))] if i != q][:10]
        hits, n = hits + len(set(best) & got[q]), n + len(best)
    assert hits >= 0.9 * n


def test_schedule_keeps_within_a_block():
    share = mixing.shares({"a": 1, "b": 2.5, "c": 0.01, "d": 7}, 256)
    assert sum(share.values()) == 256 and min(share.values()) >= 1
    plan, done = mixing.schedule(share), dict.fromkeys(share, 0)
    assert [slot for *_, slot in plan] == list(range(256))
    for s, j, slot in plan:
        assert j == done[s]
        done[s] += 1
        for n, k in done.items():
            assert abs(k - share[n] * (slot + 1) / 256) < 1


def test_mix(spark):
    rows = [(i, ["hot", "b", None][0 if i % 3 else i % 2 + 1], f"t{i}") for i in range(12_000)] + [(5, "hot", "t5"), (None, "b", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string").withColumn("bucket", F.lit(1)).withColumn("block", F.lit(1))
    out = mixing.mix(df, {"hot": 1.0, "b": 2.0, "": 1.0})
    got = out.collect()
    assert out.columns[:5] == df.columns and sorted((r.doc_id or -1, r.text or "") for r in got) == sorted((i or -1, t or "") for i, _, t in rows)
    by = {}
    for r in got:
        by.setdefault((r.mix_source, r.mix_block), []).append((r.mix_slot, r.mix_row))
    for (s, b), places in by.items():
        assert len({p for p, _ in places}) == 1 and sorted(r for _, r in places) == list(range(len(places)))
        assert len(places) == 16 or b == max(x for n, x in by if n == s)
    slots = [next(iter(p))[0] for p in by.values()]
    assert len(set(slots)) == len(slots)
    share = mixing.shares({"hot": 1.0, "b": 2.0, "": 1.0}, mixing.PERIOD)
    until = min(max(p[0][0] for (n, _), p in by.items() if n == s) for s in share)
    for slot in range(0, until, 37):
        for s in share:
            assert abs(sum(p[0][0] <= slot for (n, _), p in by.items() if n == s) - share[s] * (slot + 1) / mixing.PERIOD) < 1
    assert mixing.mix(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(df, {"hot": 1.0})


def test_mix_keeps_to_the_unrounded_weights(spark):
    """A hot source and 20 smaller ones, weights without a common period, one of them far below 1/4096."""
    rows = spark.range(99_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 33_000, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 20).cast("string"))).alias("source"))
    rows = rows.union(spark.range(99_000, 99_040).select("id", F.lit("tiny")))
    weights = {"hot": 33_000**0.5, **{f"s{i}": 3_300**0.5 for i in range(20)}, "tiny": 0.02}
    total = sum(weights.values())
    got = {}
    for r in mixing.mix(rows, weights).select("mix_source", "mix_block", "mix_slot").distinct().collect():
        got.setdefault(r.mix_source, {})[r.mix_block] = r.mix_slot
    assert {s: len(b) for s, b in got.items()} == {"hot": 2063, **{f"s{i}": 207 for i in range(20)}, "tiny": 3}
    for s, blocks in got.items():
        w = weights[s] / total
        for j, slot in blocks.items():
            # Before the slot no more than a block behind, after it no more than a block ahead.
            assert j > w * slot - 1 - 1e-9 and j + 1 < w * (slot + 1) + 1 + 1e-9, (s, j, slot)


def test_warc(spark, tmp_path):
    page = "<p>" + "é" * 80 + "</p>"
    rows = [(3, "http://a.example/x?y#z", page), (1, "https://b.example", page), (2, None, page), (4, "http://c", None), (5, "u\r\nX: 1", ""), (6, "http://d/", "short"), (7, "http://d/", "short"),
            (8, "http://e/", "body\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (9, "http://f/", "y" * 300_000), (9, "http://f/", "y" * 300_000), (None, "http://g/", "n" * 200)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1)).withColumn("row", F.lit(1))
    place = f"file://{tmp_path}/archive"
    archive = warc.write(df, place)
    got = warc.assemble(warc.read(spark, f"{place}/records", archive)).collect()
    assert len(got) == len(rows) and all(r.request.record_id and r.metadata.fields for r in got)
    texts = {r.response.record_id: r.metadata.key for r in got}
    body = {i: (h or "").encode() for i, _, h in rows}
    for r in got:
        k = int(r.metadata.key) if r.metadata.key else None
        assert (r.response.bytes, r.response.digest) == (len(body[k]), hashlib.sha256(body[k]).hexdigest())
        assert r.response.type == ("revisit" if k in (2, 3) else "response")
        if r.response.type == "response":
            assert bytes(r.response.payload) == body[k]
        else:
            assert texts[r.response.refers_to] == "1"
    df.select("page_id", "url", "html").write.parquet(f"{tmp_path}/pages.parquet")
    out = suite.QUERIES["op2_warc"](spark, str(tmp_path)).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in out if r.page_id in (1, 2, 3)) == [(1, "response", None), (2, "revisit", 1), (3, "revisit", 1)]
    assert len(out) == len(rows)
    warc.write(df.limit(0), f"{place}-none")
    assert warc.assemble(warc.read(spark, f"{place}-none")).count() == 0


@pytest.mark.parametrize("name", sorted(suite.ORACLES))
def test_against_sql(spark, name):
    from compare import check, duck
    folder = "/root/testdata/sf0.001"
    assert check(spark, duck(folder), folder, name, suite.QUERIES[name], suite.ORACLES[name]) == []


def test_pipeline(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, folder)
        assert out.columns == docs.columns, name
        rows = out.collect()
        now = spark.createDataFrame(rows, docs.schema)
    got = {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in corpus_pipeline.run(spark, folder).collect()}
    assert {k: v[1] for k, v in got.items()} == {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in rows}
    assert all(stage(spark, docs.limit(0), folder).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_pipeline_keeps_the_mixed_order(spark):
    """The positions of run() follow a schedule made slot by slot with fractions, from the rows that came through."""
    folder = "/root/testdata/sf0.001"
    source = {r.doc_id: r.source or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = sorted(corpus_pipeline.run(spark, folder).select("position", "doc_id").collect())
    assert [r.position for r in got] == list(range(len(got)))
    names = [source[r.doc_id] for r in got]
    rows = {s: names.count(s) for s in sorted(set(names))}
    total = sum(Fraction(n**0.5) for n in rows.values())
    weight, done, want, slot = {s: Fraction(n**0.5) / total for s, n in rows.items()}, dict.fromkeys(rows, 0), [], 0
    while len(want) < len(names):
        open_ = [(math.ceil((done[s] + 1) / w), s) for s, w in weight.items() if 16 * done[s] < rows[s] and math.floor(done[s] / w) <= slot]
        if open_:
            s = min(open_)[1]
            want += [s] * min(16, rows[s] - 16 * done[s])
            done[s] += 1
        slot += 1
    assert len(rows) > 1 and names == want


def test_language_threshold(spark):
    """Short noise with labels at random has low scores and goes; of the texts in a language 99 % stay at least."""
    rng = random.Random(3)
    words = {"en": "the cat and dog with that which have from this were been they would there".split(), "de": "der hund und die katze nicht eine werden sich auch durch zwischen immer wieder".split()}
    rows = [(i, " ".join(rng.choices(words[lang := ("en", "de")[i % 2]], k=60)), lang) for i in range(400)]
    rows += [(1000 + i, "".join(rng.choices("qxzvjkwy", k=4)), ("en", "de")[rng.randrange(2)]) for i in range(100)]
    kept = {r.doc_id for r in language.identify_stage(spark, spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), "").collect()}
    assert len(kept & set(range(400))) >= 396 and len(kept - set(range(400))) < 20


def test_stages_keep_columns_with_names_of_results(spark):
    from stockwright.llm import lines
    rows = [(i, f"one {i}\ntwo\nthree {i}\nfour", "a" if i % 3 else None, 7, 8, 9, 10, 11) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, mix_slot int, mix_source int, mix_row int, n_removed int, d0 int")
    for stage in (mixing.mixing_stage, lines.line_stage):
        out = stage(spark, df, "")
        assert out.columns == df.columns and sorted(out.collect(), key=lambda r: r.doc_id) == sorted(df.collect(), key=lambda r: r.doc_id)
    assert mixing.mix(df).columns.count("mix_slot") == 1 and mixing.mix(df).where("mix_slot <> 7").count() > 0
    assert {r.n_removed for r in lines.without_repeats(df).collect()} == {0}
