"""Personal data: spans by form, and further ones by bootstrapped context.

Base spans are the matches of one pattern per kind that pass the kind's test. They are the seeds: the word before a span
is a lexical pattern for its kind; quotes and brackets that open in between are passed over. A pattern scores by how often
the word is followed by a known identifier of the kind, out of those occurrences in the corpus that nothing yet unknown of
the kind's form follows; a pattern with enough distinct seeds and a high score is trusted. A candidate (a token, or groups
of digits with blanks between, that looks like an identifier of the kind but is no base span; punctuation at its edges
does not count) becomes known when the trusted patterns before it, together, are confident enough; known ones count for
other patterns in the next round, until nothing is new. Scores only rise as more is known, so that ends.
Candidates behind a trusted pattern and those that became known are added as spans; base spans stay.

The word before is looked for in the BEFORE code points in front of a span: a cue that needs more room (a longer word, or more
blanks) is neither learned nor used, nor is a candidate with more than 16 opening marks found. Base spans have no such limit.

Only built-in functions. Places are counted in code points: a match starts after all gaps and matches before it. Texts
are read whole. Patterns, instances and their counts are tables: nothing is collected but row counts.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .tables import held, table

KINDS = ("email", "ip", "card", "phone")
# The patterns of the base spans. Possessive repeats and starts at the edge of a run match the same texts
# as the plain ones, in linear time and without deep recursion.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OPEN, CLOSE = r"\"'(\[{<«“‘", r"\"')\]}>.,;:!?»”’"  # at the edges of a candidate
# Groups of digits as of a card or a phone number, or else a whole token, without what opens or closes at its edges.
CANDIDATE = (
    rf"(?<![^\s{OPEN}])(?<=(?:^|\s)[{OPEN}]{{0,16}})(?:"
    rf"(?:[0-9](?:[./_]?[0-9]){{12,18}}|\([0-9]{{1,4}}\)[\x20./-]?[0-9](?:[\x20./-]?[0-9]){{3,10}}|[0-9](?:[\x20./-]?[0-9]){{6,11}})(?=[{CLOSE}]*+(?:\s|$))"
    rf"|(?=[^\s0-9@:]*+(?:[0-9@]|:\S))[^\s{OPEN}](?:\S*(?:[^\s{CLOSE}]|::))?)"
)
# What a candidate of a kind may look like, and how many digits it has.
FORMS = {
    "email": (r"^[^\s@]+@[^\s@]{3,}$", 0, 99),
    "ip": r"^[0-9A-Fa-f]{0,4}(:[0-9A-Fa-f]{0,4}){3,7}$",
    "card": (r"^[0-9]+([./_][0-9]+)+$", 13, 19),
    "phone": (r"^[0-9(][0-9()\x20./-]*[0-9]$", 7, 12),
}
MIN_SEEDS = 5  # distinct instances before a pattern can be trusted
MIN_SCORE = 0.8  # share of a pattern's occurrences that known identifiers follow, of those that no unknown candidate follows
MIN_CONFIDENCE = 0.8  # of all trusted patterns before an instance
BEFORE = 48  # code points looked at for the word before
BLOCK = 256
SMALL = 20_000  # rows up to which a table of words is sent to all tasks


def places(h: Column, g: Column) -> Column:
    """The start of each hit, from the lengths of the hits and of the gaps: summed block by block."""
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)

    def block(b: Column) -> Column:
        first = total(F.slice(g, 1, b + 1)) + total(F.slice(h, 1, b))
        start = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
        step = lambda s, i: F.struct((s.at + F.get(h, i) + F.get(g, i + 1)).alias("at"), F.array_append(s.out, s.at).alias("out"))
        return F.aggregate(F.sequence(b, F.least(b + BLOCK - 1, F.size(h) - 1)), start, step, lambda s: s.out)

    return F.when(F.size(h) > 0, F.flatten(F.transform(F.sequence(F.lit(0), F.size(h) - 1, F.lit(BLOCK)), block))).otherwise(F.array().cast("array<int>"))


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(number: Column) -> Column:
    back = F.reverse(number)

    def step(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), step) % 10 == 0


def valid(kind: str, s: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return s.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$")
    n = F.length(digits(s))
    return n.between(9, 15) if kind == "phone" else n.between(13, 19) & luhn(digits(s))


def found_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, th, spans, candidates) per row; spans: array<struct(kind, start, end, s, before)> by kind and start.

    before is the word in front of a span, in lower case. Hits, lengths and places are columns of their own: an expression
    inside a lambda would be evaluated again for each element.
    """
    names = [*KINDS, "other"]
    pattern = PATTERNS | {"other": CANDIDATE}
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.select("id", "t", *[F.regexp_extract_all("t", F.lit(pattern[k]), F.lit(0)).alias(f"{k}_hits") for k in names])
    hits = [f"{k}_hits" for k in names]
    none = F.array().cast("array<int>")
    rows = rows.select("id", "t", *hits, *[F.transform(h, F.length).alias(f"{h}_h") for h in hits], *[
        F.when(F.size(h) > 0, F.transform(F.split("t", pattern[k], -1), F.length)).otherwise(none).alias(f"{h}_g") for k, h in zip(names, hits)])
    rows = rows.select("id", "t", *hits, *[places(F.col(f"{h}_h"), F.col(f"{h}_g")).alias(f"{h}_at") for h in hits])

    def spans(k: str) -> Column:
        def span(i: Column) -> Column:
            s, at = F.get(f"{k}_hits", i), F.get(f"{k}_hits_at", i)
            left = F.substring("t", F.greatest(at - BEFORE, F.lit(0)) + 1, F.least(at, F.lit(BEFORE)))
            before = F.lower(F.regexp_extract(left, rf"(?:^|\s)(\S++)\s++[{OPEN}]*+$", 1))
            return F.struct(F.lit(k).alias("kind"), at.alias("start"), (at + F.length(s)).alias("end"), s.alias("s"), before.alias("before"))

        kept = lambda i: valid(k, F.get(f"{k}_hits", i)) if k in KINDS else F.lit(True)
        no = F.array().cast("array<struct<kind:string,start:int,end:int,s:string,before:string>>")
        return F.when(F.size(f"{k}_hits") > 0, F.transform(F.filter(F.sequence(F.lit(0), F.size(f"{k}_hits") - 1), kept), span)).otherwise(no)

    rows = rows.select("id", F.xxhash64("t").alias("th"), F.concat(*map(spans, KINDS)).alias("spans"), spans("other").alias("c"))
    apart = lambda c: ~F.exists("spans", lambda b: (b.start < c.end) & (c.start < b.end))
    return rows.select("id", "th", "spans", F.filter("c", apart).alias("candidates"))


def fits(kind: str, s: Column) -> Column:
    form = FORMS[kind]
    if isinstance(form, str):
        return s.rlike(form)
    return s.rlike(form[0]) & F.length(digits(s)).between(form[1], form[2])


def sized(df: DataFrame) -> DataFrame:
    """A hint to send the table to all tasks if it is small; a shuffled join otherwise."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def bootstrapped(docs: DataFrame, found: DataFrame, text: str = "text", min_seeds: int = MIN_SEEDS,
                 min_score: float = MIN_SCORE, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(id, th, kind, start, end) of the spans that contexts add."""
    seeds = found.select(F.explode("spans").alias("x")).select("x.kind", F.lower("x.s").alias("instance"), F.col("x.before").alias("word"))
    seeds = held(seeds.groupBy("kind", "instance", "word").count(), "seeds")
    kinds = F.filter(F.array(*[F.when(fits(k, F.col("x.s")), F.lit(k)) for k in KINDS]), lambda k: k.isNotNull())
    options = found.select("id", "th", F.explode("candidates").alias("x")).select(
        "id", "th", F.col("x.start").alias("start"), F.col("x.end").alias("end"), F.lower("x.s").alias("instance"), F.col("x.before").alias("word"), F.explode(kinds).alias("kind"))
    options = held(options, "candidates")
    edges = held(options.where("word <> ''").groupBy("kind", "instance", "word").count(), "edges")
    # How often each word that stands before a seed or candidate occurs at all.
    words = seeds.select("word").union(edges.select("word")).where("word <> ''").distinct()
    words = sized(held(words, "words"))
    all_words = docs.select(F.explode(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+")).alias("word"))
    occurs = held(all_words.join(words, "word").groupBy("word").agg(F.count("*").alias("occurs")), "occurs")
    enough = seeds.where("word <> ''").select("kind", "word", "instance").distinct().groupBy("kind", "word").count().where(F.col("count") >= min_seeds)
    graph = held(seeds.where("word <> ''").union(edges).join(occurs, "word"), "graph")
    followed = held(graph.groupBy("kind", "word").agg(F.sum("count").alias("followed")), "followed")
    known = seeds.select("kind", "instance").distinct()
    n_known = -1
    while True:
        known = held(known, "known")
        n = known.count()
        if n == n_known:
            break
        n_known = n
        patterns = graph.join(known, ["kind", "instance"]).groupBy("kind", "word").agg(F.sum("count").alias("hits"), F.first("occurs").alias("occurs"), F.countDistinct("instance").alias("n"))
        patterns = patterns.join(followed, ["kind", "word"]).withColumn("score", F.col("hits") / (F.col("occurs") - F.col("followed") + F.col("hits")))
        patterns = held(patterns.where((F.col("n") >= min_seeds) & (F.col("score") >= min_score)).select("kind", "word", F.least("score", F.lit(0.999)).alias("score")), "patterns")
        doubt = edges.join(patterns, ["kind", "word"]).groupBy("kind", "instance").agg(F.sum(F.log1p(-F.col("score"))).alias("doubt"))
        known = known.union(doubt.where(F.lit(1) - F.exp("doubt") >= min_confidence).select("kind", "instance")).distinct()
    seed_words = seeds.select("kind", "instance").distinct()
    new = known.join(seed_words, ["kind", "instance"], "left_anti")
    spans = options.join(new, ["kind", "instance"], "left_semi").select("id", "th", "kind", "start", "end")
    # One kind per place, the first as listed.
    order = reduce(lambda c, i: c.when(F.col("kind") == KINDS[i], i), range(1, len(KINDS)), F.when(F.col("kind") == KINDS[0], 0))
    best = spans.withColumn("k", order).groupBy("id", "th", "start", "end").agg(F.min("k").alias("k"))
    return best.select("id", "th", F.element_at(F.array(*map(F.lit, KINDS)), F.col("k") + 1).alias("kind"), "start", "end")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")


def personal_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(key, base, added) per row: arrays of struct(kind, start, end), by kind as listed and start.

    A null text counts as empty. Rows equal in key and text get the same spans.
    """
    found = held(found_spans(docs, key, text), "spans")
    more = bootstrapped(docs, found, text, **options)
    listed = F.array_sort(F.collect_set(F.struct(F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("k"), "start", "end", "kind")))
    more = more.groupBy("id", "th").agg(listed.alias("added")).withColumnRenamed("id", "id2").withColumnRenamed("th", "th2")
    both = found.join(more, F.col("id").eqNullSafe(F.col("id2")) & (F.col("th") == F.col("th2")), "left")
    plain = lambda x: F.struct(x.kind.alias("kind"), x.start.alias("start"), x.end.alias("end"))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return both.select(F.col("id").alias(key), F.transform("spans", plain).alias("base"), F.coalesce(F.transform("added", plain), none).alias("added"))


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_spans(table(spark, folder, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x.kind == k)).cast("bigint").alias(f"n_{k}")
    of = lambda k: lambda x: x.kind == k
    both = F.flatten(F.array(*[F.array_sort(F.filter(F.concat("base", "added"), of(k))) for k in KINDS]))
    return found.select("doc_id", *map(count, KINDS), F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(both).alias("spans"))
