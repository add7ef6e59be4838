"""Target-distribution importance resampling over hashed n-grams.

Separators are collapsed to single spaces, so that one regular expression with lookarounds at word borders, scanned with
overlapping matches, gives at every word the spans of the n-grams of one to three words that start there. Each span goes
straight into its CRC; a longer n-gram goes on from the CRC of the shorter one. A text's features are kept as sorted
buckets in a written table, so every text is scanned once. From it come the bucket counts of the corpus (each task sums
its rows into one vector of fixed size), and then the weights: the sum over a text's features of the gain of their
bucket, the log ratio of the smoothed bucket shares in the target and in the corpus.

Rows are drawn without replacement by Gumbel noise made from the key. Ranks come from one range shuffle of slim rows:
ranges are numbered inside and start after the rows of the ranges before.

A null text has no features. Rows without features have weight 0. A null key counts as the empty text for the noise and
comes after all others in ties; rows with equal keys get the same noise and are ranked in any order among each other.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .tables import field_names, held, partitions, small_batches, table

BUCKETS = 10_000
SEED = 42
LEAST_WORDS = 20
PERCENT = 5
FLUSH = 200_000  # words whose features are held as Python numbers at a time
RUNS = rb"(?<![^ ])([^ ]+)(?:( [^ ]+)( [^ ]+)?)?(?![^ ])"


def lowered() -> bytes:
    """Byte to byte: A-Z to small letters, all other ASCII but digits and letters to a space."""
    return bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def feature_codes(spaced: bytes, runs) -> Iterator[np.ndarray]:
    """The CRCs of all runs of one to three words, in pieces of bounded size."""
    from zlib import crc32

    found = runs.finditer(spaced, overlapped=True)
    while True:
        codes = []
        for m in islice(found, FLUSH):
            one, two, three = m.groups()
            code = crc32(one)
            codes.append(code)
            if two:
                code = crc32(two, code)
                codes.append(code)
                if three:
                    codes.append(crc32(three, code))
        if not codes:
            return
        yield np.array(codes, np.uint32)


def features(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = (), buckets: int = BUCKETS) -> DataFrame:
    """The columns to keep (as c0, c1, ...), n_words, n_features and buckets (compressed steps between sorted buckets)."""
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], F.col(text).cast("binary").alias("t"))
    kept = rows.columns[:-1]

    def scan(batches):
        runs, small = regex.compile(RUNS), lowered()
        for batch in batches:
            n_words, n_features, packed = [], [], []
            for raw in batch["t"]:
                words = (raw.as_py() or b"").translate(small).split()
                pieces = [c % buckets for c in feature_codes(b" ".join(words), runs)]
                own = np.sort(np.concatenate(pieces)) if pieces else np.zeros(0, np.uint32)
                n_words.append(len(words))
                n_features.append(len(own))
                packed.append(pa.compress(np.diff(own, prepend=np.uint32(0)).astype("<u2" if buckets <= 1 << 16 else "<u4").tobytes(), "zstd", asbytes=True))
            columns = [*(batch[c] for c in kept), pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n_words", "n_features", "buckets"])

    small_batches(docs.sparkSession)
    fields = [f"{n} {rows.schema[n].dataType.simpleString()}" for n in kept]
    return rows.mapInArrow(scan, ", ".join([*fields, "n_words bigint, n_features bigint, buckets binary"]))


def unpacked(data: bytes, n: int, buckets: int) -> np.ndarray:
    step = "<u2" if buckets <= 1 << 16 else "<u4"
    return np.cumsum(np.frombuffer(pa.decompress(data, n * np.dtype(step).itemsize, "zstd"), step), dtype=np.int64)


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all rows of ``features``; buckets without features are left out."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for n, data in zip(batch["n_features"].to_pylist(), batch["buckets"]):
                if n:
                    total += np.bincount(unpacked(data.as_py(), n, buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return found.select("n_features", "buckets").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket, from the bucket counts of both sides."""
    both = (corpus.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
            .join(corpus.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"]))
    whole = Window.partitionBy()  # a row per bucket
    both = both.select("bucket", "s", "t", F.sum("s").over(whole).alias("all_s"), F.sum("t").over(whole).alias("all_t"))
    d = lambda c, plus: F.col(c).cast("double") + float(plus)
    ratio = d("t", 1) * d("all_s", buckets) / (d("s", 1) * d("all_t", buckets))
    return both.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def weighted(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """The columns kept, n_words, n_features and weight. The gains are of fixed size and travel with the function."""
    kept = [c for c in found.columns if c != "buckets"]
    buckets = len(gain)

    def weigh(batches):
        for batch in batches:
            out = [int(gain[unpacked(data.as_py(), n, buckets)].sum()) if n else 0 for n, data in zip(batch["n_features"].to_pylist(), batch["buckets"])]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(out, pa.int64())], names=[*kept, "weight"])

    return found.mapInArrow(weigh, field_names(found.select(kept), *[f"{n} {found.schema[n].dataType.simpleString()}" for n in kept[1:]], "weight bigint"))


def noise(key: Column, seed: int = SEED) -> Column:
    """floor(-1000 * ln(-ln(u))), with u from the first 32 bits of the hash of seed and key."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, drawable: Column, percent: int = PERCENT) -> DataFrame:
    """The rows of (c0, ..., score) with rank: 1, 2, 3 ... for the drawn share of the drawable rows, else null."""
    order = [F.desc("drawable"), F.desc("score"), F.asc_nulls_last("c0"), F.asc("tie")]
    rows = held(rows.withColumn("drawable", drawable).withColumn("tie", F.monotonically_increasing_id()), "weights")
    ranges = rows.repartitionByRange(partitions(rows.sparkSession), *order).withColumn("range", F.spark_partition_id())
    ranges = held(ranges, "ranges")
    sizes = ranges.groupBy("range").agg(F.count("*").alias("n"), F.count_if("drawable").alias("n_drawable"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    sizes = sizes.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n_drawable").over(Window.partitionBy()).alias("all_drawable"))
    place = F.col("start") + F.row_number().over(Window.partitionBy("range").orderBy(*order))
    drawn = ranges.join(F.broadcast(sizes), "range").withColumn("place", place)
    return drawn.withColumn("rank", F.when(F.col("place") <= F.expr(f"{percent} * all_drawable div 100"), F.col("place")))


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", buckets: int = BUCKETS,
             percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """Every row's key, n_features, weight, score and rank (null where not drawn) against the texts of the target."""
    found = held(features(docs, text, (key,), buckets), "features")
    gain = gains(bucket_counts(found, buckets), bucket_counts(features(target, target_text, (), buckets), buckets), buckets)
    vector = np.zeros(buckets, np.int64)
    for row in gain.collect():  # one number per bucket
        vector[row.bucket] = row.gain
    scored = weighted(found, vector).withColumn("score", F.col("weight") + noise(F.col("c0"), seed))
    out = ranked(scored, F.col("n_words") >= least_words, percent)
    return out.select(F.col("c0").alias(key), "n_features", "weight", "score", F.col("rank").cast("bigint").alias("rank"))


def op11_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
