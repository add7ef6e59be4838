"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter trigram is bound as the product of its three letter vectors,
the first turned by two places and the second by one. A document is the sum (bundle) of its trigram vectors, a language
the sum of its documents scaled to length one. The predicted language is the one with the largest cosine.

Bundling is a sum, so a task adds up its own documents and only languages x dimensions numbers per task are shuffled.
The prototypes are languages x dimensions numbers; more than ``max_languages`` languages is an error, which bounds
what is sent to the tasks. Texts of any length are read whole: long ones are bundled piece by piece.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import fold, small_batches, table

DIMENSIONS = 1024
SEED = 20_240_601
SCALE = 1_000_000  # unit vectors are summed as whole numbers, so that the sum does not depend on its order
PIECE = 200_000  # characters bundled at once; what a text's bundle is does not depend on it
UNKNOWN = "und"
COST = 0.25  # of losing a document whose language is right, where one whose language is wrong is worth 1
STEPS = 1000  # thresholds tried between 0 and 1


def ranked(values: np.ndarray, dense: int = 1 << 23) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and the place of each value among them."""
    if values.max(initial=0) >= dense:
        return np.unique(values, return_inverse=True)
    found = np.flatnonzero(np.bincount(values))
    place = np.zeros(found.max(initial=0) + 1, np.int64)
    place[found] = np.arange(len(found))
    return found, place[values]


class Bundler:
    """Turns texts into bundles of trigram vectors."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        self.dimensions, self.seed = dimensions, seed
        self.letters: dict[int, np.ndarray] = {}
        self.is_letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            bits = np.random.Generator(np.random.Philox(key=[self.seed, code])).integers(0, 2, self.dimensions, np.int8)
            self.letters[code] = bits * 2 - 1
        return self.letters[code]

    def pieces(self, text: str) -> Iterator[np.ndarray]:
        """Lower-case letters; every run of other characters, the start and the end is one 0.

        Each piece begins with the last two codes of the one before, so that every trigram lies in exactly one.
        """
        lower, last = text.lower(), np.zeros(1, np.int64)
        for at in range(0, len(lower), PIECE):
            raw = np.frombuffer(lower[at : at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
            end = [0] if at + PIECE >= len(lower) else []
            raw = np.concatenate([last, np.where(self.is_letter[raw], raw, 0), end]).astype(np.int64)
            keep = np.ones(len(raw), bool)
            keep[1:] = (raw[1:] != 0) | (raw[:-1] != 0)
            found = raw[keep]
            last = found[-2:]
            yield found

    def bundle(self, texts: list[str]) -> np.ndarray:
        """One row per text; a row of zeros for a text without letters."""
        out = np.zeros((len(texts), self.dimensions), np.float64)
        rows, parts, size = [], [], 0
        for row, text in enumerate(texts):
            for part in self.pieces(text):
                if len(part) > 2:
                    rows.append(row)
                    parts.append(part)
                    size += len(part)
                if size >= PIECE:
                    self.add(out, rows, parts)
                    rows, parts, size = [], [], 0
        if parts:
            self.add(out, rows, parts)
        return out

    def add(self, out: np.ndarray, rows: list[int], parts: list[np.ndarray]) -> None:
        codes = np.concatenate(parts)
        part = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        alphabet, codes = ranked(codes)
        inside = part[2:] == part[:-2]
        size = len(alphabet)
        key = ((codes[:-2] * size + codes[1:-1]) * size + codes[2:])[inside]
        grams, key = ranked(key)
        counts = np.bincount(part[2:][inside] * len(grams) + key, minlength=len(parts) * len(grams))
        counts = counts.reshape(len(parts), len(grams)).astype(np.float32)
        v = np.stack([self.letter(int(c)) for c in alphabet])
        a, b, c = grams // (size * size), grams // size % size, grams % size
        bound = np.roll(v, 2, axis=1)[a] * np.roll(v, 1, axis=1)[b] * v[c]
        for at in range(0, len(grams), 4096):
            np.add.at(out, rows, (counts[:, at : at + 4096] @ bound[at : at + 4096].astype(np.float32)).astype(np.float64))


def unit(bundles: np.ndarray) -> np.ndarray:
    length = np.sqrt((bundles**2).sum(axis=1, keepdims=True))
    return np.divide(bundles, length, out=np.zeros_like(bundles), where=length > 0)


def slices(batch: pa.RecordBatch, rows: int = 128) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def profiles(docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, seed: int = SEED,
             max_languages: int = 1000) -> dict[str, np.ndarray]:
    """The prototype of every language among the given rows. Rows with a null text or language teach nothing."""

    def learn(batches):
        bundler, sums = Bundler(dimensions, seed), {}
        for batch in batches:
            for part in slices(batch):
                vectors = np.rint(unit(bundler.bundle(part["t"].to_pylist())) * SCALE).astype(np.int64)
                names = np.array(part["l"].to_pylist(), object)
                for name in set(names):
                    sums[name] = sums.get(name, 0) + vectors[names == name].sum(axis=0)
        for name, vector in sums.items():
            yield pa.RecordBatch.from_pydict({"l": [name] * dimensions, "i": np.arange(dimensions, dtype=np.int32), "v": vector})

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(text).alias("t"), F.col(lang).cast("string").alias("l")).where("t is not null and l is not null")
    sums = rows.mapInArrow(learn, "l string, i int, v bigint").groupBy("l", "i").agg(F.sum("v").alias("v"))
    found = sums.limit(max_languages * dimensions + 1).collect()
    if len(found) > max_languages * dimensions:
        raise ValueError(f"more than {max_languages} languages")
    out: dict[str, np.ndarray] = {}
    for r in sorted(found):
        out.setdefault(r.l, np.zeros(dimensions))[r.i] = r.v
    return {name: v for name, v in out.items() if v.any()}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (),
            seed: int = SEED) -> DataFrame:
    """key, the columns to keep, lang_pred and score (cosine, 0 to 1).

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned. Ties go to the language that
    comes first in the alphabet. Repeated rows each get their row.
    """
    names = sorted(prototypes)
    matrix = unit(np.stack([prototypes[n] for n in names])) if names else np.zeros((1, 1))
    dimensions = matrix.shape[1]
    rows = docs.select(F.col(key), *keep, F.col(text).alias("__text"))
    others = rows.columns[:-1]

    def score(batches):
        bundler = Bundler(dimensions, seed)
        for batch in batches:
            for part in slices(batch):
                texts = [t or "" for t in part["__text"].to_pylist()]
                vectors = unit(bundler.bundle(texts)) if names else np.zeros((len(texts), dimensions))
                cosines = vectors @ matrix.T
                best = cosines.argmax(axis=1)
                blank = ~vectors.any(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*(part[c] for c in others), pa.array([UNKNOWN if b else names[i] for b, i in zip(blank, best)], pa.string()),
                     pa.array(np.where(blank, 0.0, np.clip(cosines[np.arange(len(best)), best], 0, 1)))],
                    names=[*others, "lang_pred", "score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(score, ", ".join([*fields, "lang_pred string", "score double"]))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", (fold("doc_id", 5) == 0).alias("held_out"))
    learned = profiles(docs.where(~F.col("held_out")))
    return predict(docs, learned, keep=("held_out",))


def threshold(scored: DataFrame, lang: str = "lang", cost: float = COST) -> float:
    """The score below which labelled rows are wrong so often that they are better lost.

    A row below it whose language is not as labelled counts 1, one that is right counts -cost; the threshold is the one
    with the largest sum, the least of those with equal sums, 0 where none is above 0 (without labelled rows, say). With a
    cost of 0.25 the rows lost that are right are at most four times those that are wrong.
    """
    hit = F.col("lang_pred") == F.col(lang).cast("string")
    rows = scored.where((F.col("lang_pred") != UNKNOWN) & F.col(lang).isNotNull()).groupBy(F.floor(F.col("score") * STEPS).alias("at"))
    gain = best = least = 0.0
    for r in sorted(rows.agg(F.count("*").alias("n"), F.count_if(hit).alias("hits")).collect()):
        gain += r.n - r.hits - cost * r.hits
        if gain > best:
            best, least = gain, (r["at"] + 1) / STEPS
    return least


def identify_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps the documents in which a language is recognised: those without any letter go, and those whose score is below a
    threshold that is calibrated on the labelled documents held out from learning."""
    learned = profiles(docs.where(fold("doc_id", 5) != 0))
    columns = docs.columns
    least = threshold(predict(docs.where(fold("doc_id", 5) == 0), learned, keep=("lang",)))
    renamed = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    at = {name: f"c{columns.index(name)}" for name in ("doc_id", "text")}
    kept = predict(renamed.withColumn("key", F.col(at["doc_id"])), learned, key="key", text=at["text"], keep=tuple(renamed.columns))
    return kept.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(columns)])
