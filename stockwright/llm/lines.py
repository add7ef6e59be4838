"""Line de-duplication over windows of three lines.

Every three consecutive lines of a text are a window, known by two 64-bit hashes. A window is repeated if another
document with a smaller id holds it, or if it stands earlier in the same text. The lines that later occurrences cover
are merged and taken out; first occurrences stay. Texts of fewer than three lines have no window. A window of three
blank lines is none, so that layout alone is no repetition.

Only built-in functions. First occurrences are found by an aggregate that shrinks in the map tasks, so a window that
stands in a third of all documents costs one row per task; only windows held by several documents are joined back.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .tables import table

WIDTH = 3
LAST = (1 << 63) - 1


def windows(lines: Column, width: int = WIDTH) -> Column:
    """An array of struct(at, h1, h2), one for each window that is not blank."""
    def window(at: Column) -> Column:
        parts = [F.get(lines, at + i) for i in range(width)]
        blank = F.trim(F.concat(*parts)) == ""
        return F.struct(at.alias("at"), F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(width), *parts).alias("h2"), blank.alias("blank"))

    some = F.when(F.size(lines) >= width, F.sequence(F.lit(0), F.size(lines) - width)).otherwise(F.array().cast("array<int>"))
    return F.filter(F.transform(some, window), lambda w: ~w.blank)


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text with repeated windows: the key (k), the text's hash (th) and the lines to remove (removed).

    The key orders documents (a null key comes last). Rows that share a key do not make each other's windows repeated;
    rows equal in key and text are treated alike.
    """
    rows = docs.select(F.coalesce(F.col(key).cast("bigint"), F.lit(LAST)).alias("k"), F.xxhash64(text).alias("th"), F.split(F.col(text), "\n").alias("lines"))
    found = rows.where(F.size("lines") >= WIDTH).select("k", "th", F.explode(windows(F.col("lines"))).alias("w"))
    found = found.select("k", "th", F.col("w.at").alias("at"), F.col("w.h1").alias("h1"), F.col("w.h2").alias("h2"))
    several = found.groupBy("h1", "h2").agg(F.min("k").alias("first"), F.count("*").alias("n")).where("n > 1").select("h1", "h2", "first")
    hits = found.join(several, ["h1", "h2"])
    # Within a text: the places of one window, of which only later ones count where the document holds it first.
    places = hits.groupBy("k", "th", "h1", "h2").agg(F.min("at").alias("first_at"), F.collect_set("at").alias("places"), F.first("first").alias("first"))
    later = places.select("k", "th", F.explode(F.when(F.col("first") < F.col("k"), F.col("places")).otherwise(
        F.array_remove(F.col("places"), F.col("first_at")))).alias("at"))
    covered = F.array_distinct(F.flatten(F.transform(F.collect_set("at"), lambda p: F.sequence(p, p + WIDTH - 1))))
    return later.groupBy("k", "th").agg(covered.alias("removed"))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns; repeated lines are taken out of the text, and n_removed tells how many.

    A null text stays null. A text whose lines all go becomes empty. A column n_removed of the rows gives way to the result.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    k, t = (names[docs.columns.index(c)] for c in (key, text))
    rows = docs.toDF(*names)
    gone = repeated_lines(rows, k, t)
    joined = rows.withColumn("k", F.coalesce(F.col(k).cast("bigint"), F.lit(LAST))).withColumn("th", F.xxhash64(t)).join(gone, ["k", "th"], "left")
    joined = joined.withColumn("lines", F.when(F.col("removed").isNotNull(), F.split(F.col(t), "\n")))
    lines = F.col("lines")  # a column: inside the lambda the text would be split again for each line
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed")), lambda i: F.get(lines, i))
    new = F.when(F.col("removed").isNull(), F.col(t)).otherwise(F.array_join(left, "\n"))
    outs = [(new if n == t else F.col(n)).alias(c) for n, c in zip(names, docs.columns) if c.lower() != "n_removed"]
    return joined.select(*outs, F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: lines before, lines removed, and the SHA-256 of what is left (of the empty text for a null)."""
    docs = table(spark, folder, "documents").select("doc_id", "text", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("bigint").alias("n_lines"))
    out = without_repeats(docs)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


def line_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Takes repeated lines out; a document that has nothing left (all of it stands elsewhere) goes, the others stay.

    n_chars, where there is one, is counted anew for changed texts.
    """
    names = [f"d{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names))
    text = at["text"]
    out = without_repeats(docs.toDF(*names), at["doc_id"], text).where((F.col("n_removed") == 0) | (F.trim(text) != ""))
    if "n_chars" in at:
        out = out.withColumn(at["n_chars"], F.when(F.col("n_removed") > 0, F.char_length(text).cast("bigint")).otherwise(F.col(at["n_chars"])))
    return out.select(*names).toDF(*docs.columns)


OP4_SQL = """
WITH docs AS (
  SELECT doc_id, text, coalesce(doc_id, 9223372036854775807) AS k, string_split(text, chr(10)) AS lines FROM documents),
wins AS (
  SELECT k, text, unnest(range(1, len(lines) - 1)) AS p, lines FROM (SELECT DISTINCT k, text, lines FROM docs WHERE len(lines) >= 3)),
w AS (
  SELECT k, text, p, lines[p] || chr(10) || lines[p + 1] || chr(10) || lines[p + 2] AS win FROM wins
  WHERE trim(lines[p] || lines[p + 1] || lines[p + 2], ' ') <> ''),
firsts AS (SELECT win, min(k) AS first FROM w GROUP BY win),
marked AS (
  SELECT w.k, w.text, w.p, first < w.k OR row_number() OVER (PARTITION BY w.k, w.text, w.win ORDER BY p) > 1 AS later
  FROM w JOIN firsts USING (win)),
gone AS (
  SELECT k, text, list_distinct(flatten(list([p, p + 1, p + 2]))) AS removed FROM marked WHERE later GROUP BY k, text)
SELECT doc_id, CAST(len(string_split(coalesce(d.text, ''), chr(10))) AS BIGINT) AS n_lines,
       CAST(coalesce(len(removed), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN removed IS NULL THEN coalesce(d.text, '') ELSE array_to_string(
         list_transform(list_filter(range(1, len(lines) + 1), lambda i: NOT list_contains(removed, i)), lambda i: lines[i]), chr(10)) END) AS text_sha256
FROM docs d LEFT JOIN gone g ON d.k = g.k AND d.text = g.text
"""
