"""Line dedup by a suffix array over line-ID sequences, built by prefix doubling.

A document is a sequence of lines.  Suffixes that agree in their first 2^k
lines form one class of the suffix array at depth 2^k (an interval of longest
common prefix 2^k or more); a class is named by its first position in
(doc_id, text, line) order, so its name tells the first copy at once.  Level
k + 1 pairs a suffix's name with that of the suffix 2^k lines on.  Classes of
one suffix drop out, so each level only holds what still repeats.

A repeated run counts from ``MIN_WORDS`` words on.  Every line of a maximal
repeated run lies in a smallest window of that many words, counted forward
from its first or backward from its last line, that also repeats; such a
window of n lines is named by its two overlapping halves of 2^k <= n lines.
Lines in a window that has an earlier copy are deleted, all judged on the
input, so of each maximal run the first copy stays.

Class names come from map-side combined aggregations, so a line that a third
of the rows share costs one row a task; rows get them by joins that AQE can
split.  Everything is DataFrame operations; texts are not shuffled as long as
the list of changed documents is small enough to broadcast.

Null text has no lines and stays null; empty text has one empty line.  A null
id comes first.  Rows that share id and text are one document and stay alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featurewright.llm.common import documents, new_value, small_side, staged
from featurewright.llm.mixing import n_words

MIN_WORDS = 20


def _lines(docs: DataFrame) -> DataFrame:
    """d (id), h (text hash), l (line number), w (words), and the line's 128-bit key; one copy of repeated rows."""
    lines = docs.select("d", "h", F.posexplode(F.split("text", "\n", -1)).alias("l", "line"))
    return lines.select("d", "h", "l", n_words(F.col("line")).alias("w"), F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), "line").alias("k2"))


def _named(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key is shared, with the class's first position ``name``; the key goes."""
    first = (
        rows.groupBy(*[F.col(k).alias(f"f_{k}") for k in key])
        .agg(F.min(F.struct("d", "h", "l")).alias("name"), F.max(F.struct("d", "h", "l")).alias("last"))
        .filter("name <> last").drop("last")
    )
    on = [F.col(k) == F.col(f"f_{k}") for k in key]
    return rows.join(first, on).drop(*key, *[f"f_{k}" for k in key])


def _windows(rows: DataFrame, min_words: int) -> DataFrame:
    """(d, h, start, n): smallest windows of ``min_words`` words inside unbroken stretches of repeated lines."""
    doc = ["d", "h"]
    isle = F.col("l") - F.row_number().over(Window.partitionBy(*doc).orderBy("l"))
    r = rows.select(*doc, "l", "w").withColumn("isle", isle)
    upto = F.sum("w").over(Window.partitionBy(*doc, "isle").orderBy("l"))
    r = r.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("w"))
    part = Window.partitionBy(*doc, "isle")
    # forward: the first line at which the words from "l" on reach the minimum
    ends = r.select(*doc, "isle", F.col("upto").alias("at"), F.lit(0).alias("asks"), "l", F.col("l").alias("here"))
    asks = r.select(*doc, "isle", (F.col("before") + min_words).alias("at"), F.lit(1).alias("asks"), "l", F.lit(None).cast("int").alias("here"))
    seen = F.min("here").over(part.orderBy(F.desc("at"), "asks", F.desc("l")).rowsBetween(Window.unboundedPreceding, 0))
    fwd = ends.union(asks).withColumn("to", seen).filter("asks = 1 AND to IS NOT NULL").select(*doc, F.col("l").alias("start"), (F.col("to") - F.col("l") + 1).alias("n"))
    # backward: the last line from which the words up to "l" reach it
    ends = r.select(*doc, "isle", F.col("before").alias("at"), F.lit(0).alias("asks"), "l", F.col("l").alias("here"))
    asks = r.select(*doc, "isle", (F.col("upto") - min_words).alias("at"), F.lit(1).alias("asks"), "l", F.lit(None).cast("int").alias("here"))
    seen = F.max("here").over(part.orderBy("at", "asks", "l").rowsBetween(Window.unboundedPreceding, 0))
    back = ends.union(asks).withColumn("from", seen).filter("asks = 1 AND from IS NOT NULL").select(*doc, F.col("from").alias("start"), (F.col("l") - F.col("from") + 1).alias("n"))
    return fwd.union(back).distinct()


def removed_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(d, h, runs, n_removed) per document that loses lines: maximal removed runs as (first, last) line."""
    src = docs.select(F.col(id_col).alias("d"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    lines = staged(_lines(src))
    # a document given twice is one document: its lines are taken once
    level = staged(_named(lines.dropDuplicates(["d", "h", "l"]), ["k1", "k2"]))
    windows = staged(_windows(level, min_words))
    longest = windows.agg(F.max("n")).first()[0] or 0
    later, k = None, 0
    while 1 << k <= longest:
        size = 1 << k
        a = level.select(F.col("d").alias("a_d"), F.col("h").alias("a_h"), F.col("l").alias("a_l"), F.col("name").alias("head"))
        b = level.select(F.col("d").alias("b_d"), F.col("h").alias("b_h"), F.col("l").alias("b_l"), F.col("name").alias("tail"))
        mine = windows.filter((F.col("n") >= size) & (F.col("n") < 2 * size))
        named = (
            mine.join(a, F.col("d").eqNullSafe(F.col("a_d")) & (F.col("h") == F.col("a_h")) & (F.col("start") == F.col("a_l")))
            .join(b, F.col("d").eqNullSafe(F.col("b_d")) & (F.col("h") == F.col("b_h")) & (F.col("start") + F.col("n") - size == F.col("b_l")))
            .select("d", "h", F.col("start").alias("l"), "n", "head", "tail")
        )
        copies = _named(named.withColumn("span", F.col("n")), ["span", "head", "tail"])
        copies = staged(copies.filter(F.struct("d", "h", "l") != F.col("name")).select("d", "h", F.col("l").alias("start"), "n"))
        later = copies if later is None else later.union(copies)
        k += 1
        if 1 << k <= longest:
            ahead = Window.partitionBy("d", "h").orderBy("l").rangeBetween(size, size)
            pairs = level.withColumn("next", F.first("name").over(ahead)).filter("next IS NOT NULL").withColumnRenamed("name", "this")
            level = staged(_named(pairs, ["this", "next"]))
    if later is None:
        later = windows.select("d", "h", "start", "n").limit(0)
    gone = later.select("d", "h", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("l")).distinct()
    isle = F.col("l") - F.row_number().over(Window.partitionBy("d", "h").orderBy("l"))
    runs = gone.withColumn("isle", isle).groupBy("d", "h", "isle").agg(F.min("l").alias("first"), F.max("l").alias("last"))
    return runs.groupBy("d", "h").agg(
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"), F.sum(F.col("last") - F.col("first") + 1).cast("long").alias("n_removed")
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` as struct ``doc``, with new_text, n_lines, n_removed, n_runs."""
    runs = staged(removed_runs(docs, id_col, text_col, min_words).select(F.col("d").alias("r_d"), F.col("h").alias("r_h"), "runs", "n_removed"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(id_col).alias("d"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    out = rows.join(small_side(runs), F.col("d").eqNullSafe(F.col("r_d")) & (F.col("h") == F.col("r_h")), "left")
    lines = F.split("text", "\n", -1)
    left = F.filter(lines, lambda x, i: ~F.exists("runs", lambda r: (i >= r["first"]) & (i <= r["last"])))
    return out.select(
        "doc",
        F.when(F.col("runs").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias("new_text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("runs").isNull(), 0).otherwise(F.size("runs")).cast("long").alias("n_runs"),
    )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the texts that are left; documents that lose every line go, ``n_chars`` follows a changed text."""
    out = dedup_lines(docs, id_col, text_col, min_words).filter("n_removed = 0 OR n_removed < n_lines")
    return out.select(*[new_value(c, text_col, F.col("new_text"), F.col("n_removed") > 0, F.col("doc")[c]).alias(c) for c in docs.columns])


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir)).select(
        "doc.doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("new_text", F.lit("")), 256).alias("kept_sha256")
    )


SQL = f"""
WITH d AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS l, unnest(string_split(text, chr(10))) AS line FROM documents),
w AS (SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS w FROM d),
c AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY l) AS upto FROM w),
f AS (SELECT a.doc_id, a.l AS first, min(b.l) AS last FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.l >= a.l AND b.upto - a.upto + a.w >= {MIN_WORDS} GROUP BY 1, 2),
g AS (SELECT b.doc_id, max(a.l) AS first, b.l AS last FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.l >= a.l AND b.upto - a.upto + a.w >= {MIN_WORDS} GROUP BY 1, 3),
s AS (SELECT u.doc_id, u.first, u.last, string_agg(c.line, chr(10) ORDER BY c.l) AS content
      FROM (SELECT * FROM f UNION SELECT * FROM g) u JOIN c ON c.doc_id = u.doc_id AND c.l BETWEEN u.first AND u.last GROUP BY 1, 2, 3),
o AS (SELECT *, row_number() OVER (PARTITION BY content, last - first ORDER BY doc_id, first) AS copy FROM s),
gone AS (SELECT DISTINCT c.doc_id, c.l FROM o JOIN c ON c.doc_id = o.doc_id AND c.l BETWEEN o.first AND o.last WHERE copy > 1),
m AS (SELECT c.doc_id, c.l, c.line, gone.l IS NOT NULL AS removed FROM c LEFT JOIN gone ON c.doc_id = gone.doc_id AND c.l = gone.l),
r AS (SELECT *, removed AND NOT coalesce(lag(removed) OVER (PARTITION BY doc_id ORDER BY l), false) AS begins FROM m)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE removed) AS n_removed, count(*) FILTER (WHERE begins) AS n_runs,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY l) FILTER (WHERE NOT removed), '')) AS kept_sha256
FROM r GROUP BY doc_id
"""
