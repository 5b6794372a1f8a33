"""Line deduplication by distinct-site spread, in DataFrame functions only.

A line that stands on many sites is boilerplate. Each line's sites go into a HyperLogLog sketch, sketches merge by
aggregation, and only lines whose estimate is near the threshold are counted exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import kept

MIN_SITES = 5
LG_K = 12
#: Estimates within this share of the threshold (five standard errors of a sketch of 2^12 registers), or within one
#: site of it, are replaced by exact counts.
NEAR = 0.082
BLANKS = " \t\r\x0b\x0c"


def _lines(text: Column | str) -> Column:
    return F.split(text, "\n")


def _text_key(text: Column | str) -> list[Column]:
    return [F.xxhash64(text).alias("t1"), F.hash(text, F.lit(7)).alias("t2")]


def line_table(docs: DataFrame, site: str = "source") -> DataFrame:
    """(k1, k2, t1, t2, at, site): hash of each line that is not blank, hash of its text, its place, its site.

    Written to the shared folder, a few bytes for each line.
    """
    cut = docs.where("text IS NOT NULL").select(
        F.col(site).cast("string").alias("site"), *_text_key("text"), F.posexplode(_lines("text")).alias("at", "line"),
    )
    bare = F.btrim("line", F.lit(BLANKS))
    keys = cut.where(bare != "").select(F.xxhash64(bare).alias("k1"), F.hash(bare).alias("k2"), "t1", "t2", "at", "site")
    return kept(keys, "lines")


def spread(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(k1, k2, sites, exact) of the lines that stand, or nearly stand, on ``min_sites`` sites. Null sites do not count."""
    band = max(1.0, NEAR * min_sites)
    sketches = lines.groupBy("k1", "k2").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"))
    estimated = sketches.select("k1", "k2", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= min_sites - band)
    estimated = kept(estimated, "line-spread")
    near = estimated.where(F.col("sites") <= min_sites + band)
    counted = lines.join(near.select("k1", "k2"), ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.countDistinct("site").alias("sites"))
    sure = estimated.where(F.col("sites") > min_sites + band)
    return sure.withColumn("exact", F.lit(False)).unionByName(counted.withColumn("exact", F.lit(True)))


def clean_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with ``text`` cleaned and the columns ``n_lines`` and ``n_removed`` (numbers of lines; replaced if there).

    Lines are compared without blanks around them; blank lines are never boilerplate. A text of which no line of its own
    would be left, blank lines aside, is a copy of other texts rather than a page with boilerplate: it stays whole, and
    document deduplication decides about it. Null text: null, no lines. Sites that are null do not count. Repeated rows
    stay repeated and are cleaned alike. No rows in, no rows out.
    """
    made = ("n_lines", "n_removed")
    names = [n for n in docs.columns if n not in made]
    lines = line_table(docs, site)
    boilerplate = kept(spread(lines, min_sites).where(F.col("sites") >= min_sites).select("k1", "k2"), "boilerplate")
    drop = lines.join(boilerplate, ["k1", "k2"], "left_semi").groupBy("t1", "t2").agg(F.collect_set("at").alias("drop"))
    keyed = docs.select(F.struct(*[F.col(f"`{n}`") for n in names if n != "text"], F.lit(0).alias("_")).alias("row"), F.col("text").alias("whole"), *_text_key("text"))
    drop = drop.select(F.col("t1").alias("d1"), F.col("t2").alias("d2"), "drop")
    joined = keyed.join(drop, (F.col("t1") == F.col("d1")) & (F.col("t2") == F.col("d2")), "left")
    all_lines = _lines("whole")
    stay = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("drop"))
    cleaned = F.array_join(F.transform(stay, lambda i: F.get(F.col("lines"), i)), "\n")
    joined = joined.withColumn("lines", F.when(F.col("drop").isNotNull(), all_lines)).withColumn("clean", cleaned)
    cut = F.col("clean").isNotNull() & (F.btrim("clean", F.lit(BLANKS + "\n")) != "")
    return joined.select(
        *[F.when(cut, F.col("clean")).otherwise(F.col("whole")).alias(n) if n == "text" else F.col("row").getField(n).alias(n) for n in names],
        F.when(F.col("whole").isNull(), 0).otherwise(F.size(all_lines)).cast("bigint").alias("n_lines"),
        F.when(cut, F.size("drop")).otherwise(0).cast("bigint").alias("n_removed"),
    )


SQL = """
WITH texts AS (SELECT row_number() OVER () AS r, * FROM documents),
cut AS (
    SELECT r, source, i AS pos, string_split(text, chr(10))[i] AS line
    FROM texts, unnest(generate_series(1, len(string_split(text, chr(10))))) AS u(i)),
bare AS (SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS key FROM cut),
boilerplate AS (SELECT key FROM bare WHERE key <> '' GROUP BY key HAVING count(DISTINCT source) >= 5),
cleaned AS (
    SELECT r, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE b.key IS NULL), '') AS text,
           count(*) AS n_lines, count(b.key) AS n_removed, count(*) FILTER (WHERE b.key IS NULL AND key <> '') AS n_own
    FROM bare LEFT JOIN boilerplate b USING (key) GROUP BY r)
SELECT t.doc_id,
       CASE WHEN n_removed > 0 AND n_own > 0 THEN c.text ELSE t.text END AS text,
       coalesce(n_lines, 0)::BIGINT AS n_lines,
       CASE WHEN n_removed > 0 AND n_own > 0 THEN n_removed ELSE 0 END::BIGINT AS n_removed
FROM texts t LEFT JOIN cleaned c USING (r)
"""
