"""Mixing sources to target weights by hash thresholds, in DataFrame functions only.

Every document has a hash. The words of a source are summed by hash bucket, the bucket in which the source's budget
ends is split into finer buckets, and so on; the last cut is one number per source, and a document is in the mix if
its hash is below it. Nothing is sorted and no document is moved: the tables between are one row per source and bucket.
A larger budget only moves the cut up, so mixes of growing budgets contain each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import kept

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
BITS = 10
LEVELS = 3
#: Names and numbers of at most so many bytes are broadcast; more sources are joined by shuffling.
BROADCAST_BYTES = 32 << 20


def n_words(text: Column | str) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def place(doc_id: Column | str, text: Column | str, seed: int = 42) -> Column:
    """A hash of ``BITS * LEVELS`` bits. Rows equal in key and text share it and are taken or left together."""
    text = F.col(text) if isinstance(text, str) else text
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    digest = F.md5(F.concat_ws("|", doc_id.cast("string"), F.md5(text), F.lit(str(seed))))
    return F.shiftright(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), 60 - BITS * LEVELS)


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``sizes`` (source, source_size) with target.

    Weights go to the sources by code point, null last, and repeat. ``share`` of all words is dealt by weight; no
    source gets over ``most`` times its size, and what that leaves is dealt again among the others. So a target is
    min(most * size, level * weight) for one level: the largest of (rest of the words) / (rest of the weights) after
    setting aside any number of sources in the order of size / weight. Windows run over one row per source.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    table = F.array(*[F.lit(float(w)) for w in weights])
    limit = F.col("source_size") * F.lit(float(most))
    earlier = Window.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    weighed = sizes.withColumn("_weight", table[turn]).withColumn("_ratio", limit / F.col("_weight"))
    rest = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum(limit).over(earlier), F.lit(0.0))
    heavy = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(earlier), F.lit(0.0))
    levelled = weighed.withColumn("_level", rest / heavy)
    return levelled.select(
        "source", "source_size", F.least(limit, F.max("_level").over(everything) * F.col("_weight")).alias("target"),
    )


def _boundary(rows: DataFrame, budgets: DataFrame, level: int) -> DataFrame:
    """The bucket of ``level`` in which each source's budget ends, with the words before it.

    ``rows`` are those of the source's bucket one level up. No row: the budget reaches the end of that bucket.
    """
    bucket = F.shiftright("place", BITS * (LEVELS - 1 - level))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    histogram = rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("_words"))
    running = histogram.withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0)))
    held = running.join(budgets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
    ends = held.where(
        (F.col("words_before") + F.col("_before") <= F.col("budget"))
        & (F.col("words_before") + F.col("_before") + F.col("_words") > F.col("budget"))
    )
    return ends.select(
        "source", "budget", "bucket", (F.col("words_before") + F.col("_before")).alias("words_before"),
        F.col("_words").alias("words_in"),
    )


def cuts(sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target, copies, cut): a document is taken ``copies`` times, and once more below ``cut``.

    ``sized`` has source, size and place, and is read once per level.
    """
    spark = sized.sparkSession
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = targets(sizes, weights, share, most)
    copies = F.when(F.col("source_size") > 0, F.floor(F.least(F.col("target") / F.col("source_size"), F.lit(most - 1)))).otherwise(0)
    aims = aims.withColumn("copies", copies.cast("int"))
    aims = kept(aims.withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size")), "mix-targets")
    open_ = aims.select("source", "budget", F.lit(0).cast("bigint").alias("words_before"))
    rows = sized
    for level in range(LEVELS):
        ends = kept(_boundary(rows, open_, level), f"mix-level{level}")
        cut = ends.select(F.col("source").alias("_s"), F.col("bucket").alias("_b"))
        if level + 1 < LEVELS:
            here = F.shiftright("place", BITS * (LEVELS - 1 - level))
            rows = rows.join(_small(cut), F.col("source").eqNullSafe(F.col("_s")) & (here == F.col("_b")), "left_semi")
        open_ = ends.drop("bucket", "words_in")
    nearer = F.col("words_before") + F.col("words_in") / 2 <= F.col("budget")
    last = ends.select(F.col("source").alias("_s"), (F.col("bucket") + nearer.cast("int")).alias("_cut"))
    ended = aims.join(last, F.col("source").eqNullSafe(F.col("_s")), "left")
    return kept(
        ended.select("source", "source_size", "target", "copies", F.coalesce("_cut", F.lit(1 << BITS * LEVELS)).alias("cut")), "mix-cuts",
    )


def _small(table: DataFrame) -> DataFrame:
    """Marked for broadcasting if its names and numbers are few enough bytes."""
    name = table.columns[0]
    size = table.agg(F.sum(F.coalesce(F.octet_length(name), F.lit(0)) + 64)).first()[0] or 0
    return F.broadcast(table) if size <= BROADCAST_BYTES else table


def mixed(docs: DataFrame, cut_table: DataFrame, seed: int = 42) -> DataFrame:
    """``docs`` with ``times``: how often the mix takes the row."""
    found = cut_table.select(F.col("source").alias("_source"), F.col("copies").alias("_copies"), F.col("cut").alias("_cut"))
    joined = docs.join(_small(found), F.col("source").eqNullSafe(F.col("_source")), "left")
    times = F.col("_copies") + (place("doc_id", "text", seed) < F.col("_cut")).cast("int")
    return joined.withColumn("times", F.coalesce(times, F.lit(0))).drop("_source", "_copies", "_cut")


def measure(docs: DataFrame, seed: int = 42) -> DataFrame:
    """(doc_id, source, size, place) of every row, kept in the shared folder: texts are read once."""
    return kept(docs.select("doc_id", "source", n_words("text").alias("size"), place("doc_id", "text", seed).alias("place")), "mix-sized")


def mix_report(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 42) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of ``docs`` (doc_id, text, source; others are ignored).

    Null or wordless texts have size 0 and are never missed; a null source is a source of its own, last in the order.
    Rows repeated in key and text are taken alike. An empty table gives no rows. What a source takes differs from its
    target by at most half of the rows that share the last hash bucket, usually one document.
    """
    sized = measure(docs, seed)
    found = cuts(sized, weights, share, most).withColumnRenamed("source", "_source")
    joined = sized.join(_small(found), F.col("source").eqNullSafe(F.col("_source")))
    times = F.col("copies") + (F.col("place") < F.col("cut")).cast("int")
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * times).cast("bigint").alias("taken"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 42) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, same columns."""
    names = docs.columns
    found = mixed(docs, cuts(measure(docs, seed), weights, share, most), seed)
    return found.where("times > 0").withColumn("times", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*names)


SQL = """
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
           ('0x' || substr(md5(concat_ws('|', doc_id::VARCHAR, md5(text), '42')), 1, 15))::BIGINT >> 30 AS place
    FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
    SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
    FROM sources),
levels AS (
    SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE - coalesce(sum(2.0::DOUBLE * source_size) OVER earlier, 0))
              / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level
    FROM weighed
    WINDOW earlier AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
aims AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, max(level) OVER () * weight) AS target FROM levels),
budgets AS (
    SELECT *, CASE WHEN source_size > 0 AND target >= source_size THEN 1 ELSE 0 END AS copies,
           target - CASE WHEN source_size > 0 AND target >= source_size THEN source_size ELSE 0 END AS budget
    FROM aims),
places AS (
    SELECT source, place, sum(size) AS words,
           coalesce(sum(sum(size)) OVER (PARTITION BY source ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sized GROUP BY source, place),
inside AS (
    SELECT p.source, p.place, before + words <= budget OR (before <= budget AND before + words / 2.0::DOUBLE <= budget) AS more
    FROM places p JOIN budgets b ON p.source IS NOT DISTINCT FROM b.source)
SELECT s.doc_id, s.size, b.source_size, b.target, (s.size * (b.copies + i.more::INT))::BIGINT AS taken
FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
JOIN inside i ON s.source IS NOT DISTINCT FROM i.source AND s.place = i.place
"""
