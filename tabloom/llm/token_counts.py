"""Token counts from the exact histogram of encoded lengths.

Documents are aggregated by encoded length; sums over all shorter and all longer lengths then answer totals, quantiles
and totals under truncation for every context limit, without reading a document again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm import bpe
from tabloom.llm.common import kept, on_executors, sliced

#: Lengths summed in one window partition; sums of such stretches go through a second window, one row each.
STRETCH = 1 << 10


def lengths(docs: DataFrame, tokenizer, text: str = "text") -> DataFrame:
    """(n_tokens) of every row; null and empty texts have 0."""
    name, tables = tokenizer

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = bpe._automaton(name, tables)
        for batch in sliced(batches, 1024):
            yield pa.RecordBatch.from_arrays([pa.array(automaton.lengths(batch.column(0)), pa.int64())], ["n_tokens"])

    return on_executors(docs.select(text), run, "n_tokens bigint")


def histogram(counted: DataFrame) -> DataFrame:
    """(n_tokens, n_docs) of a table with n_tokens: one row per length that occurs."""
    return counted.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def sums(lengths_histogram: DataFrame) -> DataFrame:
    """A row per length that occurs, ascending sums and what they answer if the length is the context limit.

    n_docs; docs_upto, tokens_upto (documents no longer, and their tokens); docs_over (longer ones); truncated_total
    (tokens left when longer documents are cut to the limit); quantile (share of documents no longer); total_docs and
    total_tokens. An empty table gives no rows. Windows see ``STRETCH`` rows, or one row per stretch.
    """
    stretch = F.floor(F.col("n_tokens") / STRETCH)
    inner = Window.partitionBy("_stretch").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    tokens = F.col("n_tokens") * F.col("n_docs")
    base = lengths_histogram.withColumn("_stretch", stretch)
    stretches = base.groupBy(F.col("_stretch").alias("_s")).agg(F.sum("n_docs").alias("_d"), F.sum(tokens).alias("_t"))
    stretches = stretches.select(
        "_s", F.coalesce(F.sum("_d").over(outer), F.lit(0)).alias("_docs"), F.coalesce(F.sum("_t").over(outer), F.lit(0)).alias("_tokens"),
        F.sum("_d").over(everything).alias("total_docs"), F.sum("_t").over(everything).alias("total_tokens"),
    )
    joined = base.join(stretches, F.col("_stretch") == F.col("_s"))
    upto = joined.withColumn("docs_upto", F.col("_docs") + F.sum("n_docs").over(inner)).withColumn("tokens_upto", F.col("_tokens") + F.sum(tokens).over(inner))
    over = F.col("total_docs") - F.col("docs_upto")
    return upto.select(
        "n_tokens", "n_docs", "docs_upto", "tokens_upto", over.alias("docs_over"),
        (F.col("tokens_upto") + F.col("n_tokens") * over).alias("truncated_total"),
        (F.col("docs_upto") / F.col("total_docs")).alias("quantile"), "total_docs", "total_tokens",
    )


def truncated_totals(summed: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(context_limit, truncated_total) for any limits: between two lengths the total grows by docs_over a token."""
    row = summed.agg(F.max("total_docs").alias("_all"), *[_found_at(x).alias(f"_{int(x)}") for x in limits])
    asked = F.array(*[F.struct(F.lit(int(x)).cast("bigint").alias("at"), F.col(f"_{int(x)}").alias("hit")) for x in limits])
    long = row.select("_all", F.explode(asked).alias("x"))
    total = F.coalesce(F.col("x.hit.tokens_upto") + F.col("x.at") * F.col("x.hit.docs_over"), F.col("x.at") * F.col("_all"), F.lit(0))
    return long.select(F.col("x.at").alias("context_limit"), total.alias("truncated_total"))


def _found_at(limit: int):
    """The sums at the longest length within a limit, as one aggregate."""
    here = F.col("n_tokens") <= int(limit)
    return F.max_by(F.when(here, F.struct("tokens_upto", "docs_over")), F.when(here, F.col("n_tokens")))


def quantiles(summed: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, n_tokens): the smallest length that at least this share of the documents does not exceed."""
    row = summed.agg(*[F.min(F.when(F.col("docs_upto") >= F.ceil(F.col("total_docs") * float(q)), F.col("n_tokens"))).alias(f"_{i}") for i, q in enumerate(shares)])
    return row.select(F.explode(F.array(*[F.struct(F.lit(float(q)).alias("share"), F.col(f"_{i}").alias("n_tokens")) for i, q in enumerate(shares)])).alias("x")).select("x.*")


def token_counts(docs: DataFrame, tokenizer, text: str = "text") -> DataFrame:
    """``sums`` of the texts of a table. Null texts count as documents of length 0; other columns are not read."""
    return sums(kept(histogram(lengths(docs, tokenizer, text)), "length-histogram"))
