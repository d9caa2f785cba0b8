"""Token counts: an exact histogram of encoded lengths that answers every context limit.

Documents are encoded once and only their lengths leave the task. The histogram has one row per
length that occurs; sums over longer lengths then give, for any limit, how many documents and
tokens are beyond it, what is left when documents are cut to it, and quantiles.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnout.llm.tables import stored
from turnout.llm.text import text_chunks
from turnout.llm.tokens import byte_bpe

#: Lengths of one block of the histogram: sums are taken within blocks, then over blocks.
BLOCK = 4096


def encoded_lengths(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``length`` of each document in tokens; a null or empty text has none."""

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(vocabulary).encode_ordinary
        for _, texts in text_chunks(batches, "text", 1 << 20):
            counts = [len(encode(t.decode("utf-8", "replace"))) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], ["length"])

    rows = docs.select(F.col(f"`{text}`").cast("binary").alias("text"))
    return rows.mapInArrow(lengths, "length long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """``length`` and ``n_docs``, counted within tasks before they are shuffled."""
    return lengths.groupBy("length").agg(F.count("*").alias("n_docs"))


def context_limits(histogram: DataFrame) -> DataFrame:
    """One row for each length, taken as a limit.

    ``docs_over`` and ``tokens_over``: documents longer than the limit and their tokens;
    ``tokens_kept``: tokens left when each document is cut to the limit; ``n_tokens``: in documents
    of just this length; ``quantile``: the share of documents up to the limit. Between two lengths
    nothing happens but that tokens_kept grows by docs_over for each token.

    No task sums the whole histogram: a block's rows are summed by one task, and one row per block
    is summed over all blocks. Empty input gives no rows. The histogram is written once, as it is read
    twice: a row for each length, not for each document.
    """
    rows = stored(histogram, "histogram").select(
        "length",
        "n_docs",
        (F.col("length") * F.col("n_docs")).alias("n_tokens"),
        F.floor(F.col("length") / BLOCK).alias("block"),
    )
    sums = F.sum("n_docs").alias("docs"), F.sum("n_tokens").alias("tokens")
    blocks = rows.groupBy("block").agg(*sums)
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.desc("block")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("docs").over(after), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("tokens").over(after), F.lit(0)).alias("tokens_after"),
        F.sum("docs").over(whole).alias("all_docs"),
        F.sum("tokens").over(whole).alias("all_tokens"),
    )
    longer = (
        Window.partitionBy("block")
        .orderBy(F.desc("length"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    docs_over = F.coalesce(F.sum("n_docs").over(longer), F.lit(0)) + F.col("docs_after")
    tokens_over = F.coalesce(F.sum("n_tokens").over(longer), F.lit(0)) + F.col("tokens_after")
    tokens_up_to = F.col("all_tokens") - F.col("tokens_over")
    tokens_kept = tokens_up_to + F.col("length") * F.col("docs_over")
    return (
        rows.join(blocks, "block")
        .withColumn("docs_over", docs_over)
        .withColumn("tokens_over", tokens_over)
        .select(
            "length",
            "n_docs",
            "n_tokens",
            "docs_over",
            "tokens_over",
            tokens_kept.alias("tokens_kept"),
            ((F.col("all_docs") - F.col("docs_over")) / F.col("all_docs")).alias("quantile"),
        )
    )


def answer_limits(limits: DataFrame, wanted: list[int]) -> DataFrame:
    """``docs_over``, ``tokens_over`` and ``tokens_kept`` for any limits, also between lengths."""
    asked = F.explode(F.array(*(F.lit(k).cast("long") for k in wanted)))
    over = F.col("length") > F.col("limit")
    joined = limits.withColumn("limit", asked)
    return joined.groupBy("limit").agg(
        F.coalesce(F.sum(F.when(over, F.col("n_docs"))), F.lit(0)).alias("docs_over"),
        F.coalesce(F.sum(F.when(over, F.col("n_tokens"))), F.lit(0)).alias("tokens_over"),
        F.sum(F.least("length", "limit") * F.col("n_docs")).alias("tokens_kept"),
    )


def answer_quantiles(limits: DataFrame, shares: list[float]) -> DataFrame:
    """The least length up to which at least each share of the documents goes."""
    asked = F.explode(F.array(*(F.lit(s).cast("double") for s in shares)))
    joined = limits.withColumn("share", asked).filter("quantile >= share")
    return joined.groupBy("share").agg(F.min("length").alias("length"))
