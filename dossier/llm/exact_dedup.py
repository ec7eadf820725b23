"""Exact duplicates: frequent digests on the map side, all others by an ordinary shuffle."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dossier.checkpoints import freeze
from dossier.llm.tables import WHITE, table

#: Frequent digests looked for.  A digest that is not among them holds less than about a
#: thousandth of all rows, and the broadcast tables have at most so many rows of 100 bytes.
FREQUENT = 1000
#: Counters of a Misra-Gries summary, and summaries that are merged before the last merge.
COUNTERS, MERGES = 4096, 64


def digest(text: Column) -> Column:
    """SHA-256 of the text without any white space; null counts as empty."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), WHITE, ""), 256)


def frequent(digests: DataFrame, column: str, most: int = FREQUENT) -> DataFrame:
    """At most ``most`` values that may be the frequent ones of ``column``.

    Misra-Gries summaries of the partitions are merged in two steps, so that no task receives
    more than a few hundredths of them.  Every value with more than ``rows / most`` rows is found.
    """
    grouped = (digests.groupBy((F.spark_partition_id() % MERGES).alias("part"))
               .agg(F.expr(f"approx_top_k_accumulate({column}, {COUNTERS})").alias("summary")))
    # grouped, as Spark cannot merge the summary of a partition without rows
    return (grouped.groupBy((F.col("part") * 0).alias("all")).agg(F.expr(f"approx_top_k_combine(summary, {COUNTERS})").alias("summary"))
            .select(F.explode(F.expr(f"approx_top_k_estimate(summary, {most})")).alias("top"))
            .select(F.col("top.item").alias(column)))


def exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                     most: int = FREQUENT) -> DataFrame:
    """For every row, which row of its equal texts stays.

    Texts are equal when their digests are.  Of equal texts, the row with the most code points
    stays, then the smallest id; a null id comes last.  Of rows that repeat an id and text one
    stays, whichever is read first, so every group keeps one row.  A null text equals the empty one and texts of
    white space only.  Returns ``doc_id, keep_id, group_size, kept, text_sha256``; other columns
    of ``docs`` are not read, an empty table gives an empty table.
    """
    slim = freeze(docs.select(
        F.col(doc_id).alias("doc_id"), digest(F.col(text)).alias("text_sha256"),
        F.coalesce(F.length(F.col(text)), F.lit(0)).alias("points"),
        F.monotonically_increasing_id().alias("row")))
    best = F.max(F.struct("points", (-F.col("doc_id")).alias("rank"), "doc_id", (-F.col("row")).alias("row")))
    candidates = freeze(frequent(slim, "text_sha256", most))
    hot = slim.join(F.broadcast(candidates), "text_sha256", "left_semi")
    winners = freeze(hot.groupBy("text_sha256").agg(best.alias("best"), F.count("*").alias("group_size")))
    by_map = slim.join(F.broadcast(winners), "text_sha256")
    same = Window.partitionBy("text_sha256")
    by_shuffle = (slim.join(F.broadcast(candidates), "text_sha256", "left_anti")
                  .withColumn("best", best.over(same))
                  .withColumn("group_size", F.count("*").over(same)))
    return by_map.unionByName(by_shuffle).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == -F.col("best.row")).alias("kept"), "text_sha256")


def op6_exact_dedup(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents"))


SQL = r"""WITH d AS (SELECT doc_id, coalesce(length(text), 0) AS points,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
w AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w"""
