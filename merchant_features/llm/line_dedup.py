"""Line deduplication: range-partitioned line hashes, first occurrences streamed in (document, position) order.

The result is a run-length coded keep bitmap per document; text is only touched
when a caller applies the bitmap. Everything is DataFrame code.

A line's key is the line without surrounding white space, A-Z lower-cased. Keys
of ``min_chars`` code points or more that occur in two or more documents lose
all their lines except those of the smallest id holding the key.

First occurrences are found in two rounds, so that a key held by a third of all
documents is never in one task. In the first round hashes are range-partitioned
together with a bucket of the document; a line that is not of the smallest
document of its (hash, bucket) is lost for certain. Only the winners, at most
``buckets`` documents per key, meet in the second round, partitioned by hash
alone. There are as many buckets as the root of the number of rows, so that the
groups of both rounds stay small. No line is ever joined with another.

Defined cases: null text is one empty line. Rows with a null id take no part and
come back unchanged. Rows that share an id are one document: their lines never
drop each other, and every row comes back. Equal rows give equal results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchant_features.llm.frames import SPACE, let, lower_az, row_columns, row_struct
from merchant_features.sources.storage import materialize

LEAST_BUCKETS = 64


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, tag, pos, hash) of every line long enough to count; ``tag`` tells rows of one id apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = (
        docs.where(F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("id"), text.alias("text"))
        .select("id", F.xxhash64("text").alias("tag"), F.posexplode(F.split(lower_az(F.col("text")), "\n")))
    )
    key = F.btrim(F.col("col"), F.lit(SPACE))
    return lines.select("id", "tag", "pos", key.alias("key")).where(F.char_length("key") >= min_chars).select(
        "id", "tag", "pos", F.unhex(F.md5("key")).alias("hash")
    )


def _streamed(lines: DataFrame, *keys: str) -> DataFrame:
    """Range-partition by ``keys``, sort by document and position, and mark what is not of the first document."""
    first = F.first("id").over(
        Window.partitionBy(*keys).orderBy("id", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return lines.repartitionByRange(*keys).withColumn("lost", F.col("id") != first)


def dropped_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, buckets: int | None = None
) -> DataFrame:
    """(id, tag, drops): the sorted positions each document loses; documents that lose none are absent."""
    lines = materialize(line_hashes(docs, id_col, text_col, min_chars))
    buckets = buckets or max(LEAST_BUCKETS, math.isqrt(docs.count()))
    salted = lines.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)))
    first_round = materialize(_streamed(salted, "hash", "bucket").drop("bucket"))
    second_round = _streamed(first_round.where(~F.col("lost")).drop("lost"), "hash")
    lost = first_round.where("lost").union(second_round.where("lost").select(first_round.columns))
    return lost.groupBy("id", "tag").agg(F.sort_array(F.collect_set("pos")).alias("drops"))


def _keep_runs(drops: Column, n_lines: Column) -> Column:
    """Half-open runs of kept lines, from the sorted dropped positions."""
    begins = F.concat(F.array(F.lit(0)), F.transform(drops, lambda p: p + 1))
    ends = F.concat(drops, F.array(n_lines))
    runs = F.arrays_zip(begins.alias("begin"), ends.alias("end"))
    return F.filter(runs, lambda r: r["end"] > r["begin"])


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                 buckets: int | None = None) -> DataFrame:
    """Every row as the struct ``row``, with ``n_lines``, ``n_dropped`` and ``keep_runs`` (null: all lines stay)."""
    drops = dropped_lines(docs, id_col, text_col, min_chars, buckets)
    rows = docs.select(row_struct(docs)).select(
        "row",
        F.col("row")[id_col].alias("id"),
        F.xxhash64(F.coalesce(F.col("row")[text_col], F.lit(""))).alias("tag"),
    )
    n_lines = F.size(F.split(F.coalesce(F.col("row")[text_col], F.lit("")), "\n"))
    marked = rows.join(drops, ["id", "tag"], "left").withColumn("n_lines", n_lines)
    return marked.select(
        "row",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.when(F.col("drops").isNull(), 0).otherwise(F.size("drops")).cast("long").alias("n_dropped"),
        F.when(F.col("drops").isNotNull(), _keep_runs(F.col("drops"), F.col("n_lines"))).alias("keep_runs"),
    )


def kept_text(text: Column, keep_runs: Column) -> Column:
    """Apply a keep bitmap; a text that loses nothing is returned as it is."""

    def joined(lines: Column) -> Column:
        run = F.transform(
            keep_runs, lambda r: F.array_join(F.slice(lines, r["begin"] + 1, r["end"] - r["begin"]), "\n")
        )
        return F.array_join(run, "\n")

    return F.when(keep_runs.isNull(), text).otherwise(let(F.split(text, "\n"), joined))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """``docs`` with the lines dropped; all rows and columns stay, null text stays null."""
    marked = keep_bitmaps(docs, id_col, text_col, min_chars)
    return marked.select(*row_columns(docs, {text_col: kept_text(F.col("row")[text_col], F.col("keep_runs"))}))
