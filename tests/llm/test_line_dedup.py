from __future__ import annotations

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from llm_fixtures import docs, nothing, texts  # noqa: F401
from merchant_features.llm import line_dedup as L

SPACE = " \t\n\x0b\x0c\r"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=10):
    """(id -> kept lines) by the contract, in memory."""
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = line.strip(SPACE).translate(AZ)
            if len(key) >= least:
                holders[key].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keys = [x.strip(SPACE).translate(AZ) for x in lines]
        kept = [x for x, k in zip(lines, keys, strict=True) if not (len(holders[k]) > 1 and min(holders[k]) != i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def got(df, **options):
    marked = L.keep_bitmaps(df, **options)
    text = F.coalesce(F.col("row")["text"], F.lit(""))
    rows = marked.select(
        F.col("row")["doc_id"], "n_lines", "n_dropped", F.sha2(L.kept_text(text, F.col("keep_runs")).cast("binary"), 256)
    )
    return sorted(tuple(r) for r in rows.collect())


def test_equals_the_plain_version(docs, texts):
    rows = list(enumerate(texts))
    assert got(docs) == plain(rows)
    assert got(docs, buckets=1) == got(docs, buckets=7) == plain(rows)


def test_all_columns_stay(docs, texts):
    df = L.dedup_lines(docs)
    assert df.columns == docs.columns and df.count() == len(texts)
    assert df.where("text IS NULL").count() == 1
    assert {r.row for r in df.select("row").collect()} == {"r"}


def test_runs_are_a_compressed_bitmap(spark):
    rows = [(1, "\n".join(f"shared line {k}" for k in range(100))), (2, "own line at top\n" + "\n".join(f"shared line {k}" for k in range(100)) + "\nown line at end")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    second = L.keep_bitmaps(df).where(F.col("row")["doc_id"] == 2).first()
    assert [tuple(r) for r in second.keep_runs] == [(0, 1), (101, 102)] and second.n_dropped == 100


def test_rows_of_one_id_and_null_ids(spark):
    line = "a line held by several"
    rows = [(1, line), (1, line + "\nmore"), (None, line), (2, line), (2, line)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r.doc_id or 0, r.text) for r in L.dedup_lines(df).collect())
    assert kept == [(0, line), (1, line), (1, line + "\nmore"), (2, ""), (2, "")]


def test_empty_table(nothing):
    assert got(nothing) == [] and L.dedup_lines(nothing).columns == nothing.columns


def test_first_occurrences_are_streamed_in_range_partitions(spark, docs):
    from conftest import plan

    from conftest import plan

    lines = L.line_hashes(docs, "doc_id", "text", 10)
    text = plan(L._streamed(lines.withColumn("bucket", F.pmod("id", F.lit(3))), "hash", "bucket"))
    assert "rangepartitioning" in text and "hashpartitioning" not in text
    assert not any(node in text for node in ("MapInArrow", "MapInPandas", "EvalPython", "InPandas"))
