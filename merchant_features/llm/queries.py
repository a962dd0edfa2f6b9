"""The registered queries of the text operators and their SQL statements."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchant_features.llm import decontamination, embedding_forest, filter_audit, jaccard_join, language_id, license_scan, line_dedup, mixing, quality_rules, source_divergence, suffix_dedup, token_counts, warc_zip
from merchant_features.llm.frames import table
from merchant_features.llm.occurrences import rows_of
from merchant_features.sources.storage import run_dir


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.taken_words(table(spark, sf_dir, "documents"))
    return taken.withColumnRenamed("id", "doc_id").drop("source").withColumn("shards", F.array_join("shards", ","))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = jaccard_join.similar_sets(table(spark, sf_dir, "documents"), n=3, percent=90, links=False).members
    return members.select(
        F.col("id").alias("doc_id"), F.col("size").cast("long").alias("n_shingles"),
        F.col("component").alias("component_id"), "n_links",
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    base = F.col("base")["label"]
    labels = F.concat(base, F.col("notices")["label"])
    best = F.array_max(F.col("notices")["score"])
    return found.select(
        F.col("id").alias("doc_id"), "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.col("base")["word"]).alias("first_word"), F.array_max(F.col("base")["word"]).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = line_dedup.keep_bitmaps(table(spark, sf_dir, "documents"))
    text = F.coalesce(F.col("row")["text"], F.lit(""))
    kept = line_dedup.kept_text(text, F.col("keep_runs"))
    return marked.select(
        F.col("row")["doc_id"].alias("doc_id"), "n_lines", "n_dropped",
        F.sha2(kept.cast("binary"), 256).alias("kept_sha256"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", decontamination.n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.removed_spans(table(spark, sf_dir, "documents"))
    return cut.select(
        F.col("id").alias("doc_id"), "n_bytes", suffix_dedup.n_removed().alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), "kept_sha256",
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are inserted; low-quality ones are revised to their distinct lines; toxic ones are deleted.

    The insertion is applied a second time, which must change nothing.
    """
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "source", "lang")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality", "toxic")
    ledger = token_counts.Ledger(spark, f"{run_dir(spark)}/token-counts/{uuid.uuid4().hex}")
    tokenizer = token_counts.Tokenizer("byte-bpe-50k")
    revised = rows_of(docs, labels.where("quality = 0").select("id"), "id").withColumn(
        "text", F.array_join(F.array_distinct(F.split("text", "\n")), "\n")
    )
    ledger.apply("1-insert", tokenizer, docs)
    ledger.apply("2-revise", tokenizer, revised)
    ledger.apply("3-delete", tokenizer, deletes=labels.where("toxic = 1").select("id"))
    ledger.apply("1-insert", tokenizer, docs)
    return ledger.totals()


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    # a null id is not learned from
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(True))
    model = language_id.train(docs.where(~held_out))
    predicted = language_id.predict(docs, model).withColumnRenamed("id", "doc_id")
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op10_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    packages = warc_zip.write_packages(table(spark, sf_dir, "pages"), warc_zip.package_folder(spark))
    records = warc_zip.read_records(packages)
    return records.select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_files(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


def op13_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_forest.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_source_mixing": op1_source_mixing,
        "op2_jaccard_join": op2_jaccard_join,
        "op3_license_scan": op3_license_scan,
        "op4_line_dedup": op4_line_dedup,
        "op5_decontamination": op5_decontamination,
        "op6_quality_rules": op6_quality_rules,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_token_counts": op8_token_counts,
        "op9_language_id": op9_language_id,
        "op10_warc_zip": op10_warc_zip,
        "op11_filter_audit": op11_filter_audit,
        "op12_source_divergence": op12_source_divergence,
        "op13_embedding_forest": op13_embedding_forest,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    from merchant_features.llm import oracle

    return oracle.STATEMENTS
