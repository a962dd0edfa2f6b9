"""Every stage on a small table against plain versions, and the stages chained."""

from __future__ import annotations

import random

import pytest
import test_decontamination
import test_jaccard_join
import test_line_dedup

import corpus_pipeline
from llm_fixtures import noise
from merchant_features.llm import mixing, quality_rules


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with copies, near copies, shared lines, junk, benchmark passages, nulls and extra columns."""
    rng = random.Random(11)
    path = str(tmp_path_factory.mktemp("corpus"))
    items = [(k, noise(rng, 30)) for k in range(4)]
    rows, labels = [], []
    for k in range(160):
        text = "\n".join(noise(rng, rng.randrange(30, 60)) for _ in range(3))
        if k % 5 == 1:
            text = rows[-1][1]
        if k % 5 == 2:
            text = rows[-2][1].replace(" a ", " changed ", 1)
        if k % 7 == 3:
            text += "\nA line that many documents share"
        if k % 11 == 4:
            text = "###".join(text.split(" "))
            text = text.replace("###", "### ")
        if k % 13 == 5:
            text += " " + items[k % 4][1]
        rows.append((k, text, "en", f"s{k % 3}" if k % 10 else None, len(text), "kept"))
        labels.append((k, 0 if "### " in text else 1, 0))
    rows += [(900, None, None, None, None, "kept"), (901, "", "en", "s1", 0, "kept")]
    spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, tag string"
    ).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, items


def test_stages_in_order_equal_plain_versions(spark, folder):
    path, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "source mixing"
    ]

    def stage(name, df):
        out = mixing.materialize(stages[name](spark, df, path))
        return out, [(r.doc_id, r.text) for r in out.collect()]

    good, rows = stage("quality rules", docs)
    judged = quality_rules.judged(docs, spark.read.parquet(f"{path}/labels.parquet"))
    assert {i for i, _ in rows} == {r.id for r in judged.where("kept").collect()}
    gone = set(range(160)) - {i for i, _ in rows}
    assert {r.doc_id for r in docs.where("contains(text, '### ')").collect()} <= gone and len(gone) < 50

    deduped, lines = stage("line dedup", good)
    assert {i for i, _ in lines} == {i for i, _ in rows}
    want = {r[0]: r[3] for r in test_line_dedup.plain(rows)}
    assert {i: test_line_dedup.hashlib.sha256((t or "").encode()).hexdigest() for i, t in lines} == want

    distinct, left = stage("n-gram Jaccard join", deduped)
    assert {i for i, _ in left} == {i for i, _, c in test_jaccard_join.plain(lines, 5, 80) if i == c}

    clean, left_clean = stage("benchmark decontamination", distinct)
    dirty = {r[0] for r in test_decontamination.plain(left, items) if r[2]}
    assert dirty and {i for i, _ in left_clean} == {i for i, _ in left} - dirty

    for df in (good, deduped, distinct, clean):
        assert df.columns == columns and df.where("tag <> 'kept'").count() == 0
    mixed, drawn = stage("source mixing", clean)
    assert mixed.columns[: len(columns)] == columns
    taken = {r.id: r.taken // r["size"] for r in mixing.taken_words(clean).collect() if r.taken}
    assert {i: sum(1 for j, _ in drawn if j == i) for i, _ in drawn} == taken

    whole = corpus_pipeline.run(spark, path)
    assert sorted((r.doc_id, r.mix_pass) for r in whole.collect()) == sorted(
        (r.doc_id, r.mix_pass) for r in mixed.collect()
    )


def test_empty_tables(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = mixing.materialize(stage(spark, docs, path))
        assert docs.count() == 0
