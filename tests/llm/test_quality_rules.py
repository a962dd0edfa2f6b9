from __future__ import annotations

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from llm_fixtures import docs, nothing, texts  # noqa: F401
from merchant_features.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {p for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for p in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)
    )


def test_statistics_equal_the_plain_version(spark, docs, texts):
    more = ["a b c d e f g h " * 3, "a b c d e f g a b c d e f g a b c", "# * $ % & | < > é", "x\nx\n\n \nx"]
    rows = [*enumerate(texts), *enumerate(more, 1000), (None, "null id # #")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Q.text_statistics(df).select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = sorted(((-1 if i is None else i), *plain(t)) for i, t in rows)
    assert sorted(((-1 if r[0] is None else r[0]), *r[1:]) for r in got.collect()) == want


def labelled(spark, n=600):
    rng = random.Random(1)
    rows, labels = [], []
    for k in range(n):
        bad = k % 4 == 0
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(rng.randrange(25, 80))]
        rows.append((k, " ".join(w + "###" * bad for w in words)))
        if k % 2 == 0 or bad:
            labels.append((k, 0 if bad else 1, None if k % 5 else 1))
    labels += [(None, 0, 0), (3, None, None), (10**6, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_rules_separate_and_explain_themselves(spark):
    docs, labels = labelled(spark)
    judged = Q.judged(docs, labels)
    kept = {r.id: r.kept for r in judged.select("id", "kept").collect()}
    assert sum(kept[k] == (k % 4 != 0) for k in kept) >= 0.97 * len(kept)
    assert all(kept[k] for k in kept if k % 4 and k % 2 == 0)
    statistics = Q.materialize(Q.text_statistics(docs))
    rules = Q.learn_rules(statistics, labels)
    assert rules and any("symbols_per_word" in str(c) or "word_length" in str(c) for c in rules[0])
    text = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


def test_conditions_are_emitted_in_order(spark):
    row = spark.createDataFrame([(10, 40, 3)], "n_words long, word_chars long, n_symbols long")
    first = (Q.Condition("n_words", False, 5.0),)
    second = (Q.Condition("symbols_per_word", True, 0.1), Q.Condition("word_length", False, 4.0))
    assert row.select(Q.verdict([first])).first()[0] is True
    assert row.select(Q.verdict([first, second])).first()[0] is False
    assert str(second[0]) == "symbols_per_word > 0.1"


def test_without_labels_only_the_base_rules_reject(spark, docs, nothing):
    _, labels = labelled(spark, 4)
    none = labels.limit(0)
    judged = Q.judged(docs, none)
    assert judged.where("kept = base_failed").count() == 0
    assert Q.judged(nothing, labels).count() == 0
    assert Q.keep_good(docs, none).columns == docs.columns
    one_class = labels.where("quality = 1")
    assert Q.judged(docs, one_class).where("kept = base_failed").count() == 0


def test_base_rules(spark):
    rows = [(1, "w " * 19), (2, " ".join(f"w{k}" for k in range(20))), (3, "a b c d e f g h " * 4), (4, None)]
    judged = Q.text_statistics(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("f", Q.base_failed())
    assert {r.id: r.f for r in judged.select("id", "f").collect()} == {1: True, 2: False, 3: True, 4: True}


def test_rows_of_one_id_are_judged_apart(spark):
    good = " ".join(f"w{k}" for k in range(30))
    df = spark.createDataFrame([(1, good, "a"), (1, "too short", "b"), (None, good, "c")], "doc_id long, text string, id string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    kept = Q.keep_good(df, labels)
    assert sorted(r["id"] for r in kept.collect()) == ["a", "c"]
    assert kept.select(F.col("id")).columns == ["id"]
