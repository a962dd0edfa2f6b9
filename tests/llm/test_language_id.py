from __future__ import annotations

import numpy as np
import pyarrow as pa

from llm_fixtures import docs, nothing, texts  # noqa: F401
from merchant_features.llm import language_id as L
from merchant_features.llm import queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = queries.op9_language_id(spark, SF).join(truth, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert 0.2 < len(held) / len(got) < 0.3
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_a_null_id_is_held_out(spark, tmp_path):
    rows = [(k, text, lang) for k in range(12) for text, lang in ((f"the cat sat on mat {k}", "en"), (f"der Hund und die {k}", "de"))]
    rows.append((None, "quelque chose en francais", "fr"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op9_language_id(spark, str(tmp_path)).collect()
    assert all(r.held_out is not None for r in got) and "fr" not in {r.lang_pred for r in got}
    assert [r.held_out for r in got if r.doc_id is None] == [True]


def test_counts_equal_the_plain_version():
    column = pa.array(["Ab c9", "", None, "é!"])
    rows = {row: c for part, counts in L.gram_counts(column) for row, c in zip(part, counts, strict=True)}

    def place(gram: bytes) -> int:
        code = len(gram)
        for b in gram:
            code = (code * 257 + b) % 2**32
        return (code * 2654435761 % 2**32) >> (32 - L.BITS)

    for row, text in ((0, b"ab c9"), (3, "é".encode())):
        want = np.zeros(L.DIMENSIONS, int)
        for size in (1, 2, 3):
            # the blank after the last word is the document's end
            for k in range(len(text) - size + 1):
                want[place(text[k : k + size])] += 1
        assert (rows[row] == want).all()
    assert rows[1].sum() == rows[2].sum() == 0


def test_clusters_are_unit_vectors_and_split_modes():
    rng = np.random.default_rng(0)
    modes = np.eye(3, 20)
    vectors = np.concatenate([m + rng.normal(0, 0.02, (30, 20)) for m in modes]).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    centroids = L.clustered(vectors, 3)
    assert np.allclose(np.linalg.norm(centroids, axis=1), 1, atol=1e-5)
    assert sorted(np.argmax(centroids[:, :3], axis=1).tolist()) == [0, 1, 2]


def test_undetermined_and_odd_rows(spark, docs, nothing):
    rows = [(1, "the cat sat on the mat", "en"), (2, "der Hund und die Katze", "de"), (3, None, "en"), (4, "123 -", "de"), (5, "x y z", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(df)
    got = {r.id: r for r in L.predict(df, model).collect()}
    assert (got[1].lang_pred, got[2].lang_pred) == ("en", "de")
    assert got[3].lang_pred == got[4].lang_pred == "und" and got[3].score == got[4].score == 0
    assert got[5].lang_pred in ("en", "de") and got[5].rejected
    assert L.predict(docs, model).count() == docs.count() and L.predict(nothing, model).count() == 0
    untrained = L.train(nothing)
    assert {r.lang_pred for r in L.predict(df, untrained).collect()} == {"und"}
    assert L.train(docs).languages == ["de", "en"]
