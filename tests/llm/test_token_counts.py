from __future__ import annotations

import base64
from collections import defaultdict

import pytest
import tiktoken

from llm_fixtures import docs, nothing, texts  # noqa: F401
from merchant_features.llm import queries
from merchant_features.llm import token_counts as T

A, B = T.Tokenizer("a"), T.Tokenizer("b")
SCHEMA = "id string, text string, source string, lang string"


@pytest.fixture(scope="module")
def encoding():
    with open(T.VOCABULARY, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("plain", pat_str=T.PATTERN, mergeable_ranks=ranks, special_tokens={})


def totals(ledger):
    return {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in ledger.totals().collect()}


def test_the_query_equals_a_recount(spark, encoding):
    sf = "/root/testdata/sf0.001"
    low, gone = set(), set()
    for r in spark.read.parquet(f"{sf}/labels.parquet").collect():
        if r.quality == 0:
            low.add(r.doc_id)
        if r.toxic == 1:
            gone.add(r.doc_id)
    want = defaultdict(lambda: [0, 0])
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        if r.doc_id not in gone:
            text = "\n".join(dict.fromkeys(r.text.split("\n"))) if r.doc_id in low else r.text
            want[(r.source, r.lang)][0] += 1
            want[(r.source, r.lang)][1] += len(encoding.encode_ordinary(text))
    got = queries.op8_token_counts(spark, sf).collect()
    assert low and gone and {(r.source, r.lang): [r.docs, r.tokens] for r in got} == want


def test_inserts_revisions_deletes_and_replays(spark, tmp_path, encoding):
    n = lambda t: len(encoding.encode_ordinary(t))
    ledger = T.Ledger(spark, f"{tmp_path}/ledger")
    assert totals(ledger) == {}
    first = spark.createDataFrame([("1", "one two", "s", "en"), ("2", "three", "s", None), ("3", None, None, "en"), (None, "x", "s", "en")], SCHEMA)
    assert ledger.apply("b1", A, first)
    start = {("s", "en", "a"): (1, n("one two")), ("s", None, "a"): (1, n("three")), (None, "en", "a"): (1, 0)}
    assert totals(ledger) == start
    assert not ledger.apply("b1", A, first) and totals(ledger) == start
    # a revision moves a document to another group; a second tokenizer version counts beside the first
    assert ledger.apply("b2", A, spark.createDataFrame([("2", "three four five", "t", "de")], SCHEMA))
    assert ledger.apply("b3", B, spark.createDataFrame([("1", "one two", "s", "en")], SCHEMA))
    assert totals(ledger) == {
        ("s", "en", "a"): (1, n("one two")), ("t", "de", "a"): (1, n("three four five")), (None, "en", "a"): (1, 0),
        ("s", "en", "b"): (1, n("one two")),
    }
    # a deletion takes back all versions; unknown ids do nothing; deleted and inserted at once is inserted
    gone = spark.createDataFrame([("1",), ("9",), ("2",)], "id string")
    assert ledger.apply("b4", A, spark.createDataFrame([("2", "six", "s", "en")], SCHEMA), gone)
    assert totals(ledger) == {("s", "en", "a"): (1, n("six")), (None, "en", "a"): (1, 0)}
    assert ledger.batches() == ["b1", "b2", "b3", "b4"]


def test_a_batch_that_broke_off_is_written_anew(spark, tmp_path, encoding):
    ledger = T.Ledger(spark, f"{tmp_path}/ledger")
    rows = spark.createDataFrame([("1", "one two", "s", "en")], SCHEMA)
    # entries are there, deltas are not complete: not committed
    ledger.apply("b1", A, rows)
    marker = next((tmp_path / "ledger/deltas/batch=b1").glob("_SUCCESS"))
    marker.unlink()
    assert ledger.batches() == [] and totals(ledger) == {}
    assert ledger.apply("b1", A, rows) and totals(ledger) == {("s", "en", "a"): (1, len(encoding.encode_ordinary("one two")))}


def test_rows_of_one_id_are_taken_back_together(spark, tmp_path):
    ledger = T.Ledger(spark, f"{tmp_path}/ledger")
    twice = spark.createDataFrame([("1", "one", "s", "en"), ("1", "one", "s", "en"), ("1", "two", "t", "en")], SCHEMA)
    ledger.apply("b1", A, twice)
    assert {k: v[0] for k, v in totals(ledger).items()} == {("s", "en", "a"): 2, ("t", "en", "a"): 1}
    ledger.apply("b2", A, deletes=spark.createDataFrame([("1",)], "id string"))
    assert totals(ledger) == {}


def test_long_white_space_is_counted(spark, tmp_path, encoding):
    """Runs that the pattern cannot take count like the pieces it would make of them."""
    texts = [f"a{c * n}{tail}" for c in (" ", "\n", "\u3000") for n in (5, 60, 700) for tail in ("", "b", "  b", "1")]
    texts += [" \t\n" * 200 + "x" + "\n" * 300 + " y", "\x1c" * 200 + "x"]
    for text in texts:
        assert T.count_tokens(encoding, text, 50) == len(encoding.encode_ordinary(text)), repr(text[:20])
    run = 5_000_000
    rows = [("1", "\n" * run + "a", "s", "en"), ("2", " " * run, "s", "de"), ("3", "b" + " \n" * (run // 2) + "c", "s", "fr")]
    ledger = T.Ledger(spark, f"{tmp_path}/ledger")
    ledger.apply("b1", A, spark.createDataFrame(rows, SCHEMA))
    got = {k[1]: v[1] for k, v in totals(ledger).items()}
    assert got["de"] == len(encoding._encode_single_piece(" " * run))
    assert got["en"] == len(encoding._encode_single_piece("\n" * (run - 1))) + len(encoding.encode_ordinary("\na"))
    assert got["fr"] > 1


def test_odd_tables(spark, tmp_path, docs, nothing):
    ledger = T.Ledger(spark, f"{tmp_path}/ledger")
    ledger.apply("empty", A, nothing)
    assert totals(ledger) == {}
    ledger.apply("docs", A, docs.drop("id").withColumnRenamed("doc_id", "id"))
    assert sum(v[0] for v in totals(ledger).values()) == docs.count()
