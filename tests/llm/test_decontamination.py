from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa

from llm_fixtures import docs, nothing, texts  # noqa: F401
from merchant_features.llm import decontamination as D
from merchant_features.llm import words as W

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return WORD.findall((text or "").encode().lower())


def plain(rows, items, width=10):
    patterns = set()
    for item, text in items:
        w = tokens(text)
        if not w:
            continue
        n = min(width, len(w))
        patterns |= {(None if item is None else str(item), tuple(w[k : k + n])) for k in range(len(w) - n + 1)}
    out = []
    for i, t in rows:
        w = tokens(t)
        hit, named = set(), set()
        for item, p in patterns:
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k : k + len(p)]) == p:
                    hit |= set(range(k, k + len(p)))
                    named |= {item} - {None}
        out.append((i, len(w), len(hit), tuple(sorted(named))))
    return sorted(out, key=repr)


def got(df, benchmark, **options):
    found = D.hits(df, benchmark, **options)
    rows = found.select("id", "n_words", D.n_hit(), "items").collect()
    return sorted(((*r[:3], tuple(r[3])) for r in rows), key=repr)


def bench(spark, texts):
    rng = random.Random(2)
    words = texts[70].split()
    items = [
        (1, " ".join(words[:25])), (2, " ".join(words[5:12])), (3, "ONE"), (10, "one Two"), (4, None), (None, "one"), (5, ""),
        (6, "..."), (7, " ".join(rng.choice("abc") for _ in range(40))), (1, " ".join(texts[12].split()[3:20])),
        (8, "ñandú İ"), (9, "x" * 5000),
    ]
    return items, spark.createDataFrame(items, "item_id long, text string")


def test_equals_the_plain_version(spark, docs, texts):
    items, benchmark = bench(spark, texts)
    rows = [(k, t) for k, t in enumerate(texts)]
    want = plain(rows, items)
    assert sum(r[2] > 0 for r in want) > 40
    assert got(docs, benchmark) == want
    assert got(docs, benchmark, block_windows=300) == want


def test_random_words_of_a_small_alphabet():
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 300))) for _ in range(200)]
    items = [(k, " ".join(rng.choice("abcd") for _ in range(rng.choice((1, 3, 6, 10, 14))))) for k in range(30)]
    compiled = D.compile_patterns(items)
    found = [(row, n, len(hit), tuple(sorted(named))) for row, n, hit, named in D.search(pa.array(texts), compiled)]
    assert sorted(found, key=repr) == plain(list(enumerate(texts)), items)


def test_positions_are_skipped():
    rng = random.Random(4)
    item = " ".join(f"p{k}" for k in range(10))
    text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(20_000))
    (patterns,) = D.compile_patterns([(1, item)])
    w = W.words(next(W.slices(pa.array([text]))), W.ALNUM)
    slots = D._block_hash(w.hashes, patterns.block, patterns.bits)
    assert np.mean(patterns.shift[slots]) > 8.9
    assert len(D._occurrences(w, patterns)[0]) == 0


def test_positions_are_skipped_beside_many_windows():
    rng = random.Random(6)
    words = [f"w{rng.randrange(10**6)}" for _ in range(60_000)]
    (patterns,) = D.compile_patterns([(k, " ".join(words[10 * k : 10 * k + 10])) for k in range(6000)])
    other = W.words(next(W.slices(pa.array([" ".join(f"v{rng.randrange(10**6)}" for _ in range(20_000))]))), W.ALNUM)
    slots = D._block_hash(other.hashes, patterns.block, patterns.bits)
    assert len(patterns.shift) >= 16 * 6000 and np.mean(patterns.shift[slots]) > 5 and np.mean(patterns.shift[slots] == 0) < 0.1


def test_blocks_go_one_at_a_time(spark, docs, texts, monkeypatch):
    """Three blocks and more: tables are compiled for one only after the former one's rows are written."""
    items, benchmark = bench(spark, texts)
    steps = []
    compiled, materialize = D._compiled, D.materialize
    monkeypatch.setattr(D, "_compiled", lambda *a: steps.append("compiled") or compiled(*a))
    monkeypatch.setattr(D, "materialize", lambda df: steps.append("written") or materialize(df))
    dirty = {r[0] for r in plain(list(enumerate(texts)), items) if r[2]}
    left = D.clean(docs, benchmark, block_windows=800)
    assert steps.count("compiled") >= 3 and steps == ["compiled", "written"] * steps.count("written") + ["compiled"]
    assert {r.doc_id for r in left.collect()} == set(range(len(texts))) - dirty


def test_clean_keeps_rows_and_columns(spark, docs, texts, nothing):
    items, benchmark = bench(spark, texts)
    dirty = {r[0] for r in plain(list(enumerate(texts)), items) if r[2]}
    left = D.clean(docs, benchmark)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == set(range(len(texts))) - dirty
    assert D.clean(nothing, benchmark).count() == 0 and got(nothing, benchmark) == []
    assert D.clean(docs, benchmark.limit(0)).count() == len(texts)


def test_repeated_rows_come_back(spark):
    df = spark.createDataFrame([(1, "one two"), (1, "one two"), (1, "three"), (None, None)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "one"), (2, "two")], "item_id long, text string")
    for options in ({}, {"block_windows": 1}):
        assert got(df, benchmark, **options) == sorted([(1, 2, 2, ("1", "2"))] * 2 + [(1, 1, 0, ()), (None, 0, 0, ())], key=repr)
