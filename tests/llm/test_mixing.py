from __future__ import annotations

import random
import re

import numpy as np
import pytest

from llm_fixtures import docs, nothing, texts  # noqa: F401
from merchant_features.llm import mixing as M


def targets(sizes, weights, total, most):
    """Water filling step by step."""
    out, left, free = {}, float(total), set(range(len(sizes)))
    while free:
        level = left / sum(weights[i] for i in free)
        full = {i for i in free if level * weights[i] >= most * sizes[i]}
        if not full:
            return [out.get(i, level * weights[i]) for i in range(len(sizes))]
        for i in full:
            out[i] = float(most * sizes[i])
            left -= out[i]
        free -= full
    return [out[i] for i in range(len(sizes))]


def test_water_filling():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randrange(1, 9)
        sizes, weights = [rng.randrange(0, 1000) for _ in range(n)], [rng.choice((1, 2, 3)) for _ in range(n)]
        got = M.water_fill(sizes, weights, sum(sizes) * 1.5, 2)
        assert got == pytest.approx(targets(sizes, weights, sum(sizes) * 1.5, 2))
        assert sum(got) == pytest.approx(sum(sizes) * 1.5)


def test_splitting_tree_is_exact():
    quotas = [100, 0, 7, 1000, 1]
    counts = M.splitting_tree(quotas, 13, np.random.Generator(np.random.PCG64(1)))
    assert counts.sum(axis=1).tolist() == quotas and (counts >= 0).all()
    assert np.ptp(counts.sum(axis=0)) <= 4
    again = M.splitting_tree(quotas, 13, np.random.Generator(np.random.PCG64(1)))
    assert (counts == again).all()
    assert M.splitting_tree([], 4, np.random.Generator(np.random.PCG64(1))).shape == (0, 4)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(8)
    rows = [(k, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(0, 120))), "hot" if k % 3 == 0 else f"s{k % 7}") for k in range(3000)]
    rows += [(5000, None, None), (5001, "a b c", None), (5001, "a b c", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7).cache(), rows


def test_targets_are_met_and_reruns_agree(corpus):
    df, rows = corpus
    got = M.taken_words(df).collect()
    assert len(got) == len(rows)
    sizes, taken, target = {}, {}, {}
    for r in got:
        assert r.taken in (0, r["size"], 2 * r["size"])
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = targets([sizes[s] for s in names], [M.WEIGHTS[k % 3] for k in range(len(names))], 1.5 * sum(sizes.values()), 2)
    for s, w in zip(names, want, strict=True):
        assert target[s] == pytest.approx(w) and abs(taken[s] - w) <= 60
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    assert all(r["size"] == words[r.id] for r in got)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, M.taken_words(df.repartition(3)).collect()), key=repr)


def test_the_mix_holds_what_is_counted(corpus):
    df, _ = corpus
    mixed = M.mix(df).collect()
    taken = {}
    for r in mixed:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len((r.text or "").split())
    want = {}
    for r in M.taken_words(df).collect():
        if r.taken and r.id != 5001:
            want[r.id] = r.taken
    taken.pop(5001, None)
    assert taken == want
    assert len({(r.doc_id, r.mix_pass) for r in mixed if r.doc_id != 5001}) == len([r for r in mixed if r.doc_id != 5001])
    shards = {r.mix_shard for r in mixed}
    assert len(shards) > 5 and max(shards) < M.SHARDS


def test_blocks_of_one_source_are_disjoint_over_shards(corpus):
    df, _ = corpus
    sizes = M.sized(df, "doc_id", "text", "source")
    sources = M.plan_sources(sizes, block_words=300)
    drawn = M.draws(sizes, sources, shards=8).collect()
    assert len({(r.id, r.tag, r["pass"]) for r in drawn if r.id != 5001}) == len([r for r in drawn if r.id != 5001])
    per_shard = {}
    for r in drawn:
        if r.source == "hot":
            per_shard[r.shard] = per_shard.get(r.shard, 0) + r["size"]
    assert len(per_shard) == 8


def test_the_tree_decides_the_shards(corpus, monkeypatch):
    """The rows name the shards that the tree gives them, and its quotas are what the shards hold."""
    df, _ = corpus
    got = M.taken_words(df, shards=8).collect()
    assert all(len(r.shards) * r["size"] == r.taken for r in got if r.id != 5001)
    drawn = M.draws(M.sized(df, "doc_id", "text", "source"), M.plan_sources(M.sized(df, "doc_id", "text", "source")), shards=8).collect()
    want = {}
    for r in drawn:
        want.setdefault((r.id, r.source), []).append(r.shard)
    assert {(r.id, r.source): r.shards for r in got if r.shards and r.id != 5001} == {k: sorted(v) for k, v in want.items() if k[0] != 5001}
    assert len({s for r in got for s in r.shards}) > 4

    def all_left(quotas, shards, rng):
        counts = np.zeros((len(quotas), shards), np.int64)
        counts[:, 0] = quotas
        return counts

    monkeypatch.setattr(M, "splitting_tree", all_left)
    assert {s for r in M.taken_words(df, shards=8).collect() for s in r.shards} == {0}


def test_a_mix_can_be_mixed_again(docs):
    again = M.mix(M.mix(docs))
    assert again.columns == [*docs.columns, "mix_shard", "mix_pass", "mix_order"] and again.count() >= 0


def test_odd_tables(docs, nothing, spark):
    assert M.mix(docs).columns == [*docs.columns, "mix_shard", "mix_pass", "mix_order"]
    assert M.taken_words(docs).count() == docs.count()
    assert M.taken_words(nothing).count() == 0 and M.mix(nothing).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", "b")], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in M.taken_words(blank).collect()] == [(0.0, 0)] * 2
