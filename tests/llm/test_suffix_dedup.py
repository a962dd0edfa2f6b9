from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import docs, nothing, texts  # noqa: F401
from merchant_features.llm import suffix_dedup as S


def plain(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    counts = Counter(t[k : k + length] for t in raw for k in range(len(t) - length + 1))
    out = []
    for i, t in enumerate(raw):
        depth = np.zeros(len(t) + 1, int)
        for k in range(len(t) - length + 1):
            if counts[t[k : k + length]] > 1:
                depth[k] += 1
                depth[k + length] -= 1
        gone = np.cumsum(depth)[:-1] > 0 if t else np.zeros(0, bool)
        edges = np.diff(np.concatenate(([0], gone.astype(int), [0])))
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((i, len(t), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def got(df, **options):
    rows = S.removed_spans(df, **options).select("id", "n_bytes", S.n_removed(), "spans", "kept_sha256").collect()
    return sorted((*r[:3], len(r[3]), r[4]) for r in rows)


def pieced(seed):
    """Texts cut from one origin with breaks between, periodic texts, copies, short texts."""
    rng = random.Random(seed)
    origin = "".join(rng.choice("abcd é") for _ in range(2500))
    found = []
    for k in range(90):
        text = ""
        for _ in range(rng.randrange(0, 5)):
            a = rng.randrange(2300)
            text += origin[a : a + rng.randrange(1, 600)] + "".join(rng.choice("xyz") for _ in range(rng.randrange(3)))
        found.append("ab" * rng.randrange(400) if k % 17 == 0 else text)
    return [*found, "", None, found[3], found[4]]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("group", [S.GROUP, 3])
def test_equals_the_plain_version(spark, seed, group):
    rows = pieced(seed)
    want = plain(rows)
    assert sum(r[2] > 0 for r in want) > 20
    assert got(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(5), group=group) == want


def test_odd_texts(docs, texts, nothing):
    short = [t if t is None or len(t) < 100_000 else None for t in texts]
    whole = docs.where("text IS NULL OR length(text) < 100000")
    want = [r for r in plain(short) if texts[r[0]] is short[r[0]]]
    assert got(whole) == want
    assert got(nothing) == []


def test_long_copies_go_whole(docs, texts):
    long = [k for k, t in enumerate(texts) if t is not None and len(t) >= 100_000]
    rows = {r[0]: r for r in got(docs)}
    assert len(long) == 2 and all(rows[k][1] == rows[k][2] for k in long)


def test_merging_runs_keeps_order_and_prefixes():
    rng = random.Random(3)
    runs = [sorted("".join(rng.choice("ab") for _ in range(rng.randrange(12))).encode() for _ in range(rng.randrange(30))) for _ in range(7)]
    out = list(S.merged([S.front_coded(r) for r in runs]))
    suffixes = [s for _, _, s, _ in out]
    assert suffixes == sorted(x for r in runs for x in r)
    assert all(runs[run][place] == s for run, place, s, _ in out)
    for before, (_, _, s, known) in zip(suffixes, out[1:], strict=False):
        assert known == S.common_prefix(before, s, 0)
    assert list(S.merged([])) == [] and list(S.merged([([], [])])) == []


def test_known_prefixes_are_not_compared_again(monkeypatch):
    compared = []
    original = S.common_prefix
    monkeypatch.setattr(S, "common_prefix", lambda x, y, known: compared.append((original(x, y, known) - known)) or known + compared[-1])
    stem = b"s" * 150
    runs = [[stem + bytes([97 + k]) + str(r).encode() for k in range(26)] for r in range(4)]
    coded = [S.front_coded(r) for r in runs]
    compared.clear()
    assert len(list(S.merged(coded))) == 104
    # only the first comparisons walk the common stem
    assert sum(n >= 150 for n in compared) <= 4


def test_equal_windows_have_their_anchor_at_the_same_place():
    rng = np.random.default_rng(1)
    shared = rng.integers(97, 101, 260).astype(np.uint8)
    raw = np.concatenate([rng.integers(97, 101, 333).astype(np.uint8), shared, rng.integers(97, 101, 100).astype(np.uint8), shared])
    _, at, first, stop = S.anchors(raw, np.array([0, len(raw)]))
    offset = {w: a - w for a, f, s in zip(at, first, stop, strict=True) for w in range(f, s)}
    assert len(offset) == len(raw) - 199
    assert all(offset[333 + k] == offset[693 + k] for k in range(61))
