from __future__ import annotations

import math
import random

import numpy as np
import pytest

from merchant_features.llm import embedding_forest as E


def plain(rows, threshold=0.95):
    """(id, links, component) of (id, vector) rows by all pairs."""
    def usable(i, v):
        return i is not None and bool(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)

    at = [k for k, (i, v) in enumerate(rows) if usable(i, v)]
    links = {k: set() for k in at}
    for k in at:
        for m in at:
            if m < k and len(rows[k][1]) == len(rows[m][1]):
                x, y = (np.array(rows[r][1], float) / max(map(abs, rows[r][1])) for r in (k, m))
                if x @ y / (math.sqrt(x @ x) * math.sqrt(y @ y)) >= threshold:
                    links[k].add(m)
                    links[m].add(k)
    out = [(i, 0, i) for k, (i, _) in enumerate(rows) if k not in links]
    seen = set()
    for k in at:
        if k in seen:
            continue
        group, todo = set(), [k]
        while todo:
            m = todo.pop()
            if m not in group:
                group.add(m)
                todo += links[m]
        seen |= group
        least = min(rows[m][0] for m in group)
        out += [(rows[m][0], len(links[m]), least) for m in group]
    return sorted(out, key=repr)


def told(df, **options):
    return sorted((tuple(r) for r in E.near_duplicates(df, **options).select("id", "n_links", "component").collect()), key=repr)


def vectors(seed, n, dim, dense=0):
    rng = np.random.default_rng(seed)
    found = list(rng.standard_normal((n, dim)))
    for k in range(n // 3):
        found.append(found[k % 40] + rng.standard_normal(dim) * 0.12)
    centre = rng.standard_normal(dim)
    found += [centre + rng.standard_normal(dim) * 0.1 for _ in range(dense)]
    found += [found[3]] * 30
    return [(int(k), [float(np.float32(c)) for c in v]) for k, v in zip(rng.permutation(len(found)), found, strict=True)]


def test_small_tables_are_whole(spark):
    rows = vectors(1, 150, 16)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    want = plain(rows)
    assert sum(r[1] for r in want) > 900
    assert told(df) == want


def test_a_forest_finds_nearly_all_links_and_dense_groups_whole(spark, monkeypatch):
    monkeypatch.setattr(E, "ROOT_SAMPLE", 300)
    monkeypatch.setattr(E, "NODE_SAMPLE", 120)
    monkeypatch.setattr(E, "BLOCK", 50)
    rows = vectors(2, 900, 24, dense=160)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    want, got = plain(rows), told(df, leaf=40)
    n_want, n_got = {r[0]: r[1] for r in want}, {r[0]: r[1] for r in got}
    assert n_want.keys() == n_got.keys()
    assert all(n_got[i] <= n_want[i] for i in n_want)
    assert sum(n_got.values()) >= 0.97 * sum(n_want.values()) > 25_000
    # with fewer trees more is missed, never more found
    few = {r[0]: r[1] for r in told(df, leaf=40, trees=1)}
    assert sum(few.values()) <= sum(n_got.values()) and all(few[i] <= n_want[i] for i in few)


def test_odd_vectors(spark):
    rng = random.Random(4)
    base = [rng.random() for _ in range(8)]
    rows = [
        (1, base), (2, [2 * c for c in base]), (3, [-c for c in base]), (4, None), (5, []), (6, [0.0] * 8), (7, [None, *base[1:]]),
        (8, [math.nan, *base[1:]]), (9, [math.inf, *base[1:]]), (None, base), (2, base), (1, base), (10, base[:3]), (11, base[:3]),
        (12, [c * 1e300 for c in base]), (13, [c * 1e-300 for c in base]), (14, [0.0 if k else -0.0 for k in range(8)]), (15, [1.0]), (16, [7.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS id", "2 AS cls", "3 AS n_links")
    assert told(df) == plain(rows)
    assert told(df.limit(0)) == []


@pytest.mark.parametrize("shift,linked", [(1e-7, False), (-1e-7, True)])
def test_the_threshold_is_exact(spark, shift, linked):
    angle = math.acos(0.95) + shift
    rows = [(1, [1.0, 0.0]), (2, [math.cos(angle), math.sin(angle)])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert (told(df)[0][1] == 1) == linked
