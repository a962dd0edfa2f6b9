from __future__ import annotations

import random
import re

import numpy as np
import pytest

from llm_fixtures import docs, nothing, texts  # noqa: F401
from merchant_features.llm import jaccard_join as J
from merchant_features.llm import occurrences as O
from merchant_features.llm.components import components

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) or frozenset([tuple(words)])


def plain(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(i, least.get(root(k), i))
    return sorted((i, len(sets[k]), least[root(k)]) for k, (i, _) in enumerate(rows))


def got(df, n, percent):
    rows = J.similar_sets(df, n=n, percent=percent).members.select("id", "size", "component").collect()
    return sorted(tuple(r) for r in rows)


def family(seed):
    """Copies at many distances from one origin, chains, and families that share a long passage."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(80)]
    found = []
    for _ in range(6):
        origin = [word() for _ in range(rng.randrange(12, 260))] + passage[: rng.choice((0, 40, 80))]
        for _ in range(14):
            copy = list(origin)
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(len(copy))] = word()
            found.append(" ".join(copy))
            if rng.random() < 0.3:
                origin = copy  # a chain
    rng.shuffle(found)
    return list(enumerate(found))


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_families_equal_the_plain_version(spark, n, percent):
    rows = family(n)
    want = plain(rows, n, percent)
    assert len({r[2] for r in want}) < len(rows)
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), n, percent) == want


def test_odd_texts_equal_the_plain_version(docs, texts):
    assert got(docs, 3, 90) == plain(list(enumerate(texts)), 3, 90)


def test_links_are_real(spark):
    rows = family(7)
    joined = J.similar_sets(spark.createDataFrame(rows, "doc_id long, text string"), n=3, percent=90)
    sizes = {bytes(r.digest): (r.id, r.size) for r in joined.members.collect()}
    sets = {i: shingles(t, 3) for i, t in rows}
    links = joined.links.collect()
    assert links
    for a, b, overlap in links:
        x, y = sets[sizes[bytes(a)][0]], sets[sizes[bytes(b)][0]]
        assert overlap == len(x & y)
        assert 10 * len(x & y) >= 9 * len(x | y)


def all_links(rows, n, percent):
    """Linked pairs of distinct sets, and the number of other rows each row is linked to."""
    sets = [shingles(t, n) for _, t in rows]
    near = lambda x, y: bool(x) and 100 * len(x & y) >= percent * len(x | y)
    distinct = list(dict.fromkeys(s for s in sets if s))
    pairs = {frozenset((x, y)) for k, x in enumerate(distinct) for y in distinct[:k] if near(x, y)}
    return pairs, sorted((i, sum(near(x, y) for y in sets) - bool(x)) for (i, _), x in zip(rows, sets, strict=True))


@pytest.mark.parametrize("block", [256, 5])
def test_all_links_and_their_numbers(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK_SETS", block)
    rng = random.Random(21)
    origin = [f"w{k}" for k in range(150)]
    rows = family(9)
    for k in range(40):
        copy = list(origin)
        for _ in range(1 + k % 3):
            copy[rng.randrange(len(copy))] = f"own{k}x{rng.randrange(9)}"
        rows.append((1000 + k, " ".join(copy)))
    rows += [(2000, rows[-1][1]), (2001, rows[-1][1]), (2002, rows[3][1]), (2003, ""), (2004, None)]
    pairs, numbers = all_links(rows, 3, 90)
    joined = J.similar_sets(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), n=3, percent=90)
    members = joined.members.collect()
    sets = dict((i, shingles(t, 3)) for i, t in rows)
    of_class = {bytes(r.digest): sets[r.id] for r in members if r.digest}
    links = joined.links.collect()
    assert len(links) == len(pairs) > 150
    assert {frozenset((of_class[bytes(r.a)], of_class[bytes(r.b)])) for r in links} == pairs
    assert sorted((r.id, r.n_links) for r in members) == numbers
    assert sorted((r.id, r["size"], r.component) for r in members) == plain(rows, 3, 90)
    alone = J.similar_sets(spark.createDataFrame(rows, "doc_id long, text string"), n=3, percent=90, links=False)
    assert alone.links is None
    assert sorted((r.id, r["size"], r.component) for r in alone.members.collect()) == plain(rows, 3, 90)
    assert sorted((r.id, r.n_links) for r in alone.members.collect()) == numbers


@pytest.mark.parametrize("copies", [20, 60, 240])
def test_groups_of_every_size_go_one_way(spark, monkeypatch, copies):
    """All pairs of a group of near copies link; every overlap is known and no pairs are written for the numbers."""
    monkeypatch.setattr(J, "BLOCK_SETS", 100)
    rng = random.Random(copies)
    origin = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(copies):
        copy = list(origin)
        copy[rng.randrange(200)] = f"own{k}"
        rows.append((k, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    written = []
    materialize = J.materialize

    def recorded(frame):
        out = materialize(frame)
        written.append(out.count())
        return out

    monkeypatch.setattr(J, "materialize", recorded)
    listed = copies < 240
    joined = J.similar_sets(df, n=3, percent=90, links=listed)
    members = joined.members.collect()
    pairs, numbers = all_links(rows, 3, 90)
    assert sorted((r.id, r.n_links) for r in members) == numbers
    assert {r.component for r in members} == {0}
    if listed:
        links = joined.links.collect()
        assert len(links) == len(pairs) == copies * (copies - 1) // 2
        assert all(r.overlap is not None for r in links)
    else:
        assert max(written) <= 60 * copies


def test_a_list_without_room_enters_nothing(spark):
    """A template's common n-gram stands too late in all sets that have it: no entry is left of its list."""
    entries = [(7, bytes([k]) * 16, 30, 4, ) for k in range(50)] + [(8, bytes([k]) * 16, 30, 1) for k in range(2)]
    df = spark.createDataFrame(entries, "token long, digest binary, size int, pos int")
    assert {r.token for r in J._with_room(df, 90).collect()} == {8}


def test_one_of_each_group_stays(spark, docs, texts, nothing):
    left = J.keep_one(docs)
    assert left.columns == docs.columns
    want = {i for i, size, component in plain(list(enumerate(texts)), 5, 80) if i == component}
    assert {r.doc_id for r in left.collect()} == want
    assert J.keep_one(nothing).count() == 0


def test_null_ids_and_repeated_rows(spark):
    text = " ".join(f"w{k}" for k in range(40))
    df = spark.createDataFrame([(5, text), (5, text), (None, text), (3, text), (9, None)], "doc_id long, text string")
    rows = [tuple(r) for r in J.similar_sets(df).members.select("id", "component").collect()]
    assert sorted(rows, key=repr) == sorted([(5, 3), (5, 3), (None, None), (3, 3), (9, 9)], key=repr)


def test_one_row_of_repeated_rows_stays(spark):
    text = " ".join(f"w{k}" for k in range(40))
    near = text.replace("w39", "other")
    rows = [
        (5, text, "a"), (5, text, "a"), (5, near, "b"), (7, text, "c"), (None, text, "d"), (None, text, "d"),
        (None, "alone in the world with no copy", "e"), (None, "alone in the world with no copy", "e"),
        (8, "", "f"), (8, "", "f"), (8, None, "g"), (9, "quite another text of its own words", "h"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(3)
    left = sorted((tuple(r) for r in J.keep_one(df).collect()), key=repr)
    kept = [r for r in left if r[2] in "ab"]
    assert len(kept) == 1 and kept[0][0] == 5
    assert sorted(r[2] for r in left if r[2] not in "ab") == ["e", "f", "f", "g", "h"]
    assert sorted(tuple(r) for r in J.keep_one(df.where("key = 'd'")).collect()) == [(None, text, "d")]


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(400, 460)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    linked = {x for a, b in links if a != b for x in (a, b)}
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in rows} == {x: root(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_copies_meet_by_their_rarest_words(spark, monkeypatch):
    """Every n-gram occurs more than once and none is frequent: what few share goes into the index, not what many do."""
    rng = random.Random(5)
    phrases = [" ".join(f"p{k}x{i}" for i in range(5)) for k in range(200)]
    rows = []
    for k in range(100):
        parts = [" ".join(f"d{k}x{i}x{j}" for j in range(10)) for i in range(9)] + rng.sample(phrases, 8)
        rng.shuffle(parts)
        text = " ".join(parts)
        rows += [(2 * k, text), (2 * k + 1, text + " end")]
    met, materialize = [], J.materialize

    def recorded(frame):
        out = materialize(frame)
        if {"leader", "digest"} <= set(out.columns):
            met.append(out.count())
        return out

    monkeypatch.setattr(J, "materialize", recorded)
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3, 90) == plain(rows, 3, 90)
    assert met and max(met) <= 1.2 * len(rows)


def test_grades_of_occurrences(spark):
    times = {7: 1, 8: 2, 9: 3, 10: 4, 11: 15, 12: 16, 13: 63, 14: 64, 15: 900}
    hashes = {t: (t * 0x9E3779B97F4A7C15) % 2**64 for t in times}
    df = spark.createDataFrame([(str(t),) for t, n in times.items() for _ in range(n)], "text string").repartition(3)

    def hashed(column):
        yield np.array([(int(t) * 0x9E3779B97F4A7C15) % 2**64 for t in column.to_pylist()], np.uint64)

    found = O.count(df, hashed, 1e3, least_hot=500, bitmap_bits=22, grades=4)
    own = np.array(list(hashes.values()), np.uint64)
    assert [len(b) * 8 for b in found.grades] == [1 << 22, 1 << 21, 1 << 20, 1 << 19]
    assert list(found.may_repeat(own)) == [n > 1 for n in times.values()]
    assert list(found.frequencies(own)) == [0, 0, 0, 1, 1, 2, 2, 3, 900]
    plain_one = O.count(df, hashed, 1e3, least_hot=500)
    assert len(plain_one.grades) == 1 and list(plain_one.frequencies(own)) == [0] * 8 + [900]
    assert [O.bits_for(n) for n in (0, 1e6, 1.3e8, 3e8, 1.5e9, 1e12)] == [26, 26, 26, 27, 27, 27]


def test_order_is_global_and_rare_first():
    class Counts:
        def may_repeat(self, t):
            return t % np.uint64(3) > 0

        def frequencies(self, t):
            return np.where(t % np.uint64(5) == 0, 40, 0)

    tokens = np.arange(1, 31, dtype=np.uint64)
    ordered, shared = J.ranked(tokens, Counts())
    assert list(ordered[:10]) == list(range(3, 31, 3)) and not shared[:10].any()
    assert set(ordered[-8:]) == {5, 10, 20, 25, *ordered[-8:][:4]}
