from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from llm_fixtures import docs, nothing, texts  # noqa: F401
from merchant_features.llm import source_divergence as S

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=10):
    """Rows are (text, lang, source)."""
    words = [re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (t or "").translate(AZ)) for t, _, _ in rows]
    out = []
    for lang in {r[1] or "" for r in rows}:
        own = [(w, r[2] or "") for w, r in zip(words, rows, strict=True) if (r[1] or "") == lang]
        found_in = Counter(t for w, _ in own for t in set(w))
        kept = sorted(t for t in found_in if found_in[t] >= least)
        known = set(kept)
        counts = {}
        for w, s in own:
            counts.setdefault(s, Counter()).update(t for t in w if t in known)
        whole = Counter()
        for c in counts.values():
            whole.update(c)

        def shares(c):
            total = sum(c.values())
            return [1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept]

        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        f = lambda x, y: (x - y) * (x - y) // (x + y)
        for s in counts:
            pairs = sorted((-sum(map(f, p[s], p[o])), o.encode(), o) for o in counts if o != s)
            terms = sorted((-f(x, y), t.encode(), t) for t, x, y in zip(kept, p[s], q, strict=True) if counts[s][t] and x > y)
            out += [(lang, s, "pair", o, -v, k) for k, (v, _, o) in enumerate(pairs, 1)]
            out += [(lang, s, "term", t, -v, k) for k, (v, _, t) in enumerate(terms[:10], 1)]
    return sorted(out)


def told(df, **options):
    return sorted(tuple(r) for r in S.audit(df, **options).select("lang", "source", "part", "item", "value", "rank").collect())


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"{rng.choice(('é', 'x', 'Ab', 'q'))}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)]
    rows = []
    for k in range(260):
        lang = rng.choice(("en", "de", None, ""))
        source = rng.choice([f"s{k}" for k in range(9)] + [None, ""])
        start = rng.randrange(60)
        text = " ".join(rng.choice(vocabulary[start : start + 60]) for _ in range(rng.randrange(1, 60)))
        rows.append((text, lang, source))
    rows += [(None, "en", "none"), ("123 456 --", "de", "signs"), ("rare", "fr", "a"), ("rare too", "fr", "b"), ("", "pt", "only")]
    return rows + rows[:20]


@pytest.mark.parametrize("groups,terms,held", [(64, 4096, 400_000), (2, 7, 50)])
def test_cells_of_any_size_give_the_plain_sums(spark, monkeypatch, groups, terms, held):
    monkeypatch.setattr(S, "GROUP_BLOCK", groups)
    monkeypatch.setattr(S, "TERM_BLOCK", terms)
    monkeypatch.setattr(S, "HELD_TERMS", held)
    rows = corpus(3)
    df = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr("*", "1 AS term", "2 AS n", "3 AS p")
    want = plain(rows)
    assert {r[2] for r in want} == {"pair", "term"}
    assert told(df.repartition(3)) == want


def test_odd_texts(docs, texts):
    rows = [(r.text, r.lang, r.source) for r in docs.select("text", "lang", "source").collect()]
    assert told(docs, least_docs=2) == plain(rows, 2)


def test_an_empty_table(nothing):
    assert S.audit(nothing).count() == 0


def test_shares_of_large_counts_are_exact(spark):
    n, total, v = 9 * 10**15, 10**16 + 7, 12345
    df = spark.createDataFrame([(n, total, v), (0, 0, 0)], "n long, total long, v long").select("v", S.share("n", "total", "v").alias("p"))
    assert {r.v: r.p for r in df.collect()} == {v: 1 + 10**9 * (n + 2) // (total + 2 * v), 0: 1}
