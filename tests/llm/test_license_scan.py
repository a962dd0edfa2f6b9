from __future__ import annotations

import random
import re
import time

import pyarrow as pa

from llm_fixtures import docs, nothing, texts  # noqa: F401
from merchant_features.llm import license_scan as L
from merchant_features.llm import queries

COMPILED = [L.Notice(text, label) for text, label in L.NOTICES]
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    words = WORD.findall((text or "").encode().lower())
    places = []
    for phrase, label in L.BASE:
        p = phrase.encode().split()
        places += [(k, label) for k in range(len(words) - len(p) + 1) if words[k : k + len(p)] == p]
    return len(words), sorted(places)


def test_base_phrases_equal_the_plain_version(texts):
    rng = random.Random(1)
    parts = ["mit", "License", "license", "Apache", "general", "public", "-", "\n", "é", "permit", "mit_license", "x"]
    more = [rng.choice(("", " ")).join(rng.choice(parts) + rng.choice((" ", ", ", "")) for _ in range(rng.randrange(40))) for _ in range(300)]
    column = pa.array([*texts, *more])
    got = [(n, sorted(base)) for n, base, _ in L._scan(column, COMPILED)]
    assert got == [plain(t) for t in [*texts, *more]]
    assert any(len(g[1]) > 1 for g in got)


def edited(rng, text, edits):
    for _ in range(edits):
        k = rng.randrange(len(text))
        kind = rng.randrange(3)
        text = text[:k] + ("" if kind == 0 else rng.choice("qz") + (text[k] if kind == 1 else "")) + text[k + (kind != 0) :] if kind != 0 else text[:k] + text[k + 1 :]
    return text


def test_every_notice_within_its_edits_is_found():
    rng = random.Random(2)
    for compiled, (notice, label) in zip(COMPILED, L.NOTICES, strict=True):
        most = len(notice) // L.CHARS_PER_EDIT
        for _ in range(40):
            inside = edited(rng, notice, rng.randrange(0, most + 1))
            text = f"some words before {inside} and behind".encode()
            spans = L.notice_spans(b"\0" + text + b"\0", compiled)
            assert spans and spans[0][2] <= most, (inside, label)


def test_notices_side_by_side_are_all_found():
    cases = [
        ("creative comons attribution or creative commons attribution", COMPILED[4], [1, 0]),
        ("mozila public license mozilla public license", COMPILED[5], [1, 0]),
        ("mozilla public license mozila public license mozilla publik license", COMPILED[5], [0, 1, 1]),
    ]
    for text, notice, edits in cases:
        spans = L.notice_spans(b"\0" + text.encode() + b"\0", notice)
        assert [e for _, _, e in spans] == edits
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    many = " ".join(f"mozil{'l' * (k % 2)}a public license" for k in range(400))
    assert len(L.notice_spans(b"\0" + many.encode() + b"\0", COMPILED[5])) == 400


def least_edits(notice, text):
    """For every end in ``text`` the fewest edits of the notice against what ends there."""
    row = list(range(len(notice) + 1))
    out = [row[-1]]
    for c in text:
        before, row = row, [0]
        for k, n in enumerate(notice):
            row.append(min(before[k] + (n != c), before[k + 1] + 1, row[k] + 1))
        out.append(row[-1])
    return out


def test_matches_equal_edit_distances():
    """No match where the edit distance allows none, one at each place that it allows, with its distance."""
    rng = random.Random(11)
    for compiled, (notice, _) in zip(COMPILED, L.NOTICES, strict=True):
        raw = notice.encode()
        for _ in range(25):
            bits = [rng.choice((edited(rng, notice, rng.randrange(0, 2 * compiled.edits)), notice[: len(notice) // 2], "other words", "license")) for _ in range(4)]
            text = " ".join(bits).encode()
            spans = L.notice_spans(b"\0" + text + b"\0", compiled)
            ends = least_edits(raw, text)
            for begin, end, edits in spans:
                assert least_edits(raw, text[begin - 1 : end - 1])[-1] <= edits <= compiled.edits
            near = [k for k, e in enumerate(ends) if e <= compiled.edits]
            covered = [any(begin - 1 - compiled.edits <= k <= end - 1 + compiled.length + compiled.edits for begin, end, _ in spans) for k in near]
            assert all(covered) and bool(spans) == bool(near)
            if near:
                assert min(e for _, _, e in spans) == min(ends)


def test_a_long_text_of_edited_notices_is_quick():
    text = ("mozila public license " * 240_000).encode()
    assert len(text) > 5_000_000
    start = time.process_time()
    spans = L.notice_spans(b"\0" + text + b"\0", COMPILED[5])
    assert len(spans) == 240_000 and time.process_time() - start < 10


def test_notices_and_phrases_are_parameters(spark):
    df = spark.createDataFrame([(1, "Do whatt you want public licence, beer ware"), (2, "MIT license")], "doc_id long, text string")
    own = L.scan(df, notices=[("do what you want public license", "wtfpl")], phrases=[("beer ware", "beer")]).orderBy("id").collect()
    assert [(n.label, n.edits) for n in own[0].notices] == [("wtfpl", 2)] and [tuple(b) for b in own[0].base] == [(6, "beer")]
    assert own[1].notices == own[1].base == []


def test_far_texts_are_not_notices():
    assert L.notice_spans(b"\0released into the wild by many licence holders\0", COMPILED[0]) == []
    # half of a notice in one document, half in the next
    assert L.notice_spans(b"\0released under the\0mit license\0", COMPILED[0]) == []


def test_spans_point_into_the_text():
    text = "Préambule.  Released under teh MIT\nLicence!"
    ((n, base, (found,)),) = list(L._scan(pa.array([text]), COMPILED))
    assert (n, base, found["label"], found["edits"]) == (6, [], "mit", 3)
    assert text.encode()[found["begin_byte"] : found["end_byte"]].decode() == "Released under teh MIT\nLicence"


def test_pieces_cover_the_notice():
    for notice, _ in L.NOTICES:
        k = len(notice) // L.CHARS_PER_EDIT
        parts = L.pieces(notice, k)
        assert len(parts) == k + 1 and b"".join(p for _, p in parts) == notice.encode()


def test_the_query(spark, docs, nothing, tmp_path):
    rows = [(1, "Released under the MIT License."), (2, None), (3, "Mozilla  public licence"), (4, "MIT license, Apache License")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op3_license_scan(spark, str(tmp_path)).collect()}
    assert tuple(got[1])[1:] == (5, 1, 3, 3, "mit", "mit", 1.0)
    assert tuple(got[2])[1:] == (0, 0, None, None, "", "", 0.0)
    assert got[3].n_base == 0 and got[3].labels == "mpl" and 0.9 < got[3].score < 1
    assert (got[4].base_labels, got[4].first_word, got[4].last_word) == ("apache,mit", 0, 2)
    assert L.scan(docs).count() == docs.count() and L.scan(nothing).count() == 0
