"""Fuzzy search for short licence notices.

Texts are read as their words, A-Z lower-cased, joined by single blanks. A
notice of n characters may have k = n // ``CHARS_PER_EDIT`` edits. Cut into
k + 1 pieces, one piece of any such occurrence is untouched: these exact seeds
find the candidates, and in the window that a seed leaves for the notice the
``regex`` library's bounded-error matching confirms it and counts its edits.
Every window is of the notice's length and twice its edits, so the work grows
with the seeds, however long the text is. Of matches that overlap, those with
the fewest edits stay, the first of equal ones.

Base phrases are found exactly, as consecutive words. Notices, phrases and their
labels are parameters; they go to every task, so there should be thousands at
most.

Defined cases: null and empty texts have no words and no notices. Rows are
scanned each on its own, whatever their id.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_features.llm import words as W

#: The phrases of the contract and their labels.
BASE = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

#: Short notices searched with errors, as words, and their labels.
NOTICES = (
    ("released under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("licensed under the gnu general public license", "gpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("creative commons attribution", "cc-by"),
    ("mozilla public license", "mpl"),
    ("redistribution and use in source and binary forms", "bsd"),
)

CHARS_PER_EDIT = 10


def pieces(notice: str, edits: int) -> list[tuple[int, bytes]]:
    """(offset, text) of ``edits`` + 1 nearly equal parts."""
    text = notice.encode()
    cuts = [len(text) * k // (edits + 1) for k in range(edits + 2)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Notice:
    """A notice with its seeds and its pattern, made in the task that uses it."""

    def __init__(self, text: str, label: str, chars_per_edit: int = CHARS_PER_EDIT):
        import regex

        raw = text.encode()
        self.label, self.length = label, len(raw)
        self.edits = len(raw) // chars_per_edit
        self.pieces = pieces(text, self.edits)
        self.pattern = regex.compile(b"(?be)(?:" + regex.escape(raw) + b"){e<=%d}" % self.edits)


def _places(text: bytes, piece: bytes) -> Iterator[int]:
    at = text.find(piece)
    while at >= 0:
        yield at
        at = text.find(piece, at + 1)


def _fewest_edits(spans: set[tuple[int, int, int]], size: int) -> list[tuple[int, int, int]]:
    """Spans that do not overlap, in order; those with fewer edits are taken first, then those that begin first."""
    taken, covered = [], bytearray(size)
    for begin, end, edits in sorted(spans, key=lambda s: (s[2], s[0], s[1])):
        if not any(covered[begin:end]):
            covered[begin:end] = b"\1" * (end - begin)
            taken.append((begin, end, edits))
    return sorted(taken)


def notice_spans(text: bytes, notice: Notice) -> list[tuple[int, int, int]]:
    """(begin, end, edits) of the notice in ``text``, where zero bytes part documents."""
    k, spans, seen = notice.edits, set(), set()
    for offset, piece in notice.pieces:
        for at in _places(text, piece):
            start = at - offset
            if start in seen:
                continue
            seen.add(start)
            # the window ends where its document does
            low = max(text.rfind(b"\0", max(0, start - k), at) + 1, start - k, 0)
            end = text.find(b"\0", at, start + notice.length + k)
            m = notice.pattern.search(text, low, end if end >= 0 else start + notice.length + k)
            if m is not None and m.end() > m.start():
                spans.add((m.start(), m.end(), sum(m.fuzzy_counts)))
    return _fewest_edits(spans, len(text)) if spans else []


def _scan(texts: pa.Array, notices: Sequence[Notice], phrases: Sequence[tuple[str, str]] = BASE) -> Iterator[tuple]:
    """(words, base places, notices) per text; a place is (first word, label), a notice a dict."""
    for part in W.slices(texts):
        w = W.words(part, W.ALNUM, hashed=False)
        p = W.plain(w)
        text = p.text.tobytes()
        base: dict[int, list] = {}
        found: dict[int, list] = {}
        for phrase, label in phrases:
            needle = phrase.encode()
            for at in _places(text, needle):
                if text[at - 1] in (0, 0x20) and text[at + len(needle)] in (0, 0x20):
                    document = int(np.searchsorted(p.bounds, at, side="right")) - 1
                    word = int(np.searchsorted(p.starts, at, side="right")) - 1
                    base.setdefault(document, []).append((word - int(w.first[document]), label))
        for notice in notices:
            for begin, end, edits in notice_spans(text, notice):
                document = int(np.searchsorted(p.bounds, begin, side="right")) - 1
                first = max(int(np.searchsorted(p.starts, begin, side="right")) - 1, int(w.first[document]))
                last = max(first, int(np.searchsorted(p.starts, end - 1, side="right")) - 1)
                found.setdefault(document, []).append(
                    {
                        "label": notice.label, "first_word": first - int(w.first[document]),
                        "last_word": last - int(w.first[document]), "begin_byte": int(w.starts[first] - part.bounds[document]),
                        "end_byte": int(w.ends[last] - part.bounds[document]), "edits": edits,
                        "score": 1.0 - edits / notice.length,
                    }
                )
        for k in range(len(part.rows)):
            yield int(w.first[k + 1] - w.first[k]), base.get(k, []), found.get(k, [])


NOTICE_TYPE = (
    "struct<label:string,first_word:bigint,last_word:bigint,begin_byte:bigint,end_byte:bigint,edits:int,score:double>"
)


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices: Sequence[tuple[str, str]] = NOTICES,
    phrases: Sequence[tuple[str, str]] = BASE, chars_per_edit: int = CHARS_PER_EDIT,
) -> DataFrame:
    """Per row: id, ``n_words``, ``base`` (places of base phrases) and ``notices`` (spans with edits).

    ``notices`` and ``phrases`` are (words joined by blanks, A-Z lower-cased; label).
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    base_type = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
    integers = ("first_word", "last_word", "begin_byte", "end_byte")
    notice_type = pa.list_(
        pa.struct(
            [("label", pa.string()), *[(n, pa.int64()) for n in integers], ("edits", pa.int32()), ("score", pa.float64())]
        )
    )

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [Notice(text, label, chars_per_edit) for text, label in notices]
        for batch in batches:
            rows = list(_scan(batch.column(1), compiled, phrases))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([[{"word": a, "label": b} for a, b in sorted(r[1])] for r in rows], base_type),
                    pa.array([r[2] for r in rows], notice_type),
                ],
                ["id", "n_words", "base", "notices"],
            )

    kind = dict(texts.dtypes)["id"]
    return texts.mapInArrow(
        scanned,
        f"id {kind}, n_words bigint, base array<struct<word:bigint,label:string>>, notices array<{NOTICE_TYPE}>",
    )
