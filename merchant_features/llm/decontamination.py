"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

A pattern is a window of ``width`` consecutive words of a benchmark item; an
item with fewer words is one pattern. Patterns of one length are searched
together. The alphabet is words: a block is two neighbouring words (one, if the
pattern is one word). A shift table by block hash says how far a text position
may be moved on because the block ends no pattern nearer; at shift 0 a bucket
of patterns with that suffix hash is tried, the whole pattern's hash selects
within it, and the words' bytes are compared. All positions of a batch of
documents move on side by side, one cursor per ``STRIDE`` words of text.

The benchmark is read in blocks of at most ``block_windows`` windows (by item),
one at a time, so that what the driver compiles and each task is sent is bounded
however long the benchmark is; every block is held against all documents and the
blocks' hits are united.

The table has ``SLOTS_PER_WINDOW`` slots or more per window, so that a full block
of windows leaves most of it free and positions still move on by most of a window.

Defined cases: null text has no words; items without words are no patterns; the
patterns of an item with a null id hit, only the list of items cannot name it; an
item id given twice has the patterns of both texts. Rows of one id are searched
each on its own and every row comes back.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_features.llm import words as W
from merchant_features.sources.storage import materialize

WIDTH = 10
STRIDE = 2048
BLOCK_WINDOWS = 400_000
SLOTS_PER_WINDOW = 16
LEAST_BITS, MOST_BITS = 16, 24


@dataclass
class Patterns:
    """Patterns of one length with their tables."""

    length: int
    block: int
    bits: int
    shift: np.ndarray
    keys: np.ndarray  # sorted whole-pattern hashes
    texts: list[bytes]  # words joined by blanks, in the order of keys
    items: list[tuple[str, ...]]


def _block_hash(hashes: np.ndarray, block: int, bits: int) -> np.ndarray:
    """Table slots of the blocks that start at each word."""
    return (W.shingles(hashes, block) >> np.uint64(64 - bits)).astype(np.int64)


def compile_patterns(items: list[tuple[object, str | None]], width: int = WIDTH) -> list[Patterns]:
    """One set of tables per pattern length."""
    found: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
    keys: dict[bytes, int] = {}
    read: dict[int, list[np.ndarray]] = defaultdict(list)
    for item, text in items:
        if text is None:
            continue
        for part in W.slices(pa.array([text])):
            w = W.words(part, W.ALNUM)
            tokens = [w.lower[a:b].tobytes() for a, b in zip(w.starts, w.ends, strict=True)]
            length = min(width, len(tokens))
            if not length:
                continue
            read[length].append(w.hashes)
            for k, key in enumerate(W.shingles(w.hashes, length).tolist()):
                joined = b" ".join(tokens[k : k + length])
                found[length][joined].update([] if item is None else [str(item)])
                keys[joined] = key
    compiled = []
    for length, texts in sorted(found.items()):
        block = min(2, length)
        bits = min(MOST_BITS, max(LEAST_BITS, (SLOTS_PER_WINDOW * len(texts) - 1).bit_length()))
        shift = np.full(1 << bits, length - block + 1, np.int16)
        for hashes in read[length]:
            windows, slots = len(hashes) - length + 1, _block_hash(hashes, block, bits)
            for k in range(length - block + 1):
                np.minimum.at(shift, slots[k : k + windows], np.int16(length - block - k))
        ordered = sorted(texts, key=lambda t: (keys[t], t))
        compiled.append(
            Patterns(
                length, block, bits, shift, np.array([keys[t] for t in ordered], np.uint64), ordered,
                [tuple(sorted(texts[t])) for t in ordered],
            )
        )
    return compiled


def _occurrences(w: W.Words, p: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """(first words, pattern numbers) of the confirmed occurrences in a slice."""
    counts = np.diff(w.first)
    long_enough = np.flatnonzero(counts >= p.length)
    if not len(long_enough):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # cursors over pattern ends: words [first + length - 1, last], a stretch of STRIDE ends each
    lanes = (counts[long_enough] - p.length) // STRIDE + 1
    lane_doc = np.repeat(long_enough, lanes)
    nth = np.arange(len(lane_doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    cursor = w.first[lane_doc] + p.length - 1 + nth * STRIDE
    stop = np.minimum(cursor + STRIDE, w.first[lane_doc + 1])
    slots = _block_hash(w.hashes, p.block, p.bits)
    tried = []
    while len(cursor):
        step = p.shift[slots[cursor - p.block + 1]].astype(np.int64)
        tried.append(cursor[step == 0])
        cursor = cursor + np.maximum(step, 1)
        alive = cursor < stop
        cursor, stop = cursor[alive], stop[alive]
    heads = np.concatenate(tried) - p.length + 1
    whole = W.shingles_at(w.hashes, heads, p.length)
    at = np.searchsorted(p.keys, whole)
    at[at == len(p.keys)] = 0
    hit = p.keys[at] == whole
    heads, at = heads[hit], at[hit]
    same = np.fromiter(
        (
            b" ".join([w.lower[a:b].tobytes() for a, b in zip(w.starts[h : h + p.length], w.ends[h : h + p.length], strict=True)])
            == p.texts[k]
            for h, k in zip(heads, at, strict=True)
        ),
        bool,
        len(heads),
    )
    return heads[same], at[same]


def search(texts: pa.Array, compiled: list[Patterns]) -> Iterator[tuple[int, int, np.ndarray, set[str]]]:
    """(row, words, hit word positions, items) for each text."""
    for part in W.slices(texts):
        w = W.words(part, W.ALNUM)
        hit = np.zeros(len(w.starts) + 1, np.int32)
        items: dict[int, set[str]] = defaultdict(set)
        document = w.document()
        for p in compiled:
            heads, which = _occurrences(w, p)
            np.add.at(hit, heads, 1)
            np.add.at(hit, heads + p.length, -1)
            for doc, k in set(zip(document[heads].tolist(), which.tolist(), strict=True)):
                items[doc].update(p.items[k])
        covered = np.cumsum(hit)[:-1] > 0
        for k, row in enumerate(part.rows):
            inside = covered[w.first[k] : w.first[k + 1]]
            yield row, len(inside), np.flatnonzero(inside), items.get(k, set())


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_windows: int) -> list[DataFrame]:
    """The items in bounded blocks."""
    usable = benchmark.where(F.col(text_col).isNotNull()).select(
        F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")
    )
    # a text of n bytes has at most n / 2 + 1 windows
    most = usable.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
    n = int(most // block_windows) + 1
    return [usable if n == 1 else usable.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) for k in range(n)]


def _compiled(block: DataFrame, width: int):
    """The tables of one block, sent to every executor once, as plain tuples (see ``frames.broadcast_fields``)."""
    patterns = compile_patterns([tuple(r) for r in block.collect()], width)
    return block.sparkSession.sparkContext.broadcast([tuple(getattr(p, f.name) for f in fields(p)) for p in patterns])


def _tag(text: pa.Scalar) -> bytes:
    return hashlib.blake2b((text.as_py() or "").encode(), digest_size=16).digest()


def hits(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", width: int = WIDTH, block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Per row: id, ``n_words``, ``spans`` (half-open runs of hit words) and ``items`` (sorted ids)."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(texts.dtypes)["id"]
    schema = f"id {kind}, tag binary, n_words bigint, spans array<struct<begin:int,end:int>>, items array<string>"
    parts = []
    blocks = _blocks(benchmark, item_col, item_text_col, block_windows)
    several = len(blocks) > 1
    for block in blocks:
        compiled = _compiled(block, width)

        def scan(batches: Iterator[pa.RecordBatch], compiled=compiled) -> Iterator[pa.RecordBatch]:
            patterns = [Patterns(*p) for p in compiled.value]
            for batch in batches:
                out = []
                ids, column = batch.column(0).to_pylist(), batch.column(1)
                for row, n, hit, items in search(column, patterns):
                    breaks = np.flatnonzero(np.diff(hit) > 1) + 1
                    begins = hit[np.concatenate(([0], breaks))] if len(hit) else hit
                    ends = hit[np.concatenate((breaks - 1, [len(hit) - 1]))] + 1 if len(hit) else hit
                    spans = [{"begin": int(a), "end": int(b)} for a, b in zip(begins, ends, strict=True)]
                    out.append((ids[row], _tag(column[row]) if several else b"", n, spans, sorted(items)))
                yield _batch(out, batch.schema.field(0).type)

        part = texts.mapInArrow(scan, schema)
        if several:  # one block's tables at a time: the next are compiled when these are gone
            part = materialize(part)
            compiled.unpersist()
        parts.append(part)
    if len(parts) == 1:
        return parts[0].drop("tag")
    united = parts[0]
    for part in parts[1:]:
        united = united.union(part)
    n_blocks = len(parts)
    merged = united.groupBy("id", "tag", "n_words").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.count(F.lit(1)).alias("copies"),
    )
    # equal rows of one id were merged too: give each back
    again = merged.withColumn("spans", _united("spans")).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), (F.col("copies") / n_blocks).cast("int")))
    )
    return again.select("id", "n_words", "spans", "items")


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
    kinds = [id_type, pa.binary(), pa.int64(), span, pa.list_(pa.string())]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["id", "tag", "n_words", "spans", "items"]
    )


def _united(spans: str):
    """Overlapping or touching runs as one, from runs in any order."""
    ordered = F.array_sort(spans)
    start = F.array().cast("array<struct<begin:int,end:int>>")

    def add(done, run):
        last = F.try_element_at(done, F.lit(-1))
        grown = F.struct(last["begin"].alias("begin"), F.greatest(last["end"], run["end"]).alias("end"))
        return F.when(
            (F.size(done) > 0) & (run["begin"] <= last["end"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown)),
        ).otherwise(F.concat(done, F.array(run)))

    return F.aggregate(ordered, start, add)


def n_hit(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, r: total + r["end"] - r["begin"])


def clean(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    width: int = WIDTH, block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window; all columns stay."""
    at = docs.columns.index(text_col)
    blocks = _blocks(benchmark, item_col, item_text_col, block_windows)
    for nth, block in enumerate(blocks, 1):
        compiled = _compiled(block, width)

        def keep(batches: Iterator[pa.RecordBatch], compiled=compiled) -> Iterator[pa.RecordBatch]:
            patterns = [Patterns(*p) for p in compiled.value]
            for batch in batches:
                stay = np.ones(batch.num_rows, bool)
                for row, _, hit, _ in search(batch.column(at), patterns):
                    stay[row] = not len(hit)
                yield batch.filter(pa.array(stay))

        docs = docs.mapInArrow(keep, docs.schema)
        if nth < len(blocks):  # written before the next block's tables are made
            docs = materialize(docs)
            compiled.unpersist()
    return docs
