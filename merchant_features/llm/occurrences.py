"""Which 64-bit hashes occur more than once, and how often the frequent ones do.

Hashes are sent as 32-bit residues packed by bucket (their first bits), so a
hash costs four bytes in one shuffle, and every bucket is counted on its own. A
task adds up what repeats before it sends: a hash that makes up a third of all
costs one residue and one number per flush.
The outcome that tasks are sent later has a fixed bound: a bitmap over the first
``BITMAP_BITS`` bits of the hashes (bits of a fuller bitmap rule out less, never
too much), and the hashes that make up at least 1 / ``most_hot`` of all. Who needs
to tell rare hashes from others asks for more bitmaps, each of half the size, of
the hashes with at least so many occurrences, and for more bits where there are
more hashes, up to ``MOST_BITS``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_features.sources.storage import materialize

BITMAP_BITS = 26
MOST_BITS = 27
#: Least occurrences of the bitmaps that ``count`` can make.
GRADES = (2, 4, 16, 64)
BUCKET_HASHES = 4 << 20
FLUSH_HASHES = 2 << 20


@dataclass
class Occurrences:
    bucket_bits: int
    grades: list[np.ndarray]  # packed bits of the hashes with at least GRADES occurrences
    hot: np.ndarray  # sorted first bucket_bits + 32 bits of frequent hashes
    frequency: np.ndarray

    def may_repeat(self, hashes: np.ndarray) -> np.ndarray:
        """False: the hash occurs once."""
        return in_grade(self.grades[0], hashes)

    def frequencies(self, hashes: np.ndarray) -> np.ndarray:
        """Counts of frequent hashes, else the number of bitmaps after the first that hold a hash one after the other."""
        found = np.zeros(len(hashes), np.int64)
        left = np.arange(len(hashes))
        for bitmap in self.grades[1:]:
            left = left[in_grade(bitmap, hashes[left])]
            found[left] += 1
        if len(self.hot):
            head = hashes >> np.uint64(32 - self.bucket_bits)
            at = np.minimum(np.searchsorted(self.hot, head), len(self.hot) - 1)
            found = np.where(self.hot[at] == head, self.frequency[at], found)
        return found


def in_bitmap(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return ((bitmap[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1).astype(bool)


def in_grade(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the first bits of the hashes are set in a bitmap of any size."""
    return in_bitmap(bitmap, (hashes >> np.uint64(64 - (8 * len(bitmap)).bit_length() + 1)).astype(np.int64))


def bits_for(expected: float) -> int:
    """Bits of the first bitmap for about so many hashes, as far as memory allows."""
    return min(MOST_BITS, max(BITMAP_BITS, int(expected).bit_length() - 1))


def count(
    texts: DataFrame, hashes: Callable[[pa.Array], Iterator[np.ndarray]], expected: float, least_hot: int = 16,
    most_hot: int = 1 << 21, bitmap_bits: int | None = None, grades: int = 1,
) -> Occurrences:
    """Count the hashes of the column ``text``; about ``expected`` of them size the buckets.

    ``grades`` is the number of bitmaps, the first of 2 ** ``bitmap_bits`` bits.
    """
    bits = max(8, int(expected / BUCKET_HASHES).bit_length())
    first_bits = bitmap_bits or BITMAP_BITS
    sized = [(least, first_bits - k) for k, least in enumerate(GRADES[:grades])]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed(held: list[np.ndarray]) -> pa.RecordBatch:
            own = np.sort(np.concatenate(held)) >> np.uint64(32 - bits)
            firsts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            n = np.diff(np.concatenate((firsts, [len(own)])))
            own = own[firsts]
            buckets = (own >> np.uint64(32)).astype(np.int64)
            residues = (own & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            heads = np.flatnonzero(np.concatenate(([True], np.diff(buckets) > 0)))
            ends = np.concatenate((heads[1:], [len(own)]))
            blobs = [residues[a:b].tobytes() for a, b in zip(heads, ends, strict=True)]
            more = [residues[a:b][n[a:b] > 1].tobytes() for a, b in zip(heads, ends, strict=True)]
            times = [n[a:b][n[a:b] > 1].astype(np.int64).tobytes() for a, b in zip(heads, ends, strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array(buckets[heads].astype(np.int32)), *[pa.array(v, pa.binary()) for v in (blobs, more, times)]],
                ["bucket", "residues", "repeated", "times"],
            )

        held, n = [], 0
        for batch in batches:
            for own in hashes(batch.column(0)):
                held.append(own)
                n += len(own)
                if n >= FLUSH_HASHES:
                    yield flushed(held)
                    held, n = [], 0
        if n:
            yield flushed(held)

    def counted(group: pa.Table) -> pa.Table:
        def read(column: str, kind: type) -> np.ndarray:
            return np.concatenate([np.frombuffer(b.as_buffer(), kind) for b in group.column(column)])

        residues = np.sort(read("residues", np.uint32))
        heads = np.flatnonzero(np.concatenate(([True], residues[1:] != residues[:-1])))
        counts = np.diff(np.concatenate((heads, [len(residues)])))
        values = residues[heads]
        np.add.at(counts, np.searchsorted(values, read("repeated", np.uint32)), read("times", np.int64) - 1)
        packed = []
        for least, own in sized:
            bitmap = np.zeros(1 << (own - bits), bool)
            bitmap[values[counts >= least] >> np.uint32(32 - own + bits)] = True
            packed.append(np.packbits(bitmap, bitorder="little").tobytes())
        frequent = counts >= least_hot
        return pa.table(
            {
                "bucket": pa.array([group.column("bucket")[0].as_py()], pa.int32()),
                "total": pa.array([int(counts.sum())], pa.int64()),
                "grades": pa.array([packed], pa.list_(pa.binary())),
                "hot": pa.array([values[frequent].tolist()], pa.list_(pa.int64())),
                "frequency": pa.array([counts[frequent].tolist()], pa.list_(pa.int64())),
            }
        )

    residues = texts.select("text").mapInArrow(packed, "bucket int, residues binary, repeated binary, times binary")
    found = materialize(
        residues.groupBy("bucket").applyInArrow(
            counted, "bucket int, total bigint, grades array<binary>, hot array<bigint>, frequency array<bigint>"
        )
    )
    least = max(least_hot, (found.agg(F.sum("total")).first()[0] or 0) // most_hot)
    bitmaps = [np.zeros(1 << (own - 3), np.uint8) for _, own in sized]
    for row in found.select("bucket", "grades").toLocalIterator():
        for bitmap, piece in zip(bitmaps, row["grades"], strict=True):
            bitmap[row["bucket"] * len(piece) : (row["bucket"] + 1) * len(piece)] = np.frombuffer(piece, np.uint8)
    pairs = found.select("bucket", F.explode(F.arrays_zip("hot", "frequency")).alias("h"))
    rows = pairs.where(F.col("h.frequency") >= least).select(
        (F.shiftleft(F.col("bucket").cast("long"), 32) + F.col("h.hot")).alias("head"), "h.frequency"
    ).toArrow()
    head = rows.column(0).to_numpy().astype(np.uint64)
    order = np.argsort(head)
    return Occurrences(bits, bitmaps, head[order], rows.column(1).to_numpy()[order])


def slot_bitmap(values: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of 2 ** ``bits`` bits with the column ``slot`` (0 ..) set; combined before it is collected."""
    parts = values.select((F.col("slot") + 1).alias("slot")).groupBy(F.expr("bitmap_bucket_number(slot)").alias("k"))
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    for row in parts.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits")).collect():
        piece = np.frombuffer(row["bits"], np.uint8)
        bitmap[(row["k"] - 1) * len(piece) : row["k"] * len(piece)] = piece
    return bitmap


def rows_of(df: DataFrame, ids: DataFrame, id_col: str, bits: int = 23) -> DataFrame:
    """The rows of ``df`` whose id is among ``ids`` (a column of the same name).

    A bitmap of fixed size goes to the tasks first, so that only these rows and a few others are shuffled.
    """
    slot = F.pmod(F.xxhash64(id_col), F.lit(1 << bits)).alias("slot")
    sent = df.sparkSession.sparkContext.broadcast(slot_bitmap(ids.select(slot), bits))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside = in_bitmap(sent.value, batch.column(batch.num_columns - 1).to_numpy())
            rows = batch.filter(pa.array(inside))
            yield rows.select(range(batch.num_columns - 1))

    few = df.select("*", slot).mapInArrow(kept, df.schema)
    return few.join(ids.select(id_col).distinct(), id_col, "left_semi")
