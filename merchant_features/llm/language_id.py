"""Language identification by nearest centroid over TF-IDF vectors of hashed character n-grams.

A text is read as its lower-cased words (digits aside they are letters) with
blanks between; the 1-, 2- and 3-byte grams of all of it are counted in
``DIMENSIONS`` hashed places, weighted by log(1 + count) * idf and normalised.
Document frequencies are counted over all training rows. Every language has
several centroids, clustered by cosine from a sample of at most ``SAMPLE``
training rows, split evenly over the languages, taken by smallest hash. The
nearest centroid's language is predicted with its cosine as the score.

Rejection is by distance: a centroid's radius is the ``REJECT_QUANTILE`` of its
own members' cosines less a margin; a text farther off is marked ``rejected``
(the nearest language is still named).

Defined cases: a null text or one without a letter is ``und`` with score 0.
Training rows with a null text or language, or without a letter, are left out.
Without any training row everything is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchant_features.llm import words as W
from merchant_features.llm.frames import broadcast_fields

BITS = 12
DIMENSIONS = 1 << BITS
SAMPLE = 1600
CENTROIDS = 4
REJECT_QUANTILE = 0.005
REJECT_MARGIN = 0.1
UNDETERMINED = "und"


def gram_counts(texts: pa.Array) -> Iterator[tuple[range, np.ndarray]]:
    """(rows, counts[row, place]) of the whole texts, some documents at a time."""
    for part in W.slices(texts, most_rows=256):
        p = W.plain(W.words(part, W.ALNUM, hashed=False))
        n = len(part.rows)
        text = p.text.astype(np.uint32)
        document = np.repeat(np.arange(n), np.diff(p.bounds))
        counts = np.zeros(n * DIMENSIONS, np.int64)
        inside = text != 0
        for size in (1, 2, 3):
            length = len(text) - size
            if length <= 0:
                continue
            code, whole = np.full(length, size, np.uint32), np.ones(length, bool)
            for k in range(size):
                code = code * np.uint32(257) + text[k : k + length]
                whole &= inside[k : k + length]
            place = (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)
            counts += np.bincount(document[:length][whole] * DIMENSIONS + place[whole], minlength=n * DIMENSIONS)
        yield part.rows, counts.reshape(n, DIMENSIONS)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vectors = np.log1p(counts).astype(np.float32) * idf.astype(np.float32)
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # unit rows
    language_of: np.ndarray  # of each centroid
    radius: np.ndarray  # least cosine each centroid accepts


def clustered(vectors: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from farthest-first seeds; deterministic."""
    seeds = [int(np.argmax(vectors @ vectors.mean(axis=0)))]
    while len(seeds) < min(k, len(vectors)):
        nearest = (vectors @ vectors[seeds].T).max(axis=1)
        far = int(np.argmin(nearest))
        if nearest[far] > 0.999:
            break
        seeds.append(far)
    centroids = vectors[seeds]
    for _ in range(rounds):
        owner = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.stack([vectors[owner == c].sum(axis=0) if (owner == c).any() else centroids[c] for c in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """(rows, rows that hold each place) over the column ``text``."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = 0, np.zeros(DIMENSIONS, np.int64)
        for batch in batches:
            rows += batch.num_rows
            for _, counts in gram_counts(batch.column(0)):
                held += (counts > 0).sum(axis=0)
        places = np.append(np.arange(DIMENSIONS), -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.append(held, rows))], ["place", "n"])

    sums = texts.select("text").mapInArrow(partial, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    found = {r["place"]: r["n"] for r in sums.collect()}
    return found.get(-1, 0), np.array([found.get(k, 0) for k in range(DIMENSIONS)], np.int64)


def train(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample: int = SAMPLE, centroids: int = CENTROIDS) -> Model:
    """Fit on ``rows``, which the caller has chosen; at most ``sample`` of them are clustered."""
    usable = rows.where(F.col(lang_col).isNotNull() & has_letter(F.col(text_col))).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    total, held = document_frequencies(usable)
    idf = np.log((1 + total) / (1 + held)) + 1.0
    languages = sorted(r["lang"] for r in usable.select("lang").distinct().collect())
    if not languages:
        none = np.zeros((0, DIMENSIONS), np.float32)
        return Model([], idf, none, np.zeros(0, np.int64), np.zeros(0))
    each = max(1, sample // len(languages))
    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.col("id").cast("string")), "tag")
    chosen = (
        usable.select(F.xxhash64("text").alias("tag"), "id", "lang").withColumn("nth", F.row_number().over(order))
        .where(F.col("nth") <= each).select("id", "tag", "lang").distinct()
    )
    # the chosen rows are at most ``sample``
    texts = usable.withColumn("tag", F.xxhash64("text")).join(F.broadcast(chosen), ["id", "tag", "lang"])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [row.tobytes() for _, c in gram_counts(batch.column(1)) for row in weighted(c, idf)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], ["lang", "vector"])

    drawn = texts.select("lang", "text").dropDuplicates().mapInArrow(vectors, "lang string, vector binary").toArrow()
    by_language: dict[str, list] = {}
    for lang, blob in sorted(zip(drawn["lang"].to_pylist(), drawn["vector"].to_pylist(), strict=True)):
        by_language.setdefault(lang, []).append(np.frombuffer(blob, np.float32))
    found, owner, radius = [], [], []
    for k, lang in enumerate(languages):
        own = np.stack(by_language[lang])
        centres = clustered(own, centroids)
        nearest = own @ centres.T
        member = np.argmax(nearest, axis=1)
        for c in range(len(centres)):
            near = nearest[member == c, c]
            radius.append(float(np.quantile(near, REJECT_QUANTILE)) - REJECT_MARGIN if len(near) else 0.0)
        found.append(centres)
        owner += [k] * len(centres)
    return Model(languages, idf, np.concatenate(found), np.array(owner), np.array(radius))


def predict(rows: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected) of every row; the text is all that is looked at."""
    sent = broadcast_fields(rows.sparkSession, model)
    texts = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), has_letter(F.col(text_col)).alias("known"))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*sent.value)
        for batch in batches:
            known = batch.column(2).to_numpy(zero_copy_only=False)
            langs, scores, rejected = [], [], []
            for part, counts in gram_counts(batch.column(1)):
                cosines = weighted(counts, m.idf) @ m.centroids.T if m.languages else None
                for k, row in enumerate(part):
                    if not known[row] or cosines is None:
                        langs.append(UNDETERMINED)
                        scores.append(0.0)
                        rejected.append(True)
                        continue
                    c = int(np.argmax(cosines[k]))
                    langs.append(m.languages[m.language_of[c]])
                    scores.append(min(1.0, max(0.0, float(cosines[k, c]))))
                    rejected.append(bool(cosines[k, c] < m.radius[c]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                ["id", "lang_pred", "score", "rejected"],
            )

    return texts.mapInArrow(nearest, f"id {dict(texts.dtypes)['id']}, lang_pred string, score double, rejected boolean")
