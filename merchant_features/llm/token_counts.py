"""Token counts kept up to date by signed deltas.

A ledger in shared storage holds, per batch, signed entries per document
(``entries``) and their sums by source, language and tokenizer version
(``deltas``). Inserting a document adds an entry; deleting it adds the negative
of what the ledger holds of it; a revised document does both. Totals are the sum
of the batches' deltas: nothing is counted again.

A batch is committed when its deltas are written completely (the writer's
success marker). Applying a committed batch again changes nothing, and a batch
that broke off is written anew, so a driver may repeat any step.

Long runs of white space are encoded as the one piece that the pattern makes of
them, without the pattern, which cannot take them.

Defined cases: a null text has no tokens and counts as a document. Rows with a
null id are left out: they could never be revised. Rows of one id in one batch
all count, and a later revision or deletion takes all of them back. Null source
or language is a group of its own. Deleting an unknown id does nothing; an id
that a batch both inserts and deletes is deleted first and then inserted.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the splitting pattern that belongs to the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: The characters that ``\\s`` stands for in the pattern.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = 50_000

ENTRIES = "id string, source string, lang string, version string, docs bigint, tokens bigint"
KEYS = ["source", "lang", "version"]


@dataclass(frozen=True)
class Tokenizer:
    """A byte-level vocabulary by its ranks file; ``version`` names it in the totals."""

    version: str
    path: str = VOCABULARY
    pattern: str = PATTERN


def count_tokens(encoding, text: str, long_run: int = LONG_RUN) -> int:
    """Tokens of a text. A run of white space is one piece, but for its last character if a word follows."""
    total, start = 0, 0
    for run in re.finditer(f"[{WHITE}]{{{long_run},}}", text):
        end = run.end() - (run.end() < len(text))
        total += len(encoding.encode_ordinary(text[start : run.start()])) + len(encoding._encode_single_piece(text[run.start() : end]))
        start = end
    return total + len(encoding.encode_ordinary(text[start:]))


def with_tokens(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """``docs`` (id, text, source, lang) with ``tokens`` in place of the text; whole texts are encoded."""
    with open(tokenizer.path, "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())  # one vocabulary, of fixed size
    pattern = tokenizer.pattern

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in sent.value.splitlines() if line)}
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            counts = [count_tokens(encoding, t.as_py()) if t.is_valid else 0 for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(counts, pa.int64())],
                ["id", "source", "lang", "tokens"],
            )

    read = docs.select(F.col("id").cast("string").alias("id"), "text", "source", "lang")
    return read.mapInArrow(encoded, "id string, source string, lang string, tokens bigint")


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    path: str

    def _part(self, kind: str, batch: str) -> str:
        return f"{self.path}/{kind}/batch={batch}"

    def _files(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/deltas")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def batches(self) -> list[str]:
        """Committed batches, by name."""
        path, files = self._files()
        if not files.exists(path):
            return []
        marker = self.spark._jvm.org.apache.hadoop.fs.Path
        found = [s.getPath() for s in files.listStatus(path)]
        done = [p.getName().removeprefix("batch=") for p in found if files.exists(marker(p, "_SUCCESS"))]
        return sorted(done)

    def _read(self, kind: str, schema: str, without: str | None = None) -> DataFrame:
        paths = [self._part(kind, b) for b in self.batches() if b != without]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def entries(self) -> DataFrame:
        return self._read("entries", ENTRIES)

    def _taken_back(self, ids: DataFrame, version: str | None) -> DataFrame:
        """The negative of what the ledger holds of these ids, of one version or of all."""
        held = self.entries() if version is None else self.entries().where(F.col("version") == version)
        net = held.join(ids, "id", "left_semi").groupBy("id", *KEYS).agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")
        )
        return net.where("docs <> 0 OR tokens <> 0").select(
            "id", *KEYS, (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens")
        )

    def apply(
        self, batch: str, tokenizer: Tokenizer, upserts: DataFrame | None = None, deletes: DataFrame | None = None
    ) -> bool:
        """Commit a batch; false if it was committed before.

        ``upserts`` has id, text, source and lang and replaces what the ledger holds of its ids under this
        tokenizer version. ``deletes`` has id and takes back all versions.
        """
        known = self.batches()
        if batch in known:
            return False
        parts = []
        if deletes is not None:
            gone = deletes.select(F.col("id").cast("string").alias("id")).distinct()
            if known:
                parts.append(self._taken_back(gone, None))
        if upserts is not None:
            rows = upserts.where(F.col("id").isNotNull())
            added = with_tokens(rows, tokenizer).withColumn("version", F.lit(tokenizer.version))
            parts.append(added.select("id", *KEYS, F.lit(1).cast("long").alias("docs"), "tokens"))
            if known:
                ids = rows.select(F.col("id").cast("string").alias("id")).distinct()
                if deletes is not None:
                    ids = ids.join(gone, "id", "left_anti")  # these are taken back already
                parts.append(self._taken_back(ids, tokenizer.version))
        signed = parts[0] if parts else self.spark.createDataFrame([], ENTRIES)
        for part in parts[1:]:
            signed = signed.unionByName(part)
        entries = self._part("entries", batch)
        signed.write.mode("overwrite").parquet(entries)
        written = self.spark.read.schema(ENTRIES).parquet(entries)
        sums = written.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        sums.coalesce(1).write.mode("overwrite").parquet(self._part("deltas", batch))
        return True

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens) from the committed deltas alone."""
        deltas = self._read("deltas", "source string, lang string, version string, docs bigint, tokens bigint")
        sums = deltas.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs <> 0 OR tokens <> 0")
