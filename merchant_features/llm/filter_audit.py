"""What filters remove in any order, kept up to date by retraction as files arrive.

Each document fails some of five filters. Four of them look at its text alone;
the fifth fails a text that a document with a smaller id holds too, which a
later file can change. All files are read as a stream of available-now
micro-batches:

1. A task computes the mask of the four text filters and, before anything is
   shuffled, settles its own copies: of rows with one text only those with the
   smallest id are passed on, the others are counted as repeats.
2. Keyed state holds the smallest id of every text so far and which counters
   its documents are in. A smaller id takes the place: what was counted for the
   former one is retracted and counted again with the fifth filter failed.
   About ``TEXTS_PER_KEY`` texts share a state key, by the hash of the text.
3. What changes are counters by part and mask; each micro-batch writes its sums
   of signed changes under its number, so a batch that is repeated overwrites
   itself. The counters are the sum over all batches.
4. Every order of the filters is answered from the counters, 32 per part.

State lives in Spark's state store (RocksDB, with its checkpoint in the shared
folder): a lost executor's state is loaded again elsewhere.

Defined cases: null text is empty; a null part is the empty string. Rows with a
null id are neither repeats nor hold a text for others, and have no labels. Rows of one id do not
repeat each other; repeated rows count each. An id with several labels is good
(toxic) if one says so. An empty table gives no rows. Names of other columns do
not matter.
"""

from __future__ import annotations

import itertools
import json
import uuid
from collections import Counter
from collections.abc import Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchant_features.llm.frames import words_of
from merchant_features.sources.storage import materialize, run_dir

FILTERS = "ABCDE"
REPEAT = 16
TEXTS_PER_KEY = 64
#: Rows that a task settles at a time before they are shuffled.
SETTLED_ROWS = 200_000
#: Held while the stream starts. A store takes 4 MB of disk in advance otherwise, and there is one for every shuffle partition.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
COUNTERS = "part string, mask int, good boolean, toxic boolean, n bigint"


def text_mask(text: Column) -> Column:
    """Bits of the filters that the text alone decides: short, repetitive, shouting, symbols."""
    words = words_of(text)
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    failed = (
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        100 * capitals > 2 * F.length(text),
        text.rlike(r"[#$%&*|]"),
    )
    bits = [F.when(condition, 1 << k).otherwise(0) for k, condition in enumerate(failed)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def _settled(rows: DataFrame, keys: int, id_type: str) -> DataFrame:
    """Rows of one task with one text: those with the smallest id by themselves, the others as counts of repeats."""
    columns = ["part", "mask", "good", "toxic"]

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = TaskContext.get().partitionId() % keys

        def settled(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            # integers stay integers: the smallest ids are found by Arrow
            least = table.filter(pc.is_valid(table.column("id"))).group_by("digest").aggregate([("id", "min")])
            joined = table.join(least, "digest", join_type="left outer")
            same = pc.equal(joined.column("id"), joined.column("id_min"))
            first = joined.filter(pc.fill_null(same, False))
            names = ["digest", "key", "id", *columns]
            first = first.group_by(names).aggregate([([], "count_all")]).rename_columns([*names, "n"])
            # a null id never compares: not a repeat, and counted as it is
            other = joined.filter(pc.invert(pc.fill_null(same, False)))
            repeats = pc.if_else(pc.is_valid(other.column("id")), REPEAT, 0)
            masks = pc.add(other.column("mask"), pc.cast(repeats, pa.int32()))
            other = other.set_column(other.column_names.index("mask"), "mask", masks).select(columns)
            other = other.group_by(columns).aggregate([([], "count_all")]).rename_columns([*columns, "n"])
            n = other.num_rows
            other = other.append_column("digest", pa.nulls(n, first.schema.field("digest").type))
            other = other.append_column("key", pa.array([here] * n, pa.int64()))
            other = other.append_column("id", pa.nulls(n, first.schema.field("id").type))
            out = pa.concat_tables([first.select([*names, "n"]), other.select([*names, "n"])])
            return out.combine_chunks().to_batches()

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= SETTLED_ROWS:
                yield from settled(held)
                held, n = [], 0
        if n:
            yield from settled(held)

    schema = f"digest string, key bigint, id {id_type}, part string, mask int, good boolean, toxic boolean, n bigint"
    return rows.select("digest", "key", "id", *columns).mapInArrow(settle, schema)


def _retract(key: tuple, frames: Iterator[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
    """Signed changes of the counters; the state has the smallest id, mask and holders of every text of the key."""
    texts = json.loads(state.get[0]) if state.exists else {}
    changes: Counter = Counter()
    moved = False
    for frame in frames:
        columns = [frame[c].tolist() for c in ("digest", "id_json", "part", "mask", "good", "toxic", "n")]
        for digest, id_json, part, mask, good, toxic, n in zip(*columns, strict=True):
            if id_json is None:
                changes[part, mask, good, toxic] += n
                continue
            own = json.loads(id_json)[0]
            known = texts.get(digest)
            if known is not None and own > known[0]:
                changes[part, mask | REPEAT, good, toxic] += n
                continue
            if known is None or own < known[0]:
                for held_part, held_good, held_toxic, held_n in known[2] if known else ():
                    changes[held_part, mask, held_good, held_toxic] -= held_n
                    changes[held_part, mask | REPEAT, held_good, held_toxic] += held_n
                known = texts[digest] = [own, mask, []]
            changes[part, mask, good, toxic] += n
            known[2].append([part, good, toxic, n])
            moved = True
    if moved:
        state.update((json.dumps(texts),))
    rows = [(*where, n) for where, n in changes.items() if n]
    yield pd.DataFrame(rows, columns=["part", "mask", "good", "toxic", "n"])


def file_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """All Parquet files of a table, or one file, as a stream; a micro-batch takes one file per core by default."""
    schema = spark.read.parquet(path).schema
    files = files_per_batch or spark.sparkContext.defaultParallelism
    # a pattern, because the stream takes a plain path for a folder
    pattern = f"{path[:-1]}[{path[-1]}]" if path[-1].isalnum() else path
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(pattern)


def count_changes(
    stream: DataFrame, labels: DataFrame, folder: str, keys: int, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """Run the stream to its present end and return all changes; ``folder`` keeps its place, so a later call goes on."""
    spark = stream.sparkSession
    of_id = materialize(
        labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(
            F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
            F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
        )
    )
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    plain = stream.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        text_mask(text).cast("int").alias("mask"), F.sha2(text.cast("binary"), 256).alias("digest"),
    ).withColumn("key", F.pmod(F.xxhash64("digest"), F.lit(keys)))
    labelled = plain.join(of_id, "id", "left").select(
        "*", F.coalesce("good", F.lit(False)).alias("g"), F.coalesce("toxic", F.lit(False)).alias("t")
    ).select("digest", "key", "id", "part", "mask", F.col("g").alias("good"), F.col("t").alias("toxic"))
    settled = _settled(labelled, keys, dict(plain.dtypes)["id"])
    # ids travel as JSON, so that pandas does not turn integers beside nulls into doubles
    keyed = settled.withColumn("id_json", F.when(F.col("id").isNotNull(), F.to_json(F.array("id")))).drop("id")
    changes = keyed.groupBy("key").applyInPandasWithState(_retract, COUNTERS, "texts string", "update", "NoTimeout")

    def write(batch: DataFrame, number: int) -> None:
        batch.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n <> 0").write.mode(
            "overwrite"
        ).parquet(f"{folder}/changes/batch={number}")

    spark.createDataFrame([], COUNTERS).write.mode("overwrite").parquet(f"{folder}/changes/batch=-1")
    before = {name: spark.conf.get(name, None) for name in STATE}
    for name, value in STATE.items():
        spark.conf.set(name, value)
    try:
        query = (
            changes.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", f"{folder}/stream").trigger(availableNow=True).start()
        )
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    query.awaitTermination()
    return spark.read.schema(COUNTERS).parquet(f"{folder}/changes")


def report(changes: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the counters."""
    number = F.sum("n")
    masks = changes.groupBy("part", "mask").agg(
        number.alias("n"), F.coalesce(F.sum(F.when(F.col("good"), F.col("n"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("toxic"), F.col("n"))), F.lit(0)).alias("toxic"),
    )
    # at most 32 masks per part
    parts = masks.where("n <> 0").groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    orders = F.array(*[F.lit("".join(o)) for o in itertools.permutations(FILTERS)])
    steps = parts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.expr(f"sequence(1, {len(FILTERS)})")))
    bit = "shiftleft(1, ascii(substr(filter_order, step, 1)) - ascii('A'))"
    before = "aggregate(slice(split(filter_order, ''), 1, step - 1), 0, (a, c) -> a | shiftleft(1, ascii(c) - ascii('A')))"
    steps = steps.withColumns({"bit": F.expr(bit), "before": F.expr(before)})

    def total(condition: str, value: str = "m.n") -> Column:
        return F.expr(f"aggregate(filter(masks, m -> {condition}), 0L, (a, m) -> a + {value})")

    removed = "(m.mask & before) = 0 AND (m.mask & bit) <> 0"
    n_orders = len(list(itertools.permutations(FILTERS)))
    return steps.select(
        "part", "filter_order", "step",
        total("(m.mask & (before | bit)) = 0").alias("kept"),
        total(removed).alias("removed"),
        total("(m.mask & before) <> 0 AND (m.mask & bit) <> 0").alias("redundant"),
        total("m.mask = bit").alias("unique_fails"),
        total(removed, "m.good").alias("good_lost"),
        total(removed, "m.toxic").alias("toxic_lost"),
        # of k failed filters each comes first in one k-th of all orders
        total("(m.mask & bit) <> 0", f"m.n * {n_orders} div bit_count(m.mask)").alias("shapley"),
    )


def audit_files(
    spark: SparkSession, path: str, labels: DataFrame, files_per_batch: int | None = None, folder: str | None = None, keys: int | None = None,
    **columns: str,
) -> DataFrame:
    """The report over all files of a table; ``folder`` and ``keys`` are given where a stream is to be continued."""
    folder = folder or f"{run_dir(spark)}/filter-audit/{uuid.uuid4().hex}"
    keys = keys or 1 + spark.read.parquet(path).count() // TEXTS_PER_KEY
    return report(count_changes(file_stream(spark, path, files_per_batch), labels, folder, keys, **columns))
