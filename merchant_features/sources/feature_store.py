"""Feature tables: period-partitioned Parquet with a schema contract and a latest-record view.

A table lives under one path: ``records`` holds the appended rows, a folder per
batch partitioned by analysis period; ``manifests`` a file per committed batch;
``contract`` an empty Parquet file with the schema and, as column metadata, which
columns identify a record and its event time.

A batch's files are staged in its folder and count when its manifest stands. A
job that died leaves no records behind, and one that is repeated adds none.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchant_features.functions.periods import analysis_period
from merchant_features.operators.contracts import to_feature_types
from merchant_features.operators.history import top1_per_key
from merchant_features.sources import manifests
from merchant_features.sources.tables import load_table

PERIOD = "id_periodo_analisis"
EVENT_TIME = "event_time"
ROLE = "feature_role"


class ContractMismatch(ValueError):
    """The frame does not have the columns and types the feature table was created with."""


def _records(path: str) -> str:
    return f"{path.rstrip('/')}/records"


def _manifests(path: str) -> str:
    return f"{path.rstrip('/')}/manifests"


def _batch(path: str, batch: str) -> str:
    return f"{_records(path)}/batch={manifests.checked_name(batch)}"


def _contract(path: str) -> str:
    return f"{path.rstrip('/')}/contract"


def _read_contract(spark: SparkSession, path: str) -> T.StructType | None:
    try:
        return spark.read.parquet(_contract(path)).schema
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _types(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def ensure_feature_table(
    spark: SparkSession, path: str, schema: T.StructType, record_id: str, event_time: str = EVENT_TIME
) -> T.StructType:
    """Create the table with ``schema`` if it is missing, else check that ``schema`` matches it."""
    for name in (record_id, event_time):
        if name not in schema.fieldNames():
            raise ContractMismatch(f"column {name} is not in the frame")
    existing = _read_contract(spark, path)
    if existing is None:
        roles = {record_id: "record_id", event_time: "event_time"}
        fields = [
            T.StructField(f.name, f.dataType, True, {ROLE: roles[f.name]} if f.name in roles else {})
            for f in schema.fields
        ]
        existing = T.StructType(fields)
        spark.createDataFrame([], existing).write.mode("ignore").parquet(_contract(path))
        return existing
    wanted, given = _types(existing), _types(schema)
    if wanted != given:
        differing = sorted(k for k in wanted.keys() | given.keys() if wanted.get(k) != given.get(k))
        raise ContractMismatch(f"columns differ from the feature table: {', '.join(differing)}")
    stored = {f.metadata.get(ROLE): f.name for f in existing.fields if f.metadata.get(ROLE)}
    if stored != {"record_id": record_id, "event_time": event_time}:
        raise ContractMismatch(f"feature table is keyed by {stored}")
    return existing


def batches(spark: SparkSession, path: str) -> list[str]:
    """Names of the committed batches."""
    return manifests.committed(spark, _manifests(path))


def stage_features(df: DataFrame, path: str, record_id: str, batch: str, event_time: str = EVENT_TIME) -> None:
    """Write the files of a batch, over those of an earlier attempt; they are not read before the batch is committed."""
    contract = ensure_feature_table(df.sparkSession, path, df.schema, record_id, event_time)
    ordered = df.select(*contract.fieldNames())
    ordered.write.mode("overwrite").option("compression", "snappy").partitionBy(PERIOD).parquet(_batch(path, batch))


def commit_batch(spark: SparkSession, path: str, batch: str) -> bool:
    """Commit a staged batch with the number of its records per period; false if it was committed before."""
    counts = _read_batches(spark, path, [batch]).groupBy(PERIOD).count().collect()
    return manifests.commit(
        spark, _manifests(path), batch, {"batch": batch, "records": {str(r[PERIOD]): r["count"] for r in counts}}
    )


def append_features(
    df: DataFrame, path: str, record_id: str, event_time: str = EVENT_TIME, batch: str | None = None
) -> bool:
    """Append records to the offline table as one batch; earlier records stay as they are.

    A batch that is committed is not appended again: false.
    """
    spark = df.sparkSession
    ensure_feature_table(spark, path, df.schema, record_id, event_time)
    batch = batch or uuid.uuid4().hex
    if batch in batches(spark, path):
        return False
    stage_features(df, path, record_id, batch, event_time)
    return commit_batch(spark, path, batch)


def _read_batches(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    contract = _read_contract(spark, path)
    if contract is None:
        raise FileNotFoundError(path)
    try:
        reader = spark.read.schema(contract).option("basePath", _records(path))
        df = reader.parquet(*[_batch(path, n) for n in names]) if names else None
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        df = None
    return spark.createDataFrame([], contract) if df is None else df.select(*contract.fieldNames())


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the committed batches."""
    return _read_batches(spark, path, batches(spark, path))


def latest_features(
    df: DataFrame, keys: Sequence[str] | str, event_time: str = EVENT_TIME
) -> DataFrame:
    """The most recent record of every key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return top1_per_key(df, keys, [F.col(event_time).desc()])


def read_features(
    spark: SparkSession, path: str, period: str | date, keys: Sequence[str] | str | None = None
) -> DataFrame:
    """All records of one analysis period, in however many parts they came; only that partition is read.

    With ``keys`` the newest record of every key. Keys must name a record:
    records that share their keys are taken for versions of each other.
    """
    period = analysis_period(period) if isinstance(period, date) else period
    df = read_records(spark, path).where(F.col(PERIOD) == period)
    return df if keys is None else latest_features(df, keys)


def with_event_time(df: DataFrame, epoch: float) -> DataFrame:
    """Stamp every record of a run with the same epoch seconds."""
    return df.withColumn(EVENT_TIME, F.lit(float(round(epoch))))


def ingest(
    spark: SparkSession,
    source: str,
    path: str,
    record_id: str,
    epoch: float,
    strings_only: bool = False,
    drop_null_ids: bool = True,
    null_string: str | None = None,
    path_glob: str | None = None,
    batch: str | None = None,
) -> bool:
    """Read prepared feature files (the whole folder, or those a pattern names), stamp, normalise and append them.

    The batch is named by the files' place and the epoch unless ``batch`` is
    given: a repeated job, with the same epoch, finds it committed and returns false.
    """
    if batch is None:
        place = hashlib.sha256(f"{source.rstrip('/')} {path_glob or ''}".encode()).hexdigest()[:16]
        batch = f"{round(epoch)}-{place}"
    if batch in batches(spark, path):
        return False
    df = with_event_time(load_table(spark, source, path_glob=path_glob), epoch)
    if drop_null_ids:
        df = df.dropna(subset=[record_id])
    typed = to_feature_types(df, strings_only=strings_only, null_string=null_string)
    return append_features(typed, path, record_id, batch=batch)
