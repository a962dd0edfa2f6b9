"""Commit markers of batches: a batch counts from the moment its manifest stands, whole or not at all.

Writers put the files of a batch into a folder of its own and commit afterwards.
A writer that dies leaves files that no manifest names; they are never read, and
the batch can be written again. Committing a name twice changes nothing.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession

SUFFIX = ".json"


def _opened(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def checked_name(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", name):
        raise ValueError(f"not a batch name: {name!r}")
    return name


def committed(spark: SparkSession, folder: str) -> list[str]:
    """Names of the committed batches, in order."""
    at, files = _opened(spark, folder)
    if not files.exists(at):
        return []
    names = [s.getPath().getName() for s in files.listStatus(at)]
    return sorted(n.removesuffix(SUFFIX) for n in names if n.endswith(SUFFIX) and not n.startswith((".", "_")))


def commit(spark: SparkSession, folder: str, name: str, content: dict) -> bool:
    """Write the manifest beside its place and rename it; false if the batch was committed before."""
    at, files = _opened(spark, f"{folder}/{checked_name(name)}{SUFFIX}")
    if files.exists(at):
        return False
    draft, _ = _opened(spark, f"{folder}/_{uuid.uuid4().hex}")
    out = files.create(draft, True)
    try:
        out.write(json.dumps(content, sort_keys=True).encode())
    finally:
        out.close()
    if files.exists(at) or not files.rename(draft, at):
        files.delete(draft, False)
        return False
    return True


def content(spark: SparkSession, folder: str, name: str) -> dict:
    text = spark.read.text(f"{folder}/{checked_name(name)}{SUFFIX}", wholetext=True).first()
    return json.loads(text[0])
