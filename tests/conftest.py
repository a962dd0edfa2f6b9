from __future__ import annotations

import os
import sys
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATE_REF = date(2021, 12, 15)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from merchant_features.plans.session import configure

    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    def make(schema: str, *rows):
        fields = T.StructType.fromDDL(schema).fields
        decimals = {i for i, f in enumerate(fields) if isinstance(f.dataType, T.DecimalType)}
        typed = [
            tuple(Decimal(str(v)) if i in decimals and v is not None else v for i, v in enumerate(row))
            for row in rows
        ]
        return spark.createDataFrame(typed, schema)

    return make


def values(df, *columns) -> list[tuple]:
    rows = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
