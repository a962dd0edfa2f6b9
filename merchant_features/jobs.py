"""The monthly jobs: prepare a feature table, ingest it, build the model table.

    spark-submit merchant_features/jobs.py prepare establishment --paths paths.json --date-ref 2021-12-15 --output DIR
    spark-submit merchant_features/jobs.py ingest establishment --input DIR --table DIR --epoch 1639526400
    spark-submit merchant_features/jobs.py model --establishment DIR --principal DIR --target DIR --date-ref 2021-12-15 --output DIR

``paths.json`` maps the logical table names of ``sources.tables`` to directories.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from merchant_features.operators.universe import OWNER, OWNER_REF
from merchant_features.plans.establishment import establishment_features
from merchant_features.plans.model import model_table
from merchant_features.plans.principal import principal_features
from merchant_features.plans.session import configure
from merchant_features.plans.target import activation_target
from merchant_features.sources import feature_store, storage, tables

PREPARE = {
    "establishment": (establishment_features, tables.ESTABLISHMENT_SOURCES),
    "principal": (principal_features, tables.PRINCIPAL_SOURCES),
    "target": (activation_target, tables.TARGET_SOURCES),
}
# Record id and the type rule of every feature table: text only, or numbers too.
INGEST = {
    "establishment": {"record_id": OWNER, "strings_only": False},
    "principal": {"record_id": OWNER_REF, "strings_only": True, "drop_null_ids": False},
    "target": {"record_id": OWNER, "strings_only": False},
    "model": {"record_id": OWNER_REF, "strings_only": True, "drop_null_ids": False},
}


def prepare(
    spark: SparkSession,
    name: str,
    paths: Mapping[str, str],
    date_ref: date,
    output: str,
    weighting: str = "none",
    partitions: int | None = None,
) -> None:
    """Compute one feature table from its sources and write its files."""
    plan, specs = PREPARE[name]
    inputs = tables.load_all(configure(spark), paths, specs, date_ref)
    tables.write_features(plan(inputs, date_ref, weighting=weighting), output, partitions)


def ingest(spark: SparkSession, name: str, source: str, table: str, epoch: float) -> bool:
    """Append prepared files to the feature table of that name; a repeated job, with the same epoch, appends nothing."""
    return feature_store.ingest(spark, source, table, epoch=epoch, **INGEST[name])


def model_from_store(
    spark: SparkSession, establishment: str, principal: str, target: str, date_ref: date
) -> DataFrame:
    """Model table from all records that the three feature tables hold of the period.

    A period may have been ingested in parts or more than once. Feature rows are
    distinct when they are prepared, so a row that was ingested again unchanged
    counts once; of an owner's labels the newest counts.
    """
    configure(spark)
    features = [
        feature_store.read_features(spark, table, date_ref).drop(feature_store.EVENT_TIME).distinct()
        for table in (principal, establishment)
    ]
    label = feature_store.read_features(spark, target, date_ref, keys=OWNER)
    return model_table(features[0], label, features[1])


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)

    command = commands.add_parser("prepare")
    command.add_argument("name", choices=PREPARE)
    command.add_argument("--paths", required=True, help="JSON file: logical table name to directory")
    command.add_argument("--date-ref", required=True, type=date.fromisoformat)
    command.add_argument("--output", required=True)
    command.add_argument("--weighting", default="none", choices=("none", "rows"))
    command.add_argument("--partitions", type=int)

    command = commands.add_parser("ingest")
    command.add_argument("name", choices=INGEST)
    command.add_argument("--input", required=True)
    command.add_argument("--table", required=True)
    command.add_argument("--epoch", required=True, type=float)

    command = commands.add_parser("model")
    for table in ("establishment", "principal", "target"):
        command.add_argument(f"--{table}", required=True)
    command.add_argument("--date-ref", required=True, type=date.fromisoformat)
    command.add_argument("--output", required=True)

    args = parser.parse_args(arguments)
    spark = SparkSession.builder.getOrCreate()
    with storage.run(spark):
        if args.command == "prepare":
            with open(args.paths) as file:
                paths = json.load(file)
            prepare(spark, args.name, paths, args.date_ref, args.output, args.weighting, args.partitions)
        elif args.command == "ingest":
            ingest(spark, args.name, args.input, args.table, args.epoch)
        else:
            df = model_from_store(spark, args.establishment, args.principal, args.target, args.date_ref)
            tables.write_features(df, args.output)


if __name__ == "__main__":
    main()
