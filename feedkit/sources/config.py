"""Schema, target and mapping files: small JSON documents, read whole on the driver."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def load_json(spark: SparkSession, document: str | dict) -> dict:
    """A dict as it is, or the JSON document at a path of any file system Spark can read."""
    if isinstance(document, dict):
        return document
    return json.loads(spark.read.text(document, wholetext=True).first()["value"])
