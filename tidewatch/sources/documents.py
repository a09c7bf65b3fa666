"""Small JSON documents given in the program, as rows of the shape the tables have."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


def schema_table(spark: SparkSession, documents: list[dict]) -> DataFrame:
    """``schema_id, schema_payload`` rows, in registration order ``seq``."""
    rows = [(i, d["schema_id"], json.dumps(d)) for i, d in enumerate(documents)]
    return spark.createDataFrame(rows, "seq bigint, schema_id string, schema_payload string")
