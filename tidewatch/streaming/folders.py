"""Where a running query keeps its files."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from tidewatch.operators.scans import shared_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder the cluster names."""
    return f"{shared_dir(spark).rstrip('/')}/tidewatch/{name}-{uuid.uuid4().hex[:12]}"
