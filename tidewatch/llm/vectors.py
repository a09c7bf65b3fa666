"""Vectors as packed bytes, and what they need to be of use."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def packed_vectors(embeddings: DataFrame, id_column: str, vector_column: str, empty: bool = False) -> DataFrame:
    """``id`` and ``v``: the components as little-endian doubles, null for a vector that is null, empty (unless ``empty``) or
    holds a null or non-finite component. Negative zeros become zeros."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column("v").to_pylist():
                row = None
                if (v or empty and v is not None) and None not in v:
                    values = np.array(v, np.float64) + 0.0
                    if np.isfinite(values).all():
                        row = values.tobytes()
                out.append(row)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], ["id", "v"])

    id_type = embeddings.schema[id_column].dataType.simpleString()
    rows = embeddings.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    return rows.mapInArrow(run, f"id {id_type}, v binary")


def matrix(rows: list[bytes], width: int, kind: type = np.float64) -> np.ndarray:
    """Packed vectors as rows of ``width``; a shorter one is filled up with zeros."""
    size = np.dtype(kind).itemsize
    if all(len(r) == width * size for r in rows):
        return np.frombuffer(b"".join(rows), kind).reshape(len(rows), width)
    out = np.zeros((len(rows), width), kind)
    for i, r in enumerate(rows):
        own = np.frombuffer(r, kind)
        out[i, : len(own)] = own
    return out
