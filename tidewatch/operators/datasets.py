"""Membership in large value sets, one field or a tuple of fields.

Membership is a join on the values themselves. Which side travels is left to Spark, which
broadcasts a set only while its measured size allows it.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F


def load_datasets(documents: DataFrame, text_column: str = "value") -> DataFrame:
    """Dataset documents (``dataset_id, dataset_version, fields, values[][]``) as one row per distinct tuple."""
    doc = F.from_json(text_column, "dataset_id string, dataset_version string, fields array<string>, values array<array<string>>")
    return (
        documents.select(doc.alias("d"))
        .where("d.dataset_id is not null")
        .select("d.dataset_id", F.coalesce("d.dataset_version", F.lit("v1")).alias("dataset_version"), F.explode("d.values").alias("tuple"))
        .dropDuplicates()
    )


def dataset_tuples(datasets: DataFrame, dataset_id: str, arity: int, version: str | None = None) -> DataFrame:
    """The tuples of one dataset that have ``arity`` values, as columns ``_m0, _m1, ...``, distinct."""
    rows = datasets.where((F.col("dataset_id") == dataset_id) & (F.size("tuple") == arity))
    if version:
        rows = rows.where(F.col("dataset_version") == version)
    return rows.select(*[F.get("tuple", F.lit(i)).alias(f"_m{i}") for i in range(arity)]).dropDuplicates()


def in_dataset(
    df: DataFrame, values: list[Column], datasets: DataFrame, dataset_id: str,
    version: str | None = None, negate: bool = False,
) -> DataFrame:
    """Rows whose value tuple is (with ``negate``: is not) in the dataset.

    A row with a missing value belongs to neither answer.
    """
    marked, on = _with_values(df, values)
    members = dataset_tuples(datasets, dataset_id, len(values), version)
    if negate:
        marked = marked.dropna(subset=on)
    return marked.join(members, on, "left_anti" if negate else "left_semi").select(*df.columns)


def with_membership(
    df: DataFrame, values: list[Column], datasets: DataFrame, dataset_id: str, version: str | None, out: str,
) -> DataFrame:
    """Adds a boolean ``out``, for membership used inside OR; null when a value is missing."""
    marked, on = _with_values(df, values)
    members = dataset_tuples(datasets, dataset_id, len(values), version).withColumn("_in", F.lit(True))
    known = reduce(and_, [F.col(name).isNotNull() for name in on])
    judged = marked.where(known).join(members, on, "left").select(*df.columns, F.coalesce("_in", F.lit(False)).alias(out))
    # Rows with a missing value would all meet in one partition of the join.
    return judged.unionByName(marked.where(~known).select(*df.columns, F.lit(None).cast("boolean").alias(out)))


def _with_values(df: DataFrame, values: list[Column]) -> tuple[DataFrame, list[str]]:
    on = [f"_m{i}" for i in range(len(values))]
    return df.withColumns(dict(zip(on, values))), on
