"""Balanced contiguous shards by global prefix sums of byte sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.llm.common import table, text_of


def shard_by_bytes(documents: DataFrame, shards: int = 16, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Puts documents into ``shards`` contiguous runs of nearly equal bytes, in the order of their ids.

    One row per input row: the id, ``size`` (UTF-8 bytes of the text plus 1; a null text has none),
    ``text_crc32``, ``law`` (``bytes``), ``shard``, ``slot`` (place in the shard, from 0) and
    ``grown_shard`` (null: this law promises nothing about a further shard).

    Rows are dealt into ranges of the id, each range sums its sizes, the running sum of those totals gives
    every range its start, and a running sum inside the range gives every row its own. The row belongs to
    the shard that holds the middle of its bytes, so each cut is at most half a document off its target.
    A shard whose target lies inside one huge document may stay empty.

    Null ids come first; rows of equal id are ordered by size and checksum, and rows equal in these as well
    are interchangeable. No row is kept with its equals: a group of copies may be cut. An empty table gives
    an empty result. Other columns are not read.

    Two tables are written: the thin rows, so that their row number is fixed, and the thin rows in ranges,
    so that the range number is. A hot id is cut by the row number.
    """
    spark = documents.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards)
    thin = table(
        documents.select(
            F.col(id_column).alias("doc_id"),
            (F.octet_length(text_of(text_column)).cast("bigint") + 1).alias("size"),
            F.crc32(text_of(text_column).cast("binary")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    order = ["doc_id", "size", "text_crc32", "row"]
    ranged = table(thin.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()), "shard-ranges")

    totals = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    # One row per range, a number the session sets: the only window here without a partition.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("range").orderBy(*order)
    placed = (
        ranged.join(starts, "range")
        .withColumn("start", F.col("bytes_before") + F.sum("size").over(inside) - F.col("size"))
        .withColumn("place", F.col("rows_before") + F.row_number().over(inside) - 1)
        .withColumn("shard", F.expr(f"cast(((2 * start + size) * {shards}) div (2 * total) as int)"))
    )
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(firsts, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
