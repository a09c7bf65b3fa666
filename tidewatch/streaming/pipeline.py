"""Streaming forms of validation, profile upkeep, first arrival, absence and rule matching.

Stateless work and work that is a mergeable aggregate runs in ``foreachBatch`` with the batch
operators; only first arrival and absence hold keyed state. Every write is per epoch
and overwrites its own folder, so an epoch replayed after a failure changes nothing.
"""

from __future__ import annotations

import re
from typing import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidewatch.operators import profile, report, validate
from tidewatch.operators.match import events_of, match_rules
from tidewatch.operators.rules import live_rules, parse_rules, rule_class
from tidewatch.operators.schemas import Registry
from tidewatch.streaming import processors
from tidewatch.streaming.processors import ROCKSDB, Absence, FirstArrival

# Processors travel to the workers whole, so the package need not be installed there.
cloudpickle.register_pickle_by_value(processors)

EPOCH = re.compile(r"epoch=(\d+)")


def write_epoch(df: DataFrame, folder: str, epoch: int) -> None:
    df.write.mode("overwrite").parquet(f"{folder}/epoch={epoch}")


def epochs_before(spark: SparkSession, folder: str, epoch: int) -> list[str]:
    """Folders of earlier epochs, oldest first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    found = sorted(int(m.group(1)) for m in map(EPOCH.fullmatch, names) if m)
    return [f"{folder}/epoch={n}" for n in found if n < epoch and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/epoch={n}/_SUCCESS"))]


def start(df: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, **trigger) -> StreamingQuery:
    """Runs ``work`` on every micro-batch; ``trigger`` as for ``DataStreamWriter.trigger``."""
    return df.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def stream_validation(
    records: DataFrame, schemas: Callable[[SparkSession], DataFrame | Registry], folder: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df, **trigger,
) -> StreamingQuery:
    """Valid stream events to ``folder/valid``, dead letters to ``folder/dlq``. ``schemas`` is read again for
    each micro-batch, so a catalogue change counts from the next one."""

    def work(batch: DataFrame, epoch: int) -> None:
        checked = validate.check_stream(prepare(batch), schemas(batch.sparkSession)).persist()
        try:
            good = validate.valid(checked).select(
                *[c for c in checked.columns if c not in ("errors", "error_code", "payload", "event")],
                F.to_json("event").alias("event"),
            )
            write_epoch(good, f"{folder}/valid", epoch)
            write_epoch(report.stream_dead_letters(checked), f"{folder}/dlq", epoch)
        finally:
            checked.unpersist()

    return start(records, work, f"{folder}/checkpoint", **trigger)


def batch_validation(
    records: DataFrame, schemas: Callable[[SparkSession], DataFrame | Registry], folder: str, as_of,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df, **trigger,
) -> StreamingQuery:
    """Batch envelopes through the five levels and into the profile.

    ``folder/marks`` carries the latest snapshot per dataset from epoch to epoch; ``folder/deltas``
    takes each epoch's profile delta, ``folder/dlq`` its dead letters. Records need ``seq``.
    """

    def work(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        earlier = epochs_before(spark, f"{folder}/marks", epoch)
        marks = spark.read.parquet(earlier[-1]) if earlier else None
        checked = validate.check_batch(prepare(batch), schemas(spark), as_of, marks=marks).persist()
        try:
            good = validate.valid(checked)
            write_epoch(profile.profile_delta(good), f"{folder}/deltas", epoch)
            write_epoch(report.dead_letters(validate.rejected(checked)), f"{folder}/dlq", epoch)
            seen = validate.snapshot_marks(checked)
            if marks is not None:
                seen = marks.unionByName(seen).groupBy("dataset_name").agg(F.max("mark").alias("mark"))
            write_epoch(seen, f"{folder}/marks", epoch)
        finally:
            checked.unpersist()

    return start(records, work, f"{folder}/checkpoint", **trigger)


def live_profile(spark: SparkSession, folder: str, compacted: str | None = None, upto: int = 0) -> DataFrame:
    """The profile all deltas written so far amount to. With ``compacted`` (see :func:`compact_deltas`) only the
    epochs from ``upto`` on are read beside it."""
    deltas = spark.read.option("basePath", f"{folder}/deltas").parquet(f"{folder}/deltas").where(F.col("epoch") >= upto).drop("epoch")
    if compacted:
        deltas = deltas.unionByName(spark.read.parquet(compacted))
    return profile.profile_of(profile.merge_deltas(deltas))


def compact_deltas(spark: SparkSession, folder: str, upto: int, target: str) -> None:
    """Merges the deltas before epoch ``upto`` into one, written to ``target``."""
    parts = epochs_before(spark, f"{folder}/deltas", upto)
    profile.merge_deltas(spark.read.parquet(*parts)).write.mode("overwrite").parquet(target)


def rule_matching(
    records: DataFrame, rule_log: Callable[[SparkSession], DataFrame | list[dict]], folder: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df, profile_datasets: set[str] = frozenset(),
    layouts: Callable[[SparkSession], DataFrame] | None = None, **trigger,
) -> StreamingQuery:
    """Stateless rule hits to ``folder/hits``. ``rule_log`` is asked in each micro-batch: a change log is folded anew,
    a list of rules (of a :class:`~tidewatch.streaming.catalogue.Catalogue`) is taken as it is.

    With ``layouts`` (see :func:`~tidewatch.operators.report.map_output_by_table`), asked in each micro-batch as well,
    ``folder/output`` holds the hits' records, their ``value`` as JSON. Rules with a sequence, a first arrival, a dataset or a field of ``profile_datasets`` need state and take no part."""

    def work(batch: DataFrame, epoch: int) -> None:
        live = rule_log(batch.sparkSession)
        live = live if isinstance(live, list) else parse_rules(live_rules(live))
        rules = [r for r in live if rule_class(r, profile_datasets, triggers=True) == "STATELESS"]
        hits = match_rules(events_of(prepare(batch)), rules)
        write_epoch(hits.select("seq", "rule_id"), f"{folder}/hits", epoch)
        if layouts is not None:
            shown = hits.select("seq", "rule_id", F.to_json("event").alias("payload"))
            mapped = report.map_output_by_table(shown, layouts(batch.sparkSession), ["seq", "rule_id"])
            write_epoch(mapped.select("seq", "rule_id", "value"), f"{folder}/output", epoch)

    return start(records, work, f"{folder}/checkpoint", **trigger)


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def first_arrivals(events: DataFrame, keys: list[str], order: list[str], ttl_ms: int | None = None) -> DataFrame:
    """First event per key and processing-time period; also cooldown, with (rule_id, partition_key) as keys.

    State that expires needs processing time, and a query in that mode keeps running empty batches;
    without ``ttl_ms`` it ends when its input does.
    """
    use_rocksdb(events.sparkSession)
    return events.groupBy(*keys).transformWithState(
        FirstArrival(order, events.columns, ttl_ms), events.schema, "Append", "ProcessingTime" if ttl_ms else "None"
    )


def absences(
    events: DataFrame, key: str, time: str, event_id: str, first, second, least: int, most: int, watermark: str = "1 minute",
) -> DataFrame:
    """(key, event_id, time) of first events without an answer, as the watermark passes their window.
    ``time`` is microseconds; events need an event-time column ``ts``."""
    use_rocksdb(events.sparkSession)
    rows = (
        events.withColumns({"is_first": F.coalesce(first, F.lit(False)), "is_second": F.coalesce(second, F.lit(False))})
        .where("is_first or is_second")
        .select(key, F.col(event_id).alias("event_id"), F.col(time).alias("time"), "is_first", "is_second", "ts")
        .withWatermark("ts", watermark)
    )
    key_type = rows.schema[key].dataType.simpleString()
    out = f"{key} {key_type}, event_id bigint, time bigint"
    return rows.groupBy(key).transformWithState(Absence(key, least, most), out, "Append", "EventTime")
