"""Entity profiles kept by batch events, and their use from stream events.

A profile is long: one row per (key, dataset, field). Input is the valid output of
``validate.check_batch``, whose anti-stale level lets snapshot times of a dataset only rise
in arrival order, so within one key they rise as well and no row has to be refused here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewatch.functions.values import text
from tidewatch.operators.scans import asof
from tidewatch.operators.scans import ensure_checkpoint_dir

PROFILE_TTL_MS = 36 * 3600 * 1000
HOUR = 3_600_000_000


def profile_delta(valid: DataFrame, order: str = "seq") -> DataFrame:
    """What a set of batch events does to profiles, one row per (key, dataset, field) written plus one per
    (key, dataset) touched (``field`` null) with its last reset and last batch.

    One aggregate with map-side combine, so a hot key costs one combined row per task, and deltas
    merge with each other in any grouping.
    """
    held = F.col("sync_mode") != "DELETE"
    entry = "map<string,variant>"
    fields = F.transform(
        F.map_entries(F.when(held, F.from_json(F.to_json("data"), entry))),
        lambda e: F.struct(e["key"].alias("field"), text(e["value"]).alias("value")),
    )
    touch = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("value")))
    events = valid.select(
        "key_value", "dataset_name", F.col(order).alias("written"),
        F.when(F.col("sync_mode").isin("FULL_SNAPSHOT", "DELETE"), F.col(order)).alias("reset"),
        F.when(held, F.col(order)).alias("held"),
        "batch_id", "snapshot_ms", F.col("batch_id").alias("last_batch"), F.col("snapshot_ms").alias("last_ms"),
        F.inline(F.concat(touch, F.coalesce(fields, F.array().cast("array<struct<field:string,value:string>>")))),
    )
    return merge_deltas(events)


def merge_deltas(deltas: DataFrame) -> DataFrame:
    """Several deltas as one."""
    keys = ["key_value", "dataset_name", "field"]
    return deltas.groupBy(*keys).agg(
        F.max_by("value", "written").alias("value"),
        F.max("written").alias("written"),
        F.max("reset").alias("reset"),
        F.max("held").alias("held"),
        F.max_by("batch_id", "held").alias("batch_id"),
        F.max_by("snapshot_ms", "held").alias("snapshot_ms"),
        F.max_by("last_batch", "written").alias("last_batch"),
        F.max_by("last_ms", "written").alias("last_ms"),
    )


def profile_of(delta: DataFrame) -> DataFrame:
    """The profile a merged delta amounts to: a field's last write, unless the key's dataset was replaced
    or deleted after it. ``batch_id`` and ``snapshot_ms`` are those of the dataset's last event, ``field_ms`` is the
    snapshot time of the field's own last write. The window holds one row per field of the key's dataset."""
    whole = W.partitionBy("key_value", "dataset_name")
    touched = F.col("field").isNull()
    of_dataset = {c: F.max(F.when(touched, F.col(c))).over(whole) for c in ("reset", "batch_id", "snapshot_ms")}
    return (
        delta.select("key_value", "dataset_name", "field", "value", "written", F.col("snapshot_ms").alias("field_ms"), *[c.alias(n) for n, c in of_dataset.items()])
        .where("field is not null and (reset is null or written >= reset)")
        .drop("written", "reset")
    )


def fold_profile(valid: DataFrame, order: str = "seq") -> DataFrame:
    """The profile after all events: a FULL_SNAPSHOT replaces the dataset's fields, an UPSERT patches
    them, a DELETE removes them."""
    return profile_of(profile_delta(valid, order))


def membership(valid: DataFrame, order: str = "seq") -> DataFrame:
    """Keys present in each dataset after all events, also those without any field (pure key sets)."""
    keys = ["key_value", "dataset_name"]
    last = valid.groupBy(*keys).agg(
        F.max_by(F.struct("sync_mode", "batch_id", "snapshot_ms"), order).alias("_l")
    )
    return last.where("_l.sync_mode <> 'DELETE'").select(*keys, "_l.batch_id", "_l.snapshot_ms")


def unexpired(profile: DataFrame, as_of_ms: Column, ttl_ms: int = PROFILE_TTL_MS) -> DataFrame:
    """Profile rows whose field was itself written less than ``ttl_ms`` before ``as_of_ms``."""
    return profile.where(as_of_ms - F.col("field_ms") < ttl_ms)


def active_batches(valid: DataFrame, order: str = "seq") -> DataFrame:
    """The batch that counts for each dataset: the one of its latest snapshot."""
    newest = F.max_by("batch_id", F.struct(F.col("snapshot_ms"), F.col(order)))
    return valid.groupBy("dataset_name").agg(newest.alias("active_batch_id"))


def active_of(delta: DataFrame) -> DataFrame:
    """As :func:`active_batches`, from a merged delta."""
    newest = F.max_by("last_batch", F.struct("last_ms", "written"))
    return delta.where("field is null").groupBy("dataset_name").agg(newest.alias("active_batch_id"))


def current_profile(valid: DataFrame, order: str = "seq") -> DataFrame:
    """The profile of each dataset's active batch. The delta, one row per entity field, is kept, so the
    events are validated one time for both the profile and the active batches."""
    ensure_checkpoint_dir(valid.sparkSession)
    delta = profile_delta(valid, order).checkpoint()
    return guard_epoch(profile_of(delta), active_of(delta))


def guard_epoch(profile: DataFrame, active: DataFrame) -> DataFrame:
    """Profile rows of each dataset's active batch; a key left out of the latest batch has no profile."""
    return profile.join(active, "dataset_name").where("batch_id = active_batch_id").drop("active_batch_id")


def profile_columns(profile: DataFrame, wanted: list[tuple[str, str]]) -> tuple[DataFrame, dict[str, str]]:
    """One row per key with a column per wanted (dataset, field), and the column of each ``dataset.field``."""
    names = {f"{d}.{f}": f"_p{i}" for i, (d, f) in enumerate(wanted)}
    picked = [
        F.first(F.when((F.col("dataset_name") == d) & (F.col("field") == f), F.col("value")), ignorenulls=True).alias(f"_p{i}")
        for i, (d, f) in enumerate(wanted)
    ]
    asked = F.struct("dataset_name", "field").isin([F.struct(F.lit(d).alias("dataset_name"), F.lit(f).alias("field")) for d, f in wanted])
    return profile.where(asked).groupBy("key_value").agg(*picked), names


def enrich(events: DataFrame, key: str, profile: DataFrame, wanted: list[tuple[str, str]]) -> tuple[DataFrame, dict[str, str]]:
    """Events with the wanted profile fields of their key, null where the profile has none."""
    wide, names = profile_columns(profile, wanted)
    return events.join(wide.withColumnRenamed("key_value", key), key, "left"), names


def enrich_asof(
    events: DataFrame, key: str, time: str, snapshots: DataFrame, snapshot_time: str, payload: Column, out: str,
    order: str = "seq",
) -> DataFrame:
    """Replay form: each event sees the latest snapshot of its key at or before its own time."""
    keyed = snapshots.withColumnRenamed("key_value", key) if key != "key_value" else snapshots
    return asof(events, keyed, [key], time, snapshot_time, payload, out, HOUR, tie=F.col(order))
