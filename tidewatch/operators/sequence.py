"""Event order per key: first arrival, cooldown, followed-by and not-followed-by.

Times are whole microseconds. None of these operators gathers a key's history in one place:
a hot key is cut along time (see ``scans``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.operators.scans import asof, ensure_checkpoint_dir

HOUR = 3_600_000_000
# Width of the time slots a key is spread over: a key seen through a month has over 4,000 of them.
SLOT = HOUR // 6
COLD_ROWS = 10_000


def first_arrival(events: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The first event of every key, forever. One aggregate with map-side combine."""
    whole = F.struct(*events.columns)
    return events.dropna(subset=keys).groupBy(*keys).agg(F.min_by(whole, order).alias("_e")).select("_e.*")


def first_arrival_ttl(
    events: DataFrame, keys: list[str], time: str, tie: str, ttl: int | str, cold_rows: int = COLD_ROWS,
) -> DataFrame:
    """Events that open a new period of their key: the first one, then each first one at least
    ``ttl`` microseconds after the last accepted. ``tie`` orders events of one instant.
    ``ttl`` may name a column that is the same for all events of a key.

    Whether an event is accepted depends on the one accepted before it. Keys with at most
    ``cold_rows`` distinct instants are folded in one aggregate each; that bound is what makes
    gathering them safe. The others take :func:`_accepted_of_hot`, which never does.
    """
    if isinstance(ttl, str):
        keys = [*keys, ttl]
    # Of several events at one instant only the first can be accepted.
    instants = (
        events.dropna(subset=[*keys, time])
        .groupBy(*keys, F.col(time).alias("_t"))
        .agg(F.min(tie).cast("bigint").alias("_tie"))
    )
    # Kept, for it is read three times and what it is made from may be a whole rule evaluation.
    ensure_checkpoint_dir(events.sparkSession)
    instants = instants.checkpoint()
    sizes = instants.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_t").alias("_from"), F.max("_t").alias("_to"))
    hot = sizes.where(F.col("_n") > cold_rows)
    length = F.col(ttl) if isinstance(ttl, str) else F.lit(ttl)
    periods = hot.agg(F.max((F.col("_to") - F.col("_from")) / length)).first()[0]

    def fold(rows: DataFrame) -> DataFrame:
        history = F.array_sort(F.collect_list(F.struct("_t", "_tie")))
        empty = F.array().cast("array<struct<_t:bigint,_tie:bigint>>")
        step = lambda acc, e: F.when(
            (F.size(acc) == 0) | (e["_t"] >= F.element_at(acc, -1)["_t"] + length), F.array_append(acc, e)
        ).otherwise(acc)
        kept = rows.groupBy(*keys).agg(history.alias("_h"))
        return kept.select(*keys, F.inline(F.aggregate("_h", empty, step)))

    rows = instants
    if periods is None:
        accepted = fold(rows)
    else:
        hot_keys = hot.select(*keys)
        cold = rows.join(hot_keys, keys, "left_anti")
        accepted = fold(cold).unionByName(_accepted_of_hot(rows.join(hot_keys, keys, "left_semi"), keys, ttl, periods))
    marks = accepted.select(*keys, F.col("_t").alias(time), F.col("_tie").alias(tie))
    return events.join(marks, [*keys, time, tie], "left_semi")


def _accepted_of_hot(rows: DataFrame, keys: list[str], ttl: int | str, periods: float) -> DataFrame:
    """Accepted instants of keys too large to gather.

    Every instant points at the one that would be accepted after it (an as-of join, cut along
    time). The accepted ones are those reached from the key's first instant. With pointers
    doubled each round, a chain of n needs log2(n) rounds, and n is at most the number of ``periods``.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    named = isinstance(ttl, str)
    slot = SLOT if named else max(1, min(ttl // 16, SLOT))
    asks = rows.withColumn("_due", F.col("_t") + (F.col(ttl) if named else F.lit(ttl)))
    pointers = asof(
        asks, rows, keys, "_due", "_t", F.struct("_t", "_tie"), "_next", slot, forward=True, tie=F.col("_tie")
    ).select(*keys, "_t", "_tie", F.col("_next._t").alias("_nt"), F.col("_next._tie").alias("_ntie")).checkpoint()

    first = rows.groupBy(*keys).agg(F.min(F.struct("_t", "_tie")).alias("_f"))
    reached = first.select(*keys, "_f._t", "_f._tie")
    rounds = max(1, math.ceil(math.log2(periods + 2)))
    for i in range(rounds):
        ahead = reached.join(pointers.select(*keys, "_t", "_nt", "_ntie"), [*keys, "_t"])
        ahead = ahead.where("_nt is not null").select(*keys, F.col("_nt").alias("_t"), F.col("_ntie").alias("_tie"))
        reached = reached.unionByName(ahead).checkpoint()
        if i + 1 < rounds:
            target = pointers.select(*keys, F.col("_t").alias("_nt"), F.col("_nt").alias("_nt2"), F.col("_ntie").alias("_ntie2"))
            pointers = (
                pointers.select(*keys, "_t", "_nt")
                .where("_nt is not null")
                .join(target, [*keys, "_nt"])
                .where("_nt2 is not null")
                .select(*keys, "_t", F.col("_nt2").alias("_nt"), F.col("_ntie2").alias("_ntie"))
                .checkpoint()
            )
    return reached.select(*keys, "_t", "_tie")


def cooldown(hits: DataFrame, seconds: dict[str, int], time: str, tie: str, cold_rows: int = COLD_ROWS) -> DataFrame:
    """Hits (``rule_id``, ``partition_key``) without those that fall inside the silence after an emitted
    hit of the same rule and key. ``seconds`` is the silence per rule; without one every hit stays,
    as does a hit without a key. One ordered pass serves all rules, whatever their silence.
    """
    lengths = {rule_id: length for rule_id, length in seconds.items() if length}
    if not lengths:
        return hits
    silence = F.create_map(*[x for rule_id, length in lengths.items() for x in (F.lit(rule_id), F.lit(length * 1_000_000).cast("bigint"))])
    keyed = hits.withColumn("_silence", F.try_element_at(silence, F.col("rule_id")))
    bound = F.col("_silence").isNotNull() & F.col("partition_key").isNotNull()
    ids = keyed.where(bound).select("rule_id", "partition_key", time, tie, "_silence")
    kept = first_arrival_ttl(ids, ["rule_id", "partition_key"], time, tie, "_silence", cold_rows).select("rule_id", tie)
    return keyed.where(~bound).unionByName(keyed.where(bound).join(kept, ["rule_id", tie], "left_semi")).select(*hits.columns)


def _first_answer(
    first: DataFrame, second: DataFrame, on: list[str], time: str, least: int, most: int, slot: int,
) -> DataFrame:
    # An answer comes later than its event, or an event both sides accept would answer itself.
    asks = first.withColumn("_from", F.col(time) + F.lit(max(least, 1)))
    answered = asof(asks, second, on, "_from", time, F.col(time), "second_time", slot, forward=True)
    inside = F.col("second_time") <= F.col(time) + F.lit(most)
    return answered.withColumn("second_time", F.when(inside, F.col("second_time"))).drop("_from")


def followed_by(
    first: DataFrame, second: DataFrame, on: list[str], time: str, least: int, most: int, slot: int = SLOT,
) -> DataFrame:
    """``first`` events answered by a ``second`` event of the same ``on`` values between ``least`` and
    ``most`` microseconds later (one at least), with the time of the earliest answer as ``second_time``.

    The earliest answer is all that is looked for, so no pairs are built inside a key.
    """
    return _first_answer(first, second, on, time, least, most, slot).where("second_time is not null")


def not_followed_by(
    first: DataFrame, second: DataFrame, on: list[str], time: str, least: int, most: int, slot: int = SLOT,
) -> DataFrame:
    """``first`` events with no such answer. An event whose ``on`` value is missing stays out."""
    unanswered = _first_answer(first.dropna(subset=on), second, on, time, least, most, slot).where("second_time is null")
    return unanswered.drop("second_time")
