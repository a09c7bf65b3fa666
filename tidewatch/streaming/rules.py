"""Whole rules on a stream: conditions, datasets, and what needs order, in one query."""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidewatch.operators.evaluate import FirstPass, RuleTerms, _case, _holds, look_ups
from tidewatch.streaming import ordered
from tidewatch.streaming.pipeline import start, write_epoch


def refuse(rule: RuleTerms) -> None:
    """A rule waits for one sequence or one first arrival at most, and for the same one in all its terms: further ones
    would need the result of the first as a stream of its own."""
    order = [*rule.sequences, *rule.arrivals]
    for _, mask in rule.main:
        if order and sum(mask >> s & 1 for s in order) != 1 or len(order) > 1:
            raise ValueError(f"rule {rule.rule['rule_id']}: on a stream a rule is conditions with one sequence or one first arrival")


def stateful_hits(events: DataFrame, rules: list[dict], time: str, tie: str, datasets: DataFrame | None = None, watermark: str = "1 minute") -> DataFrame:
    """Hits of stateless rules and of rules with datasets, a sequence or a first arrival: ``tie``, ``rule_id``, ``time``,
    ``second_time`` (of a sequence's answer), ``late``.

    ``events`` are those of :func:`~tidewatch.operators.match.events_of`, a stream, with ``time`` in microseconds and a
    unique number ``tie``. Datasets are joined as they are when a micro-batch starts: one join per dataset,
    whatever the number of rules. All sequences share one stateful operator and all first arrivals another one. A hit
    that needs order leaves once the watermark has passed it; an event that comes later leaves marked, for each rule
    whose order it missed. A membership, a sequence or an arrival with a missing value is false.
    """
    clocked = ordered.with_clock(events, time, watermark=watermark)
    first = FirstPass(clocked, rules, set())
    for r in first.stateful:
        refuse(r)
    out = [tie, "rule_id", "time", "second_time", "late"]
    plain = lambda rows: rows.select(tie, "rule_id", "time", F.lit(None).cast("bigint").alias("second_time"), F.lit(False).alias("late"))
    if not first.stateful:
        return plain(first.rows)
    rows = _members(first, datasets) if any(r.members for r in first.stateful) else first.rows
    direct = F.col("terms").isNull() | F.exists("terms", lambda m: _holds(m, F.col("_bits")))
    parts = [plain(rows.where(direct))]

    def presented(slot: Column) -> Column:
        own = F.call_function("shiftleft", F.lit(1).cast("bigint"), slot)
        return F.exists("terms", lambda m: (m.bitwiseAND(own) != 0) & _holds(m, F.col("_bits").bitwiseOR(own)))

    if any(r.sequences for r in first.stateful):
        asks = F.filter("firsts", lambda s: presented(s["slot"]))
        ready = F.filter("seconds", lambda s: _holds(s["mask"], F.col("_bits")))
        side = lambda s, is_first: F.struct(s["slot"].alias("slot"), s["key"].alias("key"), s["least"].alias("least"), s["most"].alias("most"), F.lit(is_first).alias("is_first"))
        both = F.concat(F.transform(asks, lambda s: side(s, True)), F.transform(ready, lambda s: side(s, False)))
        sides = rows.select(tie, "rule_id", "time", "_clock", F.inline(both))
        wanted = {r.rule["rule_id"]: f"{sum(1 << s for s, n in r.sequences.items() if n['pattern'] == 'FOLLOWED_BY')}L" for r in first.stateful if r.sequences}
        followed = F.expr(f"(shiftright({_case(wanted, '0L')}, slot) & 1) = 1")
        found = ordered.sequences(sides, ["rule_id", "slot", "key"], tie, F.col("is_first"), ~F.col("is_first"), F.col("least"), F.col("most"), followed)
        parts.append(found.select(*out))
    if any(r.arrivals for r in first.stateful):
        asks = F.filter("arrivals", lambda s: presented(s["slot"]))
        arrived = ordered.periods(rows.select(tie, "rule_id", "time", "_clock", F.inline(asks)), ["rule_id", "slot", "key"], tie, "ttl")
        parts.append(arrived.withColumn("second_time", F.lit(None).cast("bigint")).select(*out))
    return reduce(DataFrame.unionByName, parts)


def _members(first: FirstPass, datasets: DataFrame | None) -> DataFrame:
    """``_bits`` with all memberships. A stream can't be grouped back after an explode, so each dataset is one left join
    (as often as one rule asks the same dataset)."""
    table = look_ups(first.stateful, datasets, None, {}).dropDuplicates(["scope", "key"])
    often: Counter = Counter()
    for r in first.stateful:
        often |= Counter(f"d|{e['dataset_id']}|{e.get('dataset_version') or '*'}" for e in r.members.values())
    rows, found = first.rows, []
    for i, (scope, place) in enumerate((scope, place) for scope, n in sorted(often.items()) for place in range(n)):
        ask = F.get(F.filter("asks", lambda a: a["scope"] == scope), F.lit(place))  # noqa: B023
        members = table.where(F.col("scope") == scope).select(F.col("key").alias(f"_k{i}"), F.lit(True).alias(f"_in{i}"))
        rows = rows.withColumn("_ask", ask).withColumn(f"_k{i}", F.col("_ask.key")).withColumn(f"_no{i}", F.col("_ask.no")).drop("_ask").join(members, f"_k{i}", "left").drop(f"_k{i}")
        found.append(F.when(F.col(f"_in{i}"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(f"_no{i}"))).otherwise(F.lit(0).cast("bigint")))
    matched = reduce(lambda a, b: a.bitwiseOR(b), found)
    return rows.withColumn("_bits", first.member_bits(matched))


def rule_stream(
    events: DataFrame, rules: list[dict], folder: str, time: str, tie: str, datasets: DataFrame | None = None, watermark: str = "1 minute",
    source: Column | None = None, **trigger,
) -> StreamingQuery:
    """Hits to ``folder/hits`` and late rows to ``folder/dlq``, per epoch, with ``folder/late`` counting the late ones by
    rule. The rules are those of the start: a changed catalogue restarts the query from its checkpoint."""

    def work(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            write_epoch(batch.where("NOT late").drop("late"), f"{folder}/hits", epoch)
            write_epoch(ordered.late_letters(batch, source if source is not None else F.col("rule_id"), tie), f"{folder}/dlq", epoch)
            write_epoch(batch.where("late").groupBy("rule_id").agg(F.count("*").alias("n")), f"{folder}/late", epoch)
        finally:
            batch.unpersist()

    return start(stateful_hits(events, rules, time, tie, datasets, watermark), work, f"{folder}/checkpoint", **trigger)
