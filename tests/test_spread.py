"""What parses and matches every event is not bound to the tasks of the scan."""

from pyspark.sql import functions as F

from tests.test_rules import c, rule
from tidewatch.operators.evaluate import hits_of
from tidewatch.operators.match import events_of
from tidewatch.plans.registry import spread

SCHEMA = "seq bigint, source string, payload string, t bigint"


def test_rows_of_one_task_are_dealt_to_all(spark):
    rows = spread(spark.range(0, 1000, 1, 1).withColumnRenamed("id", "seq"), "seq")
    assert rows.groupBy(F.spark_partition_id()).count().count() == 8 and rows.agg(F.sum("seq")).first()[0] == 499_500


def test_hits_carry_only_wanted_columns(spark):
    first = {"type": "CONDITION", "expression": {"op": "IS_FIRST_ARRIVAL", "key_fields": ["k"], "ttl": "9s"}}
    rows = [(i, "S", f'{{"k": "a", "x": {i}}}', i * 5_000_000) for i in range(4)]
    hits = hits_of(events_of(spark.createDataFrame(rows, SCHEMA)), [rule("r", [[c("x", ">", 0)]], tree=first)], "t", "seq", columns=["seq"])
    assert sorted(hits.columns) == ["partition_key", "rule_id", "seq", "t"] and sorted(r.seq for r in hits.collect()) == [1, 3]
