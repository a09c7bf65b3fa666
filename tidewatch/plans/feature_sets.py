"""Queries for the feature-set jobs, over the warehouse-like tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import features
from tidewatch.plans import fixtures as fx
from tidewatch.plans.registry import query


@query("etl_latest_status", """SELECT o_custkey AS msisdn FROM (SELECT o_custkey, o_orderstatus,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) x WHERE rn = 1 AND o_orderstatus = 'F'""")
def etl_latest_status(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("msisdn"), "o_orderdate", "o_orderkey", "o_orderstatus")
    return features.latest_with_status(rows, "msisdn", ["o_orderdate", "o_orderkey"], "o_orderstatus", "F")


@query("etl_latest_partition", """WITH o AS (SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y%m') AS partition_month FROM orders)
SELECT o_orderkey, o_custkey, partition_month FROM o WHERE partition_month = (SELECT max(partition_month) FROM o WHERE partition_month <= '199706')""")
def etl_latest_partition(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyyMM").alias("partition_month"))
    return features.latest_partition(rows, "partition_month", F.lit("199706"))


@query("etl_daily_spending", """SELECT user_id, cast(cast(ts AS date) AS string) AS day, sum(cast(round(value * 100) AS bigint)) AS total_cents, count(*) AS trans_count
FROM events WHERE event_type = 'purchase' GROUP BY ALL""")
def etl_daily_spending(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "events").where("event_type = 'purchase'")
    out = features.daily_spending(rows, "user_id", F.to_date("ts").cast("string"), F.round(F.col("value") * 100).cast("bigint"))
    return out.select("user_id", "day", F.col("total_amount").alias("total_cents"), "trans_count")


MAPPING = """SELECT o_orderkey AS cust_map_id, o_custkey % 50 AS sub_id, o_custkey AS msisdn, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS status,
  CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS is_delete, cast(o_orderdate AS date) AS start_date FROM orders"""
SUBSCRIPTION = "SELECT p_partkey AS sub_id, 'VTM' || cast(p_partkey % 6 AS string) AS sub_code FROM part"
POLICY_MAPPING = "SELECT l_orderkey AS cust_map_id, l_suppkey AS policy_id, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS ppm_status FROM lineitem"
POLICY = "SELECT s_suppkey AS policy_id, s_nationkey AS promotion_id FROM supplier"
PROMOTION = "SELECT n_nationkey AS promotion_id FROM nation WHERE n_regionkey = 2"
REQUESTS = "SELECT l_orderkey AS cust_map_id, l_linenumber AS request_type, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS request_status, cast(l_shipdate AS date) AS created_on FROM lineitem"
_REGISTERED = f"""SELECT DISTINCT msisdn, sub_code FROM ({MAPPING}) m JOIN ({SUBSCRIPTION}) s USING (sub_id) JOIN ({POLICY_MAPPING}) pm USING (cust_map_id)
  JOIN ({POLICY}) pp USING (policy_id) JOIN ({PROMOTION}) pr USING (promotion_id) WHERE m.status = 1 AND is_delete = 0 AND ppm_status = 1"""


def registered(spark, sf_dir):
    return features.registered_subscribers(*[fx.view(spark, sf_dir, v) for v in (MAPPING, SUBSCRIPTION, POLICY_MAPPING, POLICY, PROMOTION)])


@query("etl_multi_join", _REGISTERED)
def etl_multi_join(spark, sf_dir):
    return registered(spark, sf_dir)


@query("etl_date_range", f"""SELECT msisdn, sub_code FROM ({REQUESTS}) r JOIN (SELECT *, start_date + 60 AS end_date FROM ({MAPPING}) x) m USING (cust_map_id)
JOIN ({SUBSCRIPTION}) s USING (sub_id) WHERE status = 1 AND is_delete = 0 AND sub_code IN ('VTM1', 'VTM2', 'VTM3', 'VTM4') AND date '1996-06-01' BETWEEN start_date AND end_date""")
def etl_date_range(spark, sf_dir):
    mapping = fx.view(spark, sf_dir, MAPPING).withColumn("end_date", F.date_add("start_date", 60))
    return features.active_packages(
        fx.view(spark, sf_dir, REQUESTS), mapping, fx.view(spark, sf_dir, SUBSCRIPTION), ["VTM1", "VTM2", "VTM3", "VTM4"], F.lit("1996-06-01").cast("date")
    )


@query("etl_renewed", f"""WITH g AS ({_REGISTERED}) SELECT msisdn, sub_code FROM g WHERE EXISTS (SELECT 1 FROM ({REQUESTS}) r JOIN ({MAPPING}) m USING (cust_map_id) JOIN ({SUBSCRIPTION}) s USING (sub_id)
WHERE m.msisdn = g.msisdn AND s.sub_code = g.sub_code AND request_type IN (1, 2) AND request_status = 1 AND created_on BETWEEN date '1996-01-01' AND date '1996-12-31')""")
def etl_renewed(spark, sf_dir):
    mapping, subscription = fx.view(spark, sf_dir, MAPPING), fx.view(spark, sf_dir, SUBSCRIPTION)
    requests = fx.view(spark, sf_dir, REQUESTS).join(mapping.select("cust_map_id", "sub_id", "msisdn"), "cust_map_id").join(subscription, "sub_id")
    day = lambda d: F.lit(d).cast("date")
    return features.renewed_subscribers(registered(spark, sf_dir), requests, day("1996-01-01"), day("1996-12-31"))


INSERTS = "SELECT l_orderkey * 10 + l_linenumber AS id, l_returnflag AS status, l_linestatus AS error_code, l_suppkey AS shop FROM lineitem"
UPDATES = "SELECT l_orderkey * 10 + 1 + l_partkey % 3 AS id, l_partkey AS changed, CASE WHEN l_partkey % 4 <> 0 THEN 'S' END AS status, CASE WHEN l_partkey % 5 = 0 THEN '00' END AS error_code FROM lineitem WHERE l_partkey % 7 = 0"


@query("corrections", f"""WITH u AS (SELECT id, arg_max(struct_pack(s := status, e := error_code), changed) AS u FROM ({UPDATES}) x GROUP BY id)
SELECT i.id, coalesce(u.u.s, status) AS status, coalesce(u.u.e, error_code) AS error_code, shop, u.id IS NOT NULL AS corrected FROM ({INSERTS}) i LEFT JOIN u ON u.id = i.id""")
def corrections(spark, sf_dir):
    return features.apply_corrections(fx.view(spark, sf_dir, INSERTS), fx.view(spark, sf_dir, UPDATES), "id", "changed")
