"""Feature-set jobs that feed the batch side: joins and aggregates over warehouse tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def latest_with_status(rows: DataFrame, key: str, updated: list[str], status: str, wanted) -> DataFrame:
    """Keys whose latest row (by ``updated``, then its tie-breakers) has the wanted status."""
    last = rows.groupBy(key).agg(F.max_by(status, F.struct(*updated)).alias(status))
    return last.where(F.col(status) == wanted).select(key)


def latest_partition(rows: DataFrame, partition: str, not_after: Column) -> DataFrame:
    """Rows of the newest partition not after a date. The partition value is a scalar subquery, so on a
    partitioned table only that partition is read."""
    newest = rows.where(F.col(partition) <= not_after).agg(F.max(partition)).scalar()
    return rows.where(F.col(partition) == newest)


def daily_spending(rows: DataFrame, key: str, day: Column, amount: Column) -> DataFrame:
    """Total amount and number of transactions per key and day."""
    return rows.groupBy(key, day.alias("day")).agg(F.sum(amount).alias("total_amount"), F.count("*").alias("trans_count"))


def registered_subscribers(
    mapping: DataFrame, subscription: DataFrame, policy_mapping: DataFrame, policy: DataFrame, promotion: DataFrame,
) -> DataFrame:
    """Distinct (msisdn, sub_code) of live mappings that hold an active promotion policy.

    Expects ``cust_map_id, sub_id, msisdn, status, is_delete`` / ``sub_id, sub_code`` /
    ``cust_map_id, policy_id, ppm_status`` / ``policy_id, promotion_id`` / ``promotion_id``.
    """
    return (
        mapping.where("status = 1 and is_delete = 0")
        .join(subscription, "sub_id")
        .join(policy_mapping.where("ppm_status = 1"), "cust_map_id")
        .join(policy, "policy_id")
        .join(promotion, "promotion_id")
        .select("msisdn", "sub_code")
        .distinct()
    )


def active_packages(
    requests: DataFrame, mapping: DataFrame, subscription: DataFrame, codes: list[str], day: Column,
) -> DataFrame:
    """(msisdn, sub_code) of ordered packages in force on ``day``."""
    live = mapping.where("status = 1 and is_delete = 0").where(day.between(F.col("start_date"), F.col("end_date")))
    return (
        requests.join(live, "cust_map_id")
        .join(subscription.where(F.col("sub_code").isin(codes)), "sub_id")
        .select("msisdn", "sub_code")
    )


def renewed_subscribers(registered: DataFrame, requests: DataFrame, since: Column, until: Column) -> DataFrame:
    """Registered pairs with a successful renewal request (type 1 or 2) created in the date range.

    Only existence matters, so the requests are a semi join.
    """
    renewals = requests.where("request_type in (1, 2) and request_status = 1").where(F.col("created_on").between(since, until))
    return registered.join(renewals, ["msisdn", "sub_code"], "left_semi")


def apply_corrections(inserts: DataFrame, updates: DataFrame, key: str, order: str) -> DataFrame:
    """Inserted rows with the latest correction of each: a corrected field wins where it is present."""
    fields = [c for c in updates.columns if c not in (key, order)]
    last = updates.groupBy(key).agg(F.max_by(F.struct(*fields), order).alias("_u"))
    merged = inserts.join(last, key, "left")
    return merged.select(
        *[F.coalesce(F.col("_u")[c], F.col(c)).alias(c) if c in fields else F.col(c) for c in inserts.columns],
        F.col("_u").isNotNull().alias("corrected"),
    )
