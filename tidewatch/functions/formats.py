"""Semantic formats a schema can demand of a field, and product classification."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from tidewatch.functions.keys import is_valid_e164
from tidewatch.functions.values import instant

UUID = r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\z"


def matches_format(value_text: Column, fmt: str) -> Column:
    """Whether a text form meets a named format; an unknown name always passes."""
    tests = {
        "ISO-8601": value_text.contains("T") & instant(value_text).isNotNull(),
        "PHONE_E164": is_valid_e164(value_text),
        "UUID": value_text.rlike(UUID),
        "ISO_DATE": value_text.rlike(r"^\d{4}-\d{2}-\d{2}\z") & F.try_to_date(value_text).isNotNull(),
        "EPOCH_MS": value_text.rlike(r"^[0-9]{1,18}\z"),
    }
    return F.coalesce(tests.get(fmt, F.lit(True)), F.lit(False))


# Client codes and message marks of the three products. Marks that carry a
# wallet's brand are the caller's to add (``top_up_marks``, ``payout_marks``).
TRANSFER_CLIENTS = ["NAPAS", "VietQR", "ViCong", "MB", "CITAD", "BIDV"]
TRANSFER_PREFIX = "GD nhan tien"
TRANSFER_MARKS = ["CHL", "Thanh toan PBH", "#TattoanTK"]
TOP_UP_MARKS = ["VTT VTP_REC_"]
PAYOUT_MARKS = ["QUATANGVOUCHER"]


def contains_any(value: Column, marks: list[str]) -> Column:
    return reduce(or_, [value.contains(mark) for mark in marks], F.lit(False))


def classify_product(
    client_code: Column,
    message: Column,
    wallet_code: str = "VTP",
    top_up_marks: list[str] = TOP_UP_MARKS,
    payout_marks: list[str] = PAYOUT_MARKS,
) -> Column:
    """Product of a credit notification: ``nhan_tien``, ``nap_tien``, ``tra_thuong`` or null.

    Transfers are known by the bank's client code; the wallet's own notices by their text.
    """
    own = client_code == wallet_code
    return (
        F.when(client_code.isin(TRANSFER_CLIENTS), "nhan_tien")
        .when(own & (message.startswith(TRANSFER_PREFIX) | contains_any(message, TRANSFER_MARKS)), "nhan_tien")
        .when(own & contains_any(message, top_up_marks), "nap_tien")
        .when(own & contains_any(message, payout_marks), "tra_thuong")
    )
