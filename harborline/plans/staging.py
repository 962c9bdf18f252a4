"""Raw policy, invoice and claim tables to typed, flagged and filtered ones."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.functions.exprs import amount
from harborline.operators.joins import known, known_mostly, lookup

OUTLIER_THRESHOLD = 200


def policies_per_user(policies: DataFrame) -> DataFrame:
    return policies.groupBy("user_id").agg(F.count(F.lit(1)).alias("policy_count"))


def typed_policy(raw: DataFrame) -> DataFrame:
    return raw.select(
        "id",
        "policy_number",
        "user_id",
        "application_id",
        "product",
        F.col("issue_date").cast("timestamp").alias("issue_date"),
        F.col("effective_date").cast("timestamp").alias("effective_date"),
        "insured_gender",
        F.col("insured_date_of_birth").cast("date").alias("insured_date_of_birth"),
    )


def stg_policy(raw: DataFrame, threshold: int = OUTLIER_THRESHOLD) -> DataFrame:
    """Typed policies; is_outlier_user marks users with more than ``threshold`` policies.

    A NULL user is never an outlier. Counting first and joining back keeps a user with most of the rows
    out of a single task, which a window count would not.
    """
    counts = policies_per_user(raw)
    outliers = counts.where(F.col("policy_count") > threshold).select("user_id", F.lit(True).alias("_outlier"))
    joined = lookup(typed_policy(raw), outliers, "user_id", "left")
    return joined.select(
        *[c for c in joined.columns if c != "_outlier"],
        F.coalesce(F.col("_outlier"), F.lit(False)).alias("is_outlier_user"),
    )


def typed_invoice(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Typed invoices. An unreadable amount stops the job, or becomes NULL unless ``strict``."""
    return raw.select(
        "id",
        "invoice_type",
        "policy_number",
        *[F.col(c).cast("timestamp").alias(c) for c in ("coverage_start_date", "coverage_end_date", "due_date")],
        "status",
        amount("pre_levy_amount", strict).alias("pre_levy_amount"),
        amount("total_amount", strict).alias("total_amount"),
        F.col("refund_date").cast("date").alias("refund_date"),
        F.col("charge_date").cast("timestamp").alias("charge_date"),
    )


def stg_invoice(
    raw: DataFrame, raw_policies: DataFrame, strict: bool = True,
    shape: Callable[[DataFrame], DataFrame] | None = None, key: str = "policy_number", mostly_known: bool = False,
) -> DataFrame:
    """Typed invoices of known policies only.

    With ``shape``, ``raw`` holds the rows that raw invoices are computed from, and ``key`` is the policy number
    there. Orphans go first then, so the join moves those rows instead of the typed ones, which are twice as wide;
    the amounts of orphans are not read. ``mostly_known`` looks the keys up first (``known_mostly``), so without
    orphans no invoice moves.
    """
    only = known_mostly if mostly_known else known
    if shape is not None:
        return typed_invoice(shape(only(raw, raw_policies.select(F.col("policy_number").alias(key)), key)), strict)
    return only(typed_invoice(raw, strict), raw_policies.select("policy_number"), "policy_number")


def quarantined(raw: DataFrame, amounts: Sequence[str]) -> DataFrame:
    """The raw rows with an amount that is there but unreadable: what lenient staging sets to NULL."""
    bad = [F.col(c).isNotNull() & amount(c, strict=False).isNull() for c in amounts]
    return raw.where(reduce(lambda a, b: a | b, bad))


def stg_claim(raw: DataFrame, strict: bool = True) -> DataFrame:
    return raw.select(
        "id",
        "type",
        "status",
        "policy_number",
        F.col("submit_date").cast("timestamp").alias("submit_date"),
        F.col("payment_date").cast("timestamp").alias("payment_date"),
        F.col("admission_date").cast("date").alias("admission_date"),
        amount("total_billed_amount", strict).alias("total_billed_amount"),
        amount("total_base_payable_amount", strict).alias("total_base_payable_amount"),
    )


def paid(invoices: DataFrame) -> DataFrame:
    return invoices.where(F.col("status") == "paid")
