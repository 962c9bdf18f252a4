"""Business marts over staged policies, invoices and claims.

Frames taken by the marts: ``policies`` is stg_policy, ``claims`` is stg_claim, and ``invoices`` is any
typed invoice frame. Orphan invoices need not be removed first: every mart joins invoices to policies,
which drops them. policy_number is unique in ``policies`` (the build checks it).

Measures are computed from small pieces: invoices are summed per (policy, period) before they meet the
policy, so a policy with very many invoices reaches the join as one row per period, and a payer is
counted by adding ones instead of by a distinct count over all invoices.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions.exprs import EXACT, QUOTIENT, label, or_zero, period_start, ratio
from harborline.operators.joins import lookup, with_last_year
from harborline.plans.staging import paid

MEASURES = [
    "premium_received",
    "policies_issued",
    "claims_paid",
    "claim_count",
    "loss_ratio",
    "avg_premium_per_policy",
    "avg_claim_amount",
]
# Totals are added up as long; only the published column is a 32-bit number.
COUNTS = ["policies_issued", "claim_count"]
ROLLUP_GRAINS = ["D", "W", "M", "Q", "Y"]
YEAR_AGO_GRAINS = ["M", "Q", "Y"]


def regular_policies(policies: DataFrame) -> DataFrame:
    return policies.where(~F.col("is_outlier_user"))


# Measure rows: pieces that only need adding up per period (and product).


def premium_rows(
    invoices: DataFrame, policies: DataFrame, grain: str, period: str, by: Sequence[str] = (), undated: bool = False
) -> DataFrame:
    """One row per (period, regular policy) with a paid invoice: the premium, and a one for the payer."""
    rows = paid(invoices).select(
        period_start("charge_date", grain).alias(period), "policy_number", "pre_levy_amount"
    )
    if not undated:
        rows = rows.where(F.col(period).isNotNull())
    per_policy = rows.groupBy(period, "policy_number").agg(F.sum("pre_levy_amount").alias("premium_received"))
    holders = regular_policies(policies).select("policy_number", *by)
    return per_policy.join(holders, "policy_number").select(
        period, *by, "premium_received", F.lit(1).alias("policies_with_payment")
    )


def issued_rows(policies: DataFrame, grain: str, period: str, by: Sequence[str] = ()) -> DataFrame:
    return regular_policies(policies).select(
        period_start("effective_date", grain).alias(period), *by, F.lit(1).alias("policies_issued")
    )


def claim_rows(claims: DataFrame, grain: str, period: str, policies: DataFrame | None = None) -> DataFrame:
    """Paid claims, of outlier users too; with ``policies`` each takes the product of its policy."""
    rows = claims.where((F.col("status") == "paid") & F.col("payment_date").isNotNull()).select(
        period_start("payment_date", grain).alias(period), "policy_number", "total_base_payable_amount"
    )
    if policies is None:
        return rows.select(
            period, F.col("total_base_payable_amount").alias("claims_paid"), F.lit(1).alias("claim_count")
        )
    per_policy = rows.groupBy(period, "policy_number").agg(
        F.sum("total_base_payable_amount").alias("claims_paid"), F.count(F.lit(1)).alias("claim_count")
    )
    products = policies.select("policy_number", "product")
    return per_policy.join(products, "policy_number").select(period, "product", "claims_paid", "claim_count")


def premium_by(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum("policies_with_payment").cast("int").alias("policies_with_payment"),
        F.round(F.sum("premium_received"), 2).alias("premium_received"),
    )


def issued_by(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("policies_issued").cast("int").alias("policies_issued"))


def claims_by(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum("claim_count").cast("int").alias("claim_count"), F.round(F.sum("claims_paid"), 2).alias("claims_paid")
    )


def combine(keys: Sequence[str], *pieces: DataFrame) -> DataFrame:
    """Add up measure rows per key and derive the ratios.

    One aggregation over the union of the pieces stands for a spine of keys left-joined to each
    measure. As in that join, a key with a NULL part has a row but matches nothing: zeros, NULL ratios.
    """
    complete = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pieces)

    def total(c: str) -> Column:
        return or_zero(F.sum(F.when(complete, F.col(c))))

    sums = stacked.groupBy(*keys).agg(
        F.round(total("premium_received"), 2).alias("premium_received"),
        total("policies_with_payment").alias("policies_with_payment"),
        total("policies_issued").alias("policies_issued"),
        F.round(total("claims_paid"), 2).alias("claims_paid"),
        total("claim_count").alias("claim_count"),
    )
    return sums.select(
        *keys,
        "premium_received",
        F.col("policies_issued").cast("int").alias("policies_issued"),
        "claims_paid",
        F.col("claim_count").cast("int").alias("claim_count"),
        ratio("claims_paid", "premium_received", 4).alias("loss_ratio"),
        ratio("premium_received", "policies_with_payment", 2, need_positive_num=True).alias("avg_premium_per_policy"),
        ratio("claims_paid", "claim_count", 2, need_positive_num=True).alias("avg_claim_amount"),
    )


def daily(policies: DataFrame, invoices: DataFrame, claims: DataFrame) -> DataFrame:
    """One row per day. Premium and issued policies leave out outlier users; claims do not."""
    return combine(
        ["day_date"],
        premium_rows(invoices, policies, "D", "day_date"),
        issued_rows(policies, "D", "day_date"),
        claim_rows(claims, "D", "day_date"),
    )


def monthly(policies: DataFrame, invoices: DataFrame, claims: DataFrame) -> DataFrame:
    """One row per month. Paid invoices without a charge date add a NULL month that holds only zeros."""
    return combine(
        ["month_start"],
        premium_rows(invoices, policies, "M", "month_start", undated=True),
        issued_rows(policies, "M", "month_start"),
        claim_rows(claims, "M", "month_start"),
    )


def by_product(policies: DataFrame, invoices: DataFrame, claims: DataFrame) -> DataFrame:
    """One row per (month, product), with the same month of the year before."""
    current = combine(
        ["month_start", "product"],
        premium_rows(invoices, policies, "M", "month_start", by=["product"]),
        issued_rows(policies, "M", "month_start", by=["product"]),
        claim_rows(claims, "M", "month_start", policies=policies),
    )
    return with_last_year(current, "month_start", ["product"], MEASURES, always_dated=True)


def regrain(days: DataFrame, grains: Sequence[str] = ROLLUP_GRAINS) -> DataFrame:
    """The daily mart added up to each grain, in one pass over it.

    Coarser grains recompute their ratios from the sums, the average premium over policies *issued*;
    the day grain keeps the daily ratios, whose average premium is over policies with a payment.
    """
    placed = days.select(
        F.explode(
            F.array(*[
                F.struct(F.lit(g).alias("time_grain"), period_start("day_date", g).alias("period_start"))
                for g in grains
            ])
        ).alias("at"),
        *MEASURES,
    ).select("at.*", *MEASURES)
    own = [m for m in MEASURES if m.startswith(("loss", "avg"))]
    sums = placed.groupBy("time_grain", "period_start").agg(
        F.sum("premium_received").alias("premium_received"),
        F.sum("policies_issued").alias("policies_issued"),
        F.sum("claims_paid").alias("claims_paid"),
        F.sum("claim_count").alias("claim_count"),
        *[F.max(F.when(F.col("time_grain") == "D", F.col(m))).alias(f"_{m}") for m in own],
    )
    fresh = {
        "loss_ratio": ratio("claims_paid", "premium_received", 4),
        "avg_premium_per_policy": ratio("premium_received", "policies_issued", 2),
        "avg_claim_amount": ratio("claims_paid", "claim_count", 2),
    }
    is_day = F.col("time_grain") == "D"
    return sums.select(
        "time_grain",
        "period_start",
        *[F.col(m).cast("int").alias(m) if m in COUNTS else m for m in MEASURES if m not in own],
        *[F.when(is_day, F.col(f"_{m}")).otherwise(fresh[m]).alias(m) for m in own],
    )


def rollups(days: DataFrame) -> DataFrame:
    """Day, week, month, quarter and year rows; the latter three with the same period a year before."""
    lends = F.col("time_grain").isin(YEAR_AGO_GRAINS)
    return with_last_year(regrain(days), "period_start", ["time_grain"], MEASURES, only=lends)


def new_policies(policies: DataFrame) -> DataFrame:
    """policy_number, is_outlier_user and is_new_policy of staged policies, without ranking anybody's policies.

    Only the first rank matters here, and a minimum is an aggregate: it combines before the shuffle
    where a window would sort all policies of a user in one task.
    """
    position = F.struct(F.col("effective_date").isNull(), F.col("effective_date"), F.col("policy_number"), F.col("id"))
    users = policies.groupBy("user_id").agg(F.min(position).alias("first"))
    rows = policies.select("user_id", "id", "policy_number", "is_outlier_user")
    return lookup(rows, users, "user_id", "left", nulls_match=True).select(
        "policy_number",
        "is_outlier_user",
        (F.col("policy_number").eqNullSafe(F.col("first.policy_number")) & F.col("id").eqNullSafe(F.col("first.id")))
        .alias("is_new_policy"),
    )


def new_vs_returning(invoices: DataFrame, marked: DataFrame) -> DataFrame:
    """Premium per policy, compared between users' first and later policies.

    ``marked`` has policy_number, is_outlier_user and is_new_policy: from new_policies or rank_policies.
    """
    per_policy = paid(invoices).groupBy("policy_number").agg(F.sum("pre_levy_amount").alias("premium"))
    flags = regular_policies(marked).select("policy_number", "is_new_policy")
    average = (F.sum("premium").cast(EXACT) / F.count("premium")).cast(QUOTIENT)
    return (
        per_policy.join(flags, "policy_number")
        .groupBy("is_new_policy")
        .agg(
            F.count(F.lit(1)).cast("int").alias("policy_count"),
            F.round(average, 2).alias("avg_net_premium"),
            F.round(F.sum("premium"), 2).alias("total_net_premium"),
        )
        .orderBy(F.desc("is_new_policy"))
        .select(
            label("is_new_policy", "new", "returning").alias("policy_type"),
            "policy_count",
            "avg_net_premium",
            "total_net_premium",
        )
    )


def invoice_totals(invoices: DataFrame) -> DataFrame:
    """Paid invoices per policy."""
    return paid(invoices).groupBy("policy_number").agg(
        F.count(F.lit(1)).cast("int").alias("invoice_count"),
        F.round(F.sum("pre_levy_amount"), 2).alias("total_pre_levy_amount"),
        F.round(F.sum("total_amount"), 2).alias("total_amount_paid"),
    )


def claim_totals(claims: DataFrame) -> DataFrame:
    """Claims per policy, of every status."""
    return claims.groupBy("policy_number").agg(
        F.count(F.lit(1)).cast("int").alias("claim_count"),
        F.round(F.sum("total_billed_amount"), 2).alias("total_billed_amount"),
        F.round(F.sum("total_base_payable_amount"), 2).alias("total_payable_amount"),
    )


def policy_wide(policies: DataFrame, invoices: DataFrame, claims: DataFrame) -> DataFrame:
    """One row per policy. Missing counts become 0; missing amounts stay NULL."""
    return (
        policies.join(invoice_totals(invoices), "policy_number", "left")
        .join(claim_totals(claims), "policy_number", "left")
        .select(
            "policy_number",
            "user_id",
            "product",
            "issue_date",
            "effective_date",
            "insured_gender",
            "insured_date_of_birth",
            "is_outlier_user",
            or_zero("invoice_count").alias("invoice_count"),
            "total_pre_levy_amount",
            "total_amount_paid",
            or_zero("claim_count").alias("claim_count"),
            "total_billed_amount",
            "total_payable_amount",
        )
    )
