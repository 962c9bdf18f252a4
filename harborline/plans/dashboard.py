"""Dashboard metrics over the marts.

The dashboards are described in words only; the formulas below are this library's own definitions and
are repeated in the README.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions.exprs import or_zero, ratio
from harborline.plans.marts import MEASURES

SUMS = ["premium_received", "policies_issued", "claims_paid", "claim_count"]
WINDOWS = ["last_7_days", "last_30_days", "week_to_date", "month_to_date"]
AGE_BANDS = [(0, "under 20"), (20, "20-29"), (30, "30-39"), (40, "40-49"), (50, "50-59"), (60, "60 and over")]


def _bounds(as_of: date) -> dict[str, tuple[date, date]]:
    return {
        "last_7_days": (as_of - timedelta(days=6), as_of),
        "last_30_days": (as_of - timedelta(days=29), as_of),
        "week_to_date": (as_of - timedelta(days=as_of.weekday()), as_of),
        "month_to_date": (as_of.replace(day=1), as_of),
    }


def period_summary(days: DataFrame, as_of: date) -> DataFrame:
    """One row per window ending on ``as_of``: sums and loss ratio, and the same a year before.

    Year-ago windows have both ends moved back by twelve months. All windows are summed in one pass.
    """
    windows = []
    for name, (first, last) in _bounds(as_of).items():
        windows += [(name, "now", F.lit(first), F.lit(last)), (name, "ly", *_year_ago(first, last))]
    # one ungrouped aggregate with a sum per window and kind, so a window that nothing falls into has a row too
    names = [f"{c}{suffix}" for suffix in ("", "_ly") for c in SUMS]
    totals = days.agg(*[
        or_zero(F.sum(F.when(F.col("day_date").between(first, last), F.col(c)))).alias(f"{name}.{c}{'_ly' if kind == 'ly' else ''}")
        for name, kind, first, last in windows
        for c in SUMS
    ])
    each = F.array(*[
        F.struct(F.lit(w).alias("window"), *[F.col(f"`{w}.{n}`").alias(n) for n in names]) for w in WINDOWS
    ])
    sums = totals.select(F.explode(each).alias("w")).select("w.*")
    return sums.select(
        "*",
        ratio("claims_paid", "premium_received", 4).alias("loss_ratio"),
        ratio("claims_paid_ly", "premium_received_ly", 4).alias("loss_ratio_ly"),
    )


def _year_ago(first: date, last: date) -> tuple[Column, Column]:
    return F.add_months(F.lit(first), -12), F.add_months(F.lit(last), -12)


def growth(current: str, before: str) -> Column:
    """(current - before) / before in percent, NULL unless there was something before."""
    change = (F.col(current) - F.col(before)) * 100
    return ratio(change, before, 2)


def yoy_table(rollups: DataFrame) -> DataFrame:
    """Quarters and years with the growth of their sums over the year before."""
    return rollups.where(F.col("time_grain").isin("Q", "Y")).select(
        "time_grain", "period_start", *SUMS, *[growth(c, f"{c}_ly").alias(f"{c}_growth_pct") for c in SUMS]
    )


def claims_overview(wide: DataFrame) -> DataFrame:
    """One row. Claim rate: policies with a claim per policy; frequency: claims per claiming policy;
    coverage: payable per billed amount; out of pocket: billed less payable."""
    sums = wide.agg(
        F.count(F.lit(1)).alias("policies"),
        F.count_if(F.col("claim_count") > 0).alias("policies_with_claims"),
        F.sum("claim_count").alias("claims"),
        F.sum("total_billed_amount").alias("billed"),
        F.sum("total_payable_amount").alias("payable"),
    )
    return sums.select(
        "policies", "policies_with_claims", "claims", "billed", "payable",
        (F.col("billed") - F.col("payable")).alias("out_of_pocket"),
        ratio("payable", "billed", 4).alias("coverage_ratio"),
        ratio("policies_with_claims", "policies", 4).alias("claim_rate"),
        ratio("claims", "policies_with_claims", 4).alias("claim_frequency"),
    )


def costliest_policies(wide: DataFrame, k: int = 10) -> DataFrame:
    """The k policies with the largest payable claim total, ties by policy number."""
    return (
        wide.where(F.col("total_payable_amount").isNotNull())
        .orderBy(F.desc("total_payable_amount"), "policy_number")
        .limit(k)
        .select("policy_number", "product", "claim_count", "total_billed_amount", "total_payable_amount")
    )


def product_profit(wide: DataFrame) -> DataFrame:
    """Per product: premium received less payable claims, and payable per premium."""
    sums = wide.groupBy("product").agg(
        or_zero(F.sum("total_pre_levy_amount")).alias("premium"), or_zero(F.sum("total_payable_amount")).alias("payable")
    )
    return sums.select(
        "product", "premium", "payable", (F.col("premium") - F.col("payable")).alias("profit"),
        ratio("payable", "premium", 4).alias("loss_ratio"),
    )


def age_band(born: str, at: Column) -> Column:
    """Age band on a day, in completed years; NULL without a birth date."""
    age = F.floor(F.months_between(at, F.col(born)) / 12)
    band = None
    for low, name in reversed(AGE_BANDS):
        band = F.when(age >= low, name) if band is None else band.when(age >= low, name)
    return band


def age_profile(wide: DataFrame, as_of: date) -> DataFrame:
    """Per age band on ``as_of``: policies, premium, payable claims, loss ratio."""
    sums = wide.groupBy(age_band("insured_date_of_birth", F.lit(as_of)).alias("age_group")).agg(
        F.count(F.lit(1)).alias("policies"),
        or_zero(F.sum("total_pre_levy_amount")).alias("premium"),
        or_zero(F.sum("total_payable_amount")).alias("payable"),
    )
    return sums.select("*", ratio("payable", "premium", 4).alias("loss_ratio"))


def revenue_per_invoice(wide: DataFrame) -> DataFrame:
    """Per product: paid total divided by paid invoices."""
    sums = wide.groupBy("product").agg(
        F.sum("invoice_count").alias("invoices"), or_zero(F.sum("total_amount_paid")).alias("revenue")
    )
    return sums.select("*", ratio("revenue", "invoices", 2).alias("revenue_per_invoice"))


def product_gender(wide: DataFrame, genders: tuple[str, ...] = ("F", "M")) -> DataFrame:
    """Policies per product, one column per gender and one for unknown."""
    cells = [F.count_if(F.col("insured_gender") == g).alias(f"policies_{g.lower()}") for g in genders]
    rest = F.count_if(F.col("insured_gender").isNull() | ~F.col("insured_gender").isin(*genders))
    return wide.groupBy("product").agg(*cells, rest.alias("policies_unknown"))


def alerts(rollups: DataFrame, grain: str = "M", threshold: float = 0.8) -> DataFrame:
    """Periods whose loss ratio lies above the threshold."""
    over = F.col("loss_ratio") > F.lit(str(threshold)).cast("decimal(10,4)")
    return rollups.where((F.col("time_grain") == grain) & over).select("time_grain", "period_start", *MEASURES)
