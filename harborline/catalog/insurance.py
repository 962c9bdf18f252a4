"""Staging, joins, aggregates and marts of the insurance domain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline import domain
from harborline.catalog.registry import query
from harborline.catalog.sqltext import THRESHOLD, VALUES, dbl, div, dt, sql, ts
from harborline.functions.exprs import label
from harborline.operators import profile
from harborline.operators.joins import known, lookup, on_spine, orphans, with_last_year
from harborline.operators.ranking import rank_policies
from harborline.plans import marts, staging

POLICY_SQL = f"""id, policy_number, user_id, application_id, product, {ts('issue_date')} AS issue_date,
  {ts('effective_date')} AS effective_date, insured_gender, {dt('insured_date_of_birth')} AS insured_date_of_birth"""
INVOICE_SQL = f"""id, invoice_type, policy_number, {ts('coverage_start_date')} AS coverage_start_date,
  {ts('coverage_end_date')} AS coverage_end_date, {ts('due_date')} AS due_date, status,
  {dbl('pre_levy_amount')} AS pre_levy_amount, {dbl('total_amount')} AS total_amount,
  {dt('refund_date')} AS refund_date, {ts('charge_date')} AS charge_date"""
CLAIM_SQL = f"""id, type, status, policy_number, {ts('submit_date')} AS submit_date,
  {ts('payment_date')} AS payment_date, {dt('admission_date')} AS admission_date,
  {dbl('total_billed_amount')} AS total_billed_amount,
  {dbl('total_base_payable_amount')} AS total_base_payable_amount"""


def policies(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_policy(domain.raw_policy(spark, sf), THRESHOLD)


def invoices(spark: SparkSession, sf: str) -> DataFrame:
    return staging.typed_invoice(domain.raw_invoice(spark, sf))


def confirmed_invoices(spark: SparkSession, sf: str) -> DataFrame:
    """Staged invoices of the confirmed policies: a third of all lines are orphans here."""
    lines = domain.table(spark, sf, "lineitem")
    return staging.stg_invoice(lines, domain.confirmed_policy(spark, sf), shape=domain.invoices_of, key="l_orderkey")


def claims(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_claim(domain.raw_claim(spark, sf))


def ranked(spark: SparkSession, sf: str) -> DataFrame:
    return rank_policies(policies(spark, sf))


def inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return policies(spark, sf), invoices(spark, sf), claims(spark, sf)


# Staging


@query("p3_stg_policy", sql(f"SELECT {POLICY_SQL}, is_outlier_user FROM stg_policy"))
def p3(spark, sf):
    return policies(spark, sf)


@query("p4_stg_invoice", sql(f"SELECT {INVOICE_SQL} FROM raw_invoice JOIN confirmed_policy USING (policy_number)"))
def p4(spark, sf):
    return confirmed_invoices(spark, sf)


@query("p5_stg_claim", sql(f"SELECT {CLAIM_SQL} FROM raw_claim"))
def p5(spark, sf):
    return claims(spark, sf)


@query("p6_paid_invoices", sql(
    f"SELECT {INVOICE_SQL} FROM raw_invoice JOIN confirmed_policy USING (policy_number) WHERE status = 'paid'"
))
def p6(spark, sf):
    return staging.paid(confirmed_invoices(spark, sf))


@query("p15_boolean_and_null", sql(
    f"SELECT policy_number, user_id FROM stg_policy WHERE NOT is_outlier_user AND insured_gender IS NULL"
))
def p15(spark, sf):
    return policies(spark, sf).where(~F.col("is_outlier_user") & F.col("insured_gender").isNull()).select(
        "policy_number", "user_id"
    )


@query("p17_flag_label", sql("""
SELECT policy_number, CASE policy_rank WHEN 1 THEN 'new' ELSE 'returning' END AS policy_type FROM ranked"""))
def p17(spark, sf):
    return ranked(spark, sf).select("policy_number", label("is_new_policy", "new", "returning").alias("policy_type"))


@query("p18_comparison_column", sql("SELECT policy_number, policy_rank = 1 AS is_new_policy FROM ranked"))
def p18(spark, sf):
    return ranked(spark, sf).select("policy_number", "is_new_policy")


@query("w1_policy_rank", sql("""
SELECT policy_number, user_id, CAST(policy_rank AS INTEGER) AS policy_rank, policy_rank = 1 AS is_new_policy
FROM ranked"""))
def w1(spark, sf):
    return ranked(spark, sf).select("policy_number", "user_id", "policy_rank", "is_new_policy")


# Joins


@query("j3_known_policies", sql("SELECT id, policy_number FROM raw_invoice WHERE policy_number IN (FROM confirmed_policy)"))
def j3(spark, sf):
    rows = domain.raw_invoice(spark, sf).select("id", "policy_number")
    return known(rows, domain.confirmed_policy(spark, sf), "policy_number")


@query("j4_count_joined_back", sql("""
SELECT policy_number, user_id, count(*) OVER (PARTITION BY user_id) AS policy_count FROM raw_policy"""))
def j4(spark, sf):
    raw = domain.raw_policy(spark, sf).select("policy_number", "user_id")
    return lookup(raw, staging.policies_per_user(raw), "user_id", "left")


@query("j5_invoice_to_ranked_policy", sql(f"""
SELECT i.id, i.policy_number, {dbl('i.pre_levy_amount')} AS pre_levy_amount, CAST(policy_rank AS INTEGER) AS policy_rank
FROM paid_invoice i JOIN ranked r ON i.policy_number = r.policy_number WHERE NOT is_outlier_user"""))
def j5(spark, sf):
    regular = marts.regular_policies(policies(spark, sf))
    ranks = rank_policies(regular).select("policy_number", "policy_rank")
    paid = staging.paid(invoices(spark, sf)).select("id", "policy_number", "pre_levy_amount")
    return lookup(paid, ranks, "policy_number", "inner")


@query("j6_key_selfjoin", sql(f"""
SELECT {dt('CAST(p.effective_date AS DATE)')} AS day_date, CAST(count(*) AS INTEGER) AS policies_issued
FROM stg_policy p JOIN ranked r ON p.policy_number = r.policy_number WHERE NOT r.is_outlier_user GROUP BY 1"""))
def j6(spark, sf):
    # the flag already is on the policy and the key is unique: the self-join is left out
    return marts.issued_by(marts.issued_rows(policies(spark, sf), "D", "day_date"), ["day_date"])


@query("j7_orphans", sql("""
SELECT id, i.policy_number FROM raw_invoice i LEFT JOIN confirmed_policy p ON i.policy_number = p.policy_number
WHERE p.policy_number IS NULL"""))
def j7(spark, sf):
    rows = domain.raw_invoice(spark, sf).select("id", "policy_number")
    return orphans(rows, domain.confirmed_policy(spark, sf), "policy_number")


def _three(spark, sf, grain, period, by=()):
    p, i, c = inputs(spark, sf)
    keys = [period, *by]
    return (
        marts.premium_by(marts.premium_rows(i, p, grain, period, by, undated=grain == "M" and not by), keys),
        marts.issued_by(marts.issued_rows(p, grain, period, by), keys),
        marts.claims_by(marts.claim_rows(c, grain, period, p if by else None), keys),
    )


SPINE_SQL = f"""
  CAST(payers AS INTEGER) AS policies_with_payment, {dbl('premium')} AS premium_received,
  CAST(issued AS INTEGER) AS policies_issued, CAST(claims AS INTEGER) AS claim_count, {dbl('paid')} AS claims_paid"""


@query("j8_spine_by_month", sql(f"""
SELECT {dt('s.k')} AS month_start, {SPINE_SQL}
FROM (SELECT k FROM monthly_premium UNION SELECT k FROM monthly_issued UNION SELECT k FROM monthly_claims) s
LEFT JOIN monthly_premium a ON s.k = a.k LEFT JOIN monthly_issued b ON s.k = b.k LEFT JOIN monthly_claims c ON s.k = c.k
"""))
def j8(spark, sf):
    return on_spine(["month_start"], *_three(spark, sf, "M", "month_start"))


@query("j9_spine_by_month_product", sql(f"""
SELECT {dt('s.k')} AS month_start, s.product, {SPINE_SQL}
FROM (SELECT k, product FROM product_premium UNION SELECT k, product FROM product_issued
  UNION SELECT k, product FROM product_claims) s
LEFT JOIN product_premium a ON s.k = a.k AND s.product = a.product
LEFT JOIN product_issued b ON s.k = b.k AND s.product = b.product
LEFT JOIN product_claims c ON s.k = c.k AND s.product = c.product"""))
def j9(spark, sf):
    return on_spine(["month_start", "product"], *_three(spark, sf, "M", "month_start", ["product"]))


@query("j10_preaggregates_to_base", sql(f"""
SELECT p.policy_number, i.invoice_count, {dbl('i.total_amount_paid')} AS total_amount_paid, c.claim_count,
  {dbl('c.total_payable_amount')} AS total_payable_amount
FROM raw_policy p LEFT JOIN invoice_totals i USING (policy_number) LEFT JOIN claim_totals c USING (policy_number)"""))
def j10(spark, sf):
    base = domain.raw_policy(spark, sf).select("policy_number")
    paid = marts.invoice_totals(invoices(spark, sf)).select(
        "policy_number", F.col("invoice_count").cast("long").alias("invoice_count"), "total_amount_paid"
    )
    claimed = marts.claim_totals(claims(spark, sf)).select(
        "policy_number", F.col("claim_count").cast("long").alias("claim_count"), "total_payable_amount"
    )
    return base.join(paid, "policy_number", "left").join(claimed, "policy_number", "left")


@query("j11_year_ago_per_product", sql(f"""
SELECT {dt('a.k')} AS month_start, a.product, CAST(a.issued AS INTEGER) AS policies_issued,
  {dt("CAST(a.k - INTERVAL 1 YEAR AS DATE)")} AS month_start_ly, CAST(b.issued AS INTEGER) AS policies_issued_ly
FROM product_issued a LEFT JOIN product_issued b
  ON b.k = CAST(a.k - INTERVAL 1 YEAR AS DATE) AND b.product = a.product"""))
def j11(spark, sf):
    keys = ["month_start", "product"]
    issued = marts.issued_by(marts.issued_rows(policies(spark, sf), "M", "month_start", ["product"]), keys)
    return with_last_year(issued, "month_start", ["product"], ["policies_issued"], always_dated=True)


@query("j12_year_ago_per_grain", sql(f"""
SELECT * REPLACE ({dt('period_start')} AS period_start, {dt('period_start_ly')} AS period_start_ly)
FROM rollups WHERE time_grain <> 'D'"""))
def j12(spark, sf):
    grains = marts.regrain(marts.daily(*inputs(spark, sf)), ["W", "M", "Q", "Y"])
    only = F.col("time_grain").isin(marts.YEAR_AGO_GRAINS)
    return with_last_year(grains, "period_start", ["time_grain"], marts.MEASURES, only=only)


@query("u2_distinct_key_union", sql(f"""
SELECT {dt('k')} AS month_start FROM (SELECT k FROM monthly_premium UNION SELECT k FROM monthly_issued
  UNION SELECT k FROM monthly_claims)"""))
def u2(spark, sf):
    return profile.union_distinct([f.select("month_start") for f in _three(spark, sf, "M", "month_start")])


@query("u4_union_of_grains", sql(f"SELECT time_grain, {dt('period_start')} AS period_start, {VALUES} FROM grains"))
def u4(spark, sf):
    return marts.regrain(marts.daily(*inputs(spark, sf)))


# Aggregates behind the marts

PREMIUM_SQL = f"CAST(payers AS INTEGER) AS policies_with_payment, {dbl('premium')} AS premium_received"
ISSUED_SQL = "CAST(issued AS INTEGER) AS policies_issued"
CLAIMS_SQL = f"CAST(claims AS INTEGER) AS claim_count, {dbl('paid')} AS claims_paid"


@query("a15_daily_premium", sql(f"SELECT {dt('k')} AS day_date, {PREMIUM_SQL} FROM daily_premium"))
def a15(spark, sf):
    rows = marts.premium_rows(invoices(spark, sf), policies(spark, sf), "D", "day_date")
    return marts.premium_by(rows, ["day_date"])


@query("a16_daily_issued", sql(f"SELECT {dt('k')} AS day_date, {ISSUED_SQL} FROM daily_issued"))
def a16(spark, sf):
    return marts.issued_by(marts.issued_rows(policies(spark, sf), "D", "day_date"), ["day_date"])


@query("a17_daily_claims", sql(f"SELECT {dt('k')} AS day_date, {CLAIMS_SQL} FROM daily_claims"))
def a17(spark, sf):
    return marts.claims_by(marts.claim_rows(claims(spark, sf), "D", "day_date"), ["day_date"])


@query("a18_mart_daily", sql(f"SELECT {dt('k')} AS day_date, {VALUES} FROM daily"))
def a18(spark, sf):
    return marts.daily(*inputs(spark, sf)).orderBy(F.asc_nulls_last("day_date"))


@query("a19_mart_monthly", sql(f"SELECT {dt('k')} AS month_start, {VALUES} FROM monthly"))
def a19(spark, sf):
    return marts.monthly(*inputs(spark, sf)).orderBy(F.asc_nulls_last("month_start"))


LY = ", ".join(f"b.{v} AS {v}_ly" for v in VALUES.split(", "))


@query("a20_mart_by_product", sql(f"""
SELECT {dt('a.k')} AS month_start, a.product, {', '.join('a.' + v for v in VALUES.split(', '))},
  {dt("CAST(a.k - INTERVAL 1 YEAR AS DATE)")} AS month_start_ly, {LY}
FROM product_month a LEFT JOIN product_month b ON b.k = CAST(a.k - INTERVAL 1 YEAR AS DATE) AND b.product = a.product"""))
def a20(spark, sf):
    return marts.by_product(*inputs(spark, sf)).orderBy(F.asc_nulls_last("month_start"), F.asc_nulls_last("product"))


@query("a21_mart_rollups", sql(f"""
SELECT * REPLACE ({dt('period_start')} AS period_start, {dt('period_start_ly')} AS period_start_ly) FROM rollups"""))
def a21(spark, sf):
    return marts.rollups(marts.daily(*inputs(spark, sf))).orderBy("time_grain", F.asc_nulls_last("period_start"))


@query("a22_new_vs_returning", sql(f"""
SELECT CASE policy_rank WHEN 1 THEN 'new' ELSE 'returning' END AS policy_type, CAST(count(*) AS INTEGER) AS policy_count,
  {div('sum(net)', 'count(net)', 2)} AS avg_net_premium, {dbl('sum(net)')} AS total_net_premium
FROM (SELECT policy_number, sum(pre_levy_amount) AS net FROM paid_invoice GROUP BY 1)
JOIN (SELECT policy_number, least(policy_rank, 2) AS policy_rank FROM ranked WHERE NOT is_outlier_user)
  USING (policy_number)
GROUP BY policy_rank"""))
def a22(spark, sf):
    return marts.new_vs_returning(invoices(spark, sf), marts.new_policies(policies(spark, sf)))


@query("a23_mart_policy_wide", sql(f"""
SELECT * REPLACE ({ts('issue_date')} AS issue_date, {ts('effective_date')} AS effective_date,
  {dt('insured_date_of_birth')} AS insured_date_of_birth, {dbl('total_pre_levy_amount')} AS total_pre_levy_amount,
  {dbl('total_amount_paid')} AS total_amount_paid, {dbl('total_billed_amount')} AS total_billed_amount,
  {dbl('total_payable_amount')} AS total_payable_amount)
FROM wide"""))
def a23(spark, sf):
    return marts.policy_wide(*inputs(spark, sf))


def _monthly_pieces():
    for key, name, values, at in (
        ("a28_monthly_premium", "monthly_premium", PREMIUM_SQL, 0),
        ("a28_monthly_issued", "monthly_issued", ISSUED_SQL, 1),
        ("a28_monthly_claims", "monthly_claims", CLAIMS_SQL, 2),
    ):
        query(key, sql(f"SELECT {dt('k')} AS month_start, {values} FROM {name}"))(
            lambda spark, sf, at=at: _three(spark, sf, "M", "month_start")[at]
        )
    for key, name, values, at in (
        ("a29_product_premium", "product_premium", PREMIUM_SQL, 0),
        ("a29_product_issued", "product_issued", ISSUED_SQL, 1),
        ("a29_product_claims", "product_claims", CLAIMS_SQL, 2),
    ):
        query(key, sql(f"SELECT {dt('k')} AS month_start, product, {values} FROM {name}"))(
            lambda spark, sf, at=at: _three(spark, sf, "M", "month_start", ["product"])[at]
        )


_monthly_pieces()


@query("a30_regrain_daily", sql(f"""
SELECT time_grain, {dt('period_start')} AS period_start, {VALUES} FROM grains WHERE time_grain <> 'D'"""))
def a30(spark, sf):
    return marts.regrain(marts.daily(*inputs(spark, sf)), ["W", "M", "Q", "Y"])


@query("a31_invoice_totals", sql(f"""
SELECT policy_number, CAST(invoice_count AS INTEGER) AS invoice_count,
  {dbl('total_pre_levy_amount')} AS total_pre_levy_amount, {dbl('total_amount_paid')} AS total_amount_paid
FROM (SELECT policy_number, count(*) AS invoice_count, sum(pre_levy_amount) AS total_pre_levy_amount,
    sum(total_amount) AS total_amount_paid
  FROM paid_invoice JOIN confirmed_policy USING (policy_number) GROUP BY 1)"""))
def a31(spark, sf):
    return marts.invoice_totals(confirmed_invoices(spark, sf))


@query("a32_claim_totals", sql(f"""
SELECT policy_number, CAST(claim_count AS INTEGER) AS claim_count,
  {dbl('total_billed_amount')} AS total_billed_amount, {dbl('total_payable_amount')} AS total_payable_amount
FROM claim_totals"""))
def a32(spark, sf):
    return marts.claim_totals(claims(spark, sf))


@query("a33_policies_per_user", sql("SELECT user_id, count(*) AS policy_count FROM raw_policy GROUP BY 1"))
def a33(spark, sf):
    return staging.policies_per_user(domain.raw_policy(spark, sf))
