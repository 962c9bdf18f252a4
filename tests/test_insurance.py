from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from harborline.operators.quality import ChecksFailed
from harborline.operators.ranking import rank_policies
from harborline.plans import build, marts, staging
from harborline.session import scratch

POLICY = """id string, policy_number string, user_id string, application_id string, product string, issue_date string,
  effective_date string, insured_gender string, insured_date_of_birth string"""
INVOICE = """id string, invoice_type string, policy_number string, coverage_start_date string, coverage_end_date string,
  due_date string, charge_date string, refund_date string, status string, pre_levy_amount string, total_amount string"""
CLAIM = """id string, type string, status string, policy_number string, submit_date string, payment_date string,
  admission_date string, total_billed_amount string, total_base_payable_amount string"""


def policy(number, user, day, product="Term"):
    return (number, number, user, "a", product, f"{day} 08:00:00+08", f"{day} 08:00:00+08", "F", "1990-01-01")


def invoice(i, number, day, amount, status="paid"):
    at = day and f"{day} 10:00:00+00"
    return (i, "new", number, at, at, at, at, None, status, amount, amount)


def claim(i, number, day, amount, status="paid"):
    at = day and f"{day} 10:00:00+00"
    return (i, "t", status, number, at, at, None, amount, amount)


@pytest.fixture(scope="module")
def raw(spark):
    policies = [
        policy("P1", "u1", "2023-01-05"),
        policy("P2", "u1", "2023-01-05"),  # same day: the policy number decides
        policy("P3", "u1", "2024-01-10"),
        policy("P4", "u2", "2024-01-15", "Life"),
        policy("P5", None, "2024-01-15"),
        policy("P6", None, "2024-02-01"),
        *[policy(f"Q{i}", "big", "2024-01-20") for i in range(4)],
    ]
    invoices = [
        invoice("i1", "P1", "2023-01-07", "100.00"),
        invoice("i2", "P1", "2023-01-07", "50.005"),
        invoice("i3", "P3", "2024-01-12", "200.00"),
        invoice("i4", "P4", None, "70.00"),  # paid without a charge date
        invoice("i5", "P4", "2024-01-12", "30.00", "open"),
        invoice("i6", "Q1", "2024-01-22", "999.00"),  # outlier user
        invoice("i7", "XX", "2024-01-12", "5.00"),  # no such policy
        invoice("i8", "P6", "2024-02-03", "40.00"),
    ]
    claims = [
        claim("c1", "P3", "2024-01-20", "80.00"),
        claim("c2", "Q1", "2024-01-25", "60.00"),  # claims of outlier users count
        claim("c3", "P4", None, "10.00"),
        claim("c4", "P4", "2024-01-30", "10.00", "open"),
        claim("c5", "XX", "2024-01-31", "1.00"),
    ]
    return {
        "raw_policy": spark.createDataFrame(policies, POLICY),
        "raw_invoice": spark.createDataFrame(invoices, INVOICE),
        "raw_claim": spark.createDataFrame(claims, CLAIM),
    }


@pytest.fixture(scope="module")
def models(raw):
    return build.build(raw, threshold=3)


def by_key(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_staging_casts_and_flags(models):
    p = by_key(models["stg_policy"].withColumn("day", F.to_date("effective_date")), "policy_number")
    assert p["P1"]["day"] == date(2023, 1, 5) and p["P1"]["insured_date_of_birth"] == date(1990, 1, 1)
    assert p["Q0"]["is_outlier_user"] is True and p["P1"]["is_outlier_user"] is False
    assert p["P5"]["is_outlier_user"] is False


def test_null_users_are_never_outliers(raw):
    flagged = staging.stg_policy(raw["raw_policy"], threshold=1)
    assert flagged.where("user_id IS NULL AND is_outlier_user").count() == 0
    assert flagged.where("user_id = 'u1' AND is_outlier_user").count() == 3


def test_orphan_invoices_are_dropped(models):
    assert {r["id"] for r in models["stg_invoice"].collect()} == {"i1", "i2", "i3", "i4", "i5", "i6", "i8"}
    amounts = by_key(models["stg_invoice"], "id")
    assert amounts["i2"]["pre_levy_amount"] == Decimal("50.005")


def test_rank_is_the_same_for_ordinary_and_heavy_users(models):
    ranked = by_key(rank_policies(models["stg_policy"]), "policy_number")
    assert [ranked[n]["policy_rank"] for n in ("P1", "P2", "P3", "P4", "P5", "P6")] == [1, 2, 3, 1, 1, 2]
    assert [ranked[f"Q{i}"]["policy_rank"] for i in range(4)] == [1, 2, 3, 4]
    assert ranked["P1"]["is_new_policy"] and not ranked["P2"]["is_new_policy"]
    assert len(ranked) == 10


def test_undated_policy_ranks_last(spark, models):
    undated = models["stg_policy"].where("policy_number = 'P1'").withColumn("effective_date", F.lit(None).cast("timestamp"))
    both = undated.unionByName(models["stg_policy"].where("policy_number = 'P2'"))
    ranks = by_key(rank_policies(both), "policy_number")
    assert ranks["P1"]["policy_rank"] == 2


def test_new_policies_agree_with_the_rank(raw, models, rows):
    marked = marts.new_policies(models["stg_policy"])
    ranked = models["int_policy_ranked"].select("policy_number", "is_outlier_user", "is_new_policy")
    assert rows(marked) == rows(ranked)


def test_new_against_returning(models):
    got = [tuple(r) for r in models["mart_new_vs_returning_premium"].collect()]
    # new: P1 150.005 and P4 70; returning: P3 200 and P6 40; rounded once, at the end
    assert got == [
        ("new", 2, Decimal("110.00"), Decimal("220.01")), ("returning", 2, Decimal("120.00"), Decimal("240.00"))
    ]


def test_daily_mart(models):
    d = by_key(models["mart_dashboard_daily"], "day_date")
    assert d[date(2023, 1, 7)]["premium_received"] == Decimal("150.01")
    assert d[date(2023, 1, 7)]["avg_premium_per_policy"] == Decimal("150.01")
    assert d[date(2024, 1, 25)]["claims_paid"] == Decimal("60.00")
    assert d[date(2024, 1, 25)]["loss_ratio"] is None
    assert d[date(2024, 1, 15)]["policies_issued"] == 2
    assert date(2024, 1, 22) not in d and None not in d
    assert d[date(2024, 1, 31)]["claim_count"] == 1  # a claim needs no known policy here


def test_undated_premium_makes_an_empty_null_month(models):
    m = by_key(models["mart_dashboard_monthly"], "month_start")
    assert None in m
    empty = m[None]
    assert empty["premium_received"] == 0 and empty["claim_count"] == 0
    assert empty["loss_ratio"] is None and empty["avg_premium_per_policy"] is None
    assert m[date(2024, 1, 1)]["premium_received"] == Decimal("200.00")
    assert m[date(2024, 1, 1)]["loss_ratio"] == Decimal("0.7050")  # 141 / 200


def test_product_mart_has_no_null_month_and_always_a_year_ago_date(models):
    p = by_key(models["mart_dashboard_by_product"], "month_start", "product")
    assert all(k[0] is not None for k in p)
    jan = p[(date(2024, 1, 1), "Term")]
    assert jan["premium_received_ly"] == Decimal("150.01") and jan["policies_issued_ly"] == 2
    assert p[(date(2024, 2, 1), "Term")]["month_start_ly"] == date(2023, 2, 1)
    assert p[(date(2024, 2, 1), "Term")]["premium_received_ly"] is None
    assert jan["claim_count"] == 2  # the claim without a policy has no product


def test_rollups(models):
    r = by_key(models["mart_dashboard_rollups"], "time_grain", "period_start")
    year = r[("Y", date(2024, 1, 1))]
    assert year["premium_received"] == Decimal("240.00") and year["premium_received_ly"] == Decimal("150.01")
    # per policy issued (4 of regular users in 2024), while the day grain divides by paying policies
    assert year["avg_premium_per_policy"] == Decimal("60.00")
    assert r[("D", date(2024, 1, 12))]["avg_premium_per_policy"] == Decimal("200.00")
    assert r[("D", date(2024, 1, 12))]["period_start_ly"] is None
    assert all(v["period_start_ly"] is None for k, v in r.items() if k[0] in "DW")
    assert ("W", date(2024, 1, 8)) in r
    months = sum(v["premium_received"] for k, v in r.items() if k[0] == "M")
    assert months == sum(v["premium_received"] for k, v in r.items() if k[0] == "D")


def test_wide_policy_counts_and_missing_amounts(models):
    w = by_key(models["mart_policy_denormalized"], "policy_number")
    assert len(w) == 10
    assert w["P2"]["invoice_count"] == 0 and w["P2"]["total_pre_levy_amount"] is None
    assert w["P4"]["claim_count"] == 2 and w["P4"]["total_payable_amount"] == Decimal("20.00")


def test_publish_writes_the_same_models(spark, raw, models, rows):
    stored = build.publish(spark, raw, scratch(spark, "publish-test"), threshold=3, check=False)
    for name in models:
        assert rows(stored[name].select(models[name].columns)) == rows(models[name]), name


def test_publish_stops_on_failing_checks(spark, raw):
    broken = {**raw, "raw_policy": raw["raw_policy"].union(raw["raw_policy"].where("policy_number = 'P4'"))}
    with pytest.raises(ChecksFailed, match="unique_stg_policy_policy_number: 1"):
        build.publish(spark, broken, scratch(spark, "publish-broken"), threshold=3)
