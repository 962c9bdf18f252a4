"""Profiling and quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline import domain
from harborline.catalog.insurance import claims, confirmed_invoices, invoices, policies
from harborline.catalog.registry import query
from harborline.catalog.sqltext import dbl, div, dt, sql
from harborline.operators import profile, quality
from harborline.operators.ranking import rank_policies
from harborline.plans import marts
from harborline.session import scratch


@query("a1_global_count", "SELECT count(*) AS record_count FROM lineitem")
def a1(spark, sf):
    return domain.table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("record_count"))


@query("a2_counts_and_distincts", sql("""
SELECT count(*) AS total_rows, count(DISTINCT policy_number) AS unique_policies, count(DISTINCT user_id) AS unique_users
FROM raw_policy"""))
def a2(spark, sf):
    return profile.profile_counts(domain.raw_policy(spark, sf), unique_policies="policy_number", unique_users="user_id")


def _stats(column: str, name: str) -> str:
    return f"""{dbl(f'min({column})')} AS min_{name}, {div(f'sum({column})', f'count({column})', 2)} AS avg_{name},
  {dbl(f'max({column})')} AS max_{name}"""


@query("a3_amount_stats", sql(f"""
SELECT {_stats('pre_levy_amount', 'pre_levy')}, {_stats('total_amount', 'total')} FROM raw_invoice"""))
def a3(spark, sf):
    return profile.amount_stats(invoices(spark, sf), {"pre_levy_amount": "pre_levy", "total_amount": "total"})


@query("a3_claim_stats", sql(f"""
SELECT {_stats('total_billed_amount', 'billed')}, {_stats('total_base_payable_amount', 'payable')} FROM raw_claim"""))
def a3_claims(spark, sf):
    return profile.amount_stats(
        claims(spark, sf), {"total_billed_amount": "billed", "total_base_payable_amount": "payable"}
    )


def _range(column: str, name: str) -> str:
    return f"{dt(f'min({column})')} AS earliest_{name}, {dt(f'max({column})')} AS latest_{name}"


@query("a4_date_ranges", sql(f"""
SELECT {_range('charge_date', 'invoice')}, {_range('due_date', 'due')}, {_range('refund_date', 'refund')}
FROM raw_invoice"""))
def a4(spark, sf):
    return profile.ranges(invoices(spark, sf), {"charge_date": "invoice", "due_date": "due", "refund_date": "refund"})


@query("a5_frequency", sql("SELECT status, count(*) AS cnt FROM raw_invoice GROUP BY 1"))
def a5(spark, sf):
    return profile.frequency(domain.raw_invoice(spark, sf), "status")


@query("a6_histogram_of_counts", sql("""
SELECT rows_per_key, count(*) AS key_count FROM (SELECT count(*) AS rows_per_key FROM raw_policy GROUP BY user_id)
GROUP BY 1"""))
def a6(spark, sf):
    return profile.histogram_of_counts(domain.raw_policy(spark, sf), "user_id")


@query("a7_bucketed_counts", sql("""
SELECT CASE WHEN n = 1 THEN 'single_policy' ELSE 'multi_policy' END AS user_type, count(*) AS user_count
FROM (SELECT count(*) AS n FROM raw_policy GROUP BY user_id) GROUP BY 1"""))
def a7(spark, sf):
    return profile.bucketed_counts(domain.raw_policy(spark, sf), "user_id")


_INVOICE_COLUMNS = (
    "id invoice_type policy_number coverage_start_date coverage_end_date due_date status pre_levy_amount total_amount "
    "refund_date charge_date"
).split()


@query("a8_null_counts", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM raw_invoice" for c in _INVOICE_COLUMNS
)))
def a8(spark, sf):
    return profile.null_counts(domain.raw_invoice(spark, sf))


@query("a9_coverage", sql("""
SELECT (SELECT count(DISTINCT policy_number) FROM raw_policy) AS total_policies,
  (SELECT count(DISTINCT policy_number) FROM raw_invoice) AS policies_with_invoices,
  (SELECT count(DISTINCT policy_number) FROM raw_claim) AS policies_with_claims"""))
def a9(spark, sf):
    return profile.coverage(
        {
            "total_policies": domain.raw_policy(spark, sf),
            "policies_with_invoices": domain.raw_invoice(spark, sf),
            "policies_with_claims": domain.raw_claim(spark, sf),
        },
        "policy_number",
    )


_ORPHAN = "SELECT '{0}' AS source, count(*) AS orphan_count FROM raw_{0} WHERE policy_number NOT IN (FROM confirmed_policy)"


@query("a10_orphan_report", sql(f"{_ORPHAN.format('invoice')} UNION ALL {_ORPHAN.format('claim')}"))
def a10(spark, sf):
    return profile.orphan_report(
        {"invoice": domain.raw_invoice(spark, sf), "claim": domain.raw_claim(spark, sf)},
        domain.confirmed_policy(spark, sf), "policy_number",
    )


@query("u3_labelled_union", sql("""
SELECT 'policy' AS source, count(*) AS n FROM raw_policy UNION ALL SELECT 'invoice', count(*) FROM raw_invoice
UNION ALL SELECT 'claim', count(*) FROM raw_claim"""))
def u3(spark, sf):
    frames = {"policy": domain.raw_policy, "invoice": domain.raw_invoice, "claim": domain.raw_claim}
    return profile.stack({n: f(spark, sf).agg(F.count(F.lit(1)).alias("n")) for n, f in frames.items()}, "source")


@query("p19_shape", sql(" UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS type, (SELECT count(*) FROM raw_claim) AS rows"
    for i, (c, t) in enumerate([
        ("id", "string"), ("type", "string"), ("status", "string"), ("policy_number", "bigint"),
        ("submit_date", "timestamp"), ("payment_date", "timestamp"), ("admission_date", "date"),
        ("total_billed_amount", "decimal(38,9)"), ("total_base_payable_amount", "decimal(38,9)"),
    ])
)))
def p19(spark, sf):
    return profile.shape(claims(spark, sf))


@query("t6k_first_rows", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5")
def t6k(spark, sf):
    return domain.table(spark, sf, "orders").select("o_orderkey", "o_custkey").orderBy("o_orderkey").limit(5)


# Quality


@query("q1_unique", sql("""
SELECT policy_number, count(*) AS n_records FROM raw_invoice WHERE policy_number IS NOT NULL GROUP BY 1
HAVING count(*) > 1"""))
def q1(spark, sf):
    return quality.unique(domain.raw_invoice(spark, sf), "policy_number")


@query("q2_not_null", sql("SELECT id, policy_number FROM raw_invoice WHERE charge_date IS NULL"))
def q2(spark, sf):
    return quality.not_null(domain.raw_invoice(spark, sf), "charge_date").select("id", "policy_number")


@query("q3_references", sql("""
SELECT id, policy_number FROM raw_claim WHERE policy_number NOT IN (FROM confirmed_policy)"""))
def q3(spark, sf):
    rows = domain.raw_claim(spark, sf).select("id", "policy_number")
    return quality.references(rows, "policy_number", domain.confirmed_policy(spark, sf), "policy_number")


@query("q4_accepted_values", sql("SELECT id, status FROM raw_invoice WHERE status NOT IN ('paid', 'open')"))
def q4(spark, sf):
    return quality.accepted(domain.raw_invoice(spark, sf).select("id", "status"), "status", ["paid", "open"])


def _duplicates(table: str, column: str) -> str:
    return f"(SELECT count(*) FROM (SELECT 1 FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1))"


def _nulls(table: str, column: str) -> str:
    return f"(SELECT count(*) FROM {table} WHERE {column} IS NULL)"


_TABLE_OF = {
    "stg_policy": "stg_policy", "stg_invoice": "confirmed_invoice", "stg_claim": "raw_claim", "int_policy_ranked": "ranked",
    "int_invoice_paid": "(SELECT * FROM confirmed_invoice WHERE status = 'paid')", "mart_policy_denormalized": "wide",
}


@query("q5_check_suite", sql(" UNION ALL ".join(
    f"SELECT '{kind}_{model}_{column}' AS \"check\", "
    f"{(_duplicates if kind == 'unique' else _nulls)(_TABLE_OF[model], column)} AS failures"
    for model, columns in quality.DECLARED.items() for column, kinds in columns.items() for kind in kinds
), confirmed_invoice="SELECT raw_invoice.* FROM raw_invoice JOIN confirmed_policy USING (policy_number)"))
def q5(spark, sf):
    def staged(name, df):  # a model is read once for each of its keys, so staging is typed once
        path = scratch(spark, f"q5-{name}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    p, i = staged("policy", policies(spark, sf)), staged("invoice", confirmed_invoices(spark, sf))
    c = staged("claim", claims(spark, sf))
    models = {
        "stg_policy": p, "stg_invoice": i, "stg_claim": c, "int_policy_ranked": rank_policies(p),
        "int_invoice_paid": i.where("status = 'paid'"), "mart_policy_denormalized": marts.policy_wide(p, i, c),
    }
    return quality.run_declared(models, quality.PART_OF)
