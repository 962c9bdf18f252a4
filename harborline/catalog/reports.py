"""Whole builds, guarded SQL, dashboard metrics, document chunks and nearest vectors."""

from __future__ import annotations

import functools
from datetime import date

from pyspark.sql import functions as F

from harborline import domain
from harborline.catalog import insurance
from harborline.catalog.loads import _name
from harborline.catalog.registry import query
from harborline.catalog.sqltext import THRESHOLD, VALUES, dbl, div, dt, sql
from harborline.operators import retrieval
from harborline.plans import adhoc, build, dashboard, loads, marts, staging, trips
from harborline.session import scratch
from harborline.sinks import tables

AS_OF = date(2000, 5, 17)


def raw(spark, sf):
    return {
        "raw_policy": domain.raw_policy(spark, sf),
        "raw_invoice": domain.raw_invoice(spark, sf),
        "raw_claim": domain.raw_claim(spark, sf),
    }


def wide(spark, sf):
    return marts.policy_wide(*insurance.inputs(spark, sf))


def days(spark, sf):
    return marts.daily(*insurance.inputs(spark, sf))


_MODEL_TABLES = {
    "stg_policy": "stg_policy", "stg_invoice": "stg_invoice", "stg_claim": "raw_claim",
    "int_invoice_paid": "paid_invoice", "int_policy_ranked": "ranked",
    "mart_new_vs_returning_premium": """(SELECT DISTINCT policy_rank = 1 FROM ranked
      WHERE NOT is_outlier_user AND policy_number IN (SELECT policy_number FROM paid_invoice))""",
    "mart_policy_denormalized": "wide", "mart_dashboard_daily": "daily", "mart_dashboard_monthly": "monthly",
    "mart_dashboard_by_product": "product_month", "mart_dashboard_rollups": "rollups",
}


@query("g1_layered_build", sql(" UNION ALL ".join(
    f"SELECT '{model}' AS model, count(*) AS row_count FROM {source}" for model, source in _MODEL_TABLES.items()
)))
def g1(spark, sf):
    models = build.publish(spark, raw(spark, sf), scratch(spark, "g1"), THRESHOLD)
    return build.model_rows(models)


_MART_KEYS = {
    "mart_dashboard_daily": ("daily", dt("k"), "''"), "mart_dashboard_monthly": ("monthly", dt("k"), "''"),
    "mart_dashboard_by_product": ("product_month", dt("k"), "product"),
    "mart_dashboard_rollups": ("rollups", dt("period_start"), "time_grain"),
}


@query("g1_published_marts", sql(" UNION ALL ".join(
    f"SELECT '{model}' AS model, {period} AS period, {part} AS part, {VALUES} FROM {source}"
    for model, (source, period, part) in _MART_KEYS.items()
)))
def g1_marts(spark, sf):
    base = scratch(spark, "g1-marts")
    build.publish(spark, raw(spark, sf), base, THRESHOLD)
    models = build.published(spark, base)
    keys = {"mart_dashboard_daily": ("day_date", F.lit("")), "mart_dashboard_monthly": ("month_start", F.lit("")),
            "mart_dashboard_by_product": ("month_start", F.col("product")),
            "mart_dashboard_rollups": ("period_start", F.col("time_grain"))}
    parts = [
        models[m].select(F.lit(m).alias("model"), F.date_format(period, "yyyy-MM-dd").alias("period"), part.alias("part"),
                         *marts.MEASURES)
        for m, (period, part) in keys.items()
    ]
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


@query("g4_branch_by_kind", sql("""
SELECT 'yellow' AS kind, count(*) AS n FROM stg_yellow UNION ALL SELECT 'green', count(*) FROM stg_green"""))
def g4(spark, sf):
    stage = {"yellow": (domain.yellow_trips, trips.stg_yellow), "green": (domain.green_trips, trips.stg_green)}
    rows = F.count(F.lit(1)).alias("n")
    yellow, green = (
        staged(read(spark, sf)).agg(rows).select(F.lit(kind).alias("kind"), "n")
        for kind, (read, staged) in ((k, stage[k]) for k in loads.KINDS)
    )
    return yellow.unionByName(green)


@query("g5_layer_routing", sql("""
SELECT 'intermediate' AS layer, count(*) AS n FROM paid_invoice JOIN confirmed_policy USING (policy_number) UNION ALL SELECT 'marts', count(*) FROM daily"""))
def g5(spark, sf):
    models = {"int_invoice_paid": staging.paid(insurance.confirmed_invoices(spark, sf)),
              "mart_dashboard_daily": days(spark, sf)}
    parts = []
    for model, df in models.items():
        layer = tables.layer_name(build.LAYERS.get(model))
        database = _name(layer)
        tables.create_layer(spark, database, scratch(spark, "g5"))
        tables.materialise(df, f"{database}.{model}", as_table=True)
        rows = spark.table(f"{database}.{model}").agg(F.count(F.lit(1)).alias("n"))
        parts.append(rows.select(F.lit(layer).alias("layer"), "n"))
    return parts[0].unionByName(parts[1])


@query("g6_readonly_sql", sql(f"""
SELECT product, count(*) AS policies, CAST(sum(claim_count) AS BIGINT) AS claims FROM wide GROUP BY 1"""))
def g6(spark, sf):
    view = _name("mart_policy_denormalized")
    wide(spark, sf).createOrReplaceTempView(view)
    text = f"SELECT product, count(*) AS policies, sum(claim_count) AS claims FROM {view} GROUP BY product ORDER BY 1;"
    return adhoc.readonly_sql(spark, text, views=[view])


# Dashboard metrics

_BOUNDS = {
    "last_7_days": ("DATE '2000-05-11'", "DATE '2000-05-17'"), "last_30_days": ("DATE '2000-04-18'", "DATE '2000-05-17'"),
    "week_to_date": ("DATE '2000-05-15'", "DATE '2000-05-17'"), "month_to_date": ("DATE '2000-05-01'", "DATE '2000-05-17'"),
}


def _window_sql(name: str, first: str, last: str) -> str:
    def part(suffix: str, shift: str) -> str:
        hit = f"FILTER (k BETWEEN {first}{shift} AND {last}{shift})"
        premium, paid = f"coalesce(sum(premium_exact) {hit}, 0)", f"coalesce(sum(paid_exact) {hit}, 0)"
        return f"""{dbl(premium)} AS premium_received{suffix}, {dbl(paid)} AS claims_paid{suffix},
  CAST(coalesce(sum(policies_issued) {hit}, 0) AS BIGINT) AS policies_issued{suffix},
  CAST(coalesce(sum(claim_count) {hit}, 0) AS BIGINT) AS claim_count{suffix},
  {div(paid, premium, 4)} AS loss_ratio{suffix}"""

    return f"SELECT '{name}' AS \"window\", {part('', '')}, {part('_ly', ' - INTERVAL 1 YEAR')} FROM daily"


@query("d1_period_summary", sql(" UNION ALL ".join(_window_sql(n, a, b) for n, (a, b) in _BOUNDS.items())))
def d1(spark, sf):
    return dashboard.period_summary(days(spark, sf), AS_OF)


@query("d2_yoy_growth", sql(f"""
SELECT time_grain, {dt('period_start')} AS period_start, {dbl('premium_received')} AS premium_received,
  policies_issued, {dbl('claims_paid')} AS claims_paid, claim_count, {', '.join(f"{div(f'(({c} - {c}_ly) * 100)', f'{c}_ly', 2)} AS {c}_growth_pct" for c in dashboard.SUMS)}
FROM (SELECT * REPLACE ({', '.join(f'CAST({c} AS DECIMAL(20,2)) AS {c}, CAST({c}_ly AS DECIMAL(20,2)) AS {c}_ly'
                                   for c in ('premium_received', 'claims_paid'))}) FROM rollups)
WHERE time_grain IN ('Q', 'Y')"""))
def d2(spark, sf):
    return dashboard.yoy_table(marts.rollups(days(spark, sf)))


@query("d3_claims_overview", sql(f"""
SELECT policies, policies_with_claims, claims, {dbl('billed')} AS billed, {dbl('payable')} AS payable,
  {dbl('billed - payable')} AS out_of_pocket, {div('payable', 'billed', 4)} AS coverage_ratio,
  {div('policies_with_claims', 'policies', 4)} AS claim_rate,
  {div('claims', 'policies_with_claims', 4)} AS claim_frequency
FROM (SELECT count(*) AS policies, count(*) FILTER (claim_count > 0) AS policies_with_claims,
  CAST(sum(claim_count) AS BIGINT) AS claims, sum(total_billed_amount) AS billed, sum(total_payable_amount) AS payable
  FROM wide)"""))
def d3(spark, sf):
    return dashboard.claims_overview(wide(spark, sf))


@query("d4_costliest_policies", sql(f"""
SELECT policy_number, product, claim_count, {dbl('total_billed_amount')} AS total_billed_amount,
  {dbl('total_payable_amount')} AS total_payable_amount
FROM wide WHERE total_payable_amount IS NOT NULL ORDER BY wide.total_payable_amount DESC, policy_number LIMIT 10"""))
def d4(spark, sf):
    return dashboard.costliest_policies(wide(spark, sf), 10)


_PROFIT = """coalesce(sum(total_pre_levy_amount), 0) AS premium, coalesce(sum(total_payable_amount), 0) AS payable"""


@query("d5_product_profit", sql(f"""
SELECT product, {dbl('premium')} AS premium, {dbl('payable')} AS payable, {dbl('premium - payable')} AS profit,
  {div('payable', 'premium', 4)} AS loss_ratio FROM (SELECT product, {_PROFIT} FROM wide GROUP BY 1)"""))
def d5(spark, sf):
    return dashboard.product_profit(wide(spark, sf))


_AGE = "CAST(date_diff('year', insured_date_of_birth, DATE '2000-05-17') - CASE WHEN strftime(insured_date_of_birth, '%m%d') > '0517' THEN 1 ELSE 0 END AS INTEGER)"
_BAND = "CASE " + " ".join(
    f"WHEN {_AGE} >= {low} THEN '{name}'" for low, name in reversed(dashboard.AGE_BANDS)
) + " END"


@query("d6_age_profile", sql(f"""
SELECT age_group, policies, {dbl('premium')} AS premium, {dbl('payable')} AS payable,
  {div('payable', 'premium', 4)} AS loss_ratio
FROM (SELECT {_BAND} AS age_group, count(*) AS policies, {_PROFIT} FROM wide GROUP BY 1)"""))
def d6(spark, sf):
    return dashboard.age_profile(wide(spark, sf), AS_OF)


@query("d7_revenue_per_invoice", sql(f"""
SELECT product, invoices, {dbl('revenue')} AS revenue, {div('revenue', 'invoices', 2)} AS revenue_per_invoice
FROM (SELECT product, CAST(sum(invoice_count) AS BIGINT) AS invoices, coalesce(sum(total_amount_paid), 0) AS revenue
  FROM wide GROUP BY 1)"""))
def d7(spark, sf):
    return dashboard.revenue_per_invoice(wide(spark, sf))


@query("d7_product_gender", sql("""
SELECT product, count(*) FILTER (insured_gender = 'F') AS policies_f, count(*) FILTER (insured_gender = 'M') AS policies_m,
  count(*) FILTER (insured_gender IS NULL) AS policies_unknown FROM wide GROUP BY 1"""))
def d7_gender(spark, sf):
    return dashboard.product_gender(wide(spark, sf))


@query("d8_alerts", sql(f"""
SELECT time_grain, {dt('period_start')} AS period_start, {VALUES} FROM rollups
WHERE time_grain = 'W' AND loss_ratio > 0.8"""))
def d8(spark, sf):
    return dashboard.alerts(marts.rollups(days(spark, sf)), "W", 0.8)


# Documents and vectors

SIZE, OVERLAP = 200, 40


@query("g9_document_chunks", f"""
WITH words AS (
  SELECT doc_id, string_split(trim(regexp_replace(text, '[ \\t\\r\\n]+', ' ', 'g'), ' '), ' ') AS w FROM documents),
parts AS (
  SELECT doc_id, w,
    unnest(range(0, 1 + greatest(0, CAST(ceil((len(w) - {SIZE}) / {SIZE - OVERLAP}.0) AS BIGINT)))) AS chunk_no
  FROM words)
SELECT doc_id, CAST(chunk_no AS INTEGER) AS chunk_no,
  array_to_string(w[chunk_no * {SIZE - OVERLAP} + 1 : chunk_no * {SIZE - OVERLAP} + {SIZE}], ' ') AS text
FROM parts""")
def g9(spark, sf):
    return retrieval.chunk(domain.table(spark, sf, "documents"), SIZE, OVERLAP)


@query("g10_nearest_vectors", """
SELECT query_id, vec_id, round(s, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM (
  SELECT q.vec_id AS query_id, v.vec_id AS vec_id,
    list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) AS s,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY s DESC, v.vec_id) AS rank
  FROM embeddings v, embeddings q WHERE q.vec_id < 5) WHERE rank <= 5""")
def g10(spark, sf):
    vectors = domain.table(spark, sf, "embeddings")
    found = retrieval.top_k(vectors, vectors.where(F.col("vec_id") < 5), 5)
    return found.select("query_id", "vec_id", F.round("similarity", 6).alias("similarity"), "rank")


@query("g10_inverted_file", """
SELECT count(*) FILTER (vec_id % 20 = 0) AS queries, true AS reached, count(*) AS indexed FROM embeddings""")
def g10_index(spark, sf):
    # every twentieth vector is looked up among all, and the answers are held against the exact ones
    vectors, path = domain.table(spark, sf, "embeddings"), scratch(spark, "g10-index")
    asked = vectors.where(F.col("vec_id") % 20 == 0)
    retrieval.build_index(vectors, path)
    found = retrieval.search_index(spark, path, asked, 10, probes=96)
    told = retrieval.recall(found, retrieval.top_k(vectors, asked, 10, query_rows=4096))
    held = spark.read.parquet(f"{path}/lists").agg(F.sum(F.size("v_rows")).cast("bigint").alias("indexed"))
    one = F.lit(1).alias("k")
    return told.select("queries", (F.col("recall") >= 0.9).alias("reached"), one).join(held.select("indexed", one), "k").drop("k")
